"""Category rule tables for the annual-measures programme (install claims).

Fixed values: every pattern, value list and result text below must equal the
source programme's. Rule order matters (first match wins); "ERROR" results are
what the quality gates look for. Column names are the landed (renamed) claim
columns: house_type, tenure_raw, year_built, year_built_num, bedrooms_raw,
wall_category, wall_type, loft_depth, fuel_before, fuel_after, heating_after.
"""

from __future__ import annotations

ERROR = "ERROR"

PROPERTY_TYPE = [
    (("lower=", "house_type", "bungalow"), "Bungalow (Unknown Detachment)"),
    (("lower_in", "house_type", ["detached", "detached bungalow", "detached house"]),
     "Detached House / Bungalow"),
    (("~", "house_type", "(?i)flat|maisonette|apartment"), "Flat / Maisonette"),
    (("~", "house_type", r"(?i)end\s*-?\s*(terrace|teracced|detached)"), "End Terrace House / Bungalow"),
    (("~", "house_type", r"(?i)mid\s*-?\s*terrace|terrace[d]?\s*house"), "Mid Terrace House / Bungalow"),
    (("~", "house_type", r"(?i)sem[i]?\s*-?\s*detach"), "Semi Detached House / Bungalow"),
    (("or", ("in", "house_type", ["N/A", "0", ""]), ("null", "house_type")), "Unknown Property Type"),
]

TENURE = [
    (("~", "tenure_raw", "(?i)owner"), "Owner Occupied"),
    (("~", "tenure_raw", r"(?i)housing assoc|H\.A\.|social housing"), "Rented from Housing Association"),
    (("~", "tenure_raw", "(?i)private|landlord"), "Privately Rented"),
    (("or", ("lower_in", "tenure_raw", ["n/a", "0", "", "other"]), ("null", "tenure_raw")),
     "Unknown Tenure"),
]


def _band(lo, hi, texts, lo_strict=False, hi_strict=False):
    lo_op = ">" if lo_strict else ">="
    hi_op = "<" if hi_strict else "<="
    num = ("and", (lo_op, "year_built_num", lo), (hi_op, "year_built_num", hi))
    if not texts:
        return num
    return ("or", num, ("lower_in", "year_built", texts))


PROPERTY_AGE = [
    (("or", ("<", "year_built_num", 1600),
      ("lower_in", "year_built", ["after 1995", "01 after 1995", "", " ", "post-1976", "pre 1976",
                                  "1950/1990", "1980's/1990's", "1915/1990", "unknown"]),
      ("null", "year_built")), "Unknown Property Age"),
    (_band(1600, 1900, ["pre-1900", "09 before 1900", "pre 1900", "1700's", "1800's", "pre-1930's",
                        "1850's", "before 1900", "pre-1900's", "1800's/1961 (extension)",
                        "1800's/1996 (renovated)"], lo_strict=True, hi_strict=True), "Built Pre-1900"),
    (_band(1900, 1929, ["08 1900-1929", "1900-1929", "1900's", "1920's"]), "Built 1900-1929"),
    (_band(1930, 1949, ["1930's", "07 1930-1949", "1930-1949", "1940's"]), "Built 1930-1949"),
    (_band(1950, 1966, ["1950's", "1950s", "06 1950-1965", "1960's", "1950-1965", "1950-60", "1960s"]),
     "Built 1950-1966"),
    (_band(1967, 1975, ["1966-1976", "1970's", "1960's", "05 1966-1976", "1970s"]), "Built 1967-1975"),
    (_band(1976, 1982, ["1977-1981", "04 1977-1981"]), "Built 1976-1982"),
    (_band(1983, 1990, ["1982-1990", "1980s", "1980's", "03 1982-1990"]), "Built 1983-1990"),
    (_band(1991, 1995, ["1990's", "1990s", "02 1991-1995"]), "Built 1991-1995"),
    (_band(1996, 2002, []), "Built 1996-2002"),
    (_band(2003, 2006, ["2000's"]), "Built 2003-2006"),
    ((">=", "year_built_num", 2006), "Built Post-2006"),
]

BEDROOMS = [
    (("=", "bedrooms_raw", "1"), "1"),
    (("=", "bedrooms_raw", "2"), "2"),
    (("=", "bedrooms_raw", "3"), "3"),
    (("=", "bedrooms_raw", "4"), "4"),
    (("in", "bedrooms_raw", ["5", "5+", "5=", "4 PLUS", "4+", "6", "7", "8", "9", "10"]), "5+"),
    (("or", ("null", "bedrooms_raw"), ("in", "bedrooms_raw", ["0", "N/A", "", " "])), "Unknown"),
]

EXTERNAL_WALL_TYPE = [(("~", "wall_category", "(?i)cavity"), "Cavity Wall Filled")]
EXTERNAL_WALL_TYPE_DEFAULT = "Unknown Insulation"

AGE_PRE_1976 = ["Built 1900-1929", "Built 1930-1949", "Built 1950-1966", "Built 1967-1975",
                "Built Pre-1900"]
AGE_POST_1976 = ["Built 1976-1982", "Built 1983-1990", "Built 1991-1995", "Built 1996-2002",
                 "Built 2003-2006", "Built Post-2006"]

WALL_INSULATION = [
    (("and", ("in", "PROPERTY_AGE", AGE_PRE_1976), ("~", "wall_category", "(?i)cavity")),
     "Cavity Wall Insulation (Pre-1976)"),
    (("and", ("in", "PROPERTY_AGE", AGE_POST_1976), ("~", "wall_category", "(?i)cavity")),
     "Cavity Wall Insulation (Post-1976)"),
    (("~", "wall_category", "(?i)cavity"), "Cavity Wall Insulation (Unknown Property Age)"),
    (("~", "wall_category", "(?i)solid|std|external"), "Solid Wall Insulation"),
    (("or", ("null", "wall_category"), ("=", "wall_category", "N/A")), "Unknown"),
]

WALL_FILL = [
    (("~", "wall_type", "(?i)full|refill"), "Full"),
    (("~", "wall_type", "(?i)partial"), "Partial"),
    (("~", "wall_type", "(?i)solid|external"), "Unknown Fill"),
    (("or", ("null", "wall_type"), ("lower_in", "wall_type", ["unknown", "n/a", "", " "])),
     "Unknown Fill"),
]

LOFT_REGIONAL = [
    (("in", "loft_depth", ["Loft insulation 0-300mm", "Loft Insulation 0-300mm",
                           "Loft Insulation 0 - 300mm", "Loft Insulation 000 - 300mm",
                           "Loft Insulation 0.-300mm"]), "Loft Insulation 0 - 300mm"),
    (("in", "loft_depth", ["Loft Insulation 25 - 300mm", "Loft Insulation 25-300mm"]),
     "Loft Insulation 25 - 300mm"),
    (("in", "loft_depth", ["Loft Insulation 50-300mm", "Loft Insulation 50 - 300mm"]),
     "Loft Insulation 50 - 300mm"),
    (("in", "loft_depth", ["Loft Insulation 100-300mm", "Loft Insulation 100 - 300mm",
                           "Loft Insulation 100 -  300mm", "loft insulation 100-300 mm"]),
     "Loft Insulation 100 - 300mm"),
    (("in", "loft_depth", ["Loft Insulation 150-300mm", "Loft Insulation 150 - 300mm", "150-300mm"]),
     "Loft Insulation 150 - 300mm"),
    (("in", "loft_depth", ["Loft Insulation 200- 300mm", "Loft Insulation 200-300mm",
                           "Loft Insulation 200 -  300mm", "Loft Insulation 200mm"]),
     "Loft Insulation 200 - 300mm"),
    (("null", "loft_depth"), "Unknown"),
]

LOFT_NATIONAL = [
    (("in", "loft_depth", ["Loft Insulation 0 - 270mm", "Loft Insulation 25 - 270mm",
                           "Loft Insulation 50 - 270mm"]), "Loft Insulation 0 - 270mm"),
    (("=", "loft_depth", "Loft Insulation 100 - 270mm"), "Loft Insulation 100 - 270mm"),
    (("in", "loft_depth", ["Loft Insulation 100 - 300mm", "Loft Insulation 100 - 300 mm",
                           "Loft Insulation 100 -300mm", "Loft Insulation 100-300mm",
                           "Loft Insulation 150-300mm", "Loft Insulation 200- 300mm",
                           "Loft Insulation 200-300mm"]), "Loft Insulation 100-300mm"),
    (("in", "loft_depth", ["Loft Insulation 0-300mm", "Loft Insulation 50-300mm"]),
     "Loft Insulation 0 - 300mm"),
    (("null", "loft_depth"), "Unknown"),
]

_NO_HEAT = ["no heating", "no heat", "no available heat source", "", " ", "N/A"]


def _fuel(col: str, heat_pump_col: str | None = None):
    electric = ("~", col, "(?i)Electric|e7|economy 7")
    if heat_pump_col:
        electric = ("or", electric, ("~", heat_pump_col, "(?i)heat pump"))
    return [
        (("~", col, "(?i)biomass|solid|smokeless|coal"), "Solid Fuel"),
        (electric, "Electric"),
        (("~", col, "(?i)lpg"), "LPG"),
        (("~", col, "(?i)gas"), "Gas"),
        (("~", col, r"(?i)\boil\b"), "Oil"),
        (("or", ("lower_in", col, _NO_HEAT), ("null", col)), "Unknown Heating Type"),
    ]


FUEL_BEFORE = _fuel("fuel_before")
FUEL_AFTER = _fuel("fuel_after", heat_pump_col="heating_after")

HEATING_SYSTEM = [
    (("and", ("~", "heating_after", "(?i)combination|combi"), ("~", "heating_after", "(?i)boiler")),
     "Condensing Combination Boiler"),
    (("and", ("~", "heating_after", "(?i)conventional"), ("~", "heating_after", "(?i)boiler")),
     "Condensing Regular Boiler"),
    (("~", "heating_after", "(?i)high heat retention|electric storage"), "Electric Storage Heater"),
    (("~", "heating_after", "(?i)system"), "System Boiler"),
    (("~", "heating_after", "(?i)air source"), "Air Source Heat Pump"),
    (("null", "heating_after"), "Unknown Heating Type"),
]

# Add-on measures, (amount column, present, absent).
ADDON_FLAGS = {
    "HOT_WATER_TANK_INSULATION": ("cost_hot_water_jacket", "Hot Water Tank Insulation",
                                  "Unknown Hot Water Tank Insulation"),
    "RADIATOR_PANELS": ("cost_radiator_panels", "Radiator Panels", "Unknown Radiator Panels"),
    "LIGHTING": ("bulbs_installed", "LEDs", "Unknown"),
    "ENERGY_MONITOR": ("cost_smart_controls", "Energy Monitor", "Unknown"),
    "WATER_WIDGET": ("cost_water_widget", "Water Widget", "Unknown"),
}

# Measure columns unpivoted, in order.
MEASURE_COLUMNS = [
    "HOT_WATER_TANK_INSULATION", "WATER_WIDGET", "ENERGY_MONITOR", "LIGHTING",
    "RADIATOR_PANELS", "MAIN_HEATING_SYSTEM", "LOFT_INSULATION_NI", "WALL_INS",
]

MEASURE_GROUP = [
    (("~", "MEASURE", "(?i)unknown"), "Unknown"),
    (("~", "MEASURE", "(?i)boiler|retention|storage|heat pump|radiator"), "Heating"),
    (("~", "MEASURE", "(?i)insulation"), "Insulation"),
    (("~", "MEASURE", r"(?i)\bleds\b"), "Lighting"),
    (("~", "MEASURE", "(?i)water widget"), "Appliances"),
    (("~", "MEASURE", "(?i)energy monitor"), "Other"),
]

# District code -> name; anything else (NULL included) Unknown.
DISTRICTS = [
    ("N09000001", "Antrim and Newtownabbey"),
    ("N09000002", "Armagh City, Banbridge and Craigavon"),
    ("N09000003", "Belfast"),
    ("N09000004", "Causeway Coast and Glens"),
    ("N09000005", "Derry City and Strabane"),
    ("N09000006", "Fermanagh and Omagh"),
    ("N09000007", "Lisburn and Castlereagh"),
    ("N09000008", "Mid and East Antrim"),
    ("N09000009", "Mid Ulster"),
    ("N09000010", "Newry, Mourne and Down"),
    ("N09000011", "Ards and North Down"),
]
DISTRICT_UNKNOWN = "Unknown"
POSTCODE_PREFIX = "BT"

# Raw claim headers -> landed column names.
CLAIM_COLUMNS = {
    "Remove": "remove_marker",
    "Duplicate address check": "duplicate_address",
    "Postcode": "Postcode",
    "House type": "house_type",
    "Tenure": "tenure_raw",
    "Year built": "year_built",
    "No. bedrooms": "bedrooms_raw",
    "Wall Insulation Category": "wall_category",
    "Wall insulation type": "wall_type",
    "Predominant LI - depth": "loft_depth",
    "Fuel type before install": "fuel_before",
    "New fuel type installed": "fuel_after",
    "New heating type installed": "heating_after",
    "Total cost H.W.T. J (£)": "cost_hot_water_jacket",
    "Total cost reflective radiator panels (£)": "cost_radiator_panels",
    "No. bulbs installed": "bulbs_installed",
    "Total cost Smart Controls (£)": "cost_smart_controls",
    "Total cost water widget (£)": "cost_water_widget",
    "Scheme Name": "scheme_name",
    "House number": "house_number",
    "Address 1": "address_1",
    "Address 2": "address_2",
    "Address 3": "address_3",
}

# The classified columns the gates check, in programme order.
GATED_COLUMNS = [
    "PROPERTY_TYPE", "TENURE", "PROPERTY_AGE", "BEDROOMS", "EXTERNAL_WALL_TYPE", "WALL_INS",
    "WALL_INS_FILL", "LOFT_INSULATION_NI", "LOFT_INSULATION", "MAIN_HEATING_FUEL",
    "FS_FUEL_AFTER", "MAIN_HEATING_SYSTEM",
]

# Output contracts.
SCHEME_COLUMN = "NISEP_SCHEME"
ANNUAL_COLUMNS = ["LAUA_NAME", "PCON_CODE", "PROPERTY_TYPE", "TENURE", "MEASURE", "MEASURE_GROUP",
                  SCHEME_COLUMN]
MASTER_COLUMNS = [
    "SUB_BUILDING", "BUILDING_NUM", "STREET", "LOCALITY", "TOWN", "COUNTY", "POSTCODE",
    "PCON_CODE", "PCON_NAME", "LAUA_CODE", "LAUA_NAME", "PROPERTY_TYPE", "TENURE",
    "PROPERTY_AGE", "MEASURE", "MEASURE_GROUP", "FY", SCHEME_COLUMN,
]
HISTORY_COLUMNS = {
    "Local Authority": "LAUA_NAME",
    "Parliamentary Constituency Code": "PCON_CODE",
    "Property Type": "PROPERTY_TYPE",
    "Property Tenure": "TENURE",
    "Measure": "MEASURE",
    "Measure Group": "MEASURE_GROUP",
}
ADDRESS_COLUMNS = ["BUILDING_NUM", "STREET", "LOCALITY", "TOWN", "COUNTY"]
SORT_KEY_COLUMNS = ["SUB_BUILDING", "BUILDING_NUM", "STREET", "LOCALITY", "TOWN", "COUNTY", "POSTCODE"]
