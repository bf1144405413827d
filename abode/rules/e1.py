"""Category rule tables for the attribute-resolution programme (two installer feeds).

Fixed values: every pattern, value list and result text below must equal the
source programme's for identical categories. Tables are in rule order (first
match wins); each is followed by its default. Feed-1 text is lower-cased and
squished before these run; feed-2 yes/no cells likewise.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Source labels and their precedence on equal dates
# (warehouse first, then feed 1, then feed 2).
# ---------------------------------------------------------------------------
SOURCE_WAREHOUSE = "HEED Pre-2015"
SOURCE_FEED1 = "HEEPS ABS"
SOURCE_FEED2 = "Warmer Homes Scotland"
SOURCE_RANK = {SOURCE_WAREHOUSE: 0, SOURCE_FEED1: 1, SOURCE_FEED2: 2}

# The address cross-reference's home-id column (input schema).
XREF_HOME_COLUMN = "HEED_HOME_ID"

# Measure-fill markers and junk keys.
NON_ECO_MARKERS = ("non-ecofundedmeasure", "non-eco funded measure")
JUNK_KEYS = ("", " ", "#N/A", "NA")

# ---------------------------------------------------------------------------
# Feed 1 (free-text MEASURE and TENURE), in rule order.
# ---------------------------------------------------------------------------
FEED1_TENURE = [
    (("~", "TENURE", "owner|private - o"), "Owner Occupier"),
    (("~", "TENURE", "private"), "Privately Rented"),
    (("~", "TENURE", "social|local authority"), "Social Housing"),
    (("~", "TENURE", "housing association|rsl|ha rent"), "Rented from Housing Association"),
]
FEED1_TENURE_DEFAULT = "Unknown Tenure"

FEED1_LOFT = [
    (("=", "MEASURE", "loft insulation"), "Loft Insulation (Unknown Thickness)"),
    (("~", "MEASURE", "virgin"), "Loft Insulation 0 - 270mm"),
    (("and", ("~", "MEASURE", "loft insulation"), ("~", "MEASURE", "top up|rafter")),
     "Loft Insulation 100-300mm"),
]

FEED1_WALL = [
    (("=", "MEASURE", "external wall insulation for cavity walls"), "Cavity Wall EWI"),
    (("and", ("~", "MEASURE", "timber frame"), ("~", "MEASURE", r"internal\s?wall|iwi")),
     "Timber Frame IWI"),
    (("and", ("~", "MEASURE", "cavity"), ("~", "MEASURE", r"internal\s?wall|iwi")),
     "Cavity Wall IWI"),
    (("~", "MEASURE", "cavity|cwi"), "Cavity Wall Filled"),
    (("~", "MEASURE", r"external\s?wall|ewi"), "Solid Wall - Externally Insulated"),
    (("~", "MEASURE", r"internal\s?wall|iwi"), "Solid Wall - Internally Insulated"),
    (("=", "MEASURE", "wall insulation"), "Wall Insulation (Unknown Wall Type)"),
]

FEED1_GLAZING = [
    (("~", "MEASURE", "window glazing|double glazed window"), "Full Double Glazing"),
]

FEED1_FUEL = [
    (("~", "MEASURE", "heat pump|electric heating|storage heat"), "Electricity"),
    (("~", "MEASURE", "gas heating system"), "Gas"),
    (("~", "MEASURE", "biomass"), "Biomass"),
    (("~", "MEASURE", "oil heating|oil boiler"), "Oil"),
    (("~", "MEASURE", "solid fuel"), "Solid Fuel"),
]

FEED1_SYSTEM = [
    (("~", "MEASURE", "boiler"), "Condensing Regular Boiler"),
    (("~", "MEASURE", "district"), "Community"),
    (("~", "MEASURE", "electric heating|storage heat"), "Electric Storage Heaters"),
    (("~", "MEASURE", "heat pump"), "Heat Pump"),
]

FEED1_RENEWABLES = [
    (("~", "MEASURE", "air source heat pump"), "ASHP"),
    (("~", "MEASURE", "photovoltaics"), "SOLAR_PV"),
    (("~", "MEASURE", "battery storage"), "BATTERY"),
]

FEED1_DRAUGHT = [(("~", "MEASURE", "draught"), "Draught Proofing (General)")]
FEED1_PIPEWORK = [(("~", "MEASURE", "pipework"), "Primary Pipework Insulation")]
FEED1_ROOM_IN_ROOF = [(("=", "MEASURE", "room in roof insulation"), "Room in Roof Insulation")]
FEED1_FLAT_ROOF = [(("=", "MEASURE", "flat roof insulation"), "Flat Roof Insulation")]
FEED1_FLOOR = [
    (("~", "MEASURE", r"under\s?floor"), "Suspended Floor Insulation"),
    (("~", "MEASURE", "floor insulation"), "Floor Insulation"),
]

UNKNOWN = "Unknown"

# ---------------------------------------------------------------------------
# Feed 2 yes/no worksheet columns (header text after
# normalisation) and the numeric-as-text columns.
# ---------------------------------------------------------------------------
FEED2_FLAG_HEADERS = [
    "Loft Insulation",
    "Pitched Roof Insulation",
    "Flat Roof Insulation",
    "Cavity Wall Insulation",
    "External Wall Insulation",
    "Internal Wall Insulation",
    "Injected Internal Wall Insulation",
    "Hybrid Wall Insulation",
    "Energy Efficient glazing/doors",
    "Biomass Boiler",
    "Biomass Boiler Back Boiler",
    "Gas Connection",
    "Gas Fired Condensing Boilers",
    "Gas Boiler LPG",
    "Oil Fired Condensing Boilers",
    "Oil Tank",
    "Electric Storage Heaters",
    "Air Source Heat Pump",
    "District Heating",
    "Solar PV",
    "Solar Thermal",
    "Domestic Battery Storage",
    "Floor Insulation",
    "Robotically Applied Under Floor",
    "Robotically Applied Underfloor Insulation Top Up",
]
FEED2_NUMERIC_HEADERS = {
    "PRE_SAP_SCORE": "Pre Sap Rating (EPCDATA::PreInstallSAP)",
    "POST_SAP_SCORE": "Post Sap Rating (EPCDATA::PostEPCSAPXML)",
    "PRE_FUEL_BILL": "Base Cost (EPCDATA::FuelCost)",
    "POST_FUEL_BILL": "End Cost (EPCDATA::PostEPCTotalFuelBillXML)",
    "POST_CO2_EMISSIONS": "End CO2 (EPCDATA::PostEPCCO2XML)",
}


def flag_name(header: str) -> str:
    """Safe column name for a feed-2 header: lower snake case."""
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in header)
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def _yes(*headers: str) -> tuple:
    conds = [("=", flag_name(h), "yes") for h in headers]
    return conds[0] if len(conds) == 1 else ("or", *conds)


FEED2_TENURE = [
    (("~", "tenure", "owner"), "Owner Occupier"),
    (("~", "tenure", "private"), "Privately Rented"),
    (("~", "tenure", "local authority"), "Social Housing"),
]
FEED2_LOFT = [(_yes("Loft Insulation", "Pitched Roof Insulation"), "Loft Insulation 100-300mm")]
FEED2_FLAT_ROOF = [(_yes("Flat Roof Insulation"), "Flat Roof Insulation")]
FEED2_WALL = [
    (_yes("Cavity Wall Insulation"), "Cavity Wall Filled"),
    (_yes("External Wall Insulation"), "Solid Wall - Externally Insulated"),
    (_yes("Internal Wall Insulation", "Injected Internal Wall Insulation"),
     "Solid Wall - Internally Insulated"),
    (_yes("Hybrid Wall Insulation"), "Wall Insulation (Unknown Wall Type)"),
]
FEED2_GLAZING = [(_yes("Energy Efficient glazing/doors"), "Full Double Glazing")]
FEED2_FUEL = [
    (_yes("Biomass Boiler", "Biomass Boiler Back Boiler"), "Biomass"),
    (_yes("Gas Connection", "Gas Fired Condensing Boilers"), "Gas"),
    (_yes("Gas Boiler LPG"), "LPG"),
    (_yes("Oil Fired Condensing Boilers", "Oil Tank"), "Oil"),
    (_yes("Electric Storage Heaters", "Air Source Heat Pump"), "Electricity"),
]
FEED2_SYSTEM = [
    (_yes("Air Source Heat Pump"), "Heat Pump"),
    (_yes("Electric Storage Heaters"), "Electric Storage Heaters"),
    (_yes("Gas Fired Condensing Boilers", "Oil Fired Condensing Boilers"),
     "Condensing Regular Boiler"),
    (_yes("Biomass Boiler", "Biomass Boiler Back Boiler", "Gas Boiler LPG"), "Boiler"),
    (_yes("District Heating"), "Community"),
]
FEED2_RENEWABLES = [
    (_yes("Air Source Heat Pump"), "ASHP"),
    (_yes("Biomass Boiler", "Biomass Boiler Back Boiler"), "BIO_BOILER"),
    (_yes("Solar PV"), "SOLAR_PV"),
    (_yes("Solar Thermal"), "SOLAR_THERMAL"),
    (_yes("Domestic Battery Storage"), "BATTERY"),
]
FEED2_FLOOR = [
    (_yes("Floor Insulation"), "Floor Insulation (Unknown Floor Type)"),
    (_yes("Robotically Applied Under Floor", "Robotically Applied Underfloor Insulation Top Up"),
     "Suspended Floor Insulation"),
]

# ---------------------------------------------------------------------------
# Attributes, warehouse code columns, excluded values, policy.
# (name, value column, warehouse code column or None, warehouse date rule,
#  excluded values, policy)
# warehouse date rule: "constant" = 2000-12-31; "capped" = detail date with
# years after 2015 replaced by 2000-01-01.
# ---------------------------------------------------------------------------
WAREHOUSE_CONSTANT_DATE = "2000-12-31"
WAREHOUSE_CAP_YEAR = 2015
WAREHOUSE_CAP_DATE = "2000-01-01"
WAREHOUSE_REGION = ("S99999999",)

ATTRIBUTES = [
    ("PROPERTY_TYPE", "PROPERTY_TYPE_NAME", "PROPERTY_TYPE_CODE", "constant", ("Unknown",), "latest"),
    ("PROPERTY_TENURE", "TENURE_NAME", "TENURE_CODE", "capped",
     ("Unknown", "Unknown Tenure", "Other"), "latest"),
    ("PROPERTY_AGE", "PROPERTY_AGE_NAME", "PROPERTY_AGE_CODE", "capped",
     ("Unknown", "Unknown Built Date", "Other"), "latest"),
    ("LOFT_INSULATION", "LOFT_INSULATION_NAME", "LOFT_INSULATION_CODE", "capped",
     ("Unknown", "Loft Insulation Unknown", "Other"), "latest"),
    ("WALL_CONSTRUCTION", "WALL_CONSTRUCTION_NAME", "EXTERNAL_WALL_TYPE_CODE", "constant",
     ("Unknown", "Other", "Unknown Insulation"), "latest"),
    ("FUEL_TYPE", "MAIN_HEATING_FUEL_NAME", "MAIN_HEATING_FUEL_CODE", "capped",
     ("Unknown", "Other"), "latest"),
    ("HEATING_SYSTEM", "MAIN_HEATING_SYSTEM_NAME", "MAIN_HEATING_SYSTEM_CODE", "capped",
     ("Unknown", "Other"), "latest"),
    ("GLAZ_TYPE", "GLAZING_TYPE_NAME", "GLAZING_TYPE_CODE", "capped", ("Unknown", "Other"), "latest"),
    ("SAP_SCORE", "SAP_SCORE", None, None, (), "latest"),
    ("SAP_FUEL_BILL", "SAP_FUEL_BILL", None, None, (), "latest"),
    ("RIR_INS", "RIR_INS", None, None, ("Unknown", "Other"), "first"),
    ("FLOOR_INSULATION", "FLOOR_INSULATION", None, None, ("Unknown", "Other"), "first"),
    ("FLAT_ROOF_INS", "FLAT_ROOF_INS", None, None, ("Unknown", "Other"), "first"),
]

# Renewable technologies (fixed list so the matrix schema is
# stable even when a technology is absent from a run) and their exclusions.
TECHNOLOGIES = ["SOLAR_PV", "BATTERY", "ASHP", "BIO_BOILER", "SOLAR_THERMAL"]
TECHNOLOGY_EXCLUDED = ("Unknown", "Other")

# Wide master column order; DATA_COUNT counts the filled
# cells of the 18 value columns (UPRN and RENEWABLE_COUNT excluded).
MASTER_COLUMNS = [
    "UPRN",
    "PROPERTY_TYPE_NAME", "TENURE_NAME", "PROPERTY_AGE_NAME", "LOFT_INSULATION_NAME",
    "WALL_CONSTRUCTION_NAME", "MAIN_HEATING_FUEL_NAME", "MAIN_HEATING_SYSTEM_NAME",
    "GLAZING_TYPE_NAME", "SAP_SCORE", "SAP_FUEL_BILL",
    "SOLAR_PV", "BATTERY", "ASHP", "BIO_BOILER", "SOLAR_THERMAL", "RENEWABLE_COUNT",
    "RIR_INS", "FLOOR_INSULATION", "FLAT_ROOF_INS",
]
