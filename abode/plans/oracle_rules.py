"""The rule tables once more, written by hand in DuckDB SQL.

The oracles of the queries use these texts and nothing of ``abode.rules``, so that
a wrong rule there shows as a difference. Fixed values: patterns, lists and
category texts are those the programmes must give, in rule order.
"""

from __future__ import annotations

from abode.rules import e1, e2

FEED1_TENURE = """CASE
  WHEN regexp_matches(TENURE, 'owner|private - o') THEN 'Owner Occupier'
  WHEN regexp_matches(TENURE, 'private') THEN 'Privately Rented'
  WHEN regexp_matches(TENURE, 'social|local authority') THEN 'Social Housing'
  WHEN regexp_matches(TENURE, 'housing association|rsl|ha rent') THEN 'Rented from Housing Association'
  ELSE 'Unknown Tenure' END"""

FEED1_LOFT = """CASE
  WHEN MEASURE = 'loft insulation' THEN 'Loft Insulation (Unknown Thickness)'
  WHEN contains(MEASURE, 'virgin') THEN 'Loft Insulation 0 - 270mm'
  WHEN contains(MEASURE, 'loft insulation') AND (contains(MEASURE, 'top up') OR contains(MEASURE, 'rafter'))
    THEN 'Loft Insulation 100-300mm'
  ELSE 'Unknown' END"""

FEED1_WALL = """CASE
  WHEN MEASURE = 'external wall insulation for cavity walls' THEN 'Cavity Wall EWI'
  WHEN contains(MEASURE, 'timber frame') AND regexp_matches(MEASURE, 'internal\\s?wall|iwi') THEN 'Timber Frame IWI'
  WHEN contains(MEASURE, 'cavity') AND regexp_matches(MEASURE, 'internal\\s?wall|iwi') THEN 'Cavity Wall IWI'
  WHEN contains(MEASURE, 'cavity') OR contains(MEASURE, 'cwi') THEN 'Cavity Wall Filled'
  WHEN regexp_matches(MEASURE, 'external\\s?wall|ewi') THEN 'Solid Wall - Externally Insulated'
  WHEN regexp_matches(MEASURE, 'internal\\s?wall|iwi') THEN 'Solid Wall - Internally Insulated'
  WHEN MEASURE = 'wall insulation' THEN 'Wall Insulation (Unknown Wall Type)'
  ELSE 'Unknown' END"""

FEED1_GLAZING = """CASE
  WHEN contains(MEASURE, 'window glazing') OR contains(MEASURE, 'double glazed window') THEN 'Full Double Glazing'
  ELSE 'Unknown' END"""

FEED1_FUEL = """CASE
  WHEN regexp_matches(MEASURE, 'heat pump|electric heating|storage heat') THEN 'Electricity'
  WHEN contains(MEASURE, 'gas heating system') THEN 'Gas'
  WHEN contains(MEASURE, 'biomass') THEN 'Biomass'
  WHEN regexp_matches(MEASURE, 'oil heating|oil boiler') THEN 'Oil'
  WHEN contains(MEASURE, 'solid fuel') THEN 'Solid Fuel'
  ELSE 'Unknown' END"""

FEED1_SYSTEM = """CASE
  WHEN contains(MEASURE, 'boiler') THEN 'Condensing Regular Boiler'
  WHEN contains(MEASURE, 'district') THEN 'Community'
  WHEN regexp_matches(MEASURE, 'electric heating|storage heat') THEN 'Electric Storage Heaters'
  WHEN contains(MEASURE, 'heat pump') THEN 'Heat Pump'
  ELSE 'Unknown' END"""

FEED1_RENEWABLES = """CASE
  WHEN contains(MEASURE, 'air source heat pump') THEN 'ASHP'
  WHEN contains(MEASURE, 'photovoltaics') THEN 'SOLAR_PV'
  WHEN contains(MEASURE, 'battery storage') THEN 'BATTERY'
  ELSE 'Unknown' END"""

FEED1_DRAUGHT = "CASE WHEN contains(MEASURE, 'draught') THEN 'Draught Proofing (General)' ELSE 'Unknown' END"
FEED1_PIPEWORK = "CASE WHEN contains(MEASURE, 'pipework') THEN 'Primary Pipework Insulation' ELSE 'Unknown' END"
FEED1_ROOM_IN_ROOF = "CASE WHEN MEASURE = 'room in roof insulation' THEN 'Room in Roof Insulation' ELSE 'Unknown' END"
FEED1_FLAT_ROOF = "CASE WHEN MEASURE = 'flat roof insulation' THEN 'Flat Roof Insulation' ELSE 'Unknown' END"
FEED1_FLOOR = """CASE
  WHEN regexp_matches(MEASURE, 'under\\s?floor') THEN 'Suspended Floor Insulation'
  WHEN contains(MEASURE, 'floor insulation') THEN 'Floor Insulation'
  ELSE 'Unknown' END"""

FEED2_TENURE = """CASE
  WHEN contains(tenure, 'owner') THEN 'Owner Occupier'
  WHEN contains(tenure, 'private') THEN 'Privately Rented'
  WHEN contains(tenure, 'local authority') THEN 'Social Housing'
  ELSE 'Unknown' END"""

FEED2_LOFT = """CASE
  WHEN loft_insulation = 'yes' OR pitched_roof_insulation = 'yes' THEN 'Loft Insulation 100-300mm' ELSE 'Unknown' END"""
FEED2_FLAT_ROOF = "CASE WHEN flat_roof_insulation = 'yes' THEN 'Flat Roof Insulation' ELSE 'Unknown' END"
FEED2_WALL = """CASE
  WHEN cavity_wall_insulation = 'yes' THEN 'Cavity Wall Filled'
  WHEN external_wall_insulation = 'yes' THEN 'Solid Wall - Externally Insulated'
  WHEN internal_wall_insulation = 'yes' OR injected_internal_wall_insulation = 'yes' THEN 'Solid Wall - Internally Insulated'
  WHEN hybrid_wall_insulation = 'yes' THEN 'Wall Insulation (Unknown Wall Type)'
  ELSE 'Unknown' END"""
FEED2_GLAZING = "CASE WHEN energy_efficient_glazing_doors = 'yes' THEN 'Full Double Glazing' ELSE 'Unknown' END"
FEED2_FUEL = """CASE
  WHEN biomass_boiler = 'yes' OR biomass_boiler_back_boiler = 'yes' THEN 'Biomass'
  WHEN gas_connection = 'yes' OR gas_fired_condensing_boilers = 'yes' THEN 'Gas'
  WHEN gas_boiler_lpg = 'yes' THEN 'LPG'
  WHEN oil_fired_condensing_boilers = 'yes' OR oil_tank = 'yes' THEN 'Oil'
  WHEN electric_storage_heaters = 'yes' OR air_source_heat_pump = 'yes' THEN 'Electricity'
  ELSE 'Unknown' END"""
FEED2_SYSTEM = """CASE
  WHEN air_source_heat_pump = 'yes' THEN 'Heat Pump'
  WHEN electric_storage_heaters = 'yes' THEN 'Electric Storage Heaters'
  WHEN gas_fired_condensing_boilers = 'yes' OR oil_fired_condensing_boilers = 'yes' THEN 'Condensing Regular Boiler'
  WHEN biomass_boiler = 'yes' OR biomass_boiler_back_boiler = 'yes' OR gas_boiler_lpg = 'yes' THEN 'Boiler'
  WHEN district_heating = 'yes' THEN 'Community'
  ELSE 'Unknown' END"""
FEED2_RENEWABLES = """CASE
  WHEN air_source_heat_pump = 'yes' THEN 'ASHP'
  WHEN biomass_boiler = 'yes' OR biomass_boiler_back_boiler = 'yes' THEN 'BIO_BOILER'
  WHEN solar_pv = 'yes' THEN 'SOLAR_PV'
  WHEN solar_thermal = 'yes' THEN 'SOLAR_THERMAL'
  WHEN domestic_battery_storage = 'yes' THEN 'BATTERY'
  ELSE 'Unknown' END"""
FEED2_FLOOR = """CASE
  WHEN floor_insulation = 'yes' THEN 'Floor Insulation (Unknown Floor Type)'
  WHEN robotically_applied_under_floor = 'yes' OR robotically_applied_underfloor_insulation_top_up = 'yes'
    THEN 'Suspended Floor Insulation'
  ELSE 'Unknown' END"""

PROPERTY_TYPE = """CASE
  WHEN lower(house_type) = 'bungalow' THEN 'Bungalow (Unknown Detachment)'
  WHEN lower(house_type) IN ('detached', 'detached bungalow', 'detached house') THEN 'Detached House / Bungalow'
  WHEN regexp_matches(house_type, 'flat|maisonette|apartment', 'i') THEN 'Flat / Maisonette'
  WHEN regexp_matches(house_type, 'end\\s*-?\\s*(terrace|teracced|detached)', 'i') THEN 'End Terrace House / Bungalow'
  WHEN regexp_matches(house_type, 'mid\\s*-?\\s*terrace|terrace[d]?\\s*house', 'i') THEN 'Mid Terrace House / Bungalow'
  WHEN regexp_matches(house_type, 'sem[i]?\\s*-?\\s*detach', 'i') THEN 'Semi Detached House / Bungalow'
  WHEN house_type IS NULL OR house_type IN ('N/A', '0', '') THEN 'Unknown Property Type'
  ELSE 'ERROR' END"""

TENURE = """CASE
  WHEN regexp_matches(tenure_raw, 'owner', 'i') THEN 'Owner Occupied'
  WHEN regexp_matches(tenure_raw, 'housing assoc|H\\.A\\.|social housing', 'i') THEN 'Rented from Housing Association'
  WHEN regexp_matches(tenure_raw, 'private|landlord', 'i') THEN 'Privately Rented'
  WHEN tenure_raw IS NULL OR lower(tenure_raw) IN ('n/a', '0', '', 'other') THEN 'Unknown Tenure'
  ELSE 'ERROR' END"""

PROPERTY_AGE = """CASE
  WHEN year_built IS NULL OR year_built_num < 1600 OR lower(year_built) IN ('after 1995', '01 after 1995', '', ' ',
    'post-1976', 'pre 1976', '1950/1990', '1980''s/1990''s', '1915/1990', 'unknown') THEN 'Unknown Property Age'
  WHEN (year_built_num > 1600 AND year_built_num < 1900) OR lower(year_built) IN ('pre-1900', '09 before 1900', 'pre 1900',
    '1700''s', '1800''s', 'pre-1930''s', '1850''s', 'before 1900', 'pre-1900''s', '1800''s/1961 (extension)',
    '1800''s/1996 (renovated)') THEN 'Built Pre-1900'
  WHEN year_built_num BETWEEN 1900 AND 1929 OR lower(year_built) IN ('08 1900-1929', '1900-1929', '1900''s', '1920''s')
    THEN 'Built 1900-1929'
  WHEN year_built_num BETWEEN 1930 AND 1949 OR lower(year_built) IN ('1930''s', '07 1930-1949', '1930-1949', '1940''s')
    THEN 'Built 1930-1949'
  WHEN year_built_num BETWEEN 1950 AND 1966 OR lower(year_built) IN ('1950''s', '1950s', '06 1950-1965', '1960''s',
    '1950-1965', '1950-60', '1960s') THEN 'Built 1950-1966'
  WHEN year_built_num BETWEEN 1967 AND 1975 OR lower(year_built) IN ('1966-1976', '1970''s', '1960''s', '05 1966-1976',
    '1970s') THEN 'Built 1967-1975'
  WHEN year_built_num BETWEEN 1976 AND 1982 OR lower(year_built) IN ('1977-1981', '04 1977-1981') THEN 'Built 1976-1982'
  WHEN year_built_num BETWEEN 1983 AND 1990 OR lower(year_built) IN ('1982-1990', '1980s', '1980''s', '03 1982-1990')
    THEN 'Built 1983-1990'
  WHEN year_built_num BETWEEN 1991 AND 1995 OR lower(year_built) IN ('1990''s', '1990s', '02 1991-1995')
    THEN 'Built 1991-1995'
  WHEN year_built_num BETWEEN 1996 AND 2002 THEN 'Built 1996-2002'
  WHEN year_built_num BETWEEN 2003 AND 2006 OR lower(year_built) = '2000''s' THEN 'Built 2003-2006'
  WHEN year_built_num >= 2006 THEN 'Built Post-2006'
  ELSE 'ERROR' END"""

BEDROOMS = """CASE
  WHEN bedrooms_raw IN ('1', '2', '3', '4') THEN bedrooms_raw
  WHEN bedrooms_raw IN ('5', '5+', '5=', '4 PLUS', '4+', '6', '7', '8', '9', '10') THEN '5+'
  WHEN bedrooms_raw IS NULL OR bedrooms_raw IN ('0', 'N/A', '', ' ') THEN 'Unknown'
  ELSE 'ERROR' END"""

EXTERNAL_WALL_TYPE = """CASE
  WHEN regexp_matches(wall_category, 'cavity', 'i') THEN 'Cavity Wall Filled' ELSE 'Unknown Insulation' END"""

WALL_INSULATION = """CASE
  WHEN regexp_matches(wall_category, 'cavity', 'i') AND PROPERTY_AGE IN ('Built Pre-1900', 'Built 1900-1929',
    'Built 1930-1949', 'Built 1950-1966', 'Built 1967-1975') THEN 'Cavity Wall Insulation (Pre-1976)'
  WHEN regexp_matches(wall_category, 'cavity', 'i') AND PROPERTY_AGE IN ('Built 1976-1982', 'Built 1983-1990',
    'Built 1991-1995', 'Built 1996-2002', 'Built 2003-2006', 'Built Post-2006') THEN 'Cavity Wall Insulation (Post-1976)'
  WHEN regexp_matches(wall_category, 'cavity', 'i') THEN 'Cavity Wall Insulation (Unknown Property Age)'
  WHEN regexp_matches(wall_category, 'solid|std|external', 'i') THEN 'Solid Wall Insulation'
  WHEN wall_category IS NULL OR wall_category = 'N/A' THEN 'Unknown'
  ELSE 'ERROR' END"""

WALL_FILL = """CASE
  WHEN regexp_matches(wall_type, 'full|refill', 'i') THEN 'Full'
  WHEN regexp_matches(wall_type, 'partial', 'i') THEN 'Partial'
  WHEN regexp_matches(wall_type, 'solid|external', 'i') THEN 'Unknown Fill'
  WHEN wall_type IS NULL OR lower(wall_type) IN ('unknown', 'n/a', '', ' ') THEN 'Unknown Fill'
  ELSE 'ERROR' END"""

LOFT_REGIONAL = """CASE
  WHEN loft_depth IN ('Loft insulation 0-300mm', 'Loft Insulation 0-300mm', 'Loft Insulation 0 - 300mm',
    'Loft Insulation 000 - 300mm', 'Loft Insulation 0.-300mm') THEN 'Loft Insulation 0 - 300mm'
  WHEN loft_depth IN ('Loft Insulation 25 - 300mm', 'Loft Insulation 25-300mm') THEN 'Loft Insulation 25 - 300mm'
  WHEN loft_depth IN ('Loft Insulation 50-300mm', 'Loft Insulation 50 - 300mm') THEN 'Loft Insulation 50 - 300mm'
  WHEN loft_depth IN ('Loft Insulation 100-300mm', 'Loft Insulation 100 - 300mm', 'Loft Insulation 100 -  300mm',
    'loft insulation 100-300 mm') THEN 'Loft Insulation 100 - 300mm'
  WHEN loft_depth IN ('Loft Insulation 150-300mm', 'Loft Insulation 150 - 300mm', '150-300mm')
    THEN 'Loft Insulation 150 - 300mm'
  WHEN loft_depth IN ('Loft Insulation 200- 300mm', 'Loft Insulation 200-300mm', 'Loft Insulation 200 -  300mm',
    'Loft Insulation 200mm') THEN 'Loft Insulation 200 - 300mm'
  WHEN loft_depth IS NULL THEN 'Unknown'
  ELSE 'ERROR' END"""

LOFT_NATIONAL = """CASE
  WHEN loft_depth IN ('Loft Insulation 0 - 270mm', 'Loft Insulation 25 - 270mm', 'Loft Insulation 50 - 270mm')
    THEN 'Loft Insulation 0 - 270mm'
  WHEN loft_depth = 'Loft Insulation 100 - 270mm' THEN 'Loft Insulation 100 - 270mm'
  WHEN loft_depth IN ('Loft Insulation 100 - 300mm', 'Loft Insulation 100 - 300 mm', 'Loft Insulation 100 -300mm',
    'Loft Insulation 100-300mm', 'Loft Insulation 150-300mm', 'Loft Insulation 200- 300mm', 'Loft Insulation 200-300mm')
    THEN 'Loft Insulation 100-300mm'
  WHEN loft_depth IN ('Loft Insulation 0-300mm', 'Loft Insulation 50-300mm') THEN 'Loft Insulation 0 - 300mm'
  WHEN loft_depth IS NULL THEN 'Unknown'
  ELSE 'ERROR' END"""

FUEL_BEFORE = """CASE
  WHEN regexp_matches(fuel_before, 'biomass|solid|smokeless|coal', 'i') THEN 'Solid Fuel'
  WHEN regexp_matches(fuel_before, 'electric|e7|economy 7', 'i') THEN 'Electric'
  WHEN regexp_matches(fuel_before, 'lpg', 'i') THEN 'LPG'
  WHEN regexp_matches(fuel_before, 'gas', 'i') THEN 'Gas'
  WHEN regexp_matches(fuel_before, '\\boil\\b', 'i') THEN 'Oil'
  WHEN fuel_before IS NULL OR lower(fuel_before) IN ('no heating', 'no heat', 'no available heat source', '', ' ', 'N/A')
    THEN 'Unknown Heating Type'
  ELSE 'ERROR' END"""

FUEL_AFTER = """CASE
  WHEN regexp_matches(fuel_after, 'biomass|solid|smokeless|coal', 'i') THEN 'Solid Fuel'
  WHEN regexp_matches(fuel_after, 'electric|e7|economy 7', 'i') OR regexp_matches(heating_after, 'heat pump', 'i')
    THEN 'Electric'
  WHEN regexp_matches(fuel_after, 'lpg', 'i') THEN 'LPG'
  WHEN regexp_matches(fuel_after, 'gas', 'i') THEN 'Gas'
  WHEN regexp_matches(fuel_after, '\\boil\\b', 'i') THEN 'Oil'
  WHEN fuel_after IS NULL OR lower(fuel_after) IN ('no heating', 'no heat', 'no available heat source', '', ' ', 'N/A')
    THEN 'Unknown Heating Type'
  ELSE 'ERROR' END"""

HEATING_SYSTEM = """CASE
  WHEN regexp_matches(heating_after, 'combination|combi', 'i') AND regexp_matches(heating_after, 'boiler', 'i')
    THEN 'Condensing Combination Boiler'
  WHEN regexp_matches(heating_after, 'conventional', 'i') AND regexp_matches(heating_after, 'boiler', 'i')
    THEN 'Condensing Regular Boiler'
  WHEN regexp_matches(heating_after, 'high heat retention|electric storage', 'i') THEN 'Electric Storage Heater'
  WHEN regexp_matches(heating_after, 'system', 'i') THEN 'System Boiler'
  WHEN regexp_matches(heating_after, 'air source', 'i') THEN 'Air Source Heat Pump'
  WHEN heating_after IS NULL THEN 'Unknown Heating Type'
  ELSE 'ERROR' END"""

MEASURE_GROUP = """CASE
  WHEN regexp_matches(MEASURE, 'unknown', 'i') THEN 'Unknown'
  WHEN regexp_matches(MEASURE, 'boiler|retention|storage|heat pump|radiator', 'i') THEN 'Heating'
  WHEN regexp_matches(MEASURE, 'insulation', 'i') THEN 'Insulation'
  WHEN regexp_matches(MEASURE, '\\bleds\\b', 'i') THEN 'Lighting'
  WHEN regexp_matches(MEASURE, 'water widget', 'i') THEN 'Appliances'
  WHEN regexp_matches(MEASURE, 'energy monitor', 'i') THEN 'Other'
  ELSE 'ERROR' END"""

#: District name of the code in the column ``lad``.
DISTRICT_NAME = """CASE lad
  WHEN 'N09000001' THEN 'Antrim and Newtownabbey'
  WHEN 'N09000002' THEN 'Armagh City, Banbridge and Craigavon'
  WHEN 'N09000003' THEN 'Belfast'
  WHEN 'N09000004' THEN 'Causeway Coast and Glens'
  WHEN 'N09000005' THEN 'Derry City and Strabane'
  WHEN 'N09000006' THEN 'Fermanagh and Omagh'
  WHEN 'N09000007' THEN 'Lisburn and Castlereagh'
  WHEN 'N09000008' THEN 'Mid and East Antrim'
  WHEN 'N09000009' THEN 'Mid Ulster'
  WHEN 'N09000010' THEN 'Newry, Mourne and Down'
  WHEN 'N09000011' THEN 'Ards and North Down'
  ELSE 'Unknown' END"""

#: Hand-typed dates and what they mean.
DATE_LITERALS = """WHEN 'Aug-20' THEN '01/08/2020' WHEN 'Sep-20' THEN '01/09/2020' WHEN '15/11/017' THEN '15/11/2017'
  WHEN '14/08/209' THEN '14/08/2019' WHEN 'July/Aug 2020' THEN '01/07/2020' WHEN 'Wk com 25/10/2021' THEN '25/10/2021'
  WHEN 'Wk com 18/10/2021' THEN '18/10/2020' WHEN '30/09/2106' THEN '30/09/2016'"""

#: Decimal or scientific numbers as text, blanks around.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

#: A word with inner apostrophes or full stops, or what stands between words.
TITLE_WORD = r"([\pL\pN]+(?:[''’.][\pL\pN]+)*|[^\pL\pN]+)"

_BY_TABLE = {
    **{id(getattr(e1, name)): globals()[name] for name in (
        "FEED1_TENURE", "FEED1_LOFT", "FEED1_WALL", "FEED1_GLAZING", "FEED1_FUEL", "FEED1_SYSTEM", "FEED1_RENEWABLES",
        "FEED1_DRAUGHT", "FEED1_PIPEWORK", "FEED1_ROOM_IN_ROOF", "FEED1_FLAT_ROOF", "FEED1_FLOOR", "FEED2_TENURE",
        "FEED2_LOFT", "FEED2_FLAT_ROOF", "FEED2_WALL", "FEED2_GLAZING", "FEED2_FUEL", "FEED2_SYSTEM", "FEED2_RENEWABLES",
        "FEED2_FLOOR")},
    **{id(getattr(e2, name)): globals()[name] for name in (
        "PROPERTY_TYPE", "TENURE", "PROPERTY_AGE", "BEDROOMS", "EXTERNAL_WALL_TYPE", "WALL_INSULATION", "WALL_FILL",
        "LOFT_REGIONAL", "LOFT_NATIONAL", "FUEL_BEFORE", "FUEL_AFTER", "HEATING_SYSTEM", "MEASURE_GROUP")},
}


# Fixed values, once more by hand: markers of a measure given elsewhere, the earliest
# credible year and the date that stands for earlier ones, add-on amounts with their
# texts, and the categories that a gate checks.
NON_ECO_MARKERS = ("non-ecofundedmeasure", "non-eco funded measure")
FLOOR_YEAR, FLOOR_DATE = 2010, "2015-01-01"
ADDON_FLAGS = {
    "HOT_WATER_TANK_INSULATION": ("cost_hot_water_jacket", "Hot Water Tank Insulation", "Unknown Hot Water Tank Insulation"),
    "RADIATOR_PANELS": ("cost_radiator_panels", "Radiator Panels", "Unknown Radiator Panels"),
    "LIGHTING": ("bulbs_installed", "LEDs", "Unknown"),
    "ENERGY_MONITOR": ("cost_smart_controls", "Energy Monitor", "Unknown"),
    "WATER_WIDGET": ("cost_water_widget", "Water Widget", "Unknown"),
}
GATED_COLUMNS = ("PROPERTY_TYPE", "TENURE", "PROPERTY_AGE", "BEDROOMS", "EXTERNAL_WALL_TYPE", "WALL_INS", "WALL_INS_FILL",
                 "LOFT_INSULATION_NI", "LOFT_INSULATION", "MAIN_HEATING_FUEL", "FS_FUEL_AFTER", "MAIN_HEATING_SYSTEM")


def case_for(rules: list) -> str:
    """The hand-written CASE for a rule table; its rules are not read, it only names the text."""
    return _BY_TABLE[id(rules)]
