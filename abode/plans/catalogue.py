"""Operator queries over the driver tables, each with an independent SQL oracle.

Every query reads whole tables. Messy inputs (free-text dates, decorated
measure phrases, planted blanks and NULLs) are derived from the tables by
arithmetic on their integer keys, with the same expression text in both
engines where the dialects agree, so the oracle sees identical input. The
Spark side runs the library operators; the SQL side restates the semantics
in plain SQL (window ``row_number`` for first/latest, CASE for rule tables).

Output columns are aliased identically on both sides; timestamps are
returned as dates; doubles that are aggregated are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.functions import dates as D
from abode.functions import text as X
from abode.functions.classify import classify
from abode.functions.numbers import positive_flag, to_number
from abode.operators import columns as P
from abode.operators import filters as FL
from abode.operators import joins as J
from abode.operators import quality as Q
from abode.operators import reshape as R
from abode.operators import resolve as W
from abode.plans import attributes as E1
from abode.plans import measures as E2
from abode.plans import oracle_rules as O
from abode.rules import e1, e2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key_sql: str, values: list) -> str:
    """Pick ``values[key]`` (same text in both dialects).

    Written as one ``split_part`` over a literal list, which Spark folds to
    an array lookup: a compact expression, so plans that substitute it into
    pushed-down filters stay small. NULL is encoded as "~".
    """
    for v in values:
        assert v is None or ("|" not in v and "~" not in v), v
    packed = "|".join("~" if v is None else str(v) for v in values).replace("'", "''")
    return f"nullif(split_part('{packed}', '|', CAST(({key_sql}) AS INT) + 1), '~')"


_WS = X.WHITESPACE_CLASS


def _squish_sql(e: str) -> str:
    return f"trim(regexp_replace({e}, '{_WS}+', ' ', 'g'))"


def _rules_sql(rules, _default) -> str:
    return O.case_for(rules)


def _tonum_sql(e: str) -> str:
    return f"(CASE WHEN regexp_matches(CAST({e} AS VARCHAR), '{O.NUMBER}') " \
           f"THEN TRY_CAST(trim(CAST({e} AS VARCHAR)) AS DOUBLE) END)"


SOURCES3 = [e1.SOURCE_WAREHOUSE, e1.SOURCE_FEED1, e1.SOURCE_FEED2]


# ===========================================================================
# Dates (D-01 .. D-10)
# ===========================================================================

def _messy_dates_spark(orders: DataFrame) -> DataFrame:
    k = "o_orderkey"
    d = "CAST(o_orderdate AS DATE)"
    raw = (
        f"CASE {k} % 8 "
        f"WHEN 0 THEN CAST(datediff({d}, DATE'1899-12-30') + 4000 AS STRING) "
        f"WHEN 1 THEN date_format({d}, 'd/M/yyyy') "
        f"WHEN 2 THEN date_format({d}, 'dd.MM.yyyy') "
        f"WHEN 3 THEN {_LITERAL_PICK} "
        f"WHEN 4 THEN concat('31/02/', CAST(year({d}) AS STRING)) "
        f"WHEN 5 THEN date_format({d}, 'dd/MM/yyyy') "
        f"WHEN 6 THEN concat(date_format({d}, 'dd/M/yyyy'), ' 10:00') "
        f"ELSE CASE WHEN {k} % 16 = 7 THEN NULL "
        f"ELSE CAST(datediff({d}, DATE'1899-12-30') + 8000 AS STRING) END END"
    )
    fyear = (f"CASE {k} % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('FY', CAST(year({d}) + 1 AS STRING)) "
             f"ELSE 'no year' END")
    return orders.selectExpr(k, f"{raw} AS raw_date", f"{fyear} AS fyear")


_LITERALS = list(D.DATE_LITERAL_REPAIRS) + [" 5.6.1999 ", "1/12/1998"]
_LITERAL_PICK = _case("o_orderkey % 10", _LITERALS)

_MESSY_DATES_DUCK = f"""
  SELECT o_orderkey,
    CASE o_orderkey % 8
      WHEN 0 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) + 4000 AS VARCHAR)
      WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%-d/%-m/%Y')
      WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y')
      WHEN 3 THEN {_LITERAL_PICK}
      WHEN 4 THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
      WHEN 5 THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y')
      WHEN 6 THEN strftime(CAST(o_orderdate AS DATE), '%d/%-m/%Y') || ' 10:00'
      ELSE CASE WHEN o_orderkey % 16 = 7 THEN NULL
           ELSE CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) + 8000 AS VARCHAR) END
    END AS raw_date,
    CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'FY' || CAST(year(o_orderdate) + 1 AS VARCHAR)
      ELSE 'no year' END AS fyear
  FROM orders"""


def _repair_dmy_sql(src: str, floor_year: int, floor_date: str) -> str:
    day_pads = ", ".join(f"'{d}/'" for d in range(1, 10))
    month_pads = ", ".join(f"'/{m}/'" for m in range(1, 10))
    lits = O.DATE_LITERALS
    return f"""
WITH src AS ({src}),
s1 AS (SELECT *, CASE WHEN coalesce(substr(raw_date, 1, 2) IN ('39', '43'), false) THEN
          CASE WHEN floor({_tonum_sql('raw_date')}) BETWEEN 0 AND 2958465 THEN
            strftime(DATE '1899-12-30' + CAST(floor({_tonum_sql('raw_date')}) - 2 AS INTEGER), '%d/%m/%Y') END
        ELSE raw_date END AS t1 FROM src),
s2 AS (SELECT *, regexp_replace(replace(t1, '.', '/'), '^{_WS}+|{_WS}+$', '', 'g') AS t2 FROM s1),
s3 AS (SELECT *, CASE WHEN coalesce(substr(t2, 1, 2) IN ({day_pads}), false) THEN '0' || t2 ELSE t2 END AS t3 FROM s2),
s4 AS (SELECT *, CASE WHEN coalesce(substr(t3, 3, 3) IN ({month_pads}), false)
          THEN substr(t3, 1, 3) || '0' || substr(t3, 4, 6) ELSE t3 END AS t4 FROM s3),
s5 AS (SELECT *, CASE t4 {lits} ELSE t4 END AS t5 FROM s4),
s6 AS (SELECT *,
        CAST(try_strptime(regexp_extract(fyear, '\\d{{4}}') || '-01-01', '%Y-%m-%d') AS DATE) AS programme_date,
        CASE WHEN regexp_matches(t5, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN CAST(try_strptime(t5, '%d/%m/%Y') AS DATE) END AS parsed
       FROM s5),
s7 AS (SELECT *, coalesce(parsed, programme_date) AS d FROM s6)
SELECT o_orderkey, raw_date, programme_date,
       CASE WHEN d IS NULL OR year(d) < {floor_year} THEN DATE '{floor_date}' ELSE d END AS ts,
       strftime(d, '%Y') AS year
FROM s7"""


def _messy_date_repair(spark, sf_dir):
    src = _messy_dates_spark(table(spark, sf_dir, "orders")).withColumn("programme_date", D.year_start("fyear"))
    out = D.with_dmy_dates(src, "raw_date", F.col("programme_date"), "ts", "year",
                           floor_year=1996, floor_date="1996-01-01")
    return out.select("o_orderkey", "raw_date", "programme_date", "ts", "year")


query("messy_date_repair", _repair_dmy_sql(_MESSY_DATES_DUCK, 1996, "1996-01-01"))(_messy_date_repair)


def _date_fallback_clamp(spark, sf_dir):
    """Programme-year fallback + clamp with the reference's own parameters."""
    src = _messy_dates_spark(table(spark, sf_dir, "orders")).withColumn("programme_date", D.year_start("fyear"))
    out = D.with_dmy_dates(src, "raw_date", F.col("programme_date"), "ts", "year")
    return out.select("o_orderkey", "raw_date", "programme_date", "ts", "year")


query("date_fallback_clamp", _repair_dmy_sql(_MESSY_DATES_DUCK, O.FLOOR_YEAR, O.FLOOR_DATE))(
    _date_fallback_clamp)


_ISO_SPARK = (
    "CASE event_id % 6 "
    "WHEN 0 THEN date_format(ts, 'yyyy-MM-dd') "
    "WHEN 1 THEN date_format(ts, 'dd/MM/yyyy') "
    "WHEN 2 THEN concat(CAST(year(ts) AS STRING), '-02-31') "
    "WHEN 3 THEN concat(' ', date_format(ts, 'yyyy.MM.dd'), ' ') "
    "WHEN 4 THEN NULL "
    "ELSE concat('2008-', date_format(ts, 'MM-dd')) END"
)
_ISO_DUCK = (
    "CASE event_id % 6 "
    "WHEN 0 THEN strftime(ts, '%Y-%m-%d') "
    "WHEN 1 THEN strftime(ts, '%d/%m/%Y') "
    "WHEN 2 THEN CAST(year(ts) AS VARCHAR) || '-02-31' "
    "WHEN 3 THEN ' ' || strftime(ts, '%Y.%m.%d') || ' ' "
    "WHEN 4 THEN NULL "
    "ELSE '2008-' || strftime(ts, '%m-%d') END"
)


def _iso_date_gate(spark, sf_dir):
    ev = table(spark, sf_dir, "events").selectExpr("event_id", f"{_ISO_SPARK} AS raw_date")
    return D.with_iso_dates(ev, "raw_date", "ts", "year").select("event_id", "raw_date", "ts", "year")


def _iso_sql() -> str:
    day_pads = ", ".join(f"'{d}/'" for d in range(1, 10))
    month_pads = ", ".join(f"'/{m}/'" for m in range(1, 10))
    lits = O.DATE_LITERALS
    return f"""
WITH src AS (SELECT event_id, {_ISO_DUCK} AS raw_date FROM events),
s2 AS (SELECT *, regexp_replace(replace(raw_date, '.', '/'), '^{_WS}+|{_WS}+$', '', 'g') AS t2 FROM src),
s3 AS (SELECT *, CASE WHEN coalesce(substr(t2, 1, 2) IN ({day_pads}), false) THEN '0' || t2 ELSE t2 END AS t3 FROM s2),
s4 AS (SELECT *, CASE WHEN coalesce(substr(t3, 3, 3) IN ({month_pads}), false)
          THEN substr(t3, 1, 3) || '0' || substr(t3, 4, 6) ELSE t3 END AS t4 FROM s3),
s5 AS (SELECT *, CASE t4 {lits} ELSE t4 END AS t5 FROM s4),
s6 AS (SELECT *, CASE WHEN coalesce(regexp_matches(t5, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$'), false)
                      THEN CAST(try_strptime(t5, '%Y-%m-%d') AS DATE) ELSE DATE '{O.FLOOR_DATE}' END AS d FROM s5)
SELECT event_id, raw_date,
       CASE WHEN year(d) < {O.FLOOR_YEAR} THEN DATE '{O.FLOOR_DATE}' ELSE d END AS ts,
       strftime(d, '%Y') AS year
FROM s6"""


query("iso_date_gate", _iso_sql())(_iso_date_gate)


@query("warehouse_date_rule", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS detail_date,
       CASE WHEN year(o_orderdate) > 1998 THEN DATE '1990-01-01' ELSE CAST(o_orderdate AS DATE) END AS ts
FROM orders""")
def _warehouse_date_rule(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("detail_date"))
    return o.withColumn("ts", D.cap_year("detail_date", 1998, "1990-01-01"))


@query("non_day_first_profile", """
WITH src AS (""" + _MESSY_DATES_DUCK + """)
SELECT raw_date, CAST(count(*) AS BIGINT) AS n FROM src
WHERE raw_date IS NULL OR raw_date = '' OR substr(raw_date, 3, 1) <> '/'
GROUP BY raw_date""")
def _non_day_first_profile(spark, sf_dir):
    """D-12 + A-02: frequency of date texts not shaped dd/..., missing included."""
    src = _messy_dates_spark(table(spark, sf_dir, "orders"))
    odd = src.where(D.not_day_first("raw_date"))
    return Q.frequency(odd, ["raw_date"]).select(F.col("value").alias("raw_date"), "n")


# ===========================================================================
# Text (X-01 .. X-12, P-10)
# ===========================================================================

_TITLE_SRC = ("concat(p_name, " + _case("p_partkey % 5", [
    " , ,", "-street", " o'neill  park", "  10A main  st ", "/the  avenue,"]) + ")")


def _title_case_tidy(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_TITLE_SRC} AS address")
    return part.select("p_partkey", "address", X.tidy_address("address").alias("tidy"))


def _title_sql() -> str:
    word = O.TITLE_WORD
    inner = (f"array_to_string(list_transform(regexp_extract_all(lower(regexp_replace(address, "
             f"'[,\\s]*$', '')), '{word}', 1), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")
    return (f"WITH src AS (SELECT p_partkey, {_TITLE_SRC} AS address FROM part) "
            f"SELECT p_partkey, address, {_squish_sql(inner)} AS tidy FROM src")


query("title_case_tidy", _title_sql())(_title_case_tidy)


@query("squish_lower_text", f"""
SELECT doc_id, {_squish_sql('lower(text)')} AS text, {_squish_sql('lower(lang)')} AS lang,
       {_squish_sql('lower(source)')} AS source, n_chars
FROM documents""")
def _squish_lower_text(spark, sf_dir):
    """P-10 over every text column of whole documents: lower + squish."""
    docs = table(spark, sf_dir, "documents")
    return P.map_text(docs, X.lower_squish)


_NOISY_REF = ("CASE o_orderkey % 4 "
              "WHEN 0 THEN concat('customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) "
              "WHEN 1 THEN concat('CUSTOMER # ', lpad(CAST(o_custkey AS STRING), 9, '0'), '?') "
              "WHEN 2 THEN concat(' \"Customer#', lpad(CAST(o_custkey AS STRING), 9, '0'), '\"') "
              "ELSE concat('Customer #', lpad(CAST(o_custkey AS STRING), 9, '0')) END")


@query("postcode_key_join", f"""
WITH o AS (SELECT o_orderkey, {_NOISY_REF} AS noisy FROM orders),
c AS (SELECT c_custkey, c_nationkey, lower(replace(c_name, ' ', '')) AS k FROM customer)
SELECT o.o_orderkey, o.noisy, c.c_custkey, n.n_name
FROM o
LEFT JOIN c ON lower(replace(translate(o.noisy, ' ?"', ''), ' ', '')) = c.k
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def _postcode_key_join(spark, sf_dir):
    """X-04/X-05 keys + J-09 chained lookups (orders -> customer -> nation)."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_NOISY_REF} AS noisy")
    o = o.withColumn("k", X.postcode_key(X.strip_postcode_noise("noisy")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", X.postcode_key("c_name").alias("k"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = J.lookup_join(o, c, "k", null_safe=False)
    out = J.lookup_join(out, n, {"c_nationkey": "n_nationkey"}, null_safe=False)
    return out.select("o_orderkey", "noisy", "c_custkey", "n_name")


@query("null_safe_lookup", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer),
n AS (SELECT nullif(n_nationkey, 24) AS nk, n_name FROM nation)
SELECT c.c_custkey, c.k, n.n_name FROM c LEFT JOIN n ON c.k IS NOT DISTINCT FROM n.nk""")
def _null_safe_lookup(spark, sf_dir):
    """Missing keys match a missing lookup key (the source programmes' join semantics)."""
    c = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS k")
    n = table(spark, sf_dir, "nation").selectExpr("nullif(n_nationkey, 24) AS nk", "n_name")
    return J.lookup_join(c, n, {"k": "nk"}, null_safe=True).select("c_custkey", "k", "n_name")


@query("blank_marker_cleanup", """
WITH src AS (SELECT p_partkey,
  CASE p_partkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN 'Flat N/A 2' ELSE p_name END AS sub_building
  FROM part)
SELECT p_partkey, CASE WHEN coalesce(contains(coalesce(sub_building, ''), 'N/A'), false) THEN ''
                       ELSE coalesce(sub_building, '') END AS sub_building
FROM src""")
def _blank_marker_cleanup(spark, sf_dir):
    """P-12 blank fill then X-12 blank-out of values containing N/A."""
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE p_partkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN 'Flat N/A 2' ELSE p_name END"
        " AS sub_building")
    filled = P.blank_nulls(p, ["sub_building"])
    return filled.withColumn("sub_building", X.blank_if_contains("sub_building", "N/A"))


# ===========================================================================
# Measures and classifiers (T-00 .. T-45, C-01)
# ===========================================================================

_MEASURE_SRC = (
    "CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Non-Eco  Funded Measure' "
    "WHEN 3 THEN ' ' WHEN 4 THEN 'non-ecofundedmeasure' ELSE upper(p_name) END")
_SECOND_SRC = "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE concat(p_type, '  Insulation') END"


def _measure_fill(spark, sf_dir):
    """F-01/F-02 blank test, T-00 fill from the second field, drop missing."""
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"{_MEASURE_SRC} AS MEASURE", f"{_SECOND_SRC} AS Non_ECO_Measure")
    p = P.map_text(p, X.lower_squish, ["MEASURE", "Non_ECO_Measure"])
    return E1.fill_measure(p).select("p_partkey", "MEASURE")


def _measure_fill_sql() -> str:
    def blank(c):
        return f"({c} IS NULL OR coalesce({c} IN ('', ' '), false))"
    markers = ", ".join(f"'{m}'" for m in O.NON_ECO_MARKERS)
    return f"""
WITH src AS (SELECT p_partkey, {_squish_sql('lower(' + _MEASURE_SRC + ')')} AS m,
                    {_squish_sql('lower(' + _SECOND_SRC + ')')} AS s FROM part),
kept AS (SELECT * FROM src WHERE NOT ({blank('m')} AND {blank('s')})),
filled AS (SELECT p_partkey, CASE WHEN coalesce(m IN ({markers}), false) OR ({blank('m')} AND NOT {blank('s')})
                                  THEN s ELSE m END AS MEASURE FROM kept)
SELECT p_partkey, MEASURE FROM filled WHERE MEASURE IS NOT NULL"""


query("measure_fill", _measure_fill_sql())(_measure_fill)

# Fixed phrase list for decorating part names (covers every feed-1 rule).
_PHRASES = [
    "loft insulation", "Virgin loft insulation", "Loft Insulation top up", "rafter loft insulation",
    "room in roof insulation", "external wall insulation for cavity walls",
    "timber frame internal wall insulation", "cavity wall IWI", "Cavity Wall Insulation",
    "external wall insulation", "internalwall insulation", "wall insulation", "CWI",
    "double glazed windows", "Window Glazing", "gas heating system", "Biomass boiler",
    "oil boiler", "air source heat pump", "solar photovoltaics", "battery storage",
    "district heating", "electric storage heaters", "under floor insulation",
    "floor insulation", "flat roof insulation", "draught proofing", "pipework", "solid fuel stove",
]
_PHRASE_SRC = ("CASE WHEN p_partkey % 58 < 29 THEN " + _case("p_partkey % 29", _PHRASES)
               + " ELSE concat(" + _case("p_partkey % 29", _PHRASES) + ", ' ', p_name) END")
_TENURE_SRC = _case("p_partkey % 8", ["Owner occupied", "Private - Owner", "Private rented", "Local Authority",
                                      "Housing Association", "RSL", None, "Mixed"])
_E1_TABLES = [
    ("TENURE_NAME", e1.FEED1_TENURE, e1.FEED1_TENURE_DEFAULT),
    ("LOFT_INSULATION_NAME", e1.FEED1_LOFT, e1.UNKNOWN),
    ("WALL_CONSTRUCTION_NAME", e1.FEED1_WALL, e1.UNKNOWN),
    ("GLAZING_TYPE_NAME", e1.FEED1_GLAZING, e1.UNKNOWN),
    ("MAIN_HEATING_FUEL_NAME", e1.FEED1_FUEL, e1.UNKNOWN),
    ("MAIN_HEATING_SYSTEM_NAME", e1.FEED1_SYSTEM, e1.UNKNOWN),
    ("RENEWABLES", e1.FEED1_RENEWABLES, e1.UNKNOWN),
    ("DRAUGHT", e1.FEED1_DRAUGHT, e1.UNKNOWN),
    ("PIPEWORK", e1.FEED1_PIPEWORK, e1.UNKNOWN),
    ("RIR_INS", e1.FEED1_ROOM_IN_ROOF, e1.UNKNOWN),
    ("FLAT_ROOF_INS", e1.FEED1_FLAT_ROOF, e1.UNKNOWN),
    ("FLOOR_INSULATION", e1.FEED1_FLOOR, e1.UNKNOWN),
]


def _classify_measure_text(spark, sf_dir):
    """Every feed-1 rule table (C-01) over decorated, lower-cased, squished text."""
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"{_PHRASE_SRC} AS MEASURE", f"{_TENURE_SRC} AS TENURE")
    p = P.map_text(p, X.lower_squish, ["MEASURE", "TENURE"])
    return p.select("p_partkey", "MEASURE", *[classify(r, d).alias(n) for n, r, d in _E1_TABLES])


def _classify_measure_sql() -> str:
    arms = ", ".join(f"{_rules_sql(r, d)} AS {n}" for n, r, d in _E1_TABLES)
    return (f"WITH src AS (SELECT p_partkey, {_squish_sql('lower(' + _PHRASE_SRC + ')')} AS MEASURE, "
            f"{_squish_sql('lower(' + _TENURE_SRC + ')')} AS TENURE FROM part) "
            f"SELECT p_partkey, MEASURE, {arms} FROM src")


query("classify_measure_text", _classify_measure_sql())(_classify_measure_text)

_HOUSE_TYPES = ["Bungalow", "DETACHED", "detached house", "Ground floor Flat", "End-Terrace", "end teracced",
                "Mid Terrace", "Terraced House", "Semi-Detached", "semi detached bungalow", "N/A", "0", "",
                None, "Terrace", "Cottage", "Apartment", "END DETACHED", "Maisonette", "Semidetach"]
_TENURES = ["Owner Occupier", "H.A. tenant", "Social Housing", "PRIVATE landlord", "n/a", "Other", None,
            "council", "Housing Association", "OWNER", "Private Rented", "0", ""]
_HOUSE_SRC = _case("c_custkey % 20", _HOUSE_TYPES)
_TEN_SRC = _case("c_custkey % 13", _TENURES)


def _claims_types(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{_HOUSE_SRC} AS house_type", f"{_TEN_SRC} AS tenure_raw")
    return c.select("c_custkey", "house_type", "tenure_raw",
                    classify(e2.PROPERTY_TYPE, e2.ERROR).alias("PROPERTY_TYPE"),
                    classify(e2.TENURE, e2.ERROR).alias("TENURE"))


_CLAIMS_TYPES_SQL = (f"SELECT c_custkey, house_type, tenure_raw, {_rules_sql(e2.PROPERTY_TYPE, e2.ERROR)} "
                     f"AS PROPERTY_TYPE, {_rules_sql(e2.TENURE, e2.ERROR)} AS TENURE FROM "
                     f"(SELECT c_custkey, {_HOUSE_SRC} AS house_type, {_TEN_SRC} AS tenure_raw FROM customer)")

query("classify_case_insensitive", _CLAIMS_TYPES_SQL)(_claims_types)

_AGE_TEXTS = ["1960's", "pre-1900", "1930's", "unknown", "1980s", "2000's", "Pre 1900", "1800's/1961 (extension)",
              "after 1995", "02 1991-1995", "1977-1981", "1950-60", "whenever"]
_YEAR_SPARK = ("CASE o_orderkey % 10 WHEN 6 THEN concat(CAST(1500 + o_orderkey % 600 AS STRING), '.5') "
               "WHEN 7 THEN " + _case("o_orderkey % 13", _AGE_TEXTS) + " WHEN 8 THEN NULL "
               "WHEN 9 THEN concat(CAST(1900 + o_orderkey % 120 AS STRING), 'd') "
               "ELSE CAST(1500 + o_orderkey % 600 AS STRING) END")
_WALL_CATS = ["Cavity", "cavity wall", "CAVITY - partial", "Solid wall", "STD", "External", "N/A", None, "Loft"]
_WALL_TYPES = ["Full fill", "REFILL", "partial", "solid", "External", "unknown", "N/A", None, " ", "mixed"]


def _ages(spark, sf_dir):
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{_YEAR_SPARK} AS year_built",
        f"{_case('o_orderkey % 9', _WALL_CATS)} AS wall_category",
        f"{_case('o_orderkey % 10', _WALL_TYPES)} AS wall_type")
    o = o.withColumn("year_built_num", to_number("year_built"))
    return o.withColumn("PROPERTY_AGE", classify(e2.PROPERTY_AGE, e2.ERROR))


def _ages_sql_src() -> str:
    return (f"SELECT o_orderkey, year_built, {_tonum_sql('year_built')} AS year_built_num, wall_category, "
            f"wall_type FROM (SELECT o_orderkey, {_YEAR_SPARK} AS year_built, "
            f"{_case('o_orderkey % 9', _WALL_CATS)} AS wall_category, "
            f"{_case('o_orderkey % 10', _WALL_TYPES)} AS wall_type FROM orders)")


@query("classify_year_bands",
       f"SELECT o_orderkey, year_built, year_built_num, {_rules_sql(e2.PROPERTY_AGE, e2.ERROR)} AS PROPERTY_AGE "
       f"FROM ({_ages_sql_src()})")
def _classify_year_bands(spark, sf_dir):
    """T-33: numeric bands, text lists, fractional gaps and non-numbers."""
    return _ages(spark, sf_dir).select("o_orderkey", "year_built", "year_built_num", "PROPERTY_AGE")


@query("classify_dependent",
       f"WITH a AS (SELECT *, {_rules_sql(e2.PROPERTY_AGE, e2.ERROR)} AS PROPERTY_AGE FROM ({_ages_sql_src()})) "
       f"SELECT o_orderkey, PROPERTY_AGE, "
       f"{_rules_sql(e2.EXTERNAL_WALL_TYPE, e2.EXTERNAL_WALL_TYPE_DEFAULT)} AS EXTERNAL_WALL_TYPE, "
       f"{_rules_sql(e2.WALL_INSULATION, e2.ERROR)} AS WALL_INS, "
       f"{_rules_sql(e2.WALL_FILL, e2.ERROR)} AS WALL_INS_FILL FROM a")
def _classify_dependent(spark, sf_dir):
    """T-35/T-36/T-37: wall classifiers, one depending on the age band."""
    a = _ages(spark, sf_dir)
    return a.select(
        "o_orderkey", "PROPERTY_AGE",
        classify(e2.EXTERNAL_WALL_TYPE, e2.EXTERNAL_WALL_TYPE_DEFAULT).alias("EXTERNAL_WALL_TYPE"),
        classify(e2.WALL_INSULATION, e2.ERROR).alias("WALL_INS"),
        classify(e2.WALL_FILL, e2.ERROR).alias("WALL_INS_FILL"))


_LOFT_TEXTS = ["Loft Insulation 0-300mm", "Loft Insulation 100 - 300mm", "Loft Insulation 0 - 270mm",
               "Loft Insulation 200 -  300mm", "150-300mm", "Loft Insulation 100 - 270mm",
               "Loft Insulation 50-300mm", None, "Loft Insulation 270mm"]
_FUELS = ["Oil", "Foil", "Mains Gas", "LPG tank", "Economy 7", "coal", "No heating", "N/A", None, "E7 storage",
          "electricity", "wood", "Heating oil"]
_HEATING = ["Combi boiler", "Conventional Boiler", "High Heat Retention Storage", "System boiler",
            "Air Source Heat Pump", None, "", "Ground source heat pump", "combination BOILER"]
_LOFT_SRC = _case("l_orderkey % 9", _LOFT_TEXTS)
_FUEL_B_SRC = _case("l_partkey % 13", _FUELS)
_FUEL_A_SRC = _case("l_suppkey % 13", _FUELS)
_HEAT_SRC = _case("l_linenumber % 9", _HEATING)
_E2_HEAT_TABLES = [
    ("LOFT_INSULATION_NI", e2.LOFT_REGIONAL), ("LOFT_INSULATION", e2.LOFT_NATIONAL),
    ("MAIN_HEATING_FUEL", e2.FUEL_BEFORE), ("FS_FUEL_AFTER", e2.FUEL_AFTER),
    ("MAIN_HEATING_SYSTEM", e2.HEATING_SYSTEM),
]


@query("classify_heating_loft",
       "SELECT l_orderkey, l_linenumber, loft_depth, fuel_before, fuel_after, heating_after, "
       + ", ".join(f"{_rules_sql(r, e2.ERROR)} AS {n}" for n, r in _E2_HEAT_TABLES)
       + f" FROM (SELECT l_orderkey, l_linenumber, {_LOFT_SRC} AS loft_depth, {_FUEL_B_SRC} AS fuel_before, "
       f"{_FUEL_A_SRC} AS fuel_after, {_HEAT_SRC} AS heating_after FROM lineitem)")
def _classify_heating_loft(spark, sf_dir):
    """T-38..T-42: exact loft lists (both bands), fuel before/after, heating system."""
    li = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_LOFT_SRC} AS loft_depth", f"{_FUEL_B_SRC} AS fuel_before",
        f"{_FUEL_A_SRC} AS fuel_after", f"{_HEAT_SRC} AS heating_after")
    return li.select("l_orderkey", "l_linenumber", "loft_depth", "fuel_before", "fuel_after", "heating_after",
                     *[classify(r, e2.ERROR).alias(n) for n, r in _E2_HEAT_TABLES])


_BEDROOMS = ["1", "2", "3", "4", "5+", "4 PLUS", "0", "N/A", None, " ", "6", "eleven", "10"]


@query("classify_bedrooms",
       f"SELECT c_custkey, bedrooms_raw, {_rules_sql(e2.BEDROOMS, e2.ERROR)} AS BEDROOMS "
       f"FROM (SELECT c_custkey, {_case('c_custkey % 13', _BEDROOMS)} AS bedrooms_raw FROM customer)")
def _classify_bedrooms(spark, sf_dir):
    """T-34."""
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_case('c_custkey % 13', _BEDROOMS)} AS bedrooms_raw")
    return c.withColumn("BEDROOMS", classify(e2.BEDROOMS, e2.ERROR))


_ADDON_SRC = [
    "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_tax END AS cost_hot_water_jacket",
    "l_discount - 0.05 AS cost_radiator_panels",
    "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity - 25 END AS bulbs_installed",
    "CASE WHEN l_partkey % 3 = 0 THEN 0.0 ELSE l_extendedprice END AS cost_smart_controls",
    "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_tax - 0.04 END AS cost_water_widget",
]


@query("addon_flags",
       "SELECT l_orderkey, l_linenumber, "
       + ", ".join(f"CASE WHEN {col} > 0 THEN '{yes}' ELSE '{no}' END AS {name}"
                   for name, (col, yes, no) in O.ADDON_FLAGS.items())
       + " FROM (SELECT l_orderkey, l_linenumber, " + ", ".join(_ADDON_SRC) + " FROM lineitem)")
def _addon_flags(spark, sf_dir):
    """T-43 / M-04: positive amount -> measure, otherwise (NULL too) unknown."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", *_ADDON_SRC)
    return li.select("l_orderkey", "l_linenumber",
                     *[positive_flag(col, yes, no).alias(name) for name, (col, yes, no) in e2.ADDON_FLAGS.items()])


_M_SRC = [
    _case("p_partkey % 3", ["Loft Insulation 0 - 300mm", "Unknown", None]) + " AS m1",
    "concat(p_type, ' boiler') AS m2",
    _case("p_partkey % 4", ["LEDs", "Cavity Wall Insulation (Unknown Property Age)", "Water Widget", None]) + " AS m3",
    _case("p_partkey % 5", ["Energy Monitor", "smart thing", "Radiator Panels", "Unknown Radiator Panels",
                            "Solid Wall Insulation"]) + " AS m4",
]


@query("unpivot_measures",
       "WITH src AS (SELECT p_partkey, " + ", ".join(_M_SRC) + " FROM part), "
       "u AS (UNPIVOT src ON m1, m2, m3, m4 INTO NAME \"COLUMN\" VALUE MEASURE) "
       f"SELECT * FROM (SELECT p_partkey, \"COLUMN\", MEASURE, {_rules_sql(e2.MEASURE_GROUP, e2.ERROR)} "
       "AS MEASURE_GROUP FROM u) WHERE MEASURE_GROUP <> 'Unknown'")
def _unpivot_measures(spark, sf_dir):
    """R-01 unpivot (NULLs dropped), T-44 measure group, F-08 drop Unknown."""
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", *_M_SRC)
    long = R.explode_measures(p, ["m1", "m2", "m3", "m4"], ["p_partkey"])
    grouped = long.withColumn("MEASURE_GROUP", classify(e2.MEASURE_GROUP, e2.ERROR))
    return grouped.where(F.col("MEASURE_GROUP") != "Unknown")


# ===========================================================================
# Resolution (K-03 .. K-06, W-01 .. W-05)
# ===========================================================================

def _event_obs(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("UPRN"),
        F.col("ts").cast("date").alias("TIMESTAMP"),
        F.col("event_type").alias("VALUE"),
        F.col("value").alias("amount"),
        F.element_at(F.array(*[F.lit(s) for s in SOURCES3]), (F.col("event_id") % 3 + 1).cast("int")).alias("SOURCE"),
        (F.col("event_id") % 3).cast("int").alias("source_rank"),
        F.col("event_id").alias("seq"),
    )


_EVENT_OBS_SQL = (
    "SELECT user_id AS UPRN, CAST(ts AS DATE) AS TIMESTAMP, event_type AS VALUE, value AS amount, "
    f"CASE event_id % 3 WHEN 0 THEN '{SOURCES3[0]}' WHEN 1 THEN '{SOURCES3[1]}' ELSE '{SOURCES3[2]}' END AS SOURCE, "
    "CAST(event_id % 3 AS INTEGER) AS source_rank, event_id AS seq FROM events")


@query("resolve_latest_events", f"""
WITH obs AS ({_EVENT_OBS_SQL})
SELECT UPRN, TIMESTAMP, VALUE, SOURCE FROM obs
WHERE UPRN IS NOT NULL AND VALUE IS NOT NULL AND VALUE NOT IN ('error')
QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY TIMESTAMP DESC NULLS LAST, source_rank, seq) = 1""")
def resolve_latest_events(spark, sf_dir):
    """K-03: three sources, exclusions, latest date per key, ties by source then row."""
    obs = _event_obs(spark, sf_dir)
    res = W.resolve_latest(obs, "UPRN", "VALUE", "TIMESTAMP", exclude=("error",))
    return res.select("UPRN", "TIMESTAMP", "VALUE", "SOURCE")


@query("resolve_latest_numeric", f"""
WITH obs AS ({_EVENT_OBS_SQL}),
n AS (SELECT UPRN, TIMESTAMP, SOURCE, source_rank, seq,
             coalesce(CASE WHEN seq % 4 = 0 THEN NULL ELSE amount END,
                      CASE WHEN seq % 5 = 0 THEN NULL ELSE amount * 0.5 END) AS SAP_SCORE FROM obs)
SELECT UPRN, TIMESTAMP, SAP_SCORE, SOURCE FROM n WHERE SAP_SCORE IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY TIMESTAMP DESC NULLS LAST, source_rank, seq) = 1""")
def _resolve_latest_numeric(spark, sf_dir):
    """K-04: coalesce(post, pre) before the latest pick."""
    obs = _event_obs(spark, sf_dir).selectExpr(
        "UPRN", "TIMESTAMP", "SOURCE", "source_rank", "seq",
        "CASE WHEN seq % 4 = 0 THEN NULL ELSE amount END AS post",
        "CASE WHEN seq % 5 = 0 THEN NULL ELSE amount * 0.5 END AS pre")
    res = W.resolve_latest_numeric(obs, "UPRN", "TIMESTAMP", "post", "pre", "SAP_SCORE")
    return res.select("UPRN", "TIMESTAMP", "SAP_SCORE", "SOURCE")


@query("resolve_first_arrival", """
SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS source_rank FROM orders
WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('5-LOW')
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3, o_orderkey) = 1""")
def _resolve_first_arrival(spark, sf_dir):
    """K-05 / W-03: first usable value per key by (source, row), not by date."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey",
        (F.col("o_orderkey") % 3).cast("int").alias("source_rank"), F.col("o_orderkey").alias("seq"))
    res = W.resolve_first(o, "o_custkey", "o_orderpriority", exclude=("5-LOW",))
    return res.select("o_custkey", "o_orderpriority", "o_orderkey", "source_rank")


_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedupe_first_wins", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def _dedupe_first_wins(spark, sf_dir):
    """W-03 on a non-unique composite key, order = every other column."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return W.first_per_key(li.select(*_LI_COLS), ["l_orderkey", "l_linenumber"], _LI_COLS[2:])


@query("group_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, n FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def _group_duplicates(spark, sf_dir):
    """W-02 group size on every row + F-12 keep groups of size > 1."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return W.with_group_size(li, ["l_orderkey", "l_linenumber"], "n").where("n > 1")


@query("duplicate_count", """
WITH k AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS k FROM lineitem)
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_keys,
       CAST(count(*) - count(DISTINCT k) - max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicates
FROM k""")
def _duplicate_count(spark, sf_dir):
    """A-06 / Q-04: duplicates = rows - distinct keys, a missing key counted as a key."""
    li = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS k")
    return Q.profile_counts(li, "k").select(
        F.col("n_rows").cast("long"), F.col("n_keys").cast("long"), F.col("n_duplicates").cast("long"))


_TECHS = ["view", "click", "purchase", "signup", "error", "refund"]


def _tech_obs(spark, sf_dir) -> DataFrame:
    obs = _event_obs(spark, sf_dir)
    return obs.select(F.col("UPRN").alias("key"), F.lit("RENEWABLES").alias("attr"), F.col("VALUE").alias("value"),
                      F.lit(None).cast("double").alias("num"), F.col("TIMESTAMP").alias("ts"),
                      F.col("SOURCE").alias("source"), "source_rank", "seq")


def _tech_sql(select: str) -> str:
    flags = ", ".join(
        f"CASE WHEN max(CASE WHEN VALUE = '{t}' THEN 1 ELSE 0 END) = 1 THEN 'Yes' ELSE '' END AS {t}" for t in _TECHS)
    count = " + ".join(f"max(CASE WHEN VALUE = '{t}' THEN 1 ELSE 0 END)" for t in _TECHS)
    firsts = ", ".join(
        f"coalesce(max(CASE WHEN VALUE = '{t}' AND rn = 1 THEN SOURCE END), '') AS {t}_SOURCE, "
        f"max(CASE WHEN VALUE = '{t}' AND rn = 1 THEN TIMESTAMP END) AS {t}_TIMESTAMP" for t in _TECHS)
    return f"""
WITH obs AS ({_EVENT_OBS_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY UPRN, VALUE ORDER BY source_rank, seq) AS rn FROM obs
      WHERE VALUE IS NOT NULL AND VALUE NOT IN ('Unknown', 'Other') AND UPRN IS NOT NULL),
m AS (SELECT UPRN, {flags}, CAST({count} AS INTEGER) AS RENEWABLE_COUNT, {firsts} FROM r GROUP BY UPRN)
SELECT {select} FROM m"""


@query("technology_flags", _tech_sql("UPRN, " + ", ".join(_TECHS) + ", RENEWABLE_COUNT"))
def _technology_flags(spark, sf_dir):
    """R-02 / A-04 / A-10 / M-02: presence flags over a fixed list + count."""
    m = R.technology_matrix(_tech_obs(spark, sf_dir), _TECHS)
    return m.select(F.col("key").alias("UPRN"), *_TECHS, "RENEWABLE_COUNT")


@query("technology_first_source",
       _tech_sql("UPRN, " + ", ".join(f"{t}_SOURCE, {t}_TIMESTAMP" for t in _TECHS)))
def _technology_first_source(spark, sf_dir):
    """A-05 / R-03 / R-04: first source and date per technology in arrival order."""
    m = R.technology_matrix(_tech_obs(spark, sf_dir), _TECHS)
    return m.select(F.col("key").alias("UPRN"), *[c for t in _TECHS for c in (f"{t}_SOURCE", f"{t}_TIMESTAMP")])


# ===========================================================================
# Master assembly and provenance (K-07 .. K-09, A-11, A-12, P-04, P-05, P-08)
# ===========================================================================

_MASTER_SPECS = [
    R.AttributeSpec("STATUS", "STATUS_NAME", "latest", exclude=("P",)),
    R.AttributeSpec("PRIORITY", "PRIORITY_NAME", "first", exclude=("5-LOW",)),
    R.AttributeSpec("EVENT", "EVENT_NAME", "latest", exclude=("error",)),
    R.AttributeSpec("SCORE", "SCORE", "latest", numeric=True),
    R.AttributeSpec("SEGMENT", "SEGMENT_NAME", "latest", exclude=("AUTOMOBILE",)),
]
_MASTER_TECHS = ["view", "click", "purchase"]
_MASTER_VALUES = ["STATUS_NAME", "PRIORITY_NAME", "EVENT_NAME", "SCORE", "SEGMENT_NAME",
                  *_MASTER_TECHS, "RENEWABLE_COUNT"]


def _master_obs(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderdate").cast("date").alias("ts"),
        F.lit(e1.SOURCE_WAREHOUSE).alias("source"), F.lit(0).alias("source_rank"), F.col("o_orderkey").alias("seq"),
        "o_orderstatus", "o_orderpriority")
    orders_obs = R.to_observations(o, "key", "ts", {"STATUS": "o_orderstatus", "PRIORITY": "o_orderpriority"},
                                   source="source")
    ev = _event_obs(spark, sf_dir).withColumn("score", F.when(F.col("seq") % 4 != 0, F.col("amount")))
    ev = ev.withColumn("tech", F.col("VALUE"))
    events_obs = R.to_observations(ev, "UPRN", "TIMESTAMP", {"EVENT": "VALUE", "RENEWABLES": "tech"},
                                   numeric={"SCORE": "score"})
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.lit(None).cast("date").alias("ts"), F.lit(e1.SOURCE_FEED2).alias("source"),
        F.lit(2).alias("source_rank"), F.col("c_custkey").alias("seq"), "c_mktsegment")
    cust_obs = R.to_observations(c, "key", "ts", {"SEGMENT": "c_mktsegment"}, source="source")
    obs = orders_obs.unionByName(events_obs).unionByName(cust_obs)
    return R.exclude_observations(obs, _MASTER_SPECS, "RENEWABLES", ("Unknown", "Other"))


def master_wide(spark, sf_dir) -> DataFrame:
    return R.resolve_wide(_master_obs(spark, sf_dir), _MASTER_SPECS, _MASTER_TECHS)


def master_assembly(spark, sf_dir):
    """K-07: one aggregation over the long frame -> master with DATA_COUNT."""
    return R.assemble_master(master_wide(spark, sf_dir), _MASTER_VALUES)


_SRC_CASE = (f"CASE event_id % 3 WHEN 0 THEN '{SOURCES3[0]}' WHEN 1 THEN '{SOURCES3[1]}' "
             f"ELSE '{SOURCES3[2]}' END")

_MASTER_CTES = f"""
obs AS (
  SELECT o_custkey AS k, 'STATUS' AS attr, o_orderstatus AS v, CAST(NULL AS DOUBLE) AS num,
         CAST(o_orderdate AS DATE) AS ts, '{e1.SOURCE_WAREHOUSE}' AS src, 0 AS rk, o_orderkey AS seq FROM orders
  UNION ALL SELECT o_custkey, 'PRIORITY', o_orderpriority, NULL, CAST(o_orderdate AS DATE), '{e1.SOURCE_WAREHOUSE}',
         0, o_orderkey FROM orders
  UNION ALL SELECT user_id, 'EVENT', event_type, NULL, CAST(ts AS DATE), {_SRC_CASE}, event_id % 3, event_id FROM events
  UNION ALL SELECT user_id, 'RENEWABLES', event_type, NULL, CAST(ts AS DATE), {_SRC_CASE}, event_id % 3, event_id
         FROM events
  UNION ALL SELECT user_id, 'SCORE', NULL, CASE WHEN event_id % 4 <> 0 THEN value END, CAST(ts AS DATE), {_SRC_CASE},
         event_id % 3, event_id FROM events
  UNION ALL SELECT c_custkey, 'SEGMENT', c_mktsegment, NULL, CAST(NULL AS DATE), '{e1.SOURCE_FEED2}', 2, c_custkey
         FROM customer),
kept AS (SELECT * FROM obs WHERE k IS NOT NULL AND (v IS NOT NULL OR num IS NOT NULL)
  AND NOT ((attr = 'STATUS' AND v = 'P') OR (attr = 'PRIORITY' AND v = '5-LOW') OR (attr = 'EVENT' AND v = 'error')
           OR (attr = 'SEGMENT' AND v = 'AUTOMOBILE') OR (attr = 'RENEWABLES' AND v IN ('Unknown', 'Other')))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k, attr ORDER BY
    CASE WHEN attr = 'PRIORITY' THEN NULL ELSE ts END DESC NULLS LAST, rk, seq) AS rn,
  row_number() OVER (PARTITION BY k, attr, v ORDER BY rk, seq) AS trn FROM kept),
wide AS (SELECT k,
  max(CASE WHEN attr = 'STATUS' AND rn = 1 THEN v END) AS STATUS_NAME,
  max(CASE WHEN attr = 'STATUS' AND rn = 1 THEN ts END) AS TIMESTAMP_STATUS,
  max(CASE WHEN attr = 'STATUS' AND rn = 1 THEN src END) AS SOURCE_STATUS,
  max(CASE WHEN attr = 'PRIORITY' AND rn = 1 THEN v END) AS PRIORITY_NAME,
  max(CASE WHEN attr = 'PRIORITY' AND rn = 1 THEN ts END) AS TIMESTAMP_PRIORITY,
  max(CASE WHEN attr = 'PRIORITY' AND rn = 1 THEN src END) AS SOURCE_PRIORITY,
  max(CASE WHEN attr = 'EVENT' AND rn = 1 THEN v END) AS EVENT_NAME,
  max(CASE WHEN attr = 'EVENT' AND rn = 1 THEN ts END) AS TIMESTAMP_EVENT,
  max(CASE WHEN attr = 'EVENT' AND rn = 1 THEN src END) AS SOURCE_EVENT,
  max(CASE WHEN attr = 'SCORE' AND rn = 1 THEN num END) AS SCORE,
  max(CASE WHEN attr = 'SCORE' AND rn = 1 THEN ts END) AS TIMESTAMP_SCORE,
  max(CASE WHEN attr = 'SCORE' AND rn = 1 THEN src END) AS SOURCE_SCORE,
  max(CASE WHEN attr = 'SEGMENT' AND rn = 1 THEN v END) AS SEGMENT_NAME,
  max(CASE WHEN attr = 'SEGMENT' AND rn = 1 THEN ts END) AS TIMESTAMP_SEGMENT,
  max(CASE WHEN attr = 'SEGMENT' AND rn = 1 THEN src END) AS SOURCE_SEGMENT,
  max(CASE WHEN attr = 'RENEWABLES' AND v = 'view' THEN 1 ELSE 0 END) AS f_view,
  max(CASE WHEN attr = 'RENEWABLES' AND v = 'click' THEN 1 ELSE 0 END) AS f_click,
  max(CASE WHEN attr = 'RENEWABLES' AND v = 'purchase' THEN 1 ELSE 0 END) AS f_purchase
  FROM ranked GROUP BY k),
master AS (SELECT k AS UPRN,
  coalesce(STATUS_NAME, '') AS STATUS_NAME, coalesce(PRIORITY_NAME, '') AS PRIORITY_NAME,
  coalesce(EVENT_NAME, '') AS EVENT_NAME, coalesce(CAST(SCORE AS VARCHAR), '') AS SCORE,
  coalesce(SEGMENT_NAME, '') AS SEGMENT_NAME,
  CASE WHEN f_view = 1 THEN 'Yes' ELSE '' END AS "view", CASE WHEN f_click = 1 THEN 'Yes' ELSE '' END AS click,
  CASE WHEN f_purchase = 1 THEN 'Yes' ELSE '' END AS purchase,
  CAST(f_view + f_click + f_purchase AS VARCHAR) AS RENEWABLE_COUNT
  FROM wide),
counted AS (SELECT *, CAST((STATUS_NAME <> '')::INT + (PRIORITY_NAME <> '')::INT + (EVENT_NAME <> '')::INT
  + (SCORE <> '')::INT + (SEGMENT_NAME <> '')::INT + ("view" <> '')::INT + (click <> '')::INT
  + (purchase <> '')::INT AS INTEGER) AS DATA_COUNT FROM master)"""

query("master_assembly", f"WITH {_MASTER_CTES} SELECT * FROM counted")(master_assembly)


@query("data_count_summary", f"""
WITH {_MASTER_CTES}
SELECT CAST(min(DATA_COUNT) AS DOUBLE) AS "min", quantile_cont(DATA_COUNT, 0.25) AS q1,
       quantile_cont(DATA_COUNT, 0.5) AS median, round(avg(DATA_COUNT), 9) AS mean,
       quantile_cont(DATA_COUNT, 0.75) AS q3, CAST(max(DATA_COUNT) AS DOUBLE) AS "max" FROM counted""")
def _data_count_summary(spark, sf_dir):
    """A-08 five-number summary + mean of DATA_COUNT (A-11)."""
    s = Q.five_number(master_assembly(spark, sf_dir), "DATA_COUNT", exact=True)
    return s.withColumn("mean", F.round("mean", 9))


_QUANTILES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


@query("exact_quantiles", "SELECT " + ", ".join(
    f"quantile_cont(l_extendedprice, {p}) AS price_{i}, quantile_cont(CAST(l_quantity AS DOUBLE), {p}) AS quantity_{i}" for i, p in enumerate(_QUANTILES)) + " FROM lineitem")
def _exact_quantiles(spark, sf_dir):
    """A-08 on an unbounded column: distributed selection, no value map in one task."""
    items = table(spark, sf_dir, "lineitem")
    found = {"price": Q.exact_quantiles(items, "l_extendedprice", _QUANTILES, most=2_000), "quantity": Q.exact_quantiles(items, "l_quantity", _QUANTILES)}
    return spark.createDataFrame([tuple(found[c][p] for p in _QUANTILES for c in found)], ", ".join(f"{c}_{i} double" for i in range(len(_QUANTILES)) for c in found))


@query("drop_columns_by_pattern", f"""
WITH {_MASTER_CTES}
SELECT k AS UPRN, coalesce(STATUS_NAME, '') AS STATUS_NAME, coalesce(PRIORITY_NAME, '') AS PRIORITY_NAME,
       coalesce(EVENT_NAME, '') AS EVENT_NAME, coalesce(CAST(SCORE AS VARCHAR), '') AS SCORE,
       coalesce(SEGMENT_NAME, '') AS SEGMENT_NAME FROM wide""")
def _drop_columns_by_pattern(spark, sf_dir):
    """P-08 drop (SOURCE|TIMESTAMP) columns case-insensitively, then P-12 blank fill."""
    wide = R.resolve_wide(_master_obs(spark, sf_dir), _MASTER_SPECS)
    narrow = P.drop_matching(wide.withColumnRenamed("key", "UPRN"), "(SOURCE|TIMESTAMP)")
    return P.blank_nulls(narrow, [c for c in narrow.columns if c != "UPRN"])


_PROV_ATTRS = ["STATUS", "PRIORITY", "EVENT"]


@query("provenance_extract", f"""
WITH {_MASTER_CTES},
pop AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT c.UPRN, c.STATUS_NAME, w.TIMESTAMP_STATUS, w.SOURCE_STATUS, c.PRIORITY_NAME, w.TIMESTAMP_PRIORITY,
       w.SOURCE_PRIORITY, c.EVENT_NAME, w.TIMESTAMP_EVENT, w.SOURCE_EVENT, c.DATA_COUNT
FROM counted c LEFT JOIN wide w ON c.UPRN = w.k
WHERE c.UPRN IN (SELECT k FROM pop)""")
def _provenance_extract(spark, sf_dir):
    """K-09: master + per-attribute provenance tables, population semi join, first-wins dedup."""
    from abode.plans.provenance import provenance_extract

    obs = _master_obs(spark, sf_dir)
    master = R.assemble_master(R.resolve_wide(obs, _MASTER_SPECS, _MASTER_TECHS), _MASTER_VALUES)
    # Provenance tables as stored: one (UPRN, TIMESTAMP, SOURCE) table per
    # attribute, each resolved from its own attribute's rows only.
    specs = {s.name: s for s in _MASTER_SPECS}
    tables = {}
    for a in _PROV_ATTRS:
        rows = obs.where(F.col("attr") == a)
        picked = (W.resolve_latest(rows, "key", "value", "ts") if specs[a].policy == "latest"
                  else W.resolve_first(rows, "key", "value"))
        tables[a] = picked.select(F.col("key").alias("UPRN"), F.col("ts").alias("TIMESTAMP"),
                                  F.col("source").alias("SOURCE"), "seq")
    population = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("UPRN"))
    contract = ["UPRN"]
    for a in _PROV_ATTRS:
        contract += [f"{a}_NAME", f"TIMESTAMP_{a}", f"SOURCE_{a}"]
    contract.append("DATA_COUNT")
    return provenance_extract(master.withColumn("seq", F.col("UPRN")), tables, population, contract)


# ===========================================================================
# Joins and population (J-02 .. J-05, J-11 .. J-13)
# ===========================================================================

@query("population_semi", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def _population_semi(spark, sf_dir):
    """J-13: keep keys in the reference population."""
    pop = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return J.in_population(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), pop, "c_custkey", "o_custkey")


@query("population_anti", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_custkey = c.c_custkey)""")
def _population_anti(spark, sf_dir):
    """J-12 / Q-05: keys missing from the reference population."""
    pop = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return J.missing_from(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), pop, "c_custkey", "o_custkey")


@query("warehouse_attribute", f"""
WITH codes AS (
  SELECT c_custkey AS home, 'NATION' AS attr, CAST(c_nationkey AS VARCHAR) AS code, true AS dated FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  UNION ALL
  SELECT c_custkey, 'SECOND', CAST(c_custkey % 25 AS VARCHAR), false FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')),
named AS (SELECT c.*, n.n_name AS value FROM codes c JOIN nation n ON c.code = CAST(n.n_nationkey AS VARCHAR)),
det AS (SELECT o_custkey AS home, CAST(o_orderkey % 25 AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS d FROM orders),
obs AS (
  SELECT nm.home, nm.attr, nm.value,
         CASE WHEN year(det.d) > 1998 THEN DATE '1990-01-01' ELSE det.d END AS TIMESTAMP
    FROM named nm JOIN det ON nm.home = det.home AND nm.code = det.code WHERE nm.dated
  UNION ALL SELECT home, attr, value, DATE '{e1.WAREHOUSE_CONSTANT_DATE}' FROM named WHERE NOT dated)
SELECT x.o_orderkey AS UPRN, obs.TIMESTAMP, obs.attr, obs.value, '{e1.SOURCE_WAREHOUSE}' AS SOURCE,
       CAST(obs.home AS BIGINT) AS seq
FROM obs JOIN orders x ON obs.home = x.o_custkey""")
def _warehouse_attribute(spark, sf_dir):
    """SRC-04 / J-02..J-04: one scan of the fact table, dictionary, dated detail, xref."""
    from abode.sources.warehouse import warehouse_observations

    homes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("HOME_ID"), F.col("c_mktsegment").alias("GOV_REG_CODE"),
        F.col("c_nationkey").alias("NATION_CODE"), (F.col("c_custkey") % 25).alias("SECOND_CODE"))
    dictionary = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("DETAIL_LOOKUP_CODE"), F.col("n_name").alias("DETAIL_LOOKUP_NAME"))
    orders = table(spark, sf_dir, "orders")
    details = orders.select(F.col("o_custkey").alias("HOMES_HOME_ID"),
                            (F.col("o_orderkey") % 25).alias("DETS_LKP_DET_LKP_ID"),
                            F.col("o_orderdate").alias("DETAIL_DATE"))
    xref = orders.select(F.col("o_orderkey").alias("UPRN"), F.col("o_custkey").alias(e1.XREF_HOME_COLUMN))
    return warehouse_observations(
        homes, dictionary, details, xref,
        [("NATION", "NATION_CODE", "capped"), ("SECOND", "SECOND_CODE", "constant")],
        region=("BUILDING", "MACHINERY", "HOUSEHOLD"), cap_after_year=1998, cap_date="1990-01-01")


@query("region_lookup_required", """
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_regionkey IN (0, 1, 2)""")
def _region_lookup_required(spark, sf_dir):
    """J-05: left join then drop unmatched == inner join on a required lookup."""
    n = table(spark, sf_dir, "nation").where("n_regionkey IN (0, 1, 2)").select("n_nationkey", "n_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    out = J.lookup_join(c, n, {"c_nationkey": "n_nationkey"}, required=True, null_safe=False)
    return out.select("c_custkey", "n_name")


@query("regeocode_coalesce", """
WITH prev AS (SELECT s_suppkey, s_nationkey, 'OLD ' || s_name AS NAME FROM supplier),
geo AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'Unknown' ELSE n_name END AS NAME
        FROM nation WHERE n_regionkey <> 3)
SELECT p.s_suppkey, p.s_nationkey, coalesce(g.NAME, p.NAME) AS NAME
FROM prev p LEFT JOIN geo g ON p.s_nationkey IS NOT DISTINCT FROM g.n_nationkey""")
def _regeocode_coalesce(spark, sf_dir):
    """J-11: newest lookup wins, old value as fallback ("Unknown" is a value and wins)."""
    prev = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_nationkey", "concat('OLD ', s_name) AS NAME")
    geo = table(spark, sf_dir, "nation").where("n_regionkey <> 3").selectExpr(
        "n_nationkey", "CASE WHEN n_nationkey % 5 = 0 THEN 'Unknown' ELSE n_name END AS NAME")
    return J.refresh_columns(prev, geo, {"s_nationkey": "n_nationkey"}, ["NAME"])


# ===========================================================================
# Appends, sorts, profiles, gates (U-01, O-02, X-07, A-02, A-03, A-07, A-09, Q-*)
# ===========================================================================

_HIST_SRC = ("SELECT o_orderkey, concat('FY', CAST(year(o_orderdate) AS STRING)) AS FY, "
             "concat(CAST(o_orderkey % 97 AS STRING), ' ', lower(o_orderpriority), ' , ') AS STREET, "
             "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS TOWN, "
             "concat('bt', CAST(o_custkey % 50 AS STRING)) AS POSTCODE FROM orders")


@query("append_and_sort", f"""
WITH h AS ({_HIST_SRC.replace('STRING', 'VARCHAR')}),
prev AS (SELECT o_orderkey, FY, STREET, TOWN, POSTCODE FROM h WHERE FY < 'FY1998'),
new AS (SELECT o_orderkey, FY, coalesce(STREET, '') AS STREET, POSTCODE FROM h WHERE FY >= 'FY1998'),
u AS (SELECT o_orderkey, FY, STREET, TOWN, POSTCODE FROM prev
      UNION ALL SELECT o_orderkey, FY, STREET, NULL, POSTCODE FROM new)
SELECT o_orderkey, FY, POSTCODE,
  coalesce(STREET, 'NA') || coalesce(TOWN, 'NA') || coalesce(POSTCODE, 'NA') AS sort_key,
  {_squish_sql("array_to_string(list_transform(regexp_extract_all(lower(regexp_replace(STREET, '[,\\s]*$', '')), '" + O.TITLE_WORD + "', 1), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")} AS STREET,
  TOWN
FROM u""")
def _append_and_sort(spark, sf_dir):
    """K-14 pieces: union by name (missing -> NULL), NA-pasting sort key, tidy, sort."""
    h = table(spark, sf_dir, "orders").selectExpr(*_split_select(_HIST_SRC))
    prev = h.where("FY < 'FY1998'")
    new = P.blank_nulls(h.where("FY >= 'FY1998'").select("o_orderkey", "FY", "STREET", "POSTCODE"), ["STREET"])
    u = W.union_sources([("prev", prev), ("new", new)], source_col="_src", rank_col="_rank").drop("_src", "_rank")
    u = u.withColumn("sort_key", X.paste_na("STREET", "TOWN", "POSTCODE"))
    u = u.withColumn("STREET", X.tidy_address("STREET"))
    return E2.sort_master(u.withColumn("_add", F.col("sort_key"))).select("o_orderkey", "FY", "POSTCODE", "sort_key", "STREET", "TOWN")


_FREQ_SRC = ("SELECT p_brand, p_type, CAST(p_size AS STRING) AS p_size, "
             "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS p_name FROM part")
_FREQ_COLS = ["p_brand", "p_type", "p_size", "p_name"]


def _freq_sql(keep_null: bool) -> str:
    arms = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM src" for c in _FREQ_COLS)
    where = "" if keep_null else " WHERE value IS NOT NULL"
    return (f"WITH src AS ({_FREQ_SRC}), long AS ({arms}) "
            f"SELECT \"column\", value, CAST(count(*) AS BIGINT) AS n FROM long{where} GROUP BY \"column\", value")


def _freq_src(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*_split_select(_FREQ_SRC))


@query("freq_with_missing", _freq_sql(True))
def _freq_with_missing(spark, sf_dir):
    """A-02 / Q-08: value counts for several columns in one pass, missing kept."""
    return Q.frequency(_freq_src(spark, sf_dir), _FREQ_COLS, keep_null=True)


@query("freq_without_missing", _freq_sql(False))
def _freq_without_missing(spark, sf_dir):
    """A-03: value counts, missing excluded."""
    return Q.frequency(_freq_src(spark, sf_dir), _FREQ_COLS, keep_null=False)


@query("distinct_measures", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def _distinct_measures(spark, sf_dir):
    """A-07: sorted distinct values (missing dropped)."""
    return Q.distinct_values(table(spark, sf_dir, "part"), "p_type").withColumnRenamed("value", "p_type")


_KNOWN_TYPES = ["ECONOMY", "STANDARD", "SMALL"]


@query("unseen_categories",
       "SELECT DISTINCT p_type AS value FROM part WHERE p_type IS NOT NULL AND p_type NOT IN ("
       + ", ".join(f"'{v}'" for v in _KNOWN_TYPES) + ")")
def _unseen_categories(spark, sf_dir):
    """Q-09: values not in the known-category list."""
    return Q.unseen_values(table(spark, sf_dir, "part"), "p_type", _KNOWN_TYPES)


@query("quality_gate_counts",
       f"SELECT CAST(count_if(PROPERTY_TYPE = 'ERROR') AS BIGINT) AS PROPERTY_TYPE, "
       f"CAST(count_if(TENURE = 'ERROR') AS BIGINT) AS TENURE FROM ({_CLAIMS_TYPES_SQL})")
def _quality_gate_counts(spark, sf_dir):
    """A-09 / Q-01: ERROR counts for every gated column in one scan."""
    return Q.gate_counts(_claims_types(spark, sf_dir), ["PROPERTY_TYPE", "TENURE"])


@query("quality_gate_offenders",
       f"SELECT * FROM ({_CLAIMS_TYPES_SQL}) WHERE PROPERTY_TYPE = 'ERROR' OR TENURE = 'ERROR'")
def _quality_gate_offenders(spark, sf_dir):
    """Q-01 lenient mode: the quarantine frame of offending rows."""
    _, offenders = Q.gate(_claims_types(spark, sf_dir), ["PROPERTY_TYPE", "TENURE"], strict=False)
    return offenders


_QUAR_SRC = ("SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'x' END AS remove_marker, "
             "CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE c_name END AS Postcode, "
             "CASE WHEN c_custkey % 2 = 0 THEN concat('N', CAST(c_nationkey AS STRING)) "
             "ELSE concat('C', CAST(c_custkey AS STRING)) END AS duplicate_address FROM customer")


@query("quarantine_split", f"""
WITH src AS ({_QUAR_SRC.replace('STRING', 'VARCHAR')}),
kept AS (SELECT * FROM src WHERE remove_marker IS NULL),
sized AS (SELECT *, count(*) OVER (PARTITION BY duplicate_address) AS dupe_check FROM kept)
SELECT c_custkey, Postcode, dupe_check, 'kept' AS route FROM sized
  WHERE NOT (Postcode IS NULL OR Postcode IN ('', ' '))
UNION ALL
SELECT c_custkey, Postcode, dupe_check, 'quarantine' FROM sized
  WHERE (Postcode IS NULL OR Postcode IN ('', ' ')) AND dupe_check = 1""")
def _quarantine_split(spark, sf_dir):
    """F-06 manual-remove filter, W-02 group size, F-07 / Q-03 blank-key split."""
    src = table(spark, sf_dir, "customer").selectExpr(*_split_select(_QUAR_SRC))
    unmarked = FL.keep_unmarked(src, "remove_marker")
    sized = W.with_group_size(unmarked, "duplicate_address", "dupe_check")
    kept, quarantined = FL.split_blank_key(sized, "Postcode", "dupe_check")
    cols = ["c_custkey", "Postcode", "dupe_check"]
    return kept.select(*cols, F.lit("kept").alias("route")).unionByName(
        quarantined.select(*cols, F.lit("quarantine").alias("route")))


# ===========================================================================
# Annual measures on driver tables (K-10 .. K-13 composed)
# ===========================================================================

def _geo_spark(spark, sf_dir):
    from abode.plans.measures import postcode_geography

    directory = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS pcds", "concat('N09', lpad(CAST(c_nationkey % 13 AS STRING), 6, '0')) AS lad25cd",
        "concat('E140', lpad(CAST(c_nationkey AS STRING), 5, '0')) AS pcon24cd")
    return postcode_geography(directory, prefix="Customer#")


def _geo_sql() -> str:
    return (f"SELECT lower(replace(c_name, ' ', '')) AS pcds, lad AS LAUA_CODE, "
            f"{O.DISTRICT_NAME} AS LAUA_NAME, pcon AS PCON_CODE FROM "
            f"(SELECT c_name, 'N09' || lpad(CAST(c_nationkey % 13 AS VARCHAR), 6, '0') AS lad, "
            f"'E140' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS pcon FROM customer) "
            f"WHERE c_name LIKE 'Customer#%'")


@query("postcode_geography", _geo_sql())
def _postcode_geography(spark, sf_dir):
    """K-12 / T-45 / F-10: postcode directory -> key, district code and name, constituency."""
    return _geo_spark(spark, sf_dir)


_CLAIM_SRC = ("SELECT o_orderkey, concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) AS Postcode, "
              + _case("o_orderkey % 20", _HOUSE_TYPES) + " AS house_type, "
              + _case("o_orderkey % 13", _TENURES) + " AS tenure_raw, "
              "CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 1000 ELSE 0 END AS cost_hot_water_jacket, "
              "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / 500 END AS cost_water_widget, "
              "o_orderpriority AS scheme_name FROM orders")


@query("annual_measure_rows", f"""
WITH src AS ({_CLAIM_SRC.replace('STRING', 'VARCHAR')}),
geo AS ({_geo_sql()}),
names AS (SELECT 'E140' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS PCON24CD, n_name AS PCON_NAME
          FROM nation),
cl AS (SELECT o_orderkey, Postcode, scheme_name,
         {_rules_sql(e2.PROPERTY_TYPE, e2.ERROR)} AS PROPERTY_TYPE, {_rules_sql(e2.TENURE, e2.ERROR)} AS TENURE,
         CASE WHEN cost_hot_water_jacket > 0 THEN 'Hot Water Tank Insulation'
              ELSE 'Unknown Hot Water Tank Insulation' END AS HOT_WATER_TANK_INSULATION,
         CASE WHEN cost_water_widget > 0 THEN 'Water Widget' ELSE 'Unknown' END AS WATER_WIDGET
       FROM src),
j AS (SELECT cl.*, g.LAUA_CODE, g.LAUA_NAME, g.PCON_CODE, nm.PCON_NAME FROM cl
      LEFT JOIN geo g ON lower(replace(cl.Postcode, ' ', '')) IS NOT DISTINCT FROM g.pcds
      LEFT JOIN names nm ON g.PCON_CODE IS NOT DISTINCT FROM nm.PCON24CD),
u AS (UNPIVOT j ON HOT_WATER_TANK_INSULATION, WATER_WIDGET INTO NAME "COLUMN" VALUE MEASURE)
SELECT * FROM (SELECT o_orderkey, LAUA_NAME, PCON_CODE, PCON_NAME, PROPERTY_TYPE, TENURE, MEASURE,
  {_rules_sql(e2.MEASURE_GROUP, e2.ERROR)} AS MEASURE_GROUP, scheme_name AS {e2.SCHEME_COLUMN} FROM u)
WHERE MEASURE_GROUP <> 'Unknown'""")
def _annual_measure_rows(spark, sf_dir):
    """K-11 composed: claims -> geography -> constituency names -> unpivot -> group -> drop Unknown."""
    from abode.plans.measures import explode_claim_measures

    claims = table(spark, sf_dir, "orders").selectExpr(*_split_select(_CLAIM_SRC))
    claims = claims.select(
        "o_orderkey", "Postcode", "scheme_name",
        classify(e2.PROPERTY_TYPE, e2.ERROR).alias("PROPERTY_TYPE"),
        classify(e2.TENURE, e2.ERROR).alias("TENURE"),
        positive_flag("cost_hot_water_jacket", *e2.ADDON_FLAGS["HOT_WATER_TANK_INSULATION"][1:])
        .alias("HOT_WATER_TANK_INSULATION"),
        positive_flag("cost_water_widget", *e2.ADDON_FLAGS["WATER_WIDGET"][1:]).alias("WATER_WIDGET"))
    names = table(spark, sf_dir, "nation").selectExpr(
        "concat('E140', lpad(CAST(n_nationkey AS STRING), 5, '0')) AS PCON24CD", "n_name AS PCON24NM", "n_nationkey AS seq")
    rows = explode_claim_measures(claims, _geo_spark(spark, sf_dir), names,
                                  measure_cols=["HOT_WATER_TANK_INSULATION", "WATER_WIDGET"])
    return rows.select("o_orderkey", "LAUA_NAME", "PCON_CODE", "PCON_NAME", "PROPERTY_TYPE", "TENURE", "MEASURE",
                       "MEASURE_GROUP", F.col("scheme_name").alias(e2.SCHEME_COLUMN))


def _split_select(sql: str) -> list[str]:
    """Split 'SELECT a, b, c FROM t' into expression strings (top-level commas only)."""
    body = sql[len("SELECT "):sql.rindex(" FROM ")]
    out, depth, cur, quoted = [], 0, "", False
    for ch in body:
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch == "(":
            depth += 1
        elif not quoted and ch == ")":
            depth -= 1
        if ch == "," and depth == 0 and not quoted:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    out.append(cur.strip())
    return out
