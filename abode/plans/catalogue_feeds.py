"""Feed-cleaning programmes over the driver tables, with SQL oracles.

``clean_feed1`` (database extract + worksheet + key -> constituency lookup)
and ``clean_feed2`` (yes/no worksheet) are run unchanged on feeds derived
from whole driver tables: orders as the feed-1 extract, part as the feed-1
worksheet, customer as the property lookup, lineitem as the feed-2 sheet.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from abode.plans import attributes as E1
from abode.plans import catalogue as _C
from abode.plans import measures as E2
from abode.plans import oracle_rules as O
from abode.plans.catalogue import (_LITERAL_PICK, _PHRASES, _WS, _case, _rules_sql, _squish_sql, _split_select,
                                   _tonum_sql, query, table)
from abode.operators import sinks as S
from abode.plans.runs import import_masters, refresh_published
from abode.rules import e1, e2
from abode.session import checkpoint_root, stage_table, staging
from abode.sources.warehouse import warehouse_observations

_TENURES = ["Owner occupied", "Private - Owner", "Private rented", "Local Authority", "Housing Association",
            "RSL", None, "Mixed"]

# -- feed 1: orders as the database extract -----------------------------------
_F1_MEASURE = ("CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Non-Eco Funded Measure' WHEN 2 THEN '' "
               "ELSE " + _case("o_orderkey % 29", _PHRASES) + " END")
_F1_SECOND = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE " + _case("o_custkey % 29", _PHRASES) + " END"
_F1_KEY = "CASE WHEN o_orderkey % 50 = 0 THEN 'abc' ELSE CAST(o_custkey AS STRING) END"


def _raw_date(dialect: str) -> str:
    d = "CAST(o_orderdate AS DATE)"
    if dialect == "spark":
        fmt = {"dmy1": f"date_format({d}, 'd/M/yyyy')", "dots": f"date_format({d}, 'dd.MM.yyyy')",
               "dmy": f"date_format({d}, 'dd/MM/yyyy')",
               "serial": f"CAST(datediff({d}, DATE'1899-12-30') + 8000 AS STRING)"}
    else:
        fmt = {"dmy1": f"strftime({d}, '%-d/%-m/%Y')", "dots": f"strftime({d}, '%d.%m.%Y')",
               "dmy": f"strftime({d}, '%d/%m/%Y')",
               "serial": f"CAST(date_diff('day', DATE '1899-12-30', {d}) + 8000 AS VARCHAR)"}
    return (f"CASE o_orderkey % 6 WHEN 0 THEN {fmt['dmy1']} WHEN 1 THEN {fmt['dots']} WHEN 2 THEN {_LITERAL_PICK} "
            f"WHEN 3 THEN {fmt['serial']} WHEN 4 THEN NULL ELSE {fmt['dmy']} END")


_F1_DB_SPARK = (f"SELECT {_F1_KEY} AS UPRN, {_raw_date('spark')} AS TIMESTAMP, "
                f"{_case('o_orderkey % 8', _TENURES)} AS TENURE, {_F1_MEASURE} AS MEASURE, "
                f"{_F1_SECOND} AS Non_ECO_Measure, 'ab1 ?2cd' AS POSTCODE, o_orderkey AS seq FROM orders")

_SHEET_DATE = ("CASE p_partkey % 3 WHEN 0 THEN concat(lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0'), '/', "
               "lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0'), '/', CAST(2005 + p_partkey % 20 AS STRING)) "
               "WHEN 1 THEN '31/02/2019' ELSE NULL END")
_SHEET_FYEAR = ("CASE WHEN p_partkey % 4 = 0 THEN NULL "
                "ELSE concat('FY', CAST(1990 + p_partkey % 30 AS STRING), '/', CAST(p_partkey % 100 AS STRING)) END")
_F1_SHEET_SPARK = (f"SELECT CAST(p_partkey AS STRING) AS UPRN, {_case('p_partkey % 8', _TENURES)} AS TENURE, "
                   f"{_SHEET_FYEAR} AS FYEAR, {_case('p_partkey % 29', _PHRASES)} AS "
                   f"`Measure.as.provided.in.quarterly.data.submission`, "
                   f"CAST(NULL AS STRING) AS `If Non-ECO Funded Measure - Please Specify`, "
                   f"{_SHEET_DATE} AS `Completion.Date.(of.measure)`, p_brand AS PCODE, p_partkey AS seq FROM part")
_LOOKUP_SPARK = ("SELECT CAST(c_custkey AS DOUBLE) AS UPRN, CASE WHEN c_custkey % 10 = 0 THEN NULL "
                 "ELSE concat('S140000', lpad(CAST(c_nationkey AS STRING), 2, '0')) END AS PCON24CD FROM customer")


def _feed1(spark, sf_dir):
    db = table(spark, sf_dir, "orders").selectExpr(*_split_select(_F1_DB_SPARK))
    sheet = table(spark, sf_dir, "part").selectExpr(*_split_select(_F1_SHEET_SPARK))
    lookup = table(spark, sf_dir, "customer").selectExpr(*_split_select(_LOOKUP_SPARK))
    return E1.clean_feed1(db, sheet, lookup)


def _dmy_chain_sql(src: str, text: str, programme: str) -> str:
    """CTEs repairing ``text`` of CTE ``src``; the last CTE, ``dated``, adds ``__d``."""
    day_pads = ", ".join(f"'{d}/'" for d in range(1, 10))
    month_pads = ", ".join(f"'/{m}/'" for m in range(1, 10))
    lits = O.DATE_LITERALS
    num = _tonum_sql(text)
    return f"""
d1 AS (SELECT *, CASE WHEN coalesce(substr({text}, 1, 2) IN ('39', '43'), false) THEN
          CASE WHEN floor({num}) BETWEEN 0 AND 2958465 THEN
            strftime(DATE '1899-12-30' + CAST(floor({num}) - 2 AS INTEGER), '%d/%m/%Y') END
        ELSE {text} END AS __t1 FROM {src}),
d2 AS (SELECT *, regexp_replace(replace(__t1, '.', '/'), '^{_WS}+|{_WS}+$', '', 'g') AS __t2 FROM d1),
d3 AS (SELECT *, CASE WHEN coalesce(substr(__t2, 1, 2) IN ({day_pads}), false) THEN '0' || __t2 ELSE __t2 END
        AS __t3 FROM d2),
d4 AS (SELECT *, CASE WHEN coalesce(substr(__t3, 3, 3) IN ({month_pads}), false)
          THEN substr(__t3, 1, 3) || '0' || substr(__t3, 4, 6) ELSE __t3 END AS __t4 FROM d3),
d5 AS (SELECT *, CASE __t4 {lits} ELSE __t4 END AS __t5 FROM d4),
dated AS (SELECT *, coalesce(CASE WHEN regexp_matches(__t5, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')
          THEN CAST(try_strptime(__t5, '%d/%m/%Y') AS DATE) END, {programme}) AS __d FROM d5)"""


def _blank(c: str) -> str:
    return f"({c} IS NULL OR coalesce({c} IN ('', ' '), false))"


def _feed1_sql() -> str:
    def duck(sql: str) -> str:
        return sql.replace("AS STRING", "AS VARCHAR")
    markers = ", ".join(f"'{m}'" for m in O.NON_ECO_MARKERS)
    classes = ", ".join(f"{_rules_sql(r, d)} AS {n}" for n, r, d in E1.FEED1_CLASSIFIERS)
    key = f"CASE WHEN {_tonum_sql('UPRN')} = floor({_tonum_sql('UPRN')}) THEN CAST({_tonum_sql('UPRN')} AS BIGINT) END"
    sheet_fields = (f"CAST(p_partkey AS VARCHAR) AS UPRN, {duck(_SHEET_DATE)} AS TIMESTAMP, "
                    f"{_case('p_partkey % 8', _TENURES)} AS TENURE, {_case('p_partkey % 29', _PHRASES)} AS MEASURE, "
                    f"CAST(NULL AS VARCHAR) AS Non_ECO_Measure, "
                    f"CAST(try_strptime(regexp_extract({duck(_SHEET_FYEAR)}, '\\d{{4}}') || '-01-01', '%Y-%m-%d') "
                    f"AS DATE) AS FYEAR_DATE, p_partkey + {1 << 60} AS seq")
    return f"""
WITH u AS (
  SELECT {duck(_F1_KEY)} AS UPRN, {_raw_date('duck')} AS TIMESTAMP, {_case('o_orderkey % 8', _TENURES)} AS TENURE,
         {_F1_MEASURE} AS MEASURE, {_F1_SECOND} AS Non_ECO_Measure, CAST(NULL AS DATE) AS FYEAR_DATE,
         o_orderkey AS seq FROM orders
  UNION ALL SELECT {sheet_fields} FROM part),
sq AS (SELECT {_squish_sql('UPRN')} AS UPRN, {_squish_sql('TIMESTAMP')} AS TIMESTAMP, {_squish_sql('TENURE')} AS TENURE,
              {_squish_sql('lower(MEASURE)')} AS m, {_squish_sql('lower(Non_ECO_Measure)')} AS s, FYEAR_DATE, seq FROM u),
kept AS (SELECT * FROM sq WHERE NOT ({_blank('m')} AND {_blank('s')})),
filled AS (SELECT {key} AS UPRN, TIMESTAMP, {_squish_sql('lower(TENURE)')} AS TENURE, FYEAR_DATE, seq,
  {_squish_sql(f"lower(CASE WHEN coalesce(m IN ({markers}), false) OR ({_blank('m')} AND NOT {_blank('s')}) THEN s ELSE m END)")}
  AS MEASURE FROM kept),
lk AS (SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_custkey % 10 = 0 THEN NULL
       ELSE 'S140000' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS PCON_CODE FROM customer),
j AS (SELECT f.*, lk.PCON_CODE FROM filled f JOIN lk ON f.UPRN = lk.k
      WHERE f.UPRN IS NOT NULL AND f.MEASURE IS NOT NULL AND lk.PCON_CODE IS NOT NULL),
{_dmy_chain_sql('j', 'TIMESTAMP', 'FYEAR_DATE')}
SELECT UPRN, PCON_CODE,
       CASE WHEN __d IS NULL OR year(__d) < {O.FLOOR_YEAR} THEN DATE '{O.FLOOR_DATE}' ELSE __d END AS TIMESTAMP,
       strftime(__d, '%Y') AS YEAR, '{e1.SOURCE_FEED1}' AS SOURCE, seq,
       'Unknown' AS PROPERTY_TYPE_NAME, 'Unknown' AS PROPERTY_AGE_NAME, {classes}
FROM dated"""


query("feed1_cleaning", _feed1_sql())(_feed1)


# -- feed 2: lineitem as the yes/no worksheet ---------------------------------
def _flag_rest(i: int) -> str:
    return f"(l_orderkey + {i}) % {7 + i % 5}"


def _flag_expr(i: int, rest: str | None = None) -> str:
    # each yes/no column is "Yes"/"yes"/"no"/blank by a different key pattern
    return f"CASE {rest or _flag_rest(i)} WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes ' WHEN 2 THEN NULL ELSE 'no' END"


_F2_TENURE = _case("l_partkey % 6", ["Owner Occupier", "PRIVATE rented", "Local Authority", "Housing assoc", None,
                                     "owner"])
_F2_KEY = ("CASE l_linenumber WHEN 1 THEN '#N/A' WHEN 2 THEN ' ' "
           "ELSE CAST(l_partkey AS STRING) END")
_F2_NUMS = ["CAST(round(l_quantity) AS STRING)", "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_quantity + 20 AS STRING) END",
            "CAST(l_extendedprice AS STRING)", "CASE WHEN l_orderkey % 4 = 0 THEN 'n/a' ELSE CAST(l_tax AS STRING) END",
            "CAST(l_discount AS STRING)"]


def _f2_date(dialect: str) -> str:
    d = "l_shipdate"
    if dialect == "spark":
        iso, dmy = f"date_format({d}, 'yyyy-MM-dd')", f"date_format({d}, 'd/M/yyyy')"
    else:
        iso, dmy = f"strftime({d}, '%Y-%m-%d')", f"strftime({d}, '%-d/%-m/%Y')"
    return f"CASE l_orderkey % 5 WHEN 0 THEN {dmy} WHEN 1 THEN NULL ELSE {iso} END"


def _feed2_select(dialect: str) -> list[str]:
    cols = [f"{_F2_KEY} AS UPRN", f"{_f2_date(dialect)} AS `Master Completion Date`", f"{_F2_TENURE} AS Tenure"]
    cols += [f"{_flag_expr(i, f'rest_{i}')} AS `{h}`" for i, h in enumerate(e1.FEED2_FLAG_HEADERS)]
    cols += [f"{e} AS `{h}`" for e, h in zip(_F2_NUMS, e1.FEED2_NUMERIC_HEADERS.values())]
    cols.append("l_orderkey * 10 + l_linenumber AS seq")
    return cols


def _feed2(spark, sf_dir):
    rests = [f"{_flag_rest(i)} AS rest_{i}" for i in range(len(e1.FEED2_FLAG_HEADERS))]  # once each, not once for each WHEN
    sheet = table(spark, sf_dir, "lineitem").selectExpr("*", *rests).selectExpr(*_feed2_select("spark"))
    return E1.clean_feed2(sheet)


def _feed2_sql() -> str:
    flags = ", ".join(f"{_squish_sql(f'lower({_flag_expr(i)})')} AS {e1.flag_name(h)}"
                      for i, h in enumerate(e1.FEED2_FLAG_HEADERS))
    nums = ", ".join(f"{_tonum_sql(e.replace('AS STRING', 'AS VARCHAR'))} AS {n}"
                     for e, n in zip(_F2_NUMS, e1.FEED2_NUMERIC_HEADERS))
    classes = ", ".join(f"{_rules_sql(r, d)} AS {n}" for n, r, d in E1.FEED2_CLASSIFIERS)
    day_pads = ", ".join(f"'{d}/'" for d in range(1, 10))
    month_pads = ", ".join(f"'/{m}/'" for m in range(1, 10))
    lits = O.DATE_LITERALS
    key = (f"CASE WHEN {_tonum_sql('raw_key')} = floor({_tonum_sql('raw_key')}) "
           f"THEN CAST({_tonum_sql('raw_key')} AS BIGINT) END")
    return f"""
WITH src AS (SELECT {_F2_KEY.replace('AS STRING', 'AS VARCHAR')} AS raw_key, {_f2_date('duck')} AS raw_date,
                    {_squish_sql(f'lower({_F2_TENURE})')} AS tenure, {flags}, {nums},
                    l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
k AS (SELECT * FROM src WHERE raw_key IS NOT NULL AND NOT coalesce(raw_key IN ('', ' ', '#N/A', 'NA'), false)),
t2 AS (SELECT *, regexp_replace(replace(raw_date, '.', '/'), '^{_WS}+|{_WS}+$', '', 'g') AS __t2 FROM k),
t3 AS (SELECT *, CASE WHEN coalesce(substr(__t2, 1, 2) IN ({day_pads}), false) THEN '0' || __t2 ELSE __t2 END
        AS __t3 FROM t2),
t4 AS (SELECT *, CASE WHEN coalesce(substr(__t3, 3, 3) IN ({month_pads}), false)
          THEN substr(__t3, 1, 3) || '0' || substr(__t3, 4, 6) ELSE __t3 END AS __t4 FROM t3),
t5 AS (SELECT *, CASE __t4 {lits} ELSE __t4 END AS __t5 FROM t4),
dd AS (SELECT *, CASE WHEN coalesce(regexp_matches(__t5, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$'), false)
          THEN CAST(try_strptime(__t5, '%Y-%m-%d') AS DATE) ELSE DATE '{O.FLOOR_DATE}' END AS __d FROM t5),
c AS (SELECT *, 'Unknown' AS PROPERTY_TYPE_NAME, 'Unknown' AS PROPERTY_AGE_NAME,
             CAST(NULL AS VARCHAR) AS RIR_INS FROM dd)
SELECT {key} AS UPRN, CASE WHEN year(__d) < {O.FLOOR_YEAR} THEN DATE '{O.FLOOR_DATE}' ELSE __d END AS TIMESTAMP,
       strftime(__d, '%Y') AS YEAR, '{e1.SOURCE_FEED2}' AS SOURCE, seq,
       PROPERTY_TYPE_NAME, PROPERTY_AGE_NAME, RIR_INS, {classes}, {", ".join(e1.FEED2_NUMERIC_HEADERS)}
FROM c"""


query("feed2_cleaning", _feed2_sql())(_feed2)



# -- the whole attribute-resolution programme --------------------------------
_WH_REGION = ("BUILDING", "MACHINERY", "HOUSEHOLD")
_WH_ATTRS = [("PROPERTY_TYPE", "PROPERTY_TYPE_CODE", "constant"), ("PROPERTY_TENURE", "TENURE_CODE", "capped")]


def _observed(spark, sf_dir, sources=("f1", "f2", "wh"), long=False):
    """Observations of feeds 1 and 2 and the warehouse, or of some of them: side by side, or ``long``."""
    f1, f2 = _feed1(spark, sf_dir), _feed2(spark, sf_dir)
    homes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("HOME_ID"), F.col("c_mktsegment").alias("GOV_REG_CODE"),
        F.col("c_nationkey").alias("PROPERTY_TYPE_CODE"), (F.col("c_custkey") % 25).alias("TENURE_CODE"))
    dictionary = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("DETAIL_LOOKUP_CODE"), F.col("n_name").alias("DETAIL_LOOKUP_NAME"))
    orders = table(spark, sf_dir, "orders")
    details = orders.select(F.col("o_custkey").alias("HOMES_HOME_ID"),
                            (F.col("o_orderkey") % 25).alias("DETS_LKP_DET_LKP_ID"),
                            F.col("o_orderdate").alias("DETAIL_DATE"))
    xref = orders.select(F.col("o_orderkey").alias("UPRN"), F.col("o_custkey").alias(e1.XREF_HOME_COLUMN))
    wh = warehouse_observations(homes, dictionary, details, xref, _WH_ATTRS, _WH_REGION,
                                e1.WAREHOUSE_CONSTANT_DATE, e1.WAREHOUSE_CAP_YEAR, e1.WAREHOUSE_CAP_DATE,
                                e1.SOURCE_WAREHOUSE)
    return E1.observations(*(df if name in sources else None for name, df in (("f1", f1), ("f2", f2), ("wh", wh))), long=long)


def attribute_master(spark, sf_dir):
    """Feeds 1 and 2 + warehouse -> one-aggregation resolve -> 20-column master."""
    return E1.master(E1.resolve_attributes(_observed(spark, sf_dir)))


def _attribute_master_merged(spark, sf_dir):
    """K-07 with a kept state: the warehouse and feed 1 first, feed 2 merged into their winners."""
    first, later = _observed(spark, sf_dir, ("f1", "wh"), long=True), _observed(spark, sf_dir, ("f2",), long=True)
    state = stage_table(E1.attribute_state(first), "attribute-state")
    return E1.master(E1.resolve_attributes(E1.attribute_state(later, state)))


def _timestamped_master(spark, sf_dir):
    """K-08 / P-11: every value with its date and source; what a property lacks is missing."""
    return E1.timestamped_master(E1.resolve_attributes(_observed(spark, sf_dir)))


def _timestamped_master_sql() -> str:
    cols = []
    for name, out, _code, _rule, _ex, _pol in e1.ATTRIBUTES:
        hit = f"CASE WHEN attr = '{name}' AND rn = 1 THEN"
        value = _num_text(f"max({hit} num END)") if name in ("SAP_SCORE", "SAP_FUEL_BILL") else f"max({hit} v END)"
        cols += [f"max({hit} ts END) AS TIMESTAMP_{name}", f"{value} AS {out}", f"max({hit} src END) AS SOURCE_{name}"]
    has = {t: f"max(CASE WHEN attr = 'RENEWABLES' AND v = '{t}' THEN 1 ELSE 0 END)" for t in e1.TECHNOLOGIES}
    total = "(" + " + ".join(has.values()) + ")"
    cols.append(f"CASE WHEN {total} > 0 THEN CAST({total} AS INTEGER) END AS RENEWABLE_COUNT")
    for t, flag in has.items():
        first = f"CASE WHEN attr = 'RENEWABLES' AND v = '{t}' AND trn = 1 THEN"
        cols += [f"CASE WHEN {total} > 0 THEN CASE WHEN {flag} = 1 THEN 'Yes' ELSE '' END END AS {t}",
                 f"CASE WHEN {total} > 0 THEN coalesce(max({first} src END), '') END AS {t}_SOURCE", f"max({first} ts END) AS {t}_TIMESTAMP"]
    return f"WITH {_ranked_sql()} SELECT k AS UPRN, {', '.join(cols)} FROM rankedobs GROUP BY k"


def _duplicates_before_resolution(spark, sf_dir):
    """Q-04: rows, keys and duplicates by attribute, after exclusion."""
    return E1.duplicate_report(_observed(spark, sf_dir))


def _duplicates_observed(spark, sf_dir):
    """Q-04 / A-06: the same numbers, observed by the write of the resolved rows."""
    counted, seen = E1.observe_duplicates(E1.resolve_attributes(_observed(spark, sf_dir), counts=True))
    stage_table(counted, "attribute-wide")
    return E1.observed_duplicates(spark, seen)


def _observations_sql() -> str:
    """CTEs up to ``keptobs``: keyed observations of all sources after exclusion."""
    region = ", ".join(f"'{r}'" for r in _WH_REGION)
    wh = f"""
  SELECT x.o_orderkey AS k, nm.attr, nm.value AS v, CAST(NULL AS DOUBLE) AS num,
         CASE WHEN nm.dated THEN (CASE WHEN year(dt.d) > {e1.WAREHOUSE_CAP_YEAR} THEN DATE '{e1.WAREHOUSE_CAP_DATE}'
              ELSE dt.d END) ELSE DATE '{e1.WAREHOUSE_CONSTANT_DATE}' END AS ts,
         '{e1.SOURCE_WAREHOUSE}' AS src, 0 AS rk, CAST(nm.home AS BIGINT) AS seq
  FROM (SELECT c.home, c.attr, c.dated, n.n_name AS value FROM (
          SELECT c_custkey AS home, 'PROPERTY_TYPE' AS attr, CAST(c_nationkey AS VARCHAR) AS code, false AS dated
            FROM customer WHERE c_mktsegment IN ({region})
          UNION ALL SELECT c_custkey, 'PROPERTY_TENURE', CAST(c_custkey % 25 AS VARCHAR), true
            FROM customer WHERE c_mktsegment IN ({region})) c
        JOIN nation n ON c.code = CAST(n.n_nationkey AS VARCHAR)) nm
  LEFT JOIN (SELECT o_custkey AS home, CAST(o_orderkey % 25 AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS d
             FROM orders) dt ON nm.dated AND nm.home = dt.home AND
             (SELECT CAST(c_custkey % 25 AS VARCHAR) FROM customer WHERE c_custkey = nm.home) = dt.code
  JOIN orders x ON x.o_custkey = nm.home
  WHERE NOT nm.dated OR dt.home IS NOT NULL"""
    feed_attrs = {a: c for a, c in E1._FEED_ATTRS.items()}
    arms = []
    for a, c in feed_attrs.items():
        arms.append(f"SELECT UPRN AS k, '{a}' AS attr, {c} AS v, CAST(NULL AS DOUBLE) AS num, TIMESTAMP AS ts, "
                    f"SOURCE AS src, 1 AS rk, seq FROM f1src")
        arms.append(f"SELECT UPRN, '{a}', {c}, CAST(NULL AS DOUBLE), TIMESTAMP, SOURCE, 2, seq FROM f2src")
    arms.append("SELECT UPRN, 'SAP_SCORE', NULL, coalesce(POST_SAP_SCORE, PRE_SAP_SCORE), TIMESTAMP, SOURCE, 2, seq "
                "FROM f2src")
    arms.append("SELECT UPRN, 'SAP_FUEL_BILL', NULL, coalesce(POST_FUEL_BILL, PRE_FUEL_BILL), TIMESTAMP, SOURCE, 2, "
                "seq FROM f2src")
    excl = []
    for name, _out, _code, _rule, ex, _pol in e1.ATTRIBUTES:
        if ex:
            excl.append(f"(attr = '{name}' AND v IN ({', '.join(repr(x) for x in ex)}))")
    excl.append(f"(attr = 'RENEWABLES' AND v IN ({', '.join(repr(x) for x in e1.TECHNOLOGY_EXCLUDED)}))")
    return f"""
f1src AS ({_feed1_sql()}),
f2src AS ({_feed2_sql()}),
allobs AS ({wh}
  UNION ALL {' UNION ALL '.join(arms)}),
keptobs AS (SELECT * FROM allobs WHERE k IS NOT NULL AND (v IS NOT NULL OR num IS NOT NULL)
            AND NOT ({' OR '.join(excl)}))"""


def _ranked_sql() -> str:
    first_attrs = ", ".join(f"'{n}'" for n, _o, _c, _r, _x, p in e1.ATTRIBUTES if p == "first")
    return f"""{_observations_sql()},
rankedobs AS (SELECT *, row_number() OVER (PARTITION BY k, attr ORDER BY
    CASE WHEN attr IN ({first_attrs}) THEN NULL ELSE ts END DESC NULLS LAST, rk, seq) AS rn,
  row_number() OVER (PARTITION BY k, attr, v ORDER BY rk, seq) AS trn FROM keptobs)"""


def _num_text(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


def _attribute_master_sql() -> str:
    pivots = []
    for name, out, _code, _rule, _ex, _pol in e1.ATTRIBUTES:
        val = "num" if name in ("SAP_SCORE", "SAP_FUEL_BILL") else "v"
        pivots.append(f"max(CASE WHEN attr = '{name}' AND rn = 1 THEN {val} END) AS {out}")
    pivots += [f"max(CASE WHEN attr = 'RENEWABLES' AND v = '{t}' THEN 1 ELSE 0 END) AS f_{t}" for t in e1.TECHNOLOGIES]

    def num_text(c):
        return f"coalesce({_num_text(c)}, '')"
    texts = []
    for name, out, *_ in e1.ATTRIBUTES:
        texts.append(f"{num_text(out)} AS {out}" if name in ("SAP_SCORE", "SAP_FUEL_BILL")
                     else f"coalesce({out}, '') AS {out}")
    texts += [f"CASE WHEN f_{t} = 1 THEN 'Yes' ELSE '' END AS {t}" for t in e1.TECHNOLOGIES]
    total = " + ".join(f"f_{t}" for t in e1.TECHNOLOGIES)
    texts.append(f"CASE WHEN {total} > 0 THEN CAST({total} AS VARCHAR) ELSE '' END AS RENEWABLE_COUNT")
    counted = [c for c in e1.MASTER_COLUMNS if c not in ("UPRN", "RENEWABLE_COUNT")]
    data_count = " + ".join(f"CAST(\"{c}\" <> '' AS INTEGER)" for c in counted)
    return f"""
WITH {_ranked_sql()},
widem AS (SELECT k, {', '.join(pivots)} FROM rankedobs GROUP BY k),
masterm AS (SELECT k AS UPRN, {', '.join(texts)} FROM widem)
SELECT *, CAST({data_count} AS INTEGER) AS DATA_COUNT FROM masterm"""


query("attribute_master", _attribute_master_sql())(attribute_master)
query("attribute_master_merged", _attribute_master_sql())(_attribute_master_merged)
query("timestamped_master", _timestamped_master_sql())(_timestamped_master)
_DUPLICATES_SQL = (
    f"WITH {_observations_sql()} SELECT attr, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT k) AS BIGINT) AS n_keys, "
    "CAST(count(*) - count(DISTINCT k) AS BIGINT) AS n_duplicates FROM keptobs WHERE attr <> 'RENEWABLES' GROUP BY attr")
query("duplicates_before_resolution", _DUPLICATES_SQL)(_duplicates_before_resolution)
query("duplicates_observed", _DUPLICATES_SQL)(_duplicates_observed)


# -- annual claims cleaning (orders as one year's claims worksheet) -----------
_CLAIMS_AS_OF = _dt.date(2025, 4, 1)
_CLAIM_OUT = ["o_orderkey", "dupe_check", *e2.GATED_COLUMNS, *e2.ADDON_FLAGS, "FY"]


def _claims_select(dialect: str) -> str:
    cast = "STRING" if dialect == "spark" else "VARCHAR"
    return ", ".join([
        "o_orderkey",
        "CASE WHEN o_orderkey % 23 = 0 THEN 'x' END AS remove_marker",
        f"CASE WHEN o_orderkey % 5 = 0 THEN concat('U', CAST(o_orderkey AS {cast})) "
        f"ELSE concat('A', CAST(o_custkey AS {cast})) END AS duplicate_address",
        f"CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' "
        f"ELSE concat('BT', CAST(o_custkey % 50 AS {cast}), ' 1AA') END AS Postcode",
        f"{_case('o_orderkey % 20', _C._HOUSE_TYPES)} AS house_type",
        f"{_case('o_orderkey % 13', _C._TENURES)} AS tenure_raw",
        f"{_C._YEAR_SPARK.replace('AS STRING', f'AS {cast}')} AS year_built",
        f"{_case('o_custkey % 13', _C._BEDROOMS)} AS bedrooms_raw",
        f"{_case('o_orderkey % 9', _C._WALL_CATS)} AS wall_category",
        f"{_case('o_orderkey % 10', _C._WALL_TYPES)} AS wall_type",
        f"{_case('o_custkey % 9', _C._LOFT_TEXTS)} AS loft_depth",
        f"{_case('o_orderkey % 13', _C._FUELS)} AS fuel_before",
        f"{_case('o_custkey % 13', _C._FUELS)} AS fuel_after",
        f"{_case('o_orderkey % 9', _C._HEATING)} AS heating_after",
        f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(round(o_totalprice / 1000, 2) AS {cast}) END "
        f"AS cost_hot_water_jacket",
        f"CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 7 - 3 AS {cast}) END AS cost_radiator_panels",
        f"CAST(o_custkey % 6 AS {cast}) AS bulbs_installed",
        f"CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '12.5' END AS cost_smart_controls",
        f"CAST(o_orderkey % 5 - 2 AS {cast}) AS cost_water_widget",
    ])


def _claims(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*_split_select(f"SELECT {_claims_select('spark')} FROM orders"))


def _claims_cleaning(spark, sf_dir):
    """K-10 in lenient mode: clean claims only."""
    cleaned, _quarantined, _offenders = E2.clean_claims(_claims(spark, sf_dir), _CLAIMS_AS_OF, strict=False)
    return cleaned.select(*_CLAIM_OUT)


def _claims_offenders(spark, sf_dir):
    """K-10 in lenient mode: what the gates took out."""
    _cleaned, _quarantined, offenders = E2.clean_claims(_claims(spark, sf_dir), _CLAIMS_AS_OF, strict=False)
    return offenders.select(*_CLAIM_OUT)


def _claims_sql(clean: bool = True) -> str:
    from abode.functions.dates import fiscal_label

    first = [("PROPERTY_TYPE", e2.PROPERTY_TYPE, e2.ERROR), ("TENURE", e2.TENURE, e2.ERROR),
             ("PROPERTY_AGE", e2.PROPERTY_AGE, e2.ERROR), ("BEDROOMS", e2.BEDROOMS, e2.ERROR),
             ("EXTERNAL_WALL_TYPE", e2.EXTERNAL_WALL_TYPE, e2.EXTERNAL_WALL_TYPE_DEFAULT),
             ("WALL_INS_FILL", e2.WALL_FILL, e2.ERROR), ("LOFT_INSULATION_NI", e2.LOFT_REGIONAL, e2.ERROR),
             ("LOFT_INSULATION", e2.LOFT_NATIONAL, e2.ERROR), ("MAIN_HEATING_FUEL", e2.FUEL_BEFORE, e2.ERROR),
             ("FS_FUEL_AFTER", e2.FUEL_AFTER, e2.ERROR), ("MAIN_HEATING_SYSTEM", e2.HEATING_SYSTEM, e2.ERROR)]
    classes = ", ".join(f"{_rules_sql(r, d)} AS {n}" for n, r, d in first)
    flags = ", ".join(f"CASE WHEN {_tonum_sql(col)} > 0 THEN '{yes}' ELSE '{no}' END AS {name}"
                      for name, (col, yes, no) in O.ADDON_FLAGS.items())
    return f"""
WITH src AS (SELECT {_claims_select('duck')} FROM orders),
unmarked AS (SELECT * FROM src WHERE remove_marker IS NULL),
sized AS (SELECT *, count(*) OVER (PARTITION BY duplicate_address) AS dupe_check FROM unmarked),
kept AS (SELECT * FROM sized WHERE NOT (Postcode IS NULL OR coalesce(Postcode IN ('', ' '), false))),
num AS (SELECT *, {_tonum_sql('year_built')} AS year_built_num FROM kept),
c1 AS (SELECT *, {classes} FROM num),
c2 AS (SELECT *, {_rules_sql(e2.WALL_INSULATION, e2.ERROR)} AS WALL_INS, {flags},
              'FY{fiscal_label(_CLAIMS_AS_OF)}' AS FY FROM c1)
SELECT {', '.join(_CLAIM_OUT)} FROM c2 WHERE {"" if clean else "NOT "}({" AND ".join(f"{c} <> 'ERROR'" for c in O.GATED_COLUMNS)})"""


query("claims_cleaning", _claims_sql())(_claims_cleaning)
query("claims_offenders", _claims_sql(clean=False))(_claims_offenders)


# -- cumulative master refresh ------------------------------------------------
def _prev_master_select(dialect: str) -> str:
    cast = "STRING" if dialect == "spark" else "VARCHAR"
    return ", ".join([
        "CAST(NULL AS {c}) AS SUB_BUILDING".format(c=cast),
        f"CAST(o_orderkey % 200 AS {cast}) AS BUILDING_NUM",
        f"concat(lower(o_orderpriority), ' road , ') AS STREET",
        f"CAST(NULL AS {cast}) AS LOCALITY",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'N/A town' ELSE 'o''neill park' END AS TOWN",
        f"CAST(NULL AS {cast}) AS COUNTY",
        f"CASE WHEN o_orderkey % 6 = 0 THEN concat('XX', CAST(o_orderkey AS {cast})) "
        f"ELSE concat('Customer#', lpad(CAST(o_custkey AS {cast}), 9, '0')) END AS POSTCODE",
        "'OLD' AS PCON_CODE", "'Old name' AS PCON_NAME", "'OLDLA' AS LAUA_CODE", "'Old LA' AS LAUA_NAME",
        "o_orderstatus AS PROPERTY_TYPE", f"CAST(NULL AS {cast}) AS TENURE", f"CAST(NULL AS {cast}) AS PROPERTY_AGE",
        "o_orderpriority AS MEASURE", "'Other' AS MEASURE_GROUP",
        f"concat('FY', CAST(year(o_orderdate) AS {cast})) AS FY", f"'S' AS {e2.SCHEME_COLUMN}",
    ])


def _new_rows_select(dialect: str) -> str:
    cast = "STRING" if dialect == "spark" else "VARCHAR"
    return ", ".join([
        "'' AS SUB_BUILDING", f"CAST(o_orderkey % 50 AS {cast}) AS BUILDING_NUM", "'HIGH-STREET , ,' AS STREET",
        "'' AS LOCALITY", "'belfast' AS TOWN", "'' AS COUNTY",
        f"concat('Customer#', lpad(CAST(o_custkey AS {cast}), 9, '0')) AS POSTCODE",
        "'' AS PCON_CODE", "'' AS PCON_NAME", "'' AS LAUA_CODE", "'' AS LAUA_NAME",
        "o_orderstatus AS PROPERTY_TYPE", "'' AS TENURE", "'' AS PROPERTY_AGE", "o_orderpriority AS MEASURE",
        "'Heating' AS MEASURE_GROUP", "'FY2425' AS FY", f"'S' AS {e2.SCHEME_COLUMN}",
    ])


def _refresh_inputs(spark, sf_dir):
    """(previous master, rows of 1998 as those of the new year with their date, constituency lookup)."""
    orders = table(spark, sf_dir, "orders")
    prev = orders.where("o_orderdate < DATE'1998-01-01'").selectExpr(
        *_split_select(f"SELECT {_prev_master_select('spark')} FROM orders"))
    new = orders.where("o_orderdate >= DATE'1998-01-01'").selectExpr(
        *_split_select(f"SELECT {_new_rows_select('spark')} FROM orders"), "o_orderdate")
    names = table(spark, sf_dir, "nation").selectExpr(
        "concat('E140', lpad(CAST(n_nationkey AS STRING), 5, '0')) AS PCON24CD", "n_name AS PCON24NM", "n_nationkey AS seq")
    return prev, new, names


def _master_refresh(spark, sf_dir):
    """K-13/K-14: re-geocode the cumulative master (new lookup wins, old value
    kept when unmatched), append the new year, tidy addresses, sort."""
    prev, new, names = _refresh_inputs(spark, sf_dir)
    return E2.refresh_master(prev, new.drop("o_orderdate"), _C._geo_spark(spark, sf_dir), names)


_HALF = "o_orderdate < DATE'1998-04-01'"


def _published_years(spark, sf_dir):
    """Both masters published in parts, then the new year in two halves: the first refresh rewrites the
    years with other geography, the second one year, whose earlier rows it re-geocodes."""
    prev, new, names = _refresh_inputs(spark, sf_dir)
    geo, root, as_of = _C._geo_spark(spark, sf_dir), f"{checkpoint_root(spark)}/years-{uuid.uuid4().hex}", _CLAIMS_AS_OF
    import_masters(prev, E2.history_columns(prev), root, as_of)
    with staging(spark) as stage:
        for half in (new.where(_HALF), new.where(f"NOT ({_HALF})")):
            refresh_published(half.drop("o_orderdate"), geo, names, root, as_of, False, stage)
    return S.current_versions(spark, root)


def _master_refresh_years(spark, sf_dir):
    """K-14 / SNK-06: a master in parts by year, of which a refresh writes those that change."""
    return S.read_published(spark, _published_years(spark, sf_dir)["measures_master"])


def _history_years(spark, sf_dir):
    """K-15: the history so far as one part, each half year as one more folder."""
    return S.read_published(spark, _published_years(spark, sf_dir)["measures_history"])


def _history_years_sql() -> str:
    cols = ", ".join(f'{src} AS "{dst}"' for dst, src in e2.HISTORY_COLUMNS.items())
    return (f"SELECT {cols} FROM (SELECT {_prev_master_select('duck')} FROM orders WHERE o_orderdate < DATE '1998-01-01') "
            f"UNION ALL SELECT {cols} FROM (SELECT {_new_rows_select('duck')} FROM orders WHERE o_orderdate >= DATE '1998-01-01')")


def _title_expr_sql(col: str) -> str:
    word = O.TITLE_WORD
    inner = (f"array_to_string(list_transform(regexp_extract_all(lower(regexp_replace({col}, '[,\\s]*$', '')), "
             f"'{word}', 1), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")
    return _squish_sql(inner)


def _master_refresh_sql(twice: str = "false") -> str:
    """``twice``: new rows that a second refresh has re-geocoded."""
    cols = e2.MASTER_COLUMNS
    geo_cols = ["LAUA_CODE", "LAUA_NAME", "PCON_CODE", "PCON_NAME"]
    prev_out = ", ".join(f"coalesce(g.{c}, p.{c}) AS {c}" if c in geo_cols else f"p.{c}" for c in cols)
    tidy = ", ".join(f"{_title_expr_sql(c)} AS {c}" if c in e2.ADDRESS_COLUMNS else c for c in cols)
    return f"""
WITH geo AS ({_C._geo_sql()}),
names AS (SELECT 'E140' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS PCON24CD, n_name AS PCON_NAME FROM nation),
geon AS (SELECT g.pcds, g.LAUA_CODE, g.LAUA_NAME, g.PCON_CODE, n.PCON_NAME FROM geo g
         LEFT JOIN names n ON g.PCON_CODE IS NOT DISTINCT FROM n.PCON24CD),
prev AS (SELECT {_prev_master_select('duck')} FROM orders WHERE o_orderdate < DATE '1998-01-01'),
newr AS (SELECT {_new_rows_select('duck')}, {twice} AS twice FROM orders WHERE o_orderdate >= DATE '1998-01-01'),
old AS (SELECT {', '.join(cols)} FROM prev UNION ALL SELECT {', '.join(cols)} FROM newr WHERE twice),
prevr AS (SELECT {prev_out} FROM old p LEFT JOIN geon g
          ON lower(replace(p.POSTCODE, ' ', '')) IS NOT DISTINCT FROM g.pcds),
u AS (SELECT {', '.join(cols)} FROM prevr UNION ALL SELECT {', '.join(cols)} FROM newr WHERE NOT twice)
SELECT {tidy} FROM u"""


query("master_refresh", _master_refresh_sql())(_master_refresh)
query("master_refresh_years", _master_refresh_sql("o_orderdate < DATE '1998-04-01'"))(_master_refresh_years)
query("history_years", _history_years_sql())(_history_years)
