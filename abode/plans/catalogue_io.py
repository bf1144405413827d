"""Queries that land files, write outputs and read them back, gates and extracts.

Files go to a fresh folder under the checkpoint folder of the session, made from
whole driver tables; the oracle is SQL over those tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.functions.numbers import cap
from abode.operators import columns as P
from abode.operators import quality as Q
from abode.operators import resolve as W
from abode.operators import sinks as S
from abode.plans import measures as E2
from abode.plans.catalogue import _CLAIM_SRC, _case, _geo_spark, _geo_sql, _rules_sql, _split_select, query, table
from abode.plans.provenance import joined_row_counts, provenance_extract, stack_provenance
from abode.plans.runs import load_listed_tables
from abode.rules import e2
from abode.session import checkpoint_root, setting, stage_table
from abode.sources.landed import guess_types, guessed, misfits, peek_header, read_extract, read_landed, read_lookup_csv, typed

AS_OF = dt.date(2025, 4, 1)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


# ===========================================================================
# Sources (SRC-05 .. SRC-13)
# ===========================================================================

_SHEET = ["Part key", "Name, full", "Brand", "Price"]


def _land_sheets(spark, sf_dir, banner: bool) -> str:
    """Worksheets as landed: one file per brand, an own banner line each, a header, text cells."""
    part = table(spark, sf_dir, "part")
    cells = F.struct(F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 7 > 0, F.col("p_name")), "p_type",
                     F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    rows = part.select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("line"),
                       F.to_csv(cells, {"quoteAll": "true", "escape": '"'}).alias("value"))
    heads = part.select(F.col("p_brand").alias("file")).distinct()
    header = ",".join(f'"{h}"' for h in _SHEET)
    lines = rows.union(heads.select("file", F.lit(-1).cast("long"), F.lit(header)))
    if banner:
        lines = lines.union(heads.select("file", F.lit(-2).cast("long"), F.concat(F.col("file"), F.lit(" sheet,,,"))))
    path = _folder(spark, "sheets")
    lines.repartition("file").sortWithinPartitions("file", "line").drop("line").write.partitionBy("file").text(path)
    return path


def _sheet_sql(banner: int) -> str:
    return f"""
WITH files AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS nth FROM (SELECT DISTINCT p_brand FROM part))
SELECT CAST(p_partkey AS VARCHAR) AS "Part key", CASE WHEN p_partkey % 7 > 0 THEN p_name END AS "Name, full", p_type AS "Brand",
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS "Price",
       CAST(nth * 4294967296 + {banner} + row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS seq
FROM part JOIN files USING (p_brand)"""


@query("landed_sheet_banner", _sheet_sql(1))
def _landed_sheet_banner(spark, sf_dir):
    """SRC-07 / SRC-09 / W-04: folder of worksheets with a banner each; landing order by file and line."""
    path = _land_sheets(spark, sf_dir, banner=True)
    return read_landed(spark, path, columns=peek_header(spark, path, banner_rows=1), banner_rows=1)


@query("landed_sheet_text", _sheet_sql(0))
def _landed_sheet_text(spark, sf_dir):
    """SRC-05: worksheets without a banner, every column as text."""
    return read_landed(spark, _land_sheets(spark, sf_dir, banner=False))


@query("landed_sheet_typed", """
SELECT p_partkey AS "Part key", CAST(p_retailprice AS DOUBLE) AS "Price" FROM part""")
def _landed_sheet_typed(spark, sf_dir):
    """SRC-06: the same sheets with declared types."""
    return typed(read_landed(spark, _land_sheets(spark, sf_dir, banner=True), banner_rows=1), {"Part key": "long", "Price": "double"})


def _land(spark, rows, header: list[str], name: str) -> str:
    """``rows`` (file, line, value) as one text file for each ``file``, its header first."""
    head = ",".join('"' + h.replace('"', '""') + '"' for h in header)
    lines = rows.union(rows.select("file").distinct().select("file", F.lit(-1).cast("long"), F.lit(head)))
    path = _folder(spark, name)
    lines.repartition("file").sortWithinPartitions("file", "line").drop("line").write.partitionBy("file").text(path)
    return path


_BREAKS = "p_partkey % 4"


@query("landed_sheet_line_breaks", f"""
WITH files AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS nth FROM (SELECT DISTINCT p_brand FROM part)),
cells AS (SELECT *, CASE {_BREAKS} WHEN 0 THEN p_name || chr(10) || p_type WHEN 1 THEN 'a "quoted" ' || p_name
    WHEN 2 THEN chr(10) || chr(10) || 'last, line' ELSE p_name END AS note FROM part JOIN files USING (p_brand))
SELECT CAST(p_partkey AS VARCHAR) AS "Part key", note AS "Note", p_type AS "Kind of\npart",
       CAST(nth * 4294967296 + 2 + coalesce(sum(1 + length(note) - length(replace(note, chr(10), '')))
         OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seq
FROM cells""")
def _landed_sheet_line_breaks(spark, sf_dir):
    """SRC-05 / W-04: cells and a header with line breaks; places by a split scan."""
    note = (F.when(F.expr(f"{_BREAKS} = 0"), F.concat_ws("\n", "p_name", "p_type")).when(F.expr(f"{_BREAKS} = 1"), F.concat(F.lit('a "quoted" '), "p_name"))
            .when(F.expr(f"{_BREAKS} = 2"), F.lit("\n\nlast, line")).otherwise(F.col("p_name")))
    cells = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in (F.col("p_partkey").cast("string"), note, F.col("p_type"))]
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("line"), F.concat_ws(",", *cells).alias("value"))
    return read_landed(spark, _land(spark, rows, ["Part key", "Note", "Kind of\npart"], "broken"))


_GUESS_ROWS, _LATE = 20, "Brand#4"


def _guess_sheet(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    price = F.when((F.col("p_brand") >= _LATE) & (F.col("p_size") > 25), F.lit("on request")).otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    cells = F.struct(F.col("p_partkey").cast("string"), "p_name", price, F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd"),
                     F.when(F.col("p_size") > 10, "TRUE").otherwise("FALSE"))
    rows = part.select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("line"), F.to_csv(cells, {"quoteAll": "true", "escape": '"'}).alias("value"))
    return read_landed(spark, _land(spark, rows, ["Part key", "Name", "Price", "Added", "In stock"], "guess"))


_GUESS_SQL = f"""
WITH files AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS nth FROM (SELECT DISTINCT p_brand FROM part)),
sheet AS (SELECT *, p_brand >= '{_LATE}' AND p_size > 25 AS late,
  CAST(nth * 4294967296 + row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS seq FROM part JOIN files USING (p_brand))"""


@query("landed_sheet_guessed", _GUESS_SQL + """
SELECT p_partkey AS "Part key", p_name AS "Name", CASE WHEN NOT late THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) END AS "Price",
       CAST(DATE '2024-01-01' + CAST(p_size AS INTEGER) AS DATE) AS "Added", p_size > 10 AS "In stock", seq FROM sheet""")
def _landed_sheet_guessed(spark, sf_dir):
    """SRC-06: types from the first rows by place; a late text in a numeric column is missing."""
    return guessed(_guess_sheet(spark, sf_dir), rows=_GUESS_ROWS)


@query("guessed_misfits", _GUESS_SQL + """
SELECT 'Price' AS "column", 'double' AS type, count(*) AS n, min(seq) AS first_seq, 'on request' AS first_value FROM sheet WHERE late HAVING count(*) > 0""")
def _guessed_misfits(spark, sf_dir):
    """SRC-06: cells that the guessed types lose, and the first of each column."""
    sheet = _guess_sheet(spark, sf_dir)
    return misfits(sheet, guess_types(sheet, rows=_GUESS_ROWS))


@query("lookup_csv_projected", "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name FROM customer")
def _lookup_csv_projected(spark, sf_dir):
    """SRC-08: two typed columns of a wide CSV lookup."""
    path = S.write_quoted_csv(table(spark, sf_dir, "customer"), _folder(spark, "lookup"))
    return read_lookup_csv(spark, path, {"c_custkey": "double", "c_name": "string"})


@query("extract_csv", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def _extract_csv(spark, sf_dir):
    """SRC-11: plain CSV scan."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return read_extract(spark, "csv:" + S.write_quoted_csv(orders, _folder(spark, "extract")))


def _listed(spark, sf_dir) -> dict[str, DataFrame]:
    """One provenance table per name in a list that is itself a table."""
    orders = table(spark, sf_dir, "orders")
    names = orders.select("o_orderpriority").distinct().orderBy("o_orderpriority")
    return load_listed_tables(spark, names, lambda name: orders.where(F.col("o_orderpriority") == name).select(
        F.col("o_custkey").alias("UPRN"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate").cast("date")).alias("TIMESTAMP"),
        F.col("o_orderstatus").alias("SOURCE"), (-F.col("o_orderkey")).alias("seq")))


@query("listed_tables", """
SELECT o_custkey AS UPRN, o_orderpriority AS attr, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS TIMESTAMP,
       o_orderstatus AS SOURCE, -o_orderkey AS seq FROM orders WHERE o_custkey IS NOT NULL""")
def _listed_tables(spark, sf_dir):
    """SRC-13: one scan per row of a table list, landing order kept."""
    return stack_provenance(_listed(spark, sf_dir))


#: The listed tables, and the market segments whose customers are the population.
_PRIORITIES = {"T1": "1-URGENT", "T2": "2-HIGH", "T3": "3-MEDIUM", "T4": "4-NOT SPECIFIED", "T5": "5-LOW"}
_SEGMENTS = ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE")
_INSIDE = f"(SELECT c_custkey FROM customer WHERE c_mktsegment IN {_SEGMENTS})"


def _provenance_inputs(spark, sf_dir):
    """Master and tables with repeated keys, dates out of order and missing, and an own landing order."""
    master = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("UPRN"), F.col("o_orderstatus").alias("VALUE"),
                                                   (F.col("o_orderkey") * 7 % 1009 * 1000000 + F.col("o_orderkey")).alias("seq"))
    listed = _listed(spark, sf_dir)
    tables = {name: listed[priority] for name, priority in _PRIORITIES.items()}
    population = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin(*_SEGMENTS)).select(F.col("c_custkey").alias("UPRN"))
    return master, tables, population


_PROV_TABLE = """SELECT o_custkey AS k, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS ts, o_orderstatus AS src
  FROM orders WHERE o_orderpriority = '{}' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY -o_orderkey) = 1"""


@query("provenance_repeated_keys", f"""
WITH m AS (SELECT o_custkey AS UPRN, o_orderstatus AS VALUE FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey * 7 % 1009 * 1000000 + o_orderkey) = 1),
{", ".join(f"{t} AS ({_PROV_TABLE.format(p)})" for t, p in _PRIORITIES.items())}
SELECT UPRN, VALUE, {", ".join(f"{t}.ts AS TIMESTAMP_{t}, {t}.src AS SOURCE_{t}" for t in _PRIORITIES)}
FROM m {" ".join(f"LEFT JOIN {t} ON UPRN = {t}.k" for t in _PRIORITIES)}
WHERE UPRN IN {_INSIDE}""")
def _provenance_repeated_keys(spark, sf_dir):
    """K-09 / J-07: first wins by landing order, in the master and in every table."""
    contract = ["UPRN", "VALUE", *(c for t in _PRIORITIES for c in (f"TIMESTAMP_{t}", f"SOURCE_{t}"))]
    return provenance_extract(*_provenance_inputs(spark, sf_dir), contract)


@query("provenance_row_counts", f"""
WITH {", ".join(f"{t} AS (SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '{p}')" for t, p in _PRIORITIES.items())},
j AS (SELECT o_custkey AS u, o_custkey IN {_INSIDE} AS inside
      FROM orders {" ".join(f"LEFT JOIN {t} ON o_custkey = {t}.k" for t in _PRIORITIES)}),
d AS (SELECT u, count(*) AS n FROM j WHERE inside GROUP BY u)
SELECT CAST((SELECT count(*) FROM j) AS BIGINT) AS rows_before, CAST((SELECT count(*) FROM j WHERE NOT inside) AS BIGINT) AS rows_not_in_population,
       CAST((SELECT count(*) FROM j WHERE inside) AS BIGINT) AS rows_in_population,
       CAST((SELECT coalesce(sum(n), 0) FROM d WHERE n > 1) AS BIGINT) AS rows_in_duplicated_keys,
       CAST((SELECT count(*) FROM d) AS BIGINT) AS rows_after_dedup""")
def _provenance_row_counts(spark, sf_dir):
    """The programme's row counts after its joins, which repeated keys multiply."""
    return joined_row_counts(*_provenance_inputs(spark, sf_dir))


# ===========================================================================
# Sinks (SNK-01 .. SNK-07), written and read back
# ===========================================================================

_OUT_SRC = ("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN concat(p_name, ', \"flat\"') "
            "ELSE p_name END AS v, CAST(p_size AS STRING) AS w FROM part")
_OUT_SQL = _OUT_SRC.replace("STRING", "VARCHAR").replace("p_partkey,", "CAST(p_partkey AS VARCHAR) AS p_partkey,", 1)


def _out(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*_split_select(_OUT_SRC))


@query("sink_attribute_csv", _OUT_SQL)
def _sink_attribute_csv(spark, sf_dir):
    """SNK-01: header, missing as NA."""
    path = S.write_attribute_csv(_out(spark, sf_dir), _folder(spark, "attribute"))
    return spark.read.option("header", "true").option("escape", '"').option("nullValue", "NA").csv(path)


@query("sink_one_file", _OUT_SQL)
def _sink_one_file(spark, sf_dir):
    """SNK-03 .. SNK-05: a report as one file with one header, in the encoding of its readers."""
    path = S.write_one_file(_out(spark, sf_dir), f"{_folder(spark, 'report')}/report.csv", encoding="windows-1252")
    with setting(spark, "spark.sql.legacy.javaCharsets", "true"):
        return stage_table(spark.read.option("header", "true").option("escape", '"').option("encoding", "windows-1252").csv(path), "report")


@query("sink_master_tsv", _OUT_SQL)
def _sink_master_tsv(spark, sf_dir):
    """SNK-02: tab-separated, missing as an empty field."""
    path = S.write_tsv(_out(spark, sf_dir), _folder(spark, "master"))
    return spark.read.option("header", "true").option("sep", "\t").option("escape", '"').csv(path)


@query("sink_dated_csv", f"SELECT *, '2025-04-01' AS stamped FROM ({_OUT_SQL})")
def _sink_dated_csv(spark, sf_dir):
    """SNK-03 / SNK-04: quoted CSV in a path that carries its date."""
    path = S.write_quoted_csv(_out(spark, sf_dir), S.dated_path(_folder(spark, "dated"), "extract", AS_OF))
    return spark.read.option("header", "true").option("escape", '"').csv(path).withColumn("stamped", F.lit(path[-10:]))


@query("sink_encoded_csv", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ' £ é' AS v FROM part")
def _sink_encoded_csv(spark, sf_dir):
    """SNK-05: report in the encoding of its readers."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, ' £ é') AS v")
    path = S.write_quoted_csv(rows, _folder(spark, "encoded"), encoding="windows-1252")
    with setting(spark, "spark.sql.legacy.javaCharsets", "true"):
        return stage_table(spark.read.option("header", "true").option("escape", '"').option("encoding", "windows-1252").csv(path), "decoded")


@query("publish_versions", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _publish_versions(spark, sf_dir):
    """SNK-06 / SNK-07 / K-16: two frames published together, twice; the pointer gives the newer versions."""
    root = _folder(spark, "published")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    S.publish({"a": customers.limit(1), "b": suppliers.limit(1)}, root, AS_OF)
    S.publish({"a": customers, "b": suppliers}, root, AS_OF)
    now = S.current_versions(spark, root)
    return spark.read.parquet(now["a"]).union(spark.read.parquet(now["b"]))


# ===========================================================================
# Columns, counts and checks (P-04, A-04, M-02, U-03, C-02, Q-06, Q-07)
# ===========================================================================

@query("prefix_suffix_rename", """
SELECT o_custkey AS UPRN, CAST(o_orderdate AS DATE) AS TIMESTAMP_ASHP, o_orderstatus AS SOURCE_ASHP, o_orderpriority AS OTHER FROM orders""")
def _prefix_suffix_rename(spark, sf_dir):
    """P-04: ASHP_TIMESTAMP -> TIMESTAMP_ASHP and so on."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("UPRN"), F.col("o_orderdate").cast("date").alias("ASHP_TIMESTAMP"),
        F.col("o_orderstatus").alias("ASHP_SOURCE"), F.col("o_orderpriority").alias("OTHER"))
    return P.prefix_suffix_rename(orders, ["TIMESTAMP", "SOURCE"], ["ASHP"])


@query("select_contract", "SELECT c_name, c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer")
def _select_contract(spark, sf_dir):
    """P-06 / P-09: typed missing column, then exactly the contract's columns in its order."""
    return P.select_contract(P.typed_nulls(table(spark, sf_dir, "customer"), {"note": "string"}), ["c_name", "c_custkey", "note"])


@query("two_key_counts", """
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, CAST(least(count(*), 1) AS BIGINT) AS present
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _two_key_counts(spark, sf_dir):
    """A-04 group count by two keys, M-02 capped at 1."""
    return W.group_sizes(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]).withColumn("present", cap("n"))


@query("column_drift", """
SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'o_orderstatus', o_orderstatus, CAST(count(*) AS BIGINT) FROM orders GROUP BY o_orderstatus""")
def _column_drift(spark, sf_dir):
    """U-03 / Q-07: profile of the columns that the previous output did not have."""
    orders = table(spark, sf_dir, "orders")
    return Q.frequency(orders, Q.check_columns(orders, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], strict=False))


@query("unique_keys", "SELECT c_custkey, c_mktsegment FROM customer")
def _unique_keys(spark, sf_dir):
    """Q-06: the run goes on only with unique keys."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    Q.assert_unique(customers, "c_custkey")
    return customers


@query("if_else_missing", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders)
SELECT o_orderkey, CASE WHEN price IS NULL THEN NULL WHEN price > 100000 THEN 'high' ELSE 'low' END AS band FROM s""")
def _if_else_missing(spark, sf_dir):
    """C-02: a missing condition gives a missing value, not "else"."""
    from abode.functions.classify import if_else

    s = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price")
    return s.select("o_orderkey", if_else(F.col("price") > 100000, F.lit("high"), F.lit("low")).alias("band"))


# ===========================================================================
# Gates, extracts and history (Q-02, K-13, K-15)
# ===========================================================================

_EXTRA = ["CAST(o_orderkey % 90 AS STRING) AS house_number", "lower(o_orderpriority) AS address_1", "CAST(NULL AS STRING) AS address_2",
          _case("o_orderkey % 4", ["N/A", "Belfast", None, "near N/A road"]) + " AS address_3",
          "CASE WHEN o_orderkey % 2 = 0 THEN 'Built Pre-1900' END AS PROPERTY_AGE", "'FY2425' AS FY"]


def _measured(spark, sf_dir) -> DataFrame:
    src = table(spark, sf_dir, "orders").selectExpr(*_split_select(_CLAIM_SRC), *_EXTRA)
    claims = src.withColumns({"PROPERTY_TYPE": F.col("house_type"), "TENURE": F.col("tenure_raw"),
                              "WATER_WIDGET": F.when(F.col("cost_water_widget") > 100, "Water Widget").otherwise("Unknown"),
                              "LIGHTING": F.when(F.col("o_orderkey") % 9 == 0, "gizmo").otherwise("LEDs")})
    names = table(spark, sf_dir, "nation").selectExpr(
        "concat('E140', lpad(CAST(n_nationkey AS STRING), 5, '0')) AS PCON24CD", "n_name AS PCON24NM", "n_nationkey AS seq")
    return E2.explode_claim_measures(claims, _geo_spark(spark, sf_dir), names, measure_cols=["WATER_WIDGET", "LIGHTING"])


_MEASURED_SQL = f"""
src AS ({_CLAIM_SRC.replace(" FROM orders", ", " + ", ".join(_EXTRA) + " FROM orders").replace("STRING", "VARCHAR")}),
geo AS ({_geo_sql()}),
names AS (SELECT 'E140' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS PCON24CD, n_name AS PCON_NAME FROM nation),
long AS (SELECT *, CASE WHEN cost_water_widget > 100 THEN 'Water Widget' ELSE 'Unknown' END AS MEASURE FROM src
         UNION ALL SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN 'gizmo' ELSE 'LEDs' END FROM src),
grouped AS (SELECT *, {_rules_sql(e2.MEASURE_GROUP, e2.ERROR)} AS MEASURE_GROUP FROM long),
placed AS (SELECT gr.*, g.LAUA_CODE, g.LAUA_NAME, g.PCON_CODE, nm.PCON_NAME FROM grouped gr
           LEFT JOIN geo g ON lower(replace(gr.Postcode, ' ', '')) IS NOT DISTINCT FROM g.pcds
           LEFT JOIN names nm ON g.PCON_CODE IS NOT DISTINCT FROM nm.PCON24CD WHERE MEASURE_GROUP <> 'Unknown'),
clean AS (SELECT * FROM placed WHERE MEASURE_GROUP <> 'ERROR' AND LAUA_NAME IS NOT NULL AND LAUA_NAME NOT IN ('Unknown', 'ERROR'))"""


@query("geography_offenders", f"""
WITH {_MEASURED_SQL} SELECT o_orderkey, MEASURE, MEASURE_GROUP, LAUA_NAME FROM placed
WHERE MEASURE_GROUP = 'ERROR' OR LAUA_NAME IS NULL OR LAUA_NAME IN ('Unknown', 'ERROR')""")
def _geography_offenders(spark, sf_dir):
    """Q-02 in lenient mode: rows of an unknown measure group or without a district."""
    _, offenders = E2.geography_gate(_measured(spark, sf_dir), strict=False)
    return offenders.select("o_orderkey", "MEASURE", "MEASURE_GROUP", "LAUA_NAME")


def _clean_rows(spark, sf_dir) -> DataFrame:
    rows, _ = E2.geography_gate(_measured(spark, sf_dir), strict=False)
    return rows


@query("annual_extract", f"""
WITH {_MEASURED_SQL} SELECT LAUA_NAME, PCON_CODE, house_type AS PROPERTY_TYPE, tenure_raw AS TENURE, MEASURE, MEASURE_GROUP,
  scheme_name AS {e2.SCHEME_COLUMN} FROM clean""")
def _annual_extract(spark, sf_dir):
    """K-13: the 7-column extract of gated rows."""
    return E2.annual_extract(_clean_rows(spark, sf_dir))


_DEPARTMENT_SQL = f"""
SELECT '' AS SUB_BUILDING, house_number AS BUILDING_NUM, address_1 AS STREET, '' AS LOCALITY,
  CASE WHEN contains(coalesce(address_3, ''), 'N/A') THEN '' ELSE coalesce(address_3, '') END AS TOWN, '' AS COUNTY, Postcode AS POSTCODE,
  coalesce(PCON_CODE, '') AS PCON_CODE, coalesce(PCON_NAME, '') AS PCON_NAME, coalesce(LAUA_CODE, '') AS LAUA_CODE, LAUA_NAME,
  coalesce(house_type, '') AS PROPERTY_TYPE, coalesce(tenure_raw, '') AS TENURE, coalesce(PROPERTY_AGE, '') AS PROPERTY_AGE, MEASURE,
  MEASURE_GROUP, FY, scheme_name AS {e2.SCHEME_COLUMN} FROM clean"""


@query("department_extract", f"WITH {_MEASURED_SQL} {_DEPARTMENT_SQL}")
def _department_extract(spark, sf_dir):
    """K-13: the 18-column extract, missing cells empty."""
    return E2.department_extract(_clean_rows(spark, sf_dir))


@query("history_append", f"""
WITH {_MEASURED_SQL}, d AS ({_DEPARTMENT_SQL})
SELECT LAUA_NAME AS "Local Authority", PCON_CODE AS "Parliamentary Constituency Code", PROPERTY_TYPE AS "Property Type",
       TENURE AS "Property Tenure", MEASURE AS "Measure", MEASURE_GROUP AS "Measure Group" FROM d
UNION ALL SELECT c_name, c_phone, c_mktsegment, NULL, 'Old', 'Other' FROM (SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_phone, c_mktsegment FROM customer)""")
def _history_append(spark, sf_dir):
    """K-15: the new year under the report's column names, after the history so far."""
    history = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS `Local Authority`", "CAST(c_custkey AS STRING) AS `Parliamentary Constituency Code`", "c_mktsegment AS `Property Type`",
        "CAST(NULL AS STRING) AS `Property Tenure`", "'Old' AS Measure", "'Other' AS `Measure Group`")
    return E2.append_history(history, E2.department_extract(_clean_rows(spark, sf_dir)))


