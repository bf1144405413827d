"""Attribute resolution programme: installer feeds + warehouse -> one record
per property.

Plan shape (the point of the design):

1. Each feed is cleaned and classified with row-local expressions only
   (no shuffle). The only feed-side join is property key -> constituency.
2. Feed rows and warehouse rows are stacked into ONE long observation frame
   ``(key, attr, value, num, ts, source, source_rank, seq)``.
3. ONE ``groupBy(key)`` resolves every attribute (latest / first /
   technology matrix) with conditional ``min_by`` aggregates: partial
   aggregation before the shuffle, one shuffle in total.
4. That wide frame is written once (lineage cut under the checkpoint
   folder); the 14 attribute tables, the master and the timestamped master
   are projections of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abode.functions import dates as D
from abode.functions import text as X
from abode.functions.classify import classify
from abode.functions.numbers import to_key, to_number
from abode.operators import columns as P
from abode.operators import filters as FL
from abode.operators import joins as J
from abode.operators import reshape as R
from abode.rules import e1
from abode.sources.landed import normalise_headers, require_columns

_SEQ_BLOCK = 1 << 60  # keeps the database extract's rows ahead of the sheet's in arrival order

# Feed-1 worksheet headers after normalisation -> landed names.
FEED1_SHEET_RENAMES = {
    "Measure as provided in quarterly data submission": "MEASURE",
    "If Non-ECO Funded Measure - Please Specify": "Non_ECO_Measure",
    "Completion Date (of measure)": "TIMESTAMP",
    "PCODE": "POSTCODE",
}

# Columns that feed 1 must have, its landing order included.
FEED1_EXTRACT_COLUMNS = ["UPRN", "TIMESTAMP", "TENURE", "MEASURE", "Non_ECO_Measure", "POSTCODE", "seq"]
FEED1_SHEET_COLUMNS = [*FEED1_SHEET_RENAMES, "UPRN", "TENURE", "FYEAR", "seq"]

FEED1_CLASSIFIERS = [
    ("TENURE_NAME", e1.FEED1_TENURE, e1.FEED1_TENURE_DEFAULT),
    ("LOFT_INSULATION_NAME", e1.FEED1_LOFT, e1.UNKNOWN),
    ("WALL_CONSTRUCTION_NAME", e1.FEED1_WALL, e1.UNKNOWN),
    ("GLAZING_TYPE_NAME", e1.FEED1_GLAZING, e1.UNKNOWN),
    ("MAIN_HEATING_FUEL_NAME", e1.FEED1_FUEL, e1.UNKNOWN),
    ("MAIN_HEATING_SYSTEM_NAME", e1.FEED1_SYSTEM, e1.UNKNOWN),
    ("RENEWABLES", e1.FEED1_RENEWABLES, e1.UNKNOWN),
    ("FLOOR_INSULATION", e1.FEED1_FLOOR, e1.UNKNOWN),
    ("FLAT_ROOF_INS", e1.FEED1_FLAT_ROOF, e1.UNKNOWN),
    ("RIR_INS", e1.FEED1_ROOM_IN_ROOF, e1.UNKNOWN),
]
FEED2_CLASSIFIERS = [
    ("TENURE_NAME", e1.FEED2_TENURE, e1.UNKNOWN),
    ("LOFT_INSULATION_NAME", e1.FEED2_LOFT, e1.UNKNOWN),
    ("WALL_CONSTRUCTION_NAME", e1.FEED2_WALL, e1.UNKNOWN),
    ("GLAZING_TYPE_NAME", e1.FEED2_GLAZING, e1.UNKNOWN),
    ("MAIN_HEATING_FUEL_NAME", e1.FEED2_FUEL, e1.UNKNOWN),
    ("MAIN_HEATING_SYSTEM_NAME", e1.FEED2_SYSTEM, e1.UNKNOWN),
    ("RENEWABLES", e1.FEED2_RENEWABLES, e1.UNKNOWN),
    ("FLOOR_INSULATION", e1.FEED2_FLOOR, e1.UNKNOWN),
    ("FLAT_ROOF_INS", e1.FEED2_FLAT_ROOF, e1.UNKNOWN),
]
CATEGORY_COLUMNS = ["PROPERTY_TYPE_NAME", "TENURE_NAME", "PROPERTY_AGE_NAME", "LOFT_INSULATION_NAME",
                    "WALL_CONSTRUCTION_NAME", "MAIN_HEATING_FUEL_NAME", "MAIN_HEATING_SYSTEM_NAME",
                    "GLAZING_TYPE_NAME", "RENEWABLES", "FLOOR_INSULATION", "FLAT_ROOF_INS", "RIR_INS"]


def _with_seq(df: DataFrame) -> DataFrame:
    """The landed order as a number, even when landed as text. "First" rules
    depend on it, so a feed without one, or with one that is no number, is an error."""
    return df.withColumn("seq", P.order_number("seq"))


def attribute_state(obs: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """What resolution has to remember of all feeds so far: ``previous`` (the state of earlier
    feeds, if any) with ``obs``. ``resolve_attributes`` of it gives the same master as of all observations."""
    specs = attribute_specs()
    kept = R.exclude_observations(obs, specs, "RENEWABLES", e1.TECHNOLOGY_EXCLUDED)
    if previous is None:
        return R.observation_state(kept, specs, e1.TECHNOLOGIES, "RENEWABLES")
    return R.merge_observations(previous, kept, specs, e1.TECHNOLOGIES, "RENEWABLES")


def _number_text(c: str):
    """Numbers as text the way a report writes them: 65 not 65.0, and never in E notation."""
    n = F.col(c)
    plain = F.regexp_replace(F.regexp_replace(n.try_cast("decimal(38,15)").cast("string"), "0+$", ""), r"\.$", "")
    return F.when(n == F.floor(n), n.try_cast("decimal(38,0)").cast("string")).otherwise(plain)


def fill_measure(df: DataFrame, measure: str = "MEASURE", second: str = "Non_ECO_Measure") -> DataFrame:
    """T-00 on lower-cased, squished text: rows blank in both fields go, a missing or
    "non-eco" measure takes the second field, rows still without one go."""
    df = FL.drop_all_blank(df, [measure, second])
    fill = X.null_safe_isin(measure, e1.NON_ECO_MARKERS) | (X.is_blank(measure) & ~X.is_blank(second))
    return df.withColumn(measure, F.when(fill, F.col(second)).otherwise(F.col(measure))).where(F.col(measure).isNotNull())


def _classified(df: DataFrame, inputs: list[str], tables: list[tuple], columns: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """``df`` with the classes of rule ``tables`` over ``inputs``; ``columns`` gives what the rules read.

    All tables are one function of a row's inputs. As columns of their own they
    would be one generated method, too large for HotSpot to compile unless the session is set for it.
    """
    classes = F.transform(F.array(F.struct(*inputs)), lambda row: F.struct(*[
        classify(rules, default, **columns(row)).alias(name) for name, rules, default in tables]))
    df = df.withColumn("__classes", F.get(classes, F.lit(0)))
    return df.withColumns({name: F.col(f"__classes.{name}") for name, *_ in tables}).drop("__classes")


def clean_feed1(db_extract: DataFrame, sheet: DataFrame, uprn_lookup: DataFrame) -> DataFrame:
    """Feed 1 (database extract + newer worksheet) -> classified rows.

    Output: UPRN, PCON_CODE, TIMESTAMP, YEAR, SOURCE, seq + CATEGORY_COLUMNS.
    Rows need a constituency (inner join on the property key). Both inputs
    must hold the declared columns and ``seq``, their landing order.
    """
    require_columns(db_extract, FEED1_EXTRACT_COLUMNS, "feed 1 extract")
    require_columns(normalise_headers(sheet), FEED1_SHEET_COLUMNS, "feed 1 worksheet")
    db = _with_seq(db_extract).select(
        F.col("UPRN").cast("string").alias("UPRN"), F.col("TIMESTAMP").cast("string").alias("TIMESTAMP"),
        F.col("TENURE").cast("string").alias("TENURE"), F.col("MEASURE").cast("string").alias("MEASURE"),
        F.col("Non_ECO_Measure").cast("string").alias("Non_ECO_Measure"),
        X.strip_postcode_noise(F.upper(F.col("POSTCODE").cast("string"))).alias("POSTCODE"),
        F.col("seq"))
    sh = _with_seq(normalise_headers(sheet))
    sh = sh.withColumnsRenamed({k: v for k, v in FEED1_SHEET_RENAMES.items() if k in sh.columns})
    sh = sh.select("UPRN", "TIMESTAMP", "TENURE", "MEASURE", "Non_ECO_Measure", "POSTCODE",
                   D.year_start("FYEAR").alias("FYEAR_DATE"), (F.col("seq") + _SEQ_BLOCK).alias("seq"))

    def tidied(df: DataFrame) -> DataFrame:
        """One function over an array of the texts, which keeps the generated code small."""
        names = ["UPRN", "TIMESTAMP", "TENURE", "MEASURE", "Non_ECO_Measure"]
        texts = [F.lower(c) if c in ("MEASURE", "Non_ECO_Measure") else F.col(c).cast("string") for c in names]
        kept = [c for c in ("FYEAR_DATE", "seq") if c in df.columns]
        tidy = df.select(F.transform(F.array(*texts), X.squish).alias("texts"), *kept)
        return tidy.select(*[F.get("texts", F.lit(i)).alias(c) for i, c in enumerate(names)], *kept)

    both = tidied(db).unionByName(tidied(sh), allowMissingColumns=True)
    both = fill_measure(both).withColumn("UPRN", to_key("UPRN")).where(F.col("UPRN").isNotNull())
    both = both.withColumns({"MEASURE": X.lower_squish("MEASURE"), "TENURE": X.lower_squish("TENURE")})

    lookup = uprn_lookup.select(to_key(F.col("UPRN")).alias("UPRN"), F.col("PCON24CD").alias("PCON_CODE"))
    # Data-sized lookup: no broadcast hint; required match == inner join.
    both = J.lookup_join(both, lookup, "UPRN", null_safe=False, required=True) \
        .where(F.col("PCON_CODE").isNotNull())

    out = D.with_dmy_dates(both, "TIMESTAMP", F.col("FYEAR_DATE"))
    out = out.withColumns({"SOURCE": F.lit(e1.SOURCE_FEED1),
                            "PROPERTY_TYPE_NAME": F.lit(e1.UNKNOWN), "PROPERTY_AGE_NAME": F.lit(e1.UNKNOWN)})
    out = _classified(out, ["MEASURE", "TENURE"], FEED1_CLASSIFIERS, lambda row: {c: row[c] for c in ("MEASURE", "TENURE")})
    return out.select("UPRN", "PCON_CODE", "TIMESTAMP", "YEAR", "SOURCE", "seq", *CATEGORY_COLUMNS)


def clean_feed2(sheet: DataFrame) -> DataFrame:
    """Feed 2 worksheet -> classified rows with SAP numbers.

    Output: UPRN, TIMESTAMP, YEAR, SOURCE, seq, CATEGORY_COLUMNS (no room in
    roof), PRE/POST_SAP_SCORE, PRE/POST_FUEL_BILL, POST_CO2_EMISSIONS. A sheet
    without a declared header stops the run.
    """
    required = ["UPRN", "Master Completion Date", "Tenure", *e1.FEED2_FLAG_HEADERS, *e1.FEED2_NUMERIC_HEADERS.values(), "seq"]
    df = require_columns(normalise_headers(sheet), required, "feed 2 worksheet")
    # Yes/no cells are only compared with "yes": each is looked at once, and the rules then compare a
    # constant or nothing. One function over an array of like cells keeps the generated code small.
    cells = F.array(*[F.col(f"`{h}`").cast("string") for h in e1.FEED2_FLAG_HEADERS])
    numbers = F.array(*[F.col(f"`{src}`").cast("string") for src in e1.FEED2_NUMERIC_HEADERS.values()])
    df = _with_seq(df.select("UPRN", "`Master Completion Date`", X.lower_squish(F.col("Tenure")).alias("tenure"), "seq",
                             F.transform(cells, lambda c: X.is_word(c, "yes")).alias("said_yes"),
                             F.transform(numbers, to_number).alias("numbers")))
    df = FL.drop_junk_keys(df, "UPRN", e1.JUNK_KEYS)
    df = df.withColumn("UPRN", to_key("UPRN"))
    df = D.with_iso_dates(df, "`Master Completion Date`")
    df = df.withColumns({name: F.get("numbers", F.lit(i)) for i, name in enumerate(e1.FEED2_NUMERIC_HEADERS)})
    df = df.withColumns({"SOURCE": F.lit(e1.SOURCE_FEED2), "PROPERTY_TYPE_NAME": F.lit(e1.UNKNOWN),
                         "PROPERTY_AGE_NAME": F.lit(e1.UNKNOWN), "RIR_INS": F.lit(None).cast("string")})
    df = _classified(df, ["tenure", "said_yes"], FEED2_CLASSIFIERS, lambda row: {"tenure": row["tenure"]} | {
        e1.flag_name(h): F.when(F.get(row["said_yes"], F.lit(i)), F.lit("yes")) for i, h in enumerate(e1.FEED2_FLAG_HEADERS)})
    return df.select("UPRN", "TIMESTAMP", "YEAR", "SOURCE", "seq", *CATEGORY_COLUMNS, *e1.FEED2_NUMERIC_HEADERS)


# (attribute, value column in the classified feeds)
_FEED_ATTRS = {
    "PROPERTY_TYPE": "PROPERTY_TYPE_NAME", "PROPERTY_TENURE": "TENURE_NAME",
    "PROPERTY_AGE": "PROPERTY_AGE_NAME", "LOFT_INSULATION": "LOFT_INSULATION_NAME",
    "WALL_CONSTRUCTION": "WALL_CONSTRUCTION_NAME", "FUEL_TYPE": "MAIN_HEATING_FUEL_NAME",
    "HEATING_SYSTEM": "MAIN_HEATING_SYSTEM_NAME", "GLAZ_TYPE": "GLAZING_TYPE_NAME",
    "RENEWABLES": "RENEWABLES", "FLOOR_INSULATION": "FLOOR_INSULATION",
    "FLAT_ROOF_INS": "FLAT_ROOF_INS", "RIR_INS": "RIR_INS",
}


#: Attributes whose values are numbers.
NUMERIC = ("SAP_SCORE", "SAP_FUEL_BILL")


def attribute_specs() -> list[R.AttributeSpec]:
    return [R.AttributeSpec(name, out, policy, numeric=name in NUMERIC,
                            exclude=tuple(excl))
            for name, out, _code, _rule, excl, policy in e1.ATTRIBUTES]


def excluded_values() -> dict[str, tuple]:
    """Values that say nothing, by attribute."""
    return {name: tuple(excl) for name, _out, _code, _rule, excl, _policy in e1.ATTRIBUTES} | {"RENEWABLES": e1.TECHNOLOGY_EXCLUDED}


def observations(feed1: DataFrame | None, feed2: DataFrame | None, warehouse: DataFrame | None, long: bool = True) -> DataFrame:
    """Stack all sources into one observation frame (one union). Values of
    feeds that say nothing are left out before rows are made of them.

    ``long``: a row for each observation. Otherwise those of a source's row stay side by side, in a column
    for each attribute (``R.to_observed_rows``); resolution and ``duplicate_report`` read either."""
    parts = []
    names = [s.name for s in attribute_specs()] + ["RENEWABLES"]
    if warehouse is not None and not long:
        own = warehouse.select(
            "UPRN", "TIMESTAMP", "SOURCE", "seq", *[F.when(F.col("attr") == n, F.col("value")).alias(n) for n in names if n not in NUMERIC],
            *[F.lit(None).cast("double").alias(n) for n in NUMERIC])
        own = own.select(F.col("UPRN").cast("long").alias("UPRN"), F.col("TIMESTAMP").cast("date").alias("TIMESTAMP"), "SOURCE", F.col("seq").cast("long").alias("seq"),
                         F.lit(e1.SOURCE_RANK[e1.SOURCE_WAREHOUSE]).alias("source_rank"), *names)
        parts.append(R.to_observed_rows(own, "UPRN", "TIMESTAMP", {n: n for n in names if n not in NUMERIC}, names, numeric={n: n for n in NUMERIC},
                                        exclude=excluded_values()))
    elif warehouse is not None:
        parts.append(warehouse.select(
            F.col("UPRN").cast("long").alias("key"), "attr", F.col("value").cast("string").alias("value"),
            F.lit(None).cast("double").alias("num"), F.col("TIMESTAMP").cast("date").alias("ts"),
            F.col("SOURCE").alias("source"), F.lit(e1.SOURCE_RANK[e1.SOURCE_WAREHOUSE]).alias("source_rank"),
            F.col("seq").cast("long").alias("seq")))
    for feed, source in ((feed1, e1.SOURCE_FEED1), (feed2, e1.SOURCE_FEED2)):
        if feed is None:
            continue
        feed = feed.withColumn("source_rank", F.lit(e1.SOURCE_RANK[source]))
        attrs = {a: c for a, c in _FEED_ATTRS.items() if c in feed.columns}
        numeric = {}
        if "POST_SAP_SCORE" in feed.columns:
            feed = feed.withColumns({
                "_sap": F.coalesce("POST_SAP_SCORE", "PRE_SAP_SCORE"),
                "_bill": F.coalesce("POST_FUEL_BILL", "PRE_FUEL_BILL")})
            numeric = {"SAP_SCORE": "_sap", "SAP_FUEL_BILL": "_bill"}
        if not long:
            for n in (n for n in NUMERIC if n not in numeric):
                feed, numeric[n] = feed.withColumn(f"_no_{n}", F.lit(None).cast("double")), f"_no_{n}"
            parts.append(R.to_observed_rows(feed, "UPRN", "TIMESTAMP", attrs, names, numeric=numeric, exclude=excluded_values()))
            continue
        parts.append(R.to_observations(feed, "UPRN", "TIMESTAMP", attrs, source="SOURCE", numeric=numeric, exclude=excluded_values()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def resolve_attributes(obs: DataFrame, counts: bool = False) -> DataFrame:
    """One row per property with value, TIMESTAMP_x, SOURCE_x per attribute and
    the technology matrix -- a single aggregation. ``counts`` adds ROWS_x (``observe_duplicates``)."""
    specs = attribute_specs()
    if "attr" not in obs.columns:  # side by side, what says nothing is missing already
        return R.resolve_rows(obs, specs, e1.TECHNOLOGIES, "RENEWABLES", counts).withColumnRenamed("key", "UPRN")
    kept = R.exclude_observations(obs, specs, "RENEWABLES", e1.TECHNOLOGY_EXCLUDED)
    return R.resolve_wide(kept, specs, e1.TECHNOLOGIES, "RENEWABLES", counts).withColumnRenamed("key", "UPRN")


def attribute_table(wide: DataFrame, name: str) -> DataFrame:
    """Per-attribute output table: (UPRN, TIMESTAMP, <value>, SOURCE), or
    (UPRN, TIMESTAMP, SOURCE, <score>) with whole scores written as integers
    for the two numeric attributes."""
    spec = {s.name: s for s in attribute_specs()}[name]
    rows = wide.where(F.col(f"SOURCE_{name}").isNotNull())
    ts, src = F.col(f"TIMESTAMP_{name}").alias("TIMESTAMP"), F.col(f"SOURCE_{name}").alias("SOURCE")
    if spec.numeric:
        return rows.select("UPRN", ts, src, _number_text(spec.out).alias(spec.out))
    return rows.select("UPRN", ts, F.col(spec.out), src)


def renewables_table(wide: DataFrame) -> DataFrame:
    """Technology matrix table: flags, count, first sources, first dates."""
    techs = e1.TECHNOLOGIES
    return wide.where(F.col("RENEWABLE_COUNT") > 0).select(
        "UPRN", *techs, "RENEWABLE_COUNT", *[f"{t}_SOURCE" for t in techs], *[f"{t}_TIMESTAMP" for t in techs])


def _as_written(wide: DataFrame) -> DataFrame:
    """Cells as both masters write them: no count without a technology, scores as plain numbers."""
    return wide.withColumns({
        "RENEWABLE_COUNT": F.when(F.col("RENEWABLE_COUNT") > 0, F.col("RENEWABLE_COUNT")),
        "SAP_SCORE": _number_text("SAP_SCORE"), "SAP_FUEL_BILL": _number_text("SAP_FUEL_BILL")})


def master(wide: DataFrame) -> DataFrame:
    """Master: UPRN + 19 value columns as text + DATA_COUNT over 18 of them."""
    value_cols = [c for c in e1.MASTER_COLUMNS if c != "UPRN"]
    return R.assemble_master(_as_written(wide), value_cols, key="UPRN", key_out="UPRN")


def timestamped_columns() -> list[str]:
    """Columns table by table: the attribute tables up to the scores, the
    technologies, then the roof and floor tables; inside as each table has them."""
    by_name = {s.name: s for s in attribute_specs()}
    late = ["RIR_INS", "FLOOR_INSULATION", "FLAT_ROOF_INS"]

    def own(name: str) -> list[str]:
        s = by_name[name]
        return ([f"TIMESTAMP_{name}", f"SOURCE_{name}", s.out] if s.numeric else [f"TIMESTAMP_{name}", s.out, f"SOURCE_{name}"])

    techs = e1.TECHNOLOGIES
    renewables = [*techs, "RENEWABLE_COUNT", *[f"{t}_SOURCE" for t in techs], *[f"{t}_TIMESTAMP" for t in techs]]
    early = [n for n in by_name if n not in late]
    return ["UPRN", *[c for n in early for c in own(n)], *renewables, *[c for n in late for c in own(n)]]


def timestamped_master(wide: DataFrame) -> DataFrame:
    """Master with date and source of every value; what a property lacks is missing."""
    techs = e1.TECHNOLOGIES
    some = F.col("RENEWABLE_COUNT").isNotNull()
    filled = _as_written(wide)
    return filled.withColumns({c: F.when(some, F.col(c)) for t in techs for c in (t, f"{t}_SOURCE")}).select(*timestamped_columns())


def duplicate_report(observations: DataFrame) -> DataFrame:
    """Rows, keys and rows beyond the first of a key, by attribute (A-06).

    Counted on what resolution reads: keyed observations after exclusion. The
    technology observations are not a table of their own and don't count.
    Observations side by side are counted by key first, so a row meets one hash aggregation of plain
    counts instead of one for each of its observations.
    """
    if "attr" not in observations.columns:
        names = [s.name for s in attribute_specs()]
        by_key = observations.groupBy("key").agg(*[F.count(n).alias(n) for n in names])
        total = by_key.agg(*[F.sum(n).alias(f"rows_{n}") for n in names], *[F.count_if(F.col(n) > 0).alias(f"keys_{n}") for n in names])
        counted = total.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("attr"), F.col(f"rows_{n}").alias("n_rows"), F.col(f"keys_{n}").alias("n_keys"),
                     (F.col(f"rows_{n}") - F.col(f"keys_{n}")).alias("n_duplicates")) for n in names])).alias("o"))
        return counted.select("o.*").where("n_rows > 0")
    kept = R.exclude_observations(observations, attribute_specs()).where(F.col("attr") != "RENEWABLES")
    return kept.groupBy("attr").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("key").alias("n_keys")).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_keys"))


def observe_duplicates(wide: DataFrame) -> tuple[DataFrame, Observation]:
    """(wide without ROWS_x, what its write observes): the numbers of ``duplicate_report`` come with the
    one aggregation that resolves everything, without a scan, shuffle or distinct count of their own."""
    names = [s.name for s in attribute_specs()]
    seen = Observation("duplicates")
    numbers = [n for a in names for n in (F.coalesce(F.sum(f"ROWS_{a}"), F.lit(0)).alias(f"rows_{a}"),
                                          F.count_if(F.col(f"ROWS_{a}") > 0).alias(f"keys_{a}"))]
    return wide.observe(seen, *numbers).drop(*[f"ROWS_{a}" for a in names]), seen


def observed_duplicates(spark: SparkSession, seen: Observation) -> DataFrame:
    """``duplicate_report`` of a write that has ended: a row for each attribute with observations."""
    got = seen.get
    rows = [(s.name, got[f"rows_{s.name}"], got[f"keys_{s.name}"], got[f"rows_{s.name}"] - got[f"keys_{s.name}"])
            for s in attribute_specs() if got[f"rows_{s.name}"]]
    return spark.createDataFrame(rows, "attr string, n_rows long, n_keys long, n_duplicates long")
