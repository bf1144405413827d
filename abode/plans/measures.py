"""Annual measures programme: yearly install claims -> measure rows, extracts,
refreshed cumulative masters.

Shape of the work on Spark: the claims year is classified row-wise (pure
expressions, no shuffle), gated, unpivoted in place, and joined to two lookups.
Their joins are left to the planner, which broadcasts what is small enough.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.functions import text as X
from abode.functions.dates import fiscal_label
from abode.functions.numbers import positive_flag, to_number
from abode.operators import columns as P
from abode.operators import filters as FL
from abode.operators import joins as J
from abode.operators import quality as Q
from abode.operators import reshape as R
from abode.operators import resolve as W
from abode.operators.by_value import ValueTable, value_lookup
from abode.rules import e2
from abode.session import stage_table
from abode.sources.landed import require_columns


def land_claims(raw: DataFrame) -> DataFrame:
    """Rename raw worksheet headers to landed names (raw and derived names
    would otherwise collide under case-insensitive resolution)."""
    require_columns(raw, list(e2.CLAIM_COLUMNS), "claims worksheet")
    return raw.select(*[F.col(f"`{c}`").alias(e2.CLAIM_COLUMNS.get(c, c)) for c in raw.columns])


def claim_tables() -> list[ValueTable]:
    """The rule tables of a claim by the columns they read."""
    return [
        ValueTable(("house_type",), {"PROPERTY_TYPE": (e2.PROPERTY_TYPE, e2.ERROR)}),
        ValueTable(("tenure_raw",), {"TENURE": (e2.TENURE, e2.ERROR)}),
        ValueTable(("bedrooms_raw",), {"BEDROOMS": (e2.BEDROOMS, e2.ERROR)}),
        ValueTable(("year_built", "wall_category"), {
            "PROPERTY_AGE": (e2.PROPERTY_AGE, e2.ERROR),
            "EXTERNAL_WALL_TYPE": (e2.EXTERNAL_WALL_TYPE, e2.EXTERNAL_WALL_TYPE_DEFAULT),
            "WALL_INS": (e2.WALL_INSULATION, e2.ERROR),
        }, {"year_built_num": to_number("year_built")}),
        ValueTable(("wall_type",), {"WALL_INS_FILL": (e2.WALL_FILL, e2.ERROR)}),
        ValueTable(("loft_depth",), {"LOFT_INSULATION_NI": (e2.LOFT_REGIONAL, e2.ERROR), "LOFT_INSULATION": (e2.LOFT_NATIONAL, e2.ERROR)}),
        ValueTable(("fuel_before",), {"MAIN_HEATING_FUEL": (e2.FUEL_BEFORE, e2.ERROR)}),
        ValueTable(("fuel_after", "heating_after"), {"FS_FUEL_AFTER": (e2.FUEL_AFTER, e2.ERROR), "MAIN_HEATING_SYSTEM": (e2.HEATING_SYSTEM, e2.ERROR)}),
    ]


def classify_claims(claims: DataFrame, as_of: _dt.date, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> tuple[DataFrame, DataFrame]:
    """(classified claims, blank-postcode quarantine), not gated yet.

    Manual removals dropped, duplicate-address group sizes attached,
    blank-postcode singletons quarantined, every category classified by distinct
    value. The values are gathered from ``claims`` as landed, before the join of group
    sizes, and staged.
    """
    lookup = value_lookup(claims, claim_tables(), stage)
    df = FL.keep_unmarked(claims, "remove_marker")
    df = W.with_group_size(df, "duplicate_address", "dupe_check")
    df, quarantined = FL.split_blank_key(df, "Postcode", "dupe_check")
    df = lookup.apply(df)
    df = df.withColumns({name: positive_flag(to_number(col), yes, no)
                         for name, (col, yes, no) in e2.ADDON_FLAGS.items()})
    return df.withColumn("FY", F.lit("FY" + fiscal_label(as_of))), quarantined


def clean_claims(claims: DataFrame, as_of: _dt.date, strict: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean claims, blank-postcode quarantine, gate offenders).

    Strict mode raises ``GateError`` at the first offender; otherwise offenders
    leave the clean claims and are returned apart.
    """
    df, quarantined = classify_claims(claims, as_of)
    clean, offenders = Q.gate(df, e2.GATED_COLUMNS, strict=strict)
    return clean, quarantined, offenders


def postcode_geography(directory: DataFrame, prefix: str = e2.POSTCODE_PREFIX) -> DataFrame:
    """Postcode directory -> (pcds key, LAUA_CODE, LAUA_NAME, PCON_CODE)."""
    names = None
    for code, name in e2.DISTRICTS:
        cond = F.col("lad25cd") == code
        names = F.when(cond, name) if names is None else names.when(cond, name)
    return directory.where(F.col("pcds").startswith(prefix)).select(
        X.postcode_key("pcds").alias("pcds"),
        F.col("lad25cd").alias("LAUA_CODE"),
        names.otherwise(e2.DISTRICT_UNKNOWN).alias("LAUA_NAME"),
        F.col("pcon24cd").alias("PCON_CODE"),
    )


def constituency_names(lookup: DataFrame, seq: str = "seq") -> DataFrame:
    """First landed row per constituency code -> (PCON24CD, PCON_NAME)."""
    require_columns(lookup, ["PCON24CD", "PCON24NM", seq], "constituency lookup")
    df = lookup.select("PCON24CD", F.col("PCON24NM").alias("PCON_NAME"), F.col(seq).cast("long").alias(seq))
    return W.first_per_key(df, "PCON24CD", [seq]).drop(seq)


MEASURE_TABLE = ValueTable(("MEASURE",), {"MEASURE_GROUP": (e2.MEASURE_GROUP, e2.ERROR)})


def explode_claim_measures(
    claims: DataFrame,
    geography: DataFrame,
    pcon_lookup: DataFrame,
    measure_cols: Sequence[str] = tuple(e2.MEASURE_COLUMNS),
    strict_unknown: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = stage_table,
) -> DataFrame:
    """Claims -> one row per measure with geography and measure group.

    Measures grouped "Unknown" are dropped (as the source programme does,
    which also drops "Cavity Wall Insulation (Unknown Property Age)";
    ``strict_unknown`` keeps that one).
    """
    keyed = claims.withColumn("pcds", X.postcode_key("Postcode"))
    geo = J.lookup_join(keyed, geography, "pcds", null_safe=True).drop("pcds")
    names = constituency_names(pcon_lookup)
    geo = J.lookup_join(geo, names, {"PCON_CODE": "PCON24CD"}, null_safe=True)
    long = R.explode_measures(geo, list(measure_cols), values_to="MEASURE")
    measures = R.explode_measures(claims, list(measure_cols), values_to="MEASURE").select("MEASURE")
    grouped = value_lookup(measures, [MEASURE_TABLE], stage).apply(long)
    if strict_unknown:
        grouped = grouped.withColumn(
            "MEASURE_GROUP",
            F.when(F.col("MEASURE") == "Cavity Wall Insulation (Unknown Property Age)", "Insulation")
            .otherwise(F.col("MEASURE_GROUP")))
    return grouped.where(F.col("MEASURE_GROUP") != "Unknown").withColumns({
        "SUB_BUILDING": F.lit(None).cast("string"), "COUNTY": F.lit(None).cast("string")})


def geography_gate(rows: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean rows, offenders): measure-group ERRORs and unresolved districts
    ("Unknown" or missing) stop a strict run and leave the clean rows otherwise."""
    grouped, bad_group = Q.gate(rows, ["MEASURE_GROUP"], strict=strict)
    clean, bad_geo = Q.gate(grouped, ["LAUA_NAME"], bad=("Unknown", "ERROR"), strict=strict, include_null=True)
    return clean, bad_group.unionByName(bad_geo)


def annual_extract(rows: DataFrame) -> DataFrame:
    """7-column yearly measure extract."""
    return rows.select(*[c for c in e2.ANNUAL_COLUMNS if c != e2.SCHEME_COLUMN],
                       F.col("scheme_name").alias(e2.SCHEME_COLUMN))


def department_extract(rows: DataFrame) -> DataFrame:
    """18-column extract, missing -> "", N/A in sub-building and town -> ""."""
    df = rows.select(
        "SUB_BUILDING", F.col("house_number").alias("BUILDING_NUM"), F.col("address_1").alias("STREET"),
        F.col("address_2").alias("LOCALITY"), F.col("address_3").alias("TOWN"), "COUNTY",
        F.col("Postcode").alias("POSTCODE"), "PCON_CODE", "PCON_NAME", "LAUA_CODE", "LAUA_NAME",
        "PROPERTY_TYPE", "TENURE", "PROPERTY_AGE", "MEASURE", "MEASURE_GROUP", "FY",
        F.col("scheme_name").alias(e2.SCHEME_COLUMN))
    df = P.blank_nulls(df)
    return df.withColumns({"SUB_BUILDING": X.blank_if_contains("SUB_BUILDING", "N/A"),
                           "TOWN": X.blank_if_contains("TOWN", "N/A")})


def sort_master(rows: DataFrame) -> DataFrame:
    """Rows by year label, postcode and address text as joined before tidying (``_add``)."""
    return rows.orderBy(F.col("FY").asc_nulls_last(), F.col("POSTCODE").asc_nulls_last(),
                        F.col("_add").asc_nulls_last()).drop("_add")


def append_and_tidy(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Master rows and new rows with tidy addresses and ``_add``, the sort key from the untidied ones."""
    out = previous.unionByName(new, allowMissingColumns=True).withColumn("_add", X.paste_na(*e2.SORT_KEY_COLUMNS))
    return out.withColumns({c: X.tidy_address(F.col(c).cast("string")) for c in e2.ADDRESS_COLUMNS})


#: Columns that a refresh takes from the postcode lookup.
GEOGRAPHY_COLUMNS = ["LAUA_CODE", "LAUA_NAME", "PCON_CODE", "PCON_NAME"]


def named_geography(geography: DataFrame, pcon_lookup: DataFrame) -> DataFrame:
    """Postcode geography with constituency names."""
    names = constituency_names(pcon_lookup)
    return geography.join(names, geography["PCON_CODE"].eqNullSafe(names["PCON24CD"]), "left").select("pcds", *GEOGRAPHY_COLUMNS)


def refreshed_rows(previous: DataFrame, new: DataFrame, geography: DataFrame, pcon_lookup: DataFrame,
                   replace_label: bool = False) -> DataFrame:
    """Previous rows re-geocoded, new rows appended, addresses tidied, with the sort key ``_add``.

    New lookup values win; the old ones are the fallback (a district named
    "Unknown" therefore replaces an old name). ``replace_label`` removes
    rows of the same FY label first, making re-runs idempotent.
    """
    prev = previous.withColumn("pcds", X.postcode_key("POSTCODE"))
    prev = J.refresh_columns(prev, named_geography(geography, pcon_lookup), {"pcds": "pcds"}, GEOGRAPHY_COLUMNS)
    prev = prev.select(*e2.MASTER_COLUMNS)
    if replace_label:
        labels = new.select("FY").distinct()
        prev = prev.join(labels, "FY", "left_anti").select(*e2.MASTER_COLUMNS)
    return append_and_tidy(prev, new.select(*e2.MASTER_COLUMNS))


def refresh_master(previous: DataFrame, new: DataFrame, geography: DataFrame, pcon_lookup: DataFrame,
                   replace_label: bool = False, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Re-geocode the cumulative master, append the new year, tidy, sort (``refreshed_rows``).

    The global sort samples its input first; ``stage`` (if given) writes the
    joined rows once before that, so that the joins run once.
    """
    out = refreshed_rows(previous, new, geography, pcon_lookup, replace_label)
    return sort_master(stage(out, "master") if stage else out)


def changed_years(previous: DataFrame, new: DataFrame, geography: DataFrame, pcon_lookup: DataFrame) -> list[str | None]:
    """FY labels, sorted, whose rows a refresh changes: those of new rows, and those in which a place
    gets another geography, meets several lookup rows or has an untidy address.

    Rows are first reduced to their different places by partial aggregation, so the join with the
    lookup moves a row for each year and place. Labels are one for each year and come to the driver.
    """
    untidy = F.lit(False)
    for c in e2.ADDRESS_COLUMNS:
        untidy = untidy | ~F.col(c).cast("string").eqNullSafe(X.tidy_address(F.col(c).cast("string")))
    places = previous.withColumn("pcds", X.postcode_key("POSTCODE")).groupBy("FY", "pcds", *GEOGRAPHY_COLUMNS).agg(
        F.bool_or(untidy).alias("_untidy"))
    found = named_geography(geography, pcon_lookup).groupBy("pcds").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*GEOGRAPHY_COLUMNS)).alias("_new"))
    moved = F.col("_untidy") | (F.coalesce(F.col("_n"), F.lit(0)) > 1)
    for c in GEOGRAPHY_COLUMNS:
        moved = moved | (F.col(f"_new.{c}").isNotNull() & ~F.col(f"_new.{c}").eqNullSafe(F.col(c)))
    years = J.lookup_join(places, found, "pcds", null_safe=True).where(moved).select("FY")
    return sorted((r["FY"] for r in years.union(new.select("FY")).distinct().collect()), key=lambda y: (y is None, y))


def history_columns(extract: DataFrame, *more: str) -> DataFrame:
    """The report's columns of an extract, under the report's names, and ``more`` as they are."""
    return extract.select(*[F.col(src).alias(dst) for dst, src in e2.HISTORY_COLUMNS.items()], *more)


def append_history(history: DataFrame, new_extract: DataFrame) -> DataFrame:
    """Historic report: report-named columns, new year appended."""
    renamed = history_columns(new_extract)
    return history.unionByName(renamed, allowMissingColumns=True)
