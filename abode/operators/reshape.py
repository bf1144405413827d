"""Long <-> wide: measure unpivot, technology matrix, one-pass wide master.

The wide master is built from one long observation frame
``(key, attr, value, num, ts, source, source_rank, seq)`` by a single
``groupBy(key)`` holding one conditional ``min_by`` per attribute. That is one
shuffle for all attributes (instead of one join per attribute table), with
partial aggregation before it, so hot keys never concentrate in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.operators.columns import blank_nulls, count_filled


def explode_measures(
    df: DataFrame,
    measure_cols: Sequence[str],
    ids: Sequence[str] | None = None,
    names_to: str = "COLUMN",
    values_to: str = "MEASURE",
) -> DataFrame:
    """Unpivot measure columns to rows, dropping missing values.

    Replaces a row-number self-join: every kept row keeps its claim columns.
    """
    ids = [c for c in df.columns if c not in measure_cols] if ids is None else list(ids)
    long = df.unpivot(ids, list(measure_cols), names_to, values_to)
    return long.where(F.col(values_to).isNotNull())


def to_observations(
    df: DataFrame,
    key: str,
    ts: str,
    attrs: dict[str, str],
    source: str = "SOURCE",
    rank: str = "source_rank",
    seq: str = "seq",
    numeric: dict[str, str] | None = None,
    exclude: dict[str, Sequence] | None = None,
) -> DataFrame:
    """Wide classified rows -> long ``(key, attr, value, num, ts, source, rank, seq)``.

    ``attrs`` maps attribute name -> text column; ``numeric`` maps attribute
    name -> numeric column. NULL values, rows without a key and the values that
    ``exclude`` lists by attribute are left out before rows are made of them.
    """
    def usable(a: str, c: str) -> Column:
        value = F.col(f"`{c}`")
        out = (exclude or {}).get(a)
        return value.isNotNull() & ~value.cast("string").isin(list(out)) if out else value.isNotNull()

    arms = [
        F.when(usable(a, c), F.struct(F.lit(a).alias("attr"), F.col(f"`{c}`").cast("string").alias("value"),
                                      F.lit(None).cast("double").alias("num")))
        for a, c in attrs.items()
    ]
    arms += [
        F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(a).alias("attr"), F.lit(None).cast("string").alias("value"),
                                                     F.col(f"`{c}`").cast("double").alias("num")))
        for a, c in (numeric or {}).items()
    ]
    exploded = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(source).alias("source"),
        F.col(rank).alias("source_rank"), F.col(seq).alias("seq"),
        F.explode(F.array(*arms)).alias("o"),  # not compacted: Spark would repeat all cells in a filter below
    )
    return exploded.where("o IS NOT NULL").select("key", "o.attr", "o.value", "o.num", "ts", "source", "source_rank", "seq")


def to_observed_rows(
    df: DataFrame,
    key: str,
    ts: str,
    attrs: dict[str, str],
    names: Sequence[str],
    source: str = "SOURCE",
    rank: str = "source_rank",
    seq: str = "seq",
    numeric: dict[str, str] | None = None,
    exclude: dict[str, Sequence] | None = None,
) -> DataFrame:
    """``to_observations`` with the observations of a row side by side: ``(key, ts, source, rank, seq)``
    and a column for each of ``names``, missing where the row observes nothing of it.

    A row stays one row, so what reads all attributes (``resolve_rows``, counts by key) moves and sorts it once
    instead of once an attribute.
    """
    def said(name: str) -> Column:
        if name in (numeric or {}):
            return F.col(f"`{numeric[name]}`").cast("double")
        if name not in attrs:
            return F.lit(None).cast("string")
        value, out = F.col(f"`{attrs[name]}`").cast("string"), (exclude or {}).get(name)
        return F.when(~value.isin(list(out)), value) if out else value

    return df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(source).alias("source"), F.col(rank).alias("source_rank"),
        F.col(seq).alias("seq"), *[said(n).alias(n) for n in names])


@dataclass(frozen=True)
class AttributeSpec:
    name: str                 # attribute name in the long frame
    out: str                  # output value column
    policy: str = "latest"    # "latest" (newest date) or "first" (arrival order)
    numeric: bool = False
    exclude: tuple = ()


def exclude_observations(obs: DataFrame, specs: Sequence[AttributeSpec],
                         tech_attr: str | None = None, tech_exclude: Sequence = ()) -> DataFrame:
    """Drop each attribute's excluded values (and NULL keys) in one filter."""
    drop = F.col("key").isNull()
    for s in specs:
        if s.exclude:
            drop = drop | ((F.col("attr") == s.name) & F.col("value").isin(list(s.exclude)))
    if tech_attr and tech_exclude:
        drop = drop | ((F.col("attr") == tech_attr) & F.col("value").isin(list(tech_exclude)))
    return obs.where(~drop)


def _order(policy: str) -> Column:
    rank_seq = [F.col("source_rank").alias("r"), F.col("seq").alias("s")]
    if policy == "latest":
        return F.struct(F.isnull("ts").alias("tn"), (-F.unix_date("ts")).alias("t"), *rank_seq)
    return F.struct(F.lit(False).alias("tn"), F.lit(0).alias("t"), *rank_seq)


def resolve_wide(
    obs: DataFrame,
    specs: Sequence[AttributeSpec],
    technologies: Sequence[str] = (),
    tech_attr: str = "RENEWABLES",
    counts: bool = False,
) -> DataFrame:
    """One row per key with (value, TIMESTAMP_x, SOURCE_x) per attribute.

    ``counts`` adds ``ROWS_x``, the key's observations of each attribute.

    Technologies give ``<T>`` ("Yes"/""), ``RENEWABLE_COUNT``,
    ``<T>_SOURCE`` ("" when absent) and ``<T>_TIMESTAMP`` (first by arrival).
    ``obs`` must already be filtered (``exclude_observations``).
    """
    aggs = []
    for s in specs:
        payload = F.struct(("num" if s.numeric else "value"), "ts", "source")
        hit = F.col("attr") == s.name
        aggs.append(F.min_by(payload, F.when(hit, _order(s.policy))).alias(f"_{s.name}"))
        if counts:
            aggs.append(F.count_if(hit).alias(f"ROWS_{s.name}"))
    for t in technologies:
        hit = (F.col("attr") == tech_attr) & (F.col("value") == t)
        aggs.append(F.max(F.when(hit, 1).otherwise(0)).alias(f"_{t}_flag"))
        aggs.append(F.min_by(F.struct("source", "ts"), F.when(hit, _order("first"))).alias(f"_{t}_first"))
    return _resolved(obs.groupBy("key").agg(*aggs), specs, technologies, counts)


def _resolved(grouped: DataFrame, specs: Sequence[AttributeSpec], technologies: Sequence[str], counts: bool) -> DataFrame:
    """The columns of ``resolve_wide`` from winners by key: structs ``_x``, ``_<T>_flag`` and ``_<T>_first``."""
    cols = [F.col("key")]
    for s in specs:
        v = "num" if s.numeric else "value"
        cols += [
            F.col(f"_{s.name}.{v}").alias(s.out),
            F.col(f"_{s.name}.ts").alias(f"TIMESTAMP_{s.name}"),
            F.col(f"_{s.name}.source").alias(f"SOURCE_{s.name}"),
        ]
    if technologies:
        cols += [F.when(F.col(f"_{t}_flag") == 1, "Yes").otherwise("").alias(t) for t in technologies]
        count = F.col(f"_{technologies[0]}_flag")
        for t in technologies[1:]:
            count = count + F.col(f"_{t}_flag")
        cols.append(count.cast("int").alias("RENEWABLE_COUNT"))
        cols += [F.coalesce(F.col(f"_{t}_first.source"), F.lit("")).alias(f"{t}_SOURCE") for t in technologies]
        cols += [F.col(f"_{t}_first.ts").alias(f"{t}_TIMESTAMP") for t in technologies]
    if counts:
        cols += [F.col(f"ROWS_{s.name}") for s in specs]
    return grouped.select(*cols)


def resolve_rows(rows: DataFrame, specs: Sequence[AttributeSpec], technologies: Sequence[str] = (), tech_attr: str = "RENEWABLES",
                 counts: bool = False) -> DataFrame:
    """``resolve_wide`` of observations side by side (``to_observed_rows``): the same columns and rows.

    One aggregation and one exchange. A winner is the smallest of one struct, order first, so a
    row is compared once an attribute it has, not once for each attribute and observation.
    """
    def winner(hit: Column, order: list[Column], payload: list[Column]) -> Column:
        return F.min(F.when(hit, F.struct(*order, *payload)))

    by_date, landed = [F.isnull("ts").alias("tn"), (-F.unix_date("ts")).alias("t")], [F.col("source_rank").alias("r"), F.col("seq").alias("s")]
    aggs = [F.max(F.coalesce(*[F.when(F.col(n).isNotNull(), 1) for n in (*(s.name for s in specs), *([tech_attr] if technologies else []))])).alias("_some")]
    for s in specs:
        value = F.col(s.name).alias("num" if s.numeric else "value")
        order = by_date + landed if s.policy == "latest" else landed
        aggs.append(winner(F.col(s.name).isNotNull(), order, [value, F.col("ts"), F.col("source")]).alias(f"_{s.name}"))
        if counts:
            aggs.append(F.count(s.name).alias(f"ROWS_{s.name}"))
    for t in technologies:
        aggs.append(winner(F.col(tech_attr) == t, landed, [F.col("source"), F.col("ts")]).alias(f"_{t}_first"))
    grouped = rows.groupBy("key").agg(*aggs).where("_some = 1")  # a key without any observation is none
    return _resolved(grouped.withColumns({f"_{t}_flag": F.when(F.col(f"_{t}_first").isNotNull(), 1).otherwise(0) for t in technologies}),
                     specs, technologies, counts)


def observation_state(obs: DataFrame, specs: Sequence[AttributeSpec], technologies: Sequence[str] = (), tech_attr: str = "RENEWABLES") -> DataFrame:
    """The observations that decide: the winner of every key and attribute, and the first
    of every key and technology.

    It resolves to the same wide rows as ``obs`` (``resolve_wide``), and so does the state of a
    state with later observations: winners are minima under one total order, whatever
    was merged before. ``obs`` must already be filtered (``exclude_observations``). One
    partial aggregation and one exchange; a hot key is a row a task and attribute.
    """
    newest = [s.name for s in specs if s.policy == "latest"]
    wanted = F.col("attr").isin([s.name for s in specs])
    is_tech = (F.col("attr") == tech_attr) & F.col("value").isin(list(technologies))
    by_date = F.col("attr").isin(newest) & ~is_tech
    order = F.struct((by_date & F.col("ts").isNull()).alias("tn"), F.when(by_date, -F.unix_date("ts")).otherwise(0).alias("t"),
                     F.col("source_rank").alias("r"), F.col("seq").alias("s"))
    kept = obs.where(F.col("key").isNotNull() & (wanted | is_tech))
    payload = F.struct("value", "num", "ts", "source", "source_rank", "seq")
    best = kept.groupBy("key", "attr", F.when(is_tech, F.col("value")).alias("technology")).agg(F.min_by(payload, order).alias("best"))
    return best.select("key", "attr", "best.*")


def merge_observations(state: DataFrame, new: DataFrame, specs: Sequence[AttributeSpec], technologies: Sequence[str] = (),
                       tech_attr: str = "RENEWABLES") -> DataFrame:
    """The state of all observations so far, from the state of earlier feeds and the rows of new
    ones. New rows must go on with the landing order (``seq``) of their source."""
    return observation_state(state.unionByName(new.select(*state.columns)), specs, technologies, tech_attr)


def technology_matrix(
    obs: DataFrame,
    technologies: Sequence[str],
    exclude: Sequence = ("Unknown", "Other"),
    tech_attr: str = "RENEWABLES",
) -> DataFrame:
    """Presence flags, count, first source and first date per technology.

    The technology list is fixed, so every technology column exists even
    when absent from the data.
    """
    kept = exclude_observations(obs.where(F.col("attr") == tech_attr), [], tech_attr, exclude)
    return resolve_wide(kept.where(F.col("value").isNotNull()), [], technologies, tech_attr)


def assemble_master(
    wide: DataFrame,
    value_cols: Sequence[str],
    count_exclude: Sequence[str] = ("RENEWABLE_COUNT",),
    key: str = "key",
    key_out: str = "UPRN",
) -> DataFrame:
    """Master: key + value columns as text with blanks for missing + DATA_COUNT.

    Timestamp/source columns are dropped before the blank fill.
    """
    master = wide.select(F.col(key).alias(key_out), *[F.col(c) for c in value_cols])
    filled = blank_nulls(master, list(value_cols))
    counted = [c for c in value_cols if c not in count_exclude]
    return filled.withColumn("DATA_COUNT", count_filled(counted))
