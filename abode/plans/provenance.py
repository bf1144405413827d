"""Provenance extract: master + one (UPRN, TIMESTAMP, SOURCE) table per
attribute, restricted to a reference population, first row per key.

Instead of one left join per attribute table, the tables are stacked into
one long frame and pivoted with a single ``groupBy(UPRN)``; the master, the
pivot and the population meet on the same key. "First" means first in the
landed order, so the master and every table must carry ``seq``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.operators import joins as J
from abode.operators import resolve as W
from abode.sources.landed import require_columns


def stack_provenance(tables: dict[str, DataFrame], key: str = "UPRN") -> DataFrame:
    """{attr: (UPRN, TIMESTAMP, SOURCE, seq)} -> long (UPRN, attr, TIMESTAMP, SOURCE, seq); rows without a key match nothing and go."""
    out = None
    for name, df in tables.items():
        require_columns(df, [key, "TIMESTAMP", "SOURCE", "seq"], f"provenance table {name}")
        part = df.where(F.col(key).isNotNull()).select(F.col(key).alias(key), F.lit(name).alias("attr"),
                         F.col("TIMESTAMP").cast("date").alias("TIMESTAMP"),
                         F.col("SOURCE").cast("string").alias("SOURCE"), F.col("seq").cast("long").alias("seq"))
        out = part if out is None else out.unionByName(part)
    return out


def renewables_provenance(renewables: DataFrame, technologies: Sequence[str], key: str = "UPRN") -> dict:
    """Split a renewables table (``<T>_TIMESTAMP``, ``<T>_SOURCE``) into per-technology tables."""
    return {t: renewables.select(key, F.col(f"{t}_TIMESTAMP").alias("TIMESTAMP"),
                                 F.col(f"{t}_SOURCE").alias("SOURCE"), "seq")
            for t in technologies}


def joined_row_counts(master: DataFrame, tables: dict[str, DataFrame], population: DataFrame, key: str = "UPRN",
                      physical: dict[str, str] | None = None) -> DataFrame:
    """Row counts of the programme in one row: after all joins, outside and inside the
    population, in keys that occur twice or more, and after first-wins.

    A key that a table holds n times multiplies the rows of the master by n; so
    counts are products of counts by key, without making the rows. ``physical``
    maps an attribute to the table that it comes from, as several may share one.
    """
    of = physical or {}
    seen: dict[str, DataFrame] = {}
    for name, df in tables.items():
        seen.setdefault(of.get(name, name), df)
    each = None
    for table, df in seen.items():
        part = df.select(F.col(key).alias("_k"), F.lit(table).alias("_t"))
        each = part if each is None else each.unionByName(part)
    per_key = each.groupBy("_k", "_t").count().groupBy("_k").agg(F.product(F.col("count").cast("double")).alias("_times"))
    rows = master.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    rows = rows.join(per_key, F.col("_key").eqNullSafe(F.col("_k")), "left").drop("_k")
    inside = population.select(F.col(key).alias("_p")).distinct().withColumn("_in", F.lit(True))
    rows = rows.join(inside, F.col("_key").eqNullSafe(F.col("_p")), "left")
    n = (F.col("_rows") * F.coalesce("_times", F.lit(1.0))).cast("long")
    within = F.col("_in").isNotNull()
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    return rows.agg(total(F.lit(True)).alias("rows_before"), total(~within).alias("rows_not_in_population"),
                    total(within).alias("rows_in_population"), total(within & (n > 1)).alias("rows_in_duplicated_keys"),
                    F.count_if(within).alias("rows_after_dedup"))


def provenance_extract(
    master: DataFrame,
    tables: dict[str, DataFrame],
    population: DataFrame,
    contract: Sequence[str],
    key: str = "UPRN",
) -> DataFrame:
    """47-column style extract (columns named by ``contract``).

    ``seq`` gives the row order of the master and of each table; duplicate keys
    keep their first row, and missing dates don't matter for that.
    """
    require_columns(master, [key, "seq"], "master")
    long = stack_provenance(tables, key)
    aggs = []
    for name in tables:
        mine = F.when(F.col("attr") == name, F.struct("seq", "TIMESTAMP", "SOURCE"))
        aggs.append(F.min(mine).alias(f"_{name}"))
    pivot = long.groupBy(key).agg(*aggs).select(
        F.col(key).alias("_pk"),
        *[F.col(f"_{n}.TIMESTAMP").alias(f"TIMESTAMP_{n}") for n in tables],
        *[F.col(f"_{n}.SOURCE").alias(f"SOURCE_{n}") for n in tables])
    first = W.first_per_key(master, key, ["seq"])
    kept = J.in_population(first, population, key)
    joined = kept.join(pivot, kept[key] == pivot["_pk"], "left").drop("_pk")
    return joined.select(*[F.col(f"`{c}`") for c in contract])
