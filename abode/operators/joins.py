"""Lookup joins, re-geocoding and population membership.

No side is hinted: lookups are callers' files of any size. Spark broadcasts
one that is under ``autoBroadcastJoinThreshold`` (statistics at plan time,
actual shuffle sizes under AQE) and otherwise shuffles both sides on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str] | dict[str, str],
    how: str = "left",
    null_safe: bool = True,
    required: bool = False,
) -> DataFrame:
    """Attach lookup columns by key.

    ``on`` is a name, a list of shared names, or ``{left_name: right_name}``.
    ``null_safe`` matches a missing key with a missing key (the semantics of
    the source programmes); it still plans as an equi join. ``required``
    drops rows without a match (inner join).
    """
    if isinstance(on, str):
        on = {on: on}
    elif not isinstance(on, dict):
        on = {k: k for k in on}
    right = lookup.select(
        *[F.col(r).alias(f"_lk_{i}") for i, r in enumerate(on.values())],
        *[c for c in lookup.columns if c not in on.values()],
    )
    cond = None
    for i, left_name in enumerate(on):
        l, r = df[left_name], right[f"_lk_{i}"]
        c = l.eqNullSafe(r) if null_safe else (l == r)
        cond = c if cond is None else cond & c
    joined = df.join(right, cond, "inner" if required else how)
    return joined.drop(*[f"_lk_{i}" for i in range(len(on))])


def refresh_columns(
    df: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    cols: Sequence[str],
    null_safe: bool = True,
) -> DataFrame:
    """Re-geocode: new lookup values win, old values are the fallback.

    ``df`` holds ``<c>`` for each of ``cols`` (the old values); the lookup
    provides new ``<c>``. Result keeps ``df``'s columns with refreshed values.
    """
    old = df.withColumnsRenamed({c: f"{c}__old" for c in cols})
    joined = lookup_join(old, lookup.select(*on.values(), *cols), on, "left", null_safe)
    refreshed = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}__old")) for c in cols})
    return refreshed.select(*df.columns)


def in_population(df: DataFrame, population: DataFrame, key: str, pop_key: str | None = None) -> DataFrame:
    """Rows whose key is in the reference population (semi join, null-safe)."""
    pop = population.select(F.col(pop_key or key).alias("_pk"))
    return df.join(pop, df[key].eqNullSafe(pop["_pk"]), "left_semi")


def missing_from(df: DataFrame, population: DataFrame, key: str, pop_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the reference population (anti join, null-safe)."""
    pop = population.select(F.col(pop_key or key).alias("_pk"))
    return df.join(pop, df[key].eqNullSafe(pop["_pk"]), "left_anti")
