"""Data-quality operators: profiles, frequency tables, gates, drift checks.

Gates compute all their counts in one aggregate job and return the
offending rows as a DataFrame (a quarantine), so a failing run says which
rows and which columns at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    def __init__(self, message: str, counts: dict, offenders: DataFrame):
        super().__init__(message)
        self.counts = counts
        self.offenders = offenders


def profile_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys (NULL counted as a key), duplicate rows."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_distinct(F.col(key)) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0)))
        .alias("n_keys"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))


def frequency(df: DataFrame, cols: Sequence[str], keep_null: bool = True) -> DataFrame:
    """(column, value, n) for every listed column in one pass.

    Values are compared as text; ``keep_null`` keeps a NULL-value row.
    """
    arms = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in cols]
    long = df.select(F.explode(F.array(*arms)).alias("o")).select("o.column", "o.value")
    if not keep_null:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def frequency_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n): value counts inside each group, missing values kept."""
    return df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def five_number(df: DataFrame, col: str, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """min, quartiles, median, max and mean.

    Quartiles are sketches of a fixed size. ``exact=True`` interpolates (Spark
    ``percentile``) with a value -> count map merged in one task: only for
    bounded columns such as DATA_COUNT (at most 19 values).
    """
    c = F.col(col).cast("double")
    if exact:
        def q(p):
            return F.percentile(c, F.lit(p))
    else:
        def q(p):
            return F.percentile_approx(c, p, accuracy).cast("double")
    return df.agg(
        F.min(c).alias("min"),
        q(0.25).alias("q1"),
        q(0.5).alias("median"),
        F.mean(c).alias("mean"),
        q(0.75).alias("q3"),
        F.max(c).alias("max"),
    )


class Bracket(NamedTuple):
    """Values above ``low`` and below ``high``: how many are not above ``low``, how many inside, wanted ranks in there."""

    low: float | None
    high: float | None
    below: int
    size: int
    ranks: list[int]


def exact_quantiles(df: DataFrame, col: str, probabilities: Sequence[float], most: int = 10_000) -> dict[float, float | None]:
    """Interpolated quantiles of all non-missing values, exact at any size.

    Distributed selection: each quantile lies between two ranks. A sketch proposes cuts
    around a rank, one aggregate counts what is below and at each cut, and the rank is either at a
    cut or in the open bracket between two, until a bracket has at most ``most``
    different values. Their counts and those of cuts are all that the driver sees; no task holds
    the column. NaN counts as the largest value; without values every quantile is None.
    """
    values = df.select(F.col(f"`{col}`").cast("double").alias("x")).where("x IS NOT NULL")
    n = values.count()
    if not n:
        return dict.fromkeys(probabilities)
    ranks = {int(r) for p in probabilities for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
    found: dict[int, float] = {}
    brackets = [Bracket(None, None, 0, n, sorted(ranks))]
    while brackets:
        low, high, below, size, own = brackets.pop()
        inside = values if low is None else values.where(F.col("x") > low)
        inside = inside if high is None else inside.where(F.col("x") < high)
        few = inside.groupBy("x").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
        if len(few) > most:
            brackets += _narrower(inside, Bracket(low, high, below, size, own), found)
            continue
        up_to, left = below, list(own)
        for row in sorted(few, key=lambda r: (math.isnan(r["x"]), r["x"])):
            up_to += row["n"]
            while left and left[0] < up_to:
                found[left.pop(0)] = row["x"]
    out = {}
    for p in probabilities:
        at = p * (n - 1)
        one, two = found[math.floor(at)], found[math.ceil(at)]
        out[p] = one if one == two else one + (at - math.floor(at)) * (two - one)
    return out


def _narrower(inside: DataFrame, bracket: Bracket, found: dict[int, float]) -> list[Bracket]:
    """Smaller brackets of those ranks that no cut has; those that one has go to ``found``. Cuts are
    values from inside the bracket, so each round leaves some out."""
    below = bracket.below
    places = sorted({min(max((r - below) / max(1, bracket.size - 1) + d / 1000, 0.0), 1.0) for r in bracket.ranks for d in (-2, 2)})
    cuts = sorted(set(inside.agg(F.percentile_approx("x", places, 10_000).alias("q")).first()["q"]))
    x = F.col("x")
    counts = inside.agg(*[F.count_if(x < c).alias(f"below{i}") for i, c in enumerate(cuts)], *[F.count_if(x <= c).alias(f"upto{i}") for i, c in enumerate(cuts)]).first()
    out: dict[tuple[float | None, float | None], Bracket] = {}
    for rank in bracket.ranks:
        low, high, first, last = bracket.low, bracket.high, below, below + bracket.size
        for i, cut in enumerate(cuts):
            if below + counts[f"upto{i}"] <= rank:
                low, first = cut, below + counts[f"upto{i}"]
            elif below + counts[f"below{i}"] <= rank:
                found[rank] = cut
                break
            else:
                high, last = cut, below + counts[f"below{i}"]
                break
        if rank not in found:
            out.setdefault((low, high), Bracket(low, high, first, last - first, [])).ranks.append(rank)
    return list(out.values())


def gate_counts(df: DataFrame, cols: Sequence[str], bad: Sequence[str] = ("ERROR",),
                include_null: bool = False) -> DataFrame:
    """One row: number of bad cells per column (single scan)."""
    def is_bad(c):
        cond = F.col(c).isin(list(bad))
        return (cond | F.col(c).isNull()) if include_null else cond
    return df.agg(*[F.count_if(is_bad(c)).alias(c) for c in cols])


def gate(df: DataFrame, cols: Sequence[str], bad: Sequence[str] = ("ERROR",), strict: bool = True,
         include_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean, offenders). Raises ``GateError`` in strict mode if any bad cell."""
    bad_row = None
    for c in cols:
        cond = F.coalesce(F.col(c).isin(list(bad)), F.lit(False))
        if include_null:
            cond = cond | F.col(c).isNull()
        bad_row = cond if bad_row is None else bad_row | cond
    offenders = df.where(bad_row)
    clean = df.where(~bad_row)
    if strict:
        counts = gate_counts(df, cols, bad, include_null).first().asDict()
        failing = {k: v for k, v in counts.items() if v}
        if failing:
            raise GateError(f"bad categories found: {failing}", failing, offenders)
    return clean, offenders


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise when a key occurs more than once."""
    dup = df.groupBy(key).count().where("count > 1").limit(1).count()
    if dup:
        raise GateError(f"{key} is not unique", {key: dup}, df)


def check_columns(df: DataFrame, expected: Sequence[str], strict: bool = True) -> list[str]:
    """Columns in ``df`` that the previous output did not have (drift)."""
    new = [c for c in df.columns if c not in set(expected)]
    if new and strict:
        raise GateError(f"unexpected columns: {new}", {"new": new}, df)
    return new


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-missing values of ``col`` as ``value``."""
    return df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def unseen_values(df: DataFrame, col: str, known: DataFrame | Sequence[str]) -> DataFrame:
    """Distinct non-missing values of ``col`` that are not in the known list.

    A literal list is a plain ``NOT IN`` filter (no join); a known-values
    DataFrame (data-sized) is an anti join left to the planner.
    """
    values = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull())
    if not isinstance(known, DataFrame):
        return values.where(~F.col("value").isin(list(known))).distinct()
    known = known.select(F.col(known.columns[0]).alias("value"))
    return values.distinct().join(known, "value", "left_anti")
