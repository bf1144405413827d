"""Classification by distinct value.

A rule table reads a few text columns that hold few different values, so its
patterns need not run on every row. The distinct inputs of all tables are
gathered in one scan (partial aggregation, so a hot value is one row a task),
classified once each, written, and joined back by value. The plan over the rows then holds
lookups instead of patterns: nothing that is pushed through it repeats a rule.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.functions.classify import Rules, classify
from abode.session import stage_table

#: Distinct inputs of one table that are joined back by a broadcast; of more, the table's rules run on the rows.
BROADCAST_VALUES = 100_000


@dataclass(frozen=True)
class ValueTable:
    """Rule tables over the text columns ``inputs``.

    ``outputs`` are applied in order, so a later one may read an earlier one;
    ``derived`` are helper columns over the inputs that the rules read.
    """

    inputs: tuple[str, ...]
    outputs: Mapping[str, tuple[Rules, str | None]]
    derived: Mapping[str, Column] = field(default_factory=dict)

    def classified(self, df: DataFrame) -> DataFrame:
        """``df`` with the outputs, by rules on its rows."""
        df = df.withColumns(dict(self.derived)) if self.derived else df
        for name, (rules, default) in self.outputs.items():
            df = df.withColumn(name, classify(rules, default))
        return df.drop(*self.derived)


@dataclass(frozen=True)
class ValueLookup:
    """The classified distinct inputs of ``tables``; ``sizes`` has their number by table."""

    tables: Sequence[ValueTable]
    values: DataFrame
    sizes: dict[int, int]

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with the outputs of all tables. Missing inputs meet missing ones."""
        for nth, table in enumerate(self.tables):
            if self.sizes.get(nth, 0) > BROADCAST_VALUES:
                df = table.classified(df)
                continue
            keys = [f"__v{nth}_{i}" for i in range(len(table.inputs))]
            found = self.values.where(F.col("nth") == nth).select(
                *[F.col(f"v{i}").alias(k) for i, k in enumerate(keys)], *[F.col(f"o{i}").alias(o) for i, o in enumerate(table.outputs)])
            same = [F.col(c).cast("string").eqNullSafe(F.col(k)) for c, k in zip(table.inputs, keys)]
            df = df.join(F.broadcast(found), same, "left").drop(*keys)
        return df


def _padded(columns: Sequence[Column], width: int, prefix: str) -> list[Column]:
    missing = [F.lit(None).cast("string")] * (width - len(columns))
    return [c.alias(f"{prefix}{i}") for i, c in enumerate([*columns, *missing])]


def value_lookup(source: DataFrame, tables: Sequence[ValueTable],
                 stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> ValueLookup:
    """Gather and classify the distinct inputs of ``tables`` in one scan of ``source``.

    ``source`` may hold more rows than the lookup is applied to. Missing and empty texts
    are values like any other; inputs are compared as text. Tables with more than
    ``BROADCAST_VALUES`` distinct inputs are left out, and their rules run on the rows.
    """
    width = max(len(t.inputs) for t in tables)
    outs = max(len(t.outputs) for t in tables)
    arms = [F.struct(F.lit(nth).alias("nth"), *_padded([F.col(c).cast("string") for c in t.inputs], width, "v")) for nth, t in enumerate(tables)]
    seen = stage(source.select(F.explode(F.array(*arms)).alias("o")).select("o.*").distinct(), "distinct-values")
    sizes = {row["nth"]: row["count"] for row in seen.groupBy("nth").count().collect()}  # a row for each table
    found = seen.select("nth", *[f"v{i}" for i in range(width)], *_padded([], outs, "o")).limit(0)
    for nth, table in enumerate(tables):
        if not 0 < sizes.get(nth, 0) <= BROADCAST_VALUES:
            continue
        own = seen.where(F.col("nth") == nth).select("nth", *[f"v{i}" for i in range(width)], *[F.col(f"v{i}").alias(c) for i, c in enumerate(table.inputs)])
        own = table.classified(own)
        found = found.union(own.select("nth", *[f"v{i}" for i in range(width)], *_padded([F.col(o) for o in table.outputs], outs, "o")))
    return ValueLookup(tables, stage(found, "classified-values"), sizes)


def classify_by_value(df: DataFrame, tables: Sequence[ValueTable], stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """``df`` with the outputs of ``tables``; ``df`` is read twice."""
    return value_lookup(df, tables, stage).apply(df)
