"""Column-level operators: renames, pattern drops, blank fills, filled counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordered fixed select; fails loudly when a contract column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"contract columns missing: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def prefix_suffix_rename(df: DataFrame, suffixes: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``<NAME>_<SUFFIX>`` -> ``<SUFFIX>_<NAME>`` for the listed names/suffixes."""
    mapping = {f"{n}_{s}": f"{s}_{n}" for n in names for s in suffixes}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name matches ``pattern`` (case-insensitive search)."""
    rx = re.compile(pattern, re.IGNORECASE)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def map_text(df: DataFrame, f: Callable[[Column], Column], cols: Sequence[str] | None = None) -> DataFrame:
    """Apply ``f`` to every string column (or the listed ones)."""
    if cols is None:
        cols = [fld.name for fld in df.schema.fields if isinstance(fld.dataType, T.StringType)]
    return df.withColumns({c: f(F.col(f"`{c}`")) for c in cols})


def blank_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every missing cell -> "" (non-text columns become text first)."""
    cols = list(df.columns) if cols is None else list(cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols})


def count_filled(cols: Sequence[str]) -> Column:
    """Number of listed (text) cells that are not empty."""
    terms = [F.when(F.col(f"`{c}`") != "", 1).otherwise(0) for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def typed_nulls(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add constant-NULL columns of the given types."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in spec.items()})


def order_number(name: str) -> Column:
    """A declared order as a long; a value that is missing or no whole number stops the run, as
    "first" would be arbitrary without it."""
    c = F.col(f"`{name}`")
    return F.coalesce(c.try_cast("long"), F.raise_error(F.concat(F.lit(f"{name} is no number: "), F.coalesce(c.cast("string"), F.lit("missing")))))
