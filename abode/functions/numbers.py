"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal/scientific text. Spark would also accept '1950d', 'NaN',
# 'Infinity'; the guard keeps those missing, as a numeric parse should.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text -> double; anything that is not a plain number becomes NULL."""
    c = _col(c)
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def to_key(c: Column | str) -> Column:
    """Text -> long property key (12-digit keys do not fit an int)."""
    n = to_number(c)
    return F.when(n == F.floor(n), n.cast("long"))


def positive_flag(c: Column | str, yes: str, no: str) -> Column:
    """``yes`` when the amount is > 0, ``no`` otherwise (NULL included)."""
    return F.when(_col(c) > 0, F.lit(yes)).otherwise(F.lit(no))


def cap(c: Column | str, upper: int = 1) -> Column:
    return F.least(_col(c), F.lit(upper))
