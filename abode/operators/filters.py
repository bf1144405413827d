"""Row filters with the missing-value semantics of the source programmes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.functions.text import is_blank, null_safe_isin


def drop_all_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where every listed column is blank (NULL, "" or " ")."""
    all_blank = None
    for c in cols:
        all_blank = is_blank(c) if all_blank is None else all_blank & is_blank(c)
    return df.where(~all_blank)


def drop_junk_keys(df: DataFrame, key: str, junk: Sequence[str]) -> DataFrame:
    """Drop rows whose key text is missing or a junk token."""
    return df.where(F.col(key).isNotNull() & ~null_safe_isin(key, junk))


def split_blank_key(df: DataFrame, key: str, group_size: str) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined).

    kept: rows with a non-blank key. quarantined: blank-key rows that are
    alone in their duplicate group; blank-key rows in larger groups are
    dropped silently, as in the source programme.
    """
    blank = is_blank(key)
    kept = df.where(~blank)
    quarantined = df.where(blank & (F.col(group_size) == 1))
    return kept, quarantined


def keep_unmarked(df: DataFrame, marker: str) -> DataFrame:
    """Keep rows whose manual removal marker is empty (NULL)."""
    return df.where(F.col(marker).isNull())
