"""Readers for landed worksheets and lookups (CSV/Parquet), header tidy.

Worksheets are landed as CSV or Parquet by an upstream step (spreadsheet
decoding is not done here). Everything is read as text with a declared
schema, then cast explicitly, so a stray value never changes a column type.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.functions.numbers import NUMBER_PATTERN
from abode.sources.lines import file_order, landed_records


class HeaderError(ValueError):
    """A source lacks declared columns or has columns that nobody declared."""


def normalise_header(name: str) -> str:
    """Runs of '.' -> space, whitespace runs -> one space, trim."""
    out = re.sub(r"\.+", " ", name)
    out = re.sub(r"\s+", " ", out)
    return out.strip()


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column by ``normalise_header``; fail on collisions."""
    new = [normalise_header(c) for c in df.columns]
    lowered = [c.lower() for c in new]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"header collision after normalisation: {dupes}")
    return df.toDF(*new)


def require_columns(df: DataFrame, required: Sequence[str], source: str, optional: Sequence[str] | None = None) -> DataFrame:
    """Header contract: every required column is there and, with ``optional``
    given, no other than required and optional ones."""
    present = set(df.columns)
    absent = [c for c in required if c not in present]
    unknown = [] if optional is None else [c for c in df.columns if c not in {*required, *optional}]
    if absent or unknown:
        raise HeaderError(f"{source}: absent columns {absent}, unknown columns {unknown}")
    return df


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def parse_header(line: str, sep: str = ",") -> list[str]:
    """Column names of a header line, quotes respected."""
    return [h.strip() for h in next(csv.reader([line], delimiter=sep), [])]


def _records_below_header(spark: SparkSession, path: str, banner_rows: int, sep: str, encoding: str) -> tuple[list[str], DataFrame]:
    """The header and the records after it, (nth, line, text). All files must agree on the header."""
    records = landed_records(spark, path, encoding)
    order = Window.partitionBy("nth").orderBy("line")
    first = records.withColumn("place", F.row_number().over(order)).where(F.col("place") <= banner_rows + 1)
    names = file_order(spark, path)
    heads = {row["nth"]: row for row in first.where(F.col("place") == banner_rows + 1).collect()}  # a row for each file
    headers = {names[nth - 1]: parse_header(heads[nth]["text"], sep) if nth in heads else [] for nth in range(1, len(names) + 1)}
    header = headers[min(headers)] if headers else []
    other = sorted(f for f, h in headers.items() if h != header)
    if other:
        raise HeaderError(f"{path}: the header of {other[0]} differs from {header}")
    ends = spark.createDataFrame([(nth, row["line"]) for nth, row in heads.items()], "nth int, header_line long")
    return header, records.join(F.broadcast(ends), "nth").where(F.col("line") > F.col("header_line")).drop("header_line")


def peek_header(spark: SparkSession, path: str, banner_rows: int = 0, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Column names of a landed CSV; all files of a folder must agree."""
    return _records_below_header(spark, path, banner_rows, sep, encoding)[0]


def read_landed(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    columns: Sequence[str] | None = None,
    banner_rows: int = 0,
    seq_col: str | None = "seq",
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Landed worksheet -> all-text DataFrame (+ ``seq`` landing order).

    CSV: the first ``banner_rows`` records of every file and the header record
    after them are dropped by their place, never by their text. ``seq`` counts files in
    the order of their paths and lines inside, so it does not depend on how
    Spark splits the input; large files are read by many tasks. A quoted cell may hold line breaks, which
    come out as line feeds; a file that ends inside one is a ``RecordError``. Blank
    lines are no rows, except in a sheet of one column, where they are missing cells. An empty file is no sheet.
    The lines are written once under the checkpoint folder. Parquet: ``seq`` is the column of
    that name, which the landing step must have written.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if seq_col:
            require_columns(df, [seq_col], path)
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    header, rows = _records_below_header(spark, path, banner_rows, sep, encoding)
    if columns and list(columns) != header:
        raise HeaderError(f"{path}: header {header} instead of {list(columns)}")
    if len(header) > 1:
        rows = rows.where(F.trim("text") != "")
    cells = F.from_csv("text", F.lit(", ".join(f"`{h.replace('`', '``')}` STRING" for h in header)),
                       {"sep": sep, "quote": '"', "escape": '"'}) if header else F.struct()
    seq = [((F.col("nth") - 1) * F.lit(1 << 32) + F.col("line")).alias(seq_col)] if seq_col else []
    return rows.select(cells.alias("cells"), *seq).select("cells.*", *([seq_col] if seq_col else []))


def read_extract(spark: SparkSession, spec: str) -> DataFrame:
    """An input named on the command line: ``csv:`` folder or ``.csv`` file as text, else Parquet."""
    if spec.startswith("csv:") or spec.endswith(".csv"):
        return spark.read.option("header", "true").option("enforceSchema", "false").option("escape", '"').csv(spec.removeprefix("csv:"))
    return spark.read.parquet(spec)


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The named columns cast to their types; a bad cell becomes NULL instead of failing the job."""
    def cast(name: str, kind: str) -> Column:
        return F.col(f"`{name}`").try_cast(kind).alias(name)

    return df.select(*[cast(c, t) for c, t in columns.items()])


#: Types that a cell may have, from narrow to wide, as bits of a mask; a blank cell may have any.
CELL_TYPES = ("boolean", "long", "double", "date", "string")
GUESS_ROWS = 10_000
_BLANK = (1 << len(CELL_TYPES)) - 1


def cell_types(c: Column) -> Column:
    """Mask of the types that a text cell can be read as. Blank and missing cells fit every type."""
    def mask(*names: str) -> int:
        return sum(1 << CELL_TYPES.index(n) for n in (*names, "string"))

    dated = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd/MM/yyyy")).isNotNull()
    return (F.when(c.isNull() | (F.trim(c) == ""), _BLANK)
            .when(c.rlike(r"^\s*[+-]?\d{1,18}\s*$"), mask("long", "double"))
            .when(c.rlike(NUMBER_PATTERN), mask("double"))
            .when(F.upper(F.trim(c)).isin("TRUE", "FALSE"), mask("boolean"))
            .when(c.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})$") & dated, mask("date")).otherwise(mask()))


def guess_types(df: DataFrame, seq: str = "seq", rows: int | None = GUESS_ROWS) -> dict[str, str]:
    """A type for every column but ``seq``, from its first ``rows`` rows by place, or from all (None).

    The types of a column are what all of its cells have in common, one partial ``bit_and`` a
    column, so order and partitioning don't matter; the narrowest one wins. Columns without
    a value are text.
    """
    columns = [c for c in df.columns if c != seq]
    seen = df if rows is None else df.orderBy(F.col(seq).cast("long")).limit(rows)
    masks = seen.agg(*[F.bit_and(cell_types(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    def narrowest(mask: int | None) -> str:
        return "string" if mask in (None, _BLANK) else next(t for b, t in enumerate(CELL_TYPES) if mask >> b & 1)

    return {c: narrowest(masks[f"c{i}"]) for i, c in enumerate(columns)}


def read_as(c: Column, kind: str) -> Column:
    """A text cell as a type of ``CELL_TYPES``; a cell that doesn't fit is missing."""
    if kind == "date":
        return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd/MM/yyyy"))
    return c if kind == "string" else F.trim(c).try_cast(kind)


def guessed(df: DataFrame, seq: str = "seq", rows: int | None = GUESS_ROWS) -> DataFrame:
    """``df`` with every column in the type that its first ``rows`` rows have; ``seq`` stays.

    A later cell that doesn't fit is missing; :func:`misfits` tells which.
    """
    types = guess_types(df, seq, rows)
    return df.select(*[read_as(F.col(f"`{c}`"), types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def misfits(df: DataFrame, types: dict[str, str], seq: str = "seq") -> DataFrame:
    """(column, type, n, first_seq, first_value): columns with cells that don't fit their type, how many, and the first."""
    arms = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"`{c}`").alias("value"), read_as(F.col(f"`{c}`"), t).isNull().alias("lost"))
            for c, t in types.items() if t != "string"]
    if not arms:
        return df.select(F.lit("").alias("column"), F.lit("").alias("type"), F.lit(0).cast("long").alias("n"),
                         F.col(seq).cast("long").alias("first_seq"), F.lit("").alias("first_value")).limit(0)
    cells = df.select(F.col(seq).cast("long").alias("seq"), F.explode(F.array(*arms)).alias("cell")).select("seq", "cell.*")
    lost = cells.where(F.col("lost") & (F.trim("value") != ""))
    return lost.groupBy("column", "type").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.min_by("value", "seq").alias("first_value"))


def read_lookup_csv(spark: SparkSession, path: str, columns: dict[str, str], sep: str = ",") -> DataFrame:
    """Projected CSV lookup with per-column types, e.g. ``{"UPRN": "double",
    "PCON24CD": "string"}``: only the named columns are kept."""
    df = spark.read.option("header", "true").option("sep", sep).option("escape", '"').csv(path)
    return typed(df, columns)
