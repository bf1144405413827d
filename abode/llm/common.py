"""Helpers shared by the corpus operators: staging, carried rows, hash order."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from abode.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``; without one this raises.

    Tests and a laptop set one of their own (``SparkContext.setCheckpointDir``).
    """
    return checkpoint_root(spark)


#: With this setting the shuffle files of a query go when it has run, not when the driver happens to collect garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _releasing(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage of a slim frame in the shared checkpoint folder; shuffle files behind it go."""
    checkpoint_folder(df.sparkSession)
    with _releasing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a new frame, so that the setting holds


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def col(name: str) -> Column:
    """Column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for one task, after which freed memory goes back to the system.

    Python workers outlive their tasks; one that keeps what a large task freed
    takes it from the executor for as long as it lives.
    """
    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task


def map_texts(docs: DataFrame, fn: Callable[[pa.Array], Sequence[pa.Array]], fields: Sequence[T.StructField],
              text_col: str = "text") -> DataFrame:
    """Run ``fn`` on the text column of every Arrow batch.

    The result has the whole input row in the struct column ``row`` and one
    column for each field, so names of the input cannot clash with results.
    """
    at = docs.columns.index(text_col)
    carried = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"))
    names = ["row", *(f.name for f in fields)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            row = batch.column(0)
            yield pa.RecordBatch.from_arrays([row, *fn(pc.struct_field(row, [at]))], names=names)

    return carried.mapInArrow(released(run), T.StructType([carried.schema["row"], *fields]))


def unpack(mapped: DataFrame) -> DataFrame:
    """Input columns followed by result columns; a result replaces an input column of its name."""
    results = [c for c in mapped.columns if c != "row"]
    taken = {c.lower() for c in results}
    own = [c for c in mapped.schema["row"].dataType.names if c.lower() not in taken]
    return mapped.select(*[F.col("row").getField(c).alias(c) for c in own], *results)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null text has none."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [b"" if v is None else v for v in texts.cast(kind).to_pylist()]


def split_by_range(hashes: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each of ``ranges`` equal ranges of 64-bit hashes with the places of its members, in order."""
    of = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    for bucket, part in zip(range(ranges), np.split(order, np.searchsorted(of[order], np.arange(1, ranges)))):
        if len(part):
            yield bucket, part


def packed(values: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def by_range(rows: DataFrame, ranges: int) -> DataFrame:
    """Rows of one ``bucket`` side by side in one task."""
    return rows.repartition(ranges, "bucket").sortWithinPartitions("bucket")


def rows_by_bucket(batches: Batches) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of sorted batches, one bucket at a time; the first column is the bucket."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield tuple(column[k].as_py() for column in batch.columns)

    for bucket, group in groupby(rows(), key=lambda r: r[0]):
        yield bucket, list(group)


def source_key(name: str) -> Column:
    """Group key that is never null; the null group sorts after every text."""
    return F.when(col(name).isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), col(name).cast("string")))


def shuffle_hash(seed: int, *columns: Column) -> Column:
    """Seeded hash that gives rows a fixed pseudo-random order."""
    return F.xxhash64(F.lit(seed), *columns)


def hash_bucket(h: Column, buckets: int) -> Column:
    """Bucket of a 64-bit hash, growing with the hash, so that buckets follow hash order."""
    return F.least(F.floor((h.cast("double") / F.lit(2.0**64) + 0.5) * buckets), F.lit(buckets - 1)).cast("int")


def running_sum(rows: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` within ``by`` in (bucket, order) order.

    No group is gathered in one task: sums by bucket are small and give every
    bucket its start; the window then runs inside (by, bucket) only. ``rows``
    is read twice and should be staged.
    """
    start = f"{out}_start"
    sums = rows.groupBy(*by, bucket).agg(F.sum(value).alias(start))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0)))
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(starts, [*by, bucket])
            .withColumn(out, F.col(start) + F.sum(value).over(inside))
            .drop(start))
