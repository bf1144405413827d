"""Proportional stratified interleaving of documents into shards.

Rows of each source get a seeded random order; the fractional rank
``(rank - 1/2) / rows of the source`` spreads every source evenly over (0, 1);
sorting all rows by it and cutting the sequence into equal parts gives shards
that all hold the mixture of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode.llm.common import col, hash_bucket, partitions, running_sum, shuffle_hash, source_key, stage

BUCKETS_PER_PARTITION = 8


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: int = 20, id_col: str = "doc_id",
                       text_col: str = "text", by: str = "source") -> DataFrame:
    """Assign every row of ``docs`` to one of ``shards`` shards.

    Returns the id, the source, ``size`` (UTF-8 bytes plus 1), ``text_crc32``,
    ``shard`` and ``slot`` (place in the shard, from 0 without gaps). Row counts
    of shards differ by at most one, and those of a source by at most one from
    its share, up to ties.

    Null text: size 1, checksum 0. Null source: a source of its own. Repeated
    rows: each gets its own slot. Empty table: no rows. Other columns of the
    input are ignored, whatever their names.

    Only ids, sources, sizes and hashes move; text stays in the scan.
    """
    buckets = BUCKETS_PER_PARTITION * partitions(docs)
    text = F.coalesce(col(text_col).cast("binary"), F.lit(b""))
    slim = stage(docs.select(
        col(id_col).alias("id"), col(by).alias("origin"), source_key(by).alias("src"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"))
        .withColumn("h", shuffle_hash(seed, F.col("id"), F.col("crc")))
        .withColumn("bucket", hash_bucket(F.col("h"), buckets))
        .withColumn("one", F.lit(1).cast("long")))
    order = [F.col("h"), F.col("id"), F.col("size"), F.col("crc")]
    ranked = running_sum(slim, ["src"], "bucket", order, "one", "rank")
    totals = slim.groupBy("src").agg(F.sum("one").alias("src_rows"))
    n = slim.count()
    placed = stage(ranked.join(totals, "src")
                   .withColumn("fraction", (F.col("rank") - 0.5) / F.col("src_rows"))
                   .withColumn("cut", F.floor(F.col("fraction") * buckets).cast("int"))
                   .drop("bucket", "rank", "src_rows"))
    sorted_rows = running_sum(placed, [], "cut", [F.col("fraction"), F.col("src"), *order], "one", "place")
    shard = F.expr(f"(place - 1) * {shards} div {max(n, 1)}")
    first = F.expr(f"(((place - 1) * {shards} div {max(n, 1)}) * {max(n, 1)} + {shards - 1}) div {shards}")
    return sorted_rows.select(
        F.col("id").alias(id_col), F.col("origin").alias(by), "size", F.col("crc").alias("text_crc32"),
        shard.cast("int").alias("shard"), (F.col("place") - 1 - first).cast("long").alias("slot"))
