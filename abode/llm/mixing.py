"""Mixing sources to target weights by weighted fair queueing.

Every shuffled document gets a virtual finish time: the tokens its source has
sent up to and including it, divided by the weight of the source. Copies of a
second pass carry on where the first ended. Sorting all copies by finish time
serves the sources in proportion to their weights; the sequence is cut where
the token budget is spent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abode.llm.common import col, hash_bucket, partitions, running_sum, shuffle_hash, source_key, stage

BUCKETS_PER_PARTITION = 8
#: Decisions that a broadcast may hold, of 24 bytes each.
BROADCAST_ROWS = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """Weight and target of each source, one row per source.

    ``sizes`` has ``src`` and ``src_size``. Sources in code point order take the
    weights in turn. Targets fill ``share`` of all tokens in proportion to
    the weights; a source stops at ``repeats`` times its size, and what it
    leaves goes to the others by weight. With sources in the order of limit by
    weight, the first whose limit lies above the level of the rest ends the
    capped ones.
    """
    nth = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights)
    weighed = (sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
               .withColumn("limit", (F.col("src_size") * repeats).cast("double"))
               .withColumn("fill", F.col("limit") / F.col("weight")))
    by_fill = Window.orderBy("fill", "src")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (weighed
              .withColumn("budget", F.lit(float(share)) * F.sum("src_size").over(every))
              .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                          / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    final = F.min(F.when(F.col("fill") >= F.col("level"), F.struct("fill", "src", "level"))).over(every)
    return (levels.withColumn("final", final.getField("level"))
            .withColumn("target", F.least(F.col("limit"), F.col("weight") * F.coalesce(F.col("final"), F.lit(float("inf")))))
            .select("src", "src_size", "weight", "target", "budget"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 8,
                id_col: str = "doc_id", text_col: str = "text", by: str = "source") -> DataFrame:
    """How often the mix takes each document.

    Returns one row per row of ``docs``: the id, the source, ``size`` (words of
    the text), ``text_hash``, ``source_size``, ``target`` of its source, the first
    ``finish`` time, ``copies`` (0 to ``repeats``) and ``taken`` (words).

    Null or empty text: size 0, taken 0. Null source: a source of its own, last
    in order. Repeated rows: each counts. No words at all: targets 0. Empty
    table: no rows. Other columns of the input are ignored.

    Memory: only ids, sources, sizes and hashes move. The windows over sources
    hold one row per source. The cut is one row.
    """
    parts = BUCKETS_PER_PARTITION * partitions(docs)
    slim = stage(docs.select(
        col(id_col).alias("id"), col(by).alias("origin"), source_key(by).alias("src"),
        F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(col(text_col)).alias("text_hash"))
        .withColumn("h", shuffle_hash(seed, F.col("id"), F.col("text_hash")))
        .withColumn("bucket", hash_bucket(F.col("h"), parts)))
    targets = source_targets(slim.groupBy("src").agg(F.sum("size").alias("src_size")), weights, share, repeats)
    served = running_sum(slim, ["src"], "bucket", [F.col("h"), F.col("id"), F.col("size"), F.col("text_hash")], "size", "sent")
    rows = stage(served.join(targets, "src").drop("bucket"))

    finish = lambda epoch: (F.col("sent") + F.col("src_size") * epoch) / F.col("weight")
    order = ["finish", "src", "h", "id"]
    queue = stage(rows.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(repeats)])))
                  .select(finish(F.col("epoch")).alias("finish"), "src", "h", "id", "size", "budget")
                  .repartitionByRange(partitions(docs), *order)
                  .withColumn("part", F.spark_partition_id()))
    per_part = queue.groupBy("part").agg(F.sum("size").alias("tokens"), F.max("budget").alias("budget"))
    in_order = Window.orderBy("part")
    ends = per_part.withColumn("end", F.sum("tokens").over(in_order)).withColumn("start", F.col("end") - F.col("tokens"))
    # The part in which the budget runs out holds the cut; parts before it are taken whole.
    last = ends.filter("start <= budget and end > budget").orderBy("part").select("part", "start").first()
    if last is None:
        within = F.lit(True)
        reached = lambda epoch: within
    else:
        inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        cut = (queue.filter(F.col("part") == last["part"])
               .withColumn("spent", F.lit(last["start"]) + F.sum("size").over(inside))
               .filter("spent > budget").orderBy(*order).select(*order).first())
        limit = F.struct(*[F.lit(cut[c]).cast(rows.schema[c].dataType if c != "finish" else "double").alias(c) for c in order])
        reached = lambda epoch: F.struct(finish(epoch).alias("finish"), "src", "h", "id") < limit
    copies = sum((F.when(reached(e), 1).otherwise(0) for e in range(1, repeats)), F.when(reached(0), 1).otherwise(0))
    return rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).select(
        F.col("id").alias(id_col), F.col("origin").alias(by), "size", "text_hash", F.col("src_size").alias("source_size"),
        "target", finish(0).alias("finish"), "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it.

    Rows that agree in id, source and text share their copies, so that repeated
    rows keep their total. Columns are those of ``docs``. Up to ``BROADCAST_ROWS``
    decisions are broadcast, and text stays in the scan; more meet the rows in a shuffle.
    """
    key = lambda text_hash: F.struct(col(id_col).alias("id"), col(by).alias("origin"), text_hash.alias("text_hash"))
    wanted = stage(decisions.withColumn("mix_key", F.xxhash64(key(F.col("text_hash"))))
                   .groupBy("mix_key").agg(F.sum("copies").alias("mix_copies"), F.count(F.lit(1)).alias("mix_rows"))
                   .filter("mix_copies > 0"))
    repeated = not wanted.filter("mix_rows > 1").isEmpty()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    joined = (docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"),
                          F.xxhash64(key(F.xxhash64(col(text_col)))).alias("mix_key"))
              .join(wanted, "mix_key"))
    each = joined.filter("mix_rows = 1").select("row", F.col("mix_copies").cast("int").alias("mix_each"))
    if repeated:
        nth = F.row_number().over(Window.partitionBy("mix_key").orderBy("mix_key"))
        share = F.expr("mix_copies div mix_rows") + F.when(nth <= F.col("mix_copies") % F.col("mix_rows"), 1).otherwise(0)
        each = each.union(joined.filter("mix_rows > 1").select("row", share.cast("int").alias("mix_each")).filter("mix_each > 0"))
    return each.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_each"))).alias("copy")).select("row.*")
