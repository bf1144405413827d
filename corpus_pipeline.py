"""Training corpus pipeline: five stages over ``documents``, each written and read again.

1. quality rules: documents that the rules or the trees reject go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. benchmark decontamination: documents with a benchmark passage go;
4. source mix: documents are dropped or repeated until sources meet their weights;
5. sharding: every row gets its shard and slot.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from abode.llm import decontamination, mixing, ngram_join, quality, sharding
from abode.llm.common import checkpoint_folder, table
from abode.session import delete_path

WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, mixing.mix_sources(docs, WEIGHTS, SHARE, REPEATS))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(docs, SHARDS)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mix", mixing_stage),
    ("sharding", sharding_stage),
]

#: The trees of the first stage have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``: id, source, size, checksum, shard and slot of every row of the mix.

    What a stage returns is written as Parquet to the shared checkpoint folder and
    reread, so a lost executor costs no earlier stage; only the last folder stays.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    for number in range(len(STAGES) - 1):
        delete_path(spark, f"{folder}/{number}")
    return docs
