"""Session construction and lineage cuts.

On a cluster the session is supplied by the platform; ``build_session`` only
fills settings that nobody made, so cluster configuration wins.
Lineage is cut by writing Parquet under ``spark.checkpoint.dir`` (a shared
folder the cluster names), never under a machine-local temporary folder.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults for local runs and tests; a cluster's own settings take precedence.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial aggregation must stay on: it is what makes hot keys cheap.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Above HotSpot's limit for compiled methods a projection is cut into small
    # methods instead of one that the optimising compiler gives up on.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rule tables compile to large generated methods; without this HotSpot
    # leaves methods over 8 KB interpreted (2-3x slower classifiers).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods -XX:ReservedCodeCacheSize=1g",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods -XX:ReservedCodeCacheSize=1g",
}


def _configured() -> set[str]:
    """Settings that the cluster or the submit command already made."""
    if SparkContext._jvm is not None:
        return {key for key, _ in SparkConf().getAll()}
    keys = set(re.findall(r"--conf[ =]['\"]?([\w.]+)=", os.environ.get("PYSPARK_SUBMIT_ARGS", "")))
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(home, "spark-defaults.conf")
    if os.path.exists(defaults):
        with open(defaults) as lines:
            keys |= {line.split()[0].split("=")[0] for line in lines if line.startswith("spark.")}
    return keys


def build_session(
    master: str | None = None,
    app_name: str = "abode",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """The active session as it is, or a new one.

    A new session takes the defaults above for settings that nobody made;
    ``shuffle_partitions`` and ``extra`` are the caller's own and always hold.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    made = _configured()
    conf = {key: value for key, value in _DEFAULTS.items() if key not in made}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (conf) or the context's checkpoint
    dir. Raises when neither is set: callers (tests) must set one first.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # e.g. Spark Connect: only the conf is visible
            root = None
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(tests set a scratch folder)"
        )
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """The configured checkpoint folder; ``fallback`` where none is set (tests, a laptop)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        spark.sparkContext.setCheckpointDir(fallback)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    The read-back plan has no lineage to recompute when an executor is lost,
    and later stages get Parquet pruning and pushdown on it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a write or an eager read."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has staged, through Spark's own file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``stage(df, name)`` for one run; what it staged is removed when the run ends well.

    After a failure the folders stay, so that a look at them is possible.
    """
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}")
        df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    yield stage
    for path in paths:
        delete_path(spark, path)
