"""Yearly claim worksheets landing in a folder -> measure rows, incrementally.

The source programme is re-run by hand each year on the new worksheet and
appends to cumulative masters. Here the landing folder is a Structured
Streaming file source: each new landed file is picked up once (the stream
checkpoint records which), cleaned and classified by the same operators as
the batch programme, and appended.

Exactly-once output: every micro-batch writes to its own ``batch=<id>``
folder with overwrite, so a batch replayed after a failure replaces its own
output instead of duplicating it. Gates run in lenient mode inside the
stream (offending rows go to ``offenders/`` and ``offenders_measures/`` and to no
other output) because halting a stream on one bad cell would block every later file. Files are expected
in the landing folder without the worksheet's banner line (the landing step
that converts the workbook drops it; ``read_landed`` handles it in batch).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from abode.operators import quality as Q
from abode.plans import measures as E2
from abode.rules import e2
from abode.session import staging
from abode.sources.landed import text_schema


def claims_schema():
    """All-text schema of a landed claims worksheet."""
    return text_schema(list(e2.CLAIM_COLUMNS))


def process_claims_batch(batch: DataFrame, batch_id: int, out_root: str, as_of: _dt.date,
                         geography: DataFrame, pcon_lookup: DataFrame) -> None:
    root = out_root.rstrip("/")

    def write(name: str, df: DataFrame) -> str:
        path = f"{root}/{name}/batch={batch_id}"
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(path)
        return path

    with staging(batch.sparkSession) as stage:
        classified, quarantined = E2.classify_claims(E2.land_claims(batch), as_of, stage)
        classified = stage(classified, f"claims-batch-{batch_id}")
        clean, offenders = Q.gate(classified, e2.GATED_COLUMNS, strict=False)
        measured = stage(E2.explode_claim_measures(clean, geography, pcon_lookup, stage=stage), f"measures-batch-{batch_id}")
        rows, bad_rows = E2.geography_gate(measured, strict=False)
        write("quarantine", quarantined)
        write("offenders", offenders)
        write("offenders_measures", bad_rows)
        write("measures", rows)


def start_claims_stream(
    spark: SparkSession,
    landing_dir: str,
    out_root: str,
    checkpoint_location: str,
    as_of: _dt.date,
    geography: DataFrame,
    pcon_lookup: DataFrame,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the landing-folder stream (``availableNow`` processes what is there, then stops)."""
    reader = (spark.readStream.schema(claims_schema()).option("header", "true")
              .option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    writer = raw.writeStream.foreachBatch(
        lambda df, bid: process_claims_batch(df, bid, out_root, as_of, geography, pcon_lookup)
    ).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
