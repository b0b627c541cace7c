"""Incremental ingest with Structured Streaming (STR1-STR4).

* ``snapshot_stream``: a file-source stream over landed snapshots (Parquet or JSON).
* ``run_first_seen``: the accumulated first-seen table. Each micro-batch is deduped
  deterministically (``min_by`` on the order columns), anti-joined against the keys
  of *earlier* batches and written to its own ``batch_id=N`` partition with dynamic
  overwrite, so a retried batch replaces its own output (idempotent, exactly-once).
* ``dedupe_within_watermark``: bounded-state dedupe of re-sent items by snapshot time.
* ``run_daily_counts``: tumbling one-day windows with a watermark; update mode writes
  each batch's changed windows with the batch id, and the reader keeps the latest.

Stream checkpoints and sinks live under the session's checkpoint folder.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.dedupe import dedupe_first
from newslake.session import BROADCAST_BYTES, scratch_path


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive plans for the jobs of a ``foreachBatch`` handler: streaming turns them off in its session.

    The handler's own jobs are ordinary batch jobs, whose small shuffles are worth coalescing.
    """
    name = "spark.sql.adaptive.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def snapshot_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """STR1: stream the files under ``path`` (optionally filtered by a name glob)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def order_files(spark: SparkSession, path: str, partition: str) -> None:
    """Give the files under ``path/<partition>=<number>`` modification times in the order of the number.

    A file stream takes files by modification time; files that one job wrote have it in no order.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{partition}=")]
    folders.sort(key=lambda f: int(f.getName().split("=")[1]))
    start = int(time.time() * 1000) - 60_000 * (len(folders) + 1)
    for i, folder in enumerate(folders):
        for s in fs.listStatus(folder):
            fs.setTimes(s.getPath(), start + 60_000 * i, -1)


def dedupe_within_watermark(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """STR2: drop re-sent items whose key was seen within ``delay`` of snapshot time.

    The watermark must be on the *snapshot* time, not the article's own date: a
    re-sent item may carry a changed ``published_at``.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def _first_seen_batch(sink: str, key: str, order: list[str]):
    def handle(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write(batch, batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The micro-batch (bounded by maxFilesPerTrigger) feeds two branches: read it once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = dedupe_first(batch, F.col(key), order, null_key="keep")
            if batch_id > 0:
                # Batch 0 created the sink (possibly empty); read it with an explicit schema. History is
                # filtered by the batch's keys, map-side while their measured bytes allow.
                schema = T.StructType(fresh.schema.fields + [T.StructField("batch_id", T.LongType())])
                seen = spark.read.schema(schema).parquet(sink).filter(F.col("batch_id") < F.lit(batch_id)).select(key)
                keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
                size = keys.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()[0] or 0
                seen = seen.join(F.broadcast(keys) if 4 * size <= BROADCAST_BYTES else keys, key, "left_semi")
                fresh = fresh.join(seen, key, "left_anti")
            (
                fresh.withColumn("batch_id", F.lit(batch_id).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id")
                .parquet(sink)
            )
        finally:
            batch.unpersist()

    return handle


def run_first_seen(
    stream: DataFrame, *, key: str, order: list[str], sink: str, checkpoint: str, progress: list | None = None,
) -> DataFrame:
    """STR3: run ``stream`` to completion (``availableNow``) into a first-seen table.

    Incoming rows are counted with ``observe`` (SNK9); pass a list as ``progress`` to
    receive each batch's observed metrics.
    """
    observed = stream.observe("ingest", F.count(F.lit(1)).alias("rows_in"))
    q = (
        observed.writeStream.foreachBatch(_first_seen_batch(sink, key, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if progress is not None:
        progress.extend(
            p.observedMetrics["ingest"].asDict() for p in q.recentProgress if p.observedMetrics.get("ingest") is not None
        )
    return stream.sparkSession.read.parquet(sink).drop("batch_id")


def daily_counts(stream: DataFrame, *, event_time: str, hit: Column, delay: str = "1 day") -> DataFrame:
    """STR4: articles and hits per tumbling day window, watermarked."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.count_if(hit).alias("n_hits"))
    )


def run_daily_counts(counts: DataFrame, *, sink: str, checkpoint: str) -> DataFrame:
    """Run the windowed counts in update mode; return the latest value of every window."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(sink)
        )

    q = (
        counts.writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = counts.sparkSession.read.parquet(sink)
    latest = out.groupBy("w").agg(F.max_by(F.struct("n_events", "n_hits"), F.col("batch_id")).alias("v"))
    return latest.select(
        F.date_format(F.col("w.start"), "yyyy-MM-dd").alias("day"),
        F.col("v.n_events").alias("n_events"),
        F.col("v.n_hits").alias("n_hits"),
    )


def stream_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh ``(sink, checkpoint)`` locations for one streaming run."""
    base = scratch_path(spark, name)
    return f"{base}/sink", f"{base}/checkpoint"


__all__ = [
    "adaptive", "daily_counts", "dedupe_within_watermark", "order_files", "run_daily_counts", "run_first_seen",
    "snapshot_stream", "stream_paths",
]
