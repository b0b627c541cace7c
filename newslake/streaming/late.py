"""Streams with disorder: a watermark of the run's own, expiring state and a table of the rows behind it (STR2, STR4).

Spark's stateful operators drop rows behind the watermark and only count them in a metric. Here every micro-batch
is split before anything is done with it: rows older than the newest event time of *earlier* batches less the
delay are written to ``late/batch_id=N``, the others are handed on. Rows without an event time are never late.

Per batch one row of progress is written (rows, on time, late, repeats, newest event time), last of all, so

* a restarted run knows the watermark without reading data,
* a retried batch overwrites its own partitions and counts nothing twice,
* state is what the kept rows of batches not yet behind the watermark hold: older partitions are not opened.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.dedupe import dedupe_first
from newslake.streaming.ingest import adaptive

PROGRESS = "batch_id long, rows long, late long, repeats long, newest timestamp"

# (rows, batch, watermark) -> the rows to write, and the number of repeats among n rows, asked after the write.
OnTime = Callable[[DataFrame, int, datetime | None], tuple[DataFrame, Callable[[int], int]]]

_PROGRESS_TYPES = [tuple(f.split()) for f in PROGRESS.split(", ")]


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


class LateRows:
    """Runs a stream batch by batch under one folder: ``on_time``, ``late`` and ``progress`` tables."""

    def __init__(self, sink: str, event_time: str, delay: timedelta):
        self.sink, self.event_time, self.delay = sink.rstrip("/"), event_time, delay
        self.batches: dict[int, tuple] = {}  # batch -> its row of progress: bounded by the number of batches

    def watermark(self, batch_id: int) -> datetime | None:
        """Newest event time of the batches before, less the delay."""
        newest = [p[4] for b, p in self.batches.items() if b < batch_id and p[4] is not None]
        return max(newest) - self.delay if newest else None

    def open_batches(self, batch_id: int) -> list[int]:
        """Earlier batches with rows that are not behind the watermark."""
        mark = self.watermark(batch_id)
        return [b for b, p in self.batches.items() if b < batch_id and p[4] is not None and (mark is None or p[4] >= mark)]

    def _batch(self, on_time: OnTime):
        def handle(batch: DataFrame, batch_id: int) -> None:
            with adaptive(batch.sparkSession):
                split(batch, batch_id)

        def split(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                mark = self.watermark(batch_id)
                behind = F.coalesce(F.col(self.event_time) < F.lit(mark), F.lit(False)) if mark else F.lit(False)
                n, late, newest = batch.agg(F.count(F.lit(1)), F.count_if(behind), F.max(self.event_time)).first()
                if late:
                    _write(batch.where(behind), f"{self.sink}/late", batch_id)
                out, repeats = on_time(batch.where(~behind) if late else batch, batch_id, mark)
                _write(out, f"{self.sink}/on_time", batch_id)
                row = (batch_id, n, late, repeats(n - late), newest)
                typed = [F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, _PROGRESS_TYPES, strict=True)]
                _write(spark.range(0, 1, 1, 1).select(*typed), f"{self.sink}/progress", batch_id)
                self.batches[batch_id] = row
            finally:
                batch.unpersist()

        return handle

    def run(self, stream: DataFrame, checkpoint: str, on_time: OnTime) -> None:
        """Run the stream to its end, with ``on_time`` for the rows of every batch that are not late."""
        self.batches = {r["batch_id"]: tuple(r) for r in self.progress(stream.sparkSession).collect()}
        q = (stream.writeStream.foreachBatch(self._batch(on_time)).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def _table(self, spark, name: str, schema) -> DataFrame:
        schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        fields = [f for f in schema.fields if f.name != "batch_id"] + [T.StructField("batch_id", T.LongType())]
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.sink}/{name}")
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return spark.createDataFrame([], T.StructType(fields))
        return spark.read.schema(T.StructType(fields)).parquet(f"{self.sink}/{name}")

    def progress(self, spark) -> DataFrame:
        return self._table(spark, "progress", PROGRESS).select("batch_id", "rows", "late", "repeats", "newest")

    def late(self, spark, schema) -> DataFrame:
        """The rows behind the watermark, with their ``batch_id``."""
        return self._table(spark, "late", schema)

    def on_time(self, spark, schema) -> DataFrame:
        return self._table(spark, "on_time", schema)


def dedupe_with_late(
    stream: DataFrame, keys: list[str], event_time: str, order: list[str], *, delay: timedelta, sink: str, checkpoint: str,
) -> LateRows:
    """STR2: the first row of every key within the watermark; a key is free again once its row is behind it.

    Kept rows are in ``on_time``, rows behind the watermark in ``late``, repeats are counted in ``progress``. Rows
    without an event time are all kept.
    """
    run = LateRows(sink, event_time, delay)

    def on_time(rows: DataFrame, batch_id: int, mark: datetime | None):
        key = F.when(F.col(event_time).isNotNull(), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
        fresh = dedupe_first(rows.withColumn("__key", key), F.col("__key"), order, null_key="keep")
        state = run.open_batches(batch_id)
        if state:
            held = run.on_time(rows.sparkSession, T.StructType([*rows.schema.fields, T.StructField("__key", T.StringType())]))
            held = held.where(F.col("batch_id").isin(state) & (F.col(event_time) >= F.lit(mark))).select("__key")
            fresh = fresh.join(held, "__key", "left_anti").select(*fresh.columns)
        kept = Observation()  # counted by the write
        return fresh.observe(kept, F.count(F.lit(1)).alias("n")), lambda n: n - kept.get["n"]

    run.run(stream, checkpoint, on_time)
    return run


def daily_counts_with_late(
    stream: DataFrame, event_time: str, hit, *, delay: timedelta, sink: str, checkpoint: str,
) -> DataFrame:
    """STR4: per day the rows in time, hits among them, and the rows that came behind the watermark.

    Every batch writes its own partial counts, so there is no state to keep; a day is the sum over batches. Rows
    without an event time stand under a NULL day.
    """
    spark = stream.sparkSession
    run = LateRows(sink, event_time, delay)
    day = F.date_format(event_time, "yyyy-MM-dd").alias("day")

    def on_time(rows: DataFrame, batch_id: int, mark: datetime | None):
        return rows.groupBy(day).agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.coalesce(hit, F.lit(False))).alias("n_hits")), lambda n: 0

    run.run(stream, checkpoint, on_time)
    counted = run.on_time(spark, "day string, n_events long, n_hits long").select("day", "n_events", "n_hits", F.lit(0).alias("n_late"))
    late = run.late(spark, stream.schema).groupBy(day).agg(F.count(F.lit(1)).alias("n_late"))
    none = F.lit(0).cast("long")
    rows = counted.unionByName(late.select("day", none.alias("n_events"), none.alias("n_hits"), "n_late"))
    return rows.groupBy("day").agg(*[F.sum(c).alias(c) for c in ("n_events", "n_hits", "n_late")])


__all__ = ["LateRows", "daily_counts_with_late", "dedupe_with_late"]
