"""Streaming queries: the events table read as a file stream out of order, run with availableNow."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.plans.registry import query
from newslake.session import pin_session, scratch_path
from newslake.streaming.ingest import order_files, run_first_seen, snapshot_stream, stream_paths
from newslake.streaming.late import daily_counts_with_late, dedupe_with_late

SLICES, PER_BATCH = 10, 2
DISPLACED = 3  # slices that every tenth event comes too late


def _landed_events(spark: SparkSession, sf_dir: str, resend: bool = False) -> DataFrame:
    """The events landed in ``SLICES`` time slices, two a micro-batch, in one scan.

    Every tenth event stands ``DISPLACED`` slices behind its time; events without a time are in the last slice.
    With ``resend`` every seventh event comes once more, a slice later.
    """
    pin_session(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    micros = F.unix_micros("ts")
    lo, hi, n = events.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    step = ((hi or 0) - (lo or 0)) // SLICES + 1
    last = F.lit(SLICES - 1)
    place = F.floor((micros - F.lit(lo or 0)) / F.lit(step)).cast("int") + F.when(F.col("event_id") % 10 == 3, DISPLACED).otherwise(0)
    place = F.least(last, F.coalesce(place, last))
    copies = F.array(place, F.when(F.col("event_id") % 7 == 0, F.least(last, place + 1))) if resend else F.array(place)
    rows = events.withColumn("slice", F.explode(F.array_compact(copies)))
    landed = scratch_path(spark, "landed-events")
    parts = 1 + n // 2_000_000  # files a slice
    rows.repartition(SLICES * parts, "slice", F.pmod(F.xxhash64("event_id"), F.lit(parts))).write.partitionBy("slice").parquet(landed)
    order_files(spark, landed, "slice")
    return snapshot_stream(spark, landed, rows.schema, max_files_per_trigger=PER_BATCH * parts)


ARRIVAL_SQL = f"""e AS (
  SELECT *, epoch_us(ts) AS us, min(epoch_us(ts)) OVER () AS lo, max(epoch_us(ts)) OVER () AS hi FROM events
), p AS (
  SELECT *, least({SLICES - 1}, coalesce(CAST(floor((us - lo) / ((hi - lo) // {SLICES} + 1)) AS INTEGER)
    + CASE WHEN event_id % 10 = 3 THEN {DISPLACED} ELSE 0 END, {SLICES - 1})) AS slice FROM e
), """
FROM_ALL = f"a AS (SELECT *, (dense_rank() OVER (ORDER BY slice) - 1) // {PER_BATCH} AS batch FROM p)"
WITH_COPIES = f"""c AS (
  SELECT * FROM p UNION ALL SELECT * REPLACE (least({SLICES - 1}, slice + 1) AS slice) FROM p WHERE event_id % 7 = 0
), a AS (SELECT *, (dense_rank() OVER (ORDER BY slice) - 1) // {PER_BATCH} AS batch FROM c)"""
MARKED = """, n AS (SELECT batch, max(us) AS newest FROM a GROUP BY batch),
w AS (
  SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000000 AS mark FROM n
), m AS (SELECT a.*, coalesce(us < mark, false) AS late FROM a JOIN w USING (batch))"""


STREAM_FIRST_SQL = f"""WITH {ARRIVAL_SQL}{FROM_ALL}
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY CAST(user_id AS VARCHAR) || ':' || event_type ORDER BY batch, ts NULLS FIRST, event_id) AS rn
  FROM a) WHERE rn = 1 OR user_id IS NULL OR event_type IS NULL
"""


@query("stream_first_seen", STREAM_FIRST_SQL)
def q_stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1, STR3: of every key the row that arrives first (within a batch the oldest)."""
    s = _landed_events(spark, sf_dir).withColumn(
        "key", F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type"))
    )
    sink, ckpt = stream_paths(spark, "stream-first-seen")
    out = run_first_seen(s, key="key", order=["ts", "event_id"], sink=sink, checkpoint=ckpt)
    return out.select("event_id", "user_id", "event_type")


STREAM_WM_SQL = f"""WITH {ARRIVAL_SQL}{WITH_COPIES}{MARKED}, k AS (
  SELECT *, CASE WHEN late THEN 'late' WHEN us IS NULL THEN 'kept'
    WHEN row_number() OVER (PARTITION BY event_id, late ORDER BY batch) = 1 THEN 'kept' ELSE 'repeat' END AS outcome FROM m
)
SELECT batch AS batch_id, outcome, count(*) AS n, CAST(sum(CASE WHEN outcome <> 'repeat' THEN event_id END) AS BIGINT) AS ids
FROM k GROUP BY batch, outcome
"""


@query("stream_watermark_dedupe", STREAM_WM_SQL)
def q_stream_watermark_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2: re-sent events over out-of-order files: per batch what is kept, late and repeated; together all rows."""
    s = _landed_events(spark, sf_dir, resend=True)
    sink, ckpt = stream_paths(spark, "stream-watermark")
    run = dedupe_with_late(s, ["event_id"], "ts", ["ts", "event_id"], delay=timedelta(days=1), sink=sink, checkpoint=ckpt)
    written = run.on_time(spark, s.schema).select("batch_id", "event_id", F.lit("kept").alias("outcome")).unionByName(
        run.late(spark, s.schema).select("batch_id", "event_id", F.lit("late").alias("outcome")))
    counted = written.groupBy("batch_id", "outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    repeats = run.progress(spark).where("repeats > 0").select(
        "batch_id", F.lit("repeat").alias("outcome"), F.col("repeats").alias("n"), F.lit(None).cast("long").alias("ids"))
    return counted.unionByName(repeats)


STREAM_DAILY_SQL = f"""WITH {ARRIVAL_SQL}{FROM_ALL}{MARKED}
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (WHERE NOT late) AS n_events,
       count(*) FILTER (WHERE NOT late AND event_type = 'error') AS n_hits, count(*) FILTER (WHERE late) AS n_late
FROM m GROUP BY 1
"""


@query("stream_daily_counts", STREAM_DAILY_SQL)
def q_stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: rows and hits a day, rows behind the watermark counted apart, none lost."""
    sink, ckpt = stream_paths(spark, "stream-daily")
    return daily_counts_with_late(
        _landed_events(spark, sf_dir), "ts", F.col("event_type") == F.lit("error"), delay=timedelta(days=1), sink=sink, checkpoint=ckpt)
