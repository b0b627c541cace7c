"""Streams out of order: kept, late and repeated rows are all rows; state and counts survive a restart."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from newslake.streaming.ingest import order_files, snapshot_stream, stream_paths
from newslake.streaming.late import LateRows, daily_counts_with_late, dedupe_with_late

ROW = "event_id long, ts timestamp, kind string, slice int"


def at(day, hour=0):
    return datetime(2025, 6, day, hour)


def landed(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, ROW).repartition(1).write.mode(mode).partitionBy("slice").parquet(path)
    order_files(spark, path, "slice")
    return snapshot_stream(spark, path, spark.createDataFrame([], ROW).schema, max_files_per_trigger=1)


ROWS = [
    (1, at(1), "a", 0), (2, at(2), "a", 0), (3, None, "a", 0), (1, at(1), "a", 0),
    (4, at(4), "b", 1), (2, at(2), "a", 1),  # day 2 is not behind the mark of slice 0 (day 1): a repeat
    (5, at(2, 23), "a", 2), (6, at(3, 1), "b", 2), (4, at(4), "b", 2),  # mark: day 3; 5 is late
    (7, at(9), "a", 3), (3, None, "a", 3),  # without a time: kept
    (4, at(4), "b", 4), (8, at(8), "b", 4), (7, at(9), "a", 4),  # mark: day 8
]


def test_kept_late_and_repeated_are_all_rows(spark, tmp_path):
    s = landed(spark, str(tmp_path / "in"), ROWS)
    sink, ckpt = stream_paths(spark, "test-late")
    run = dedupe_with_late(s, ["event_id"], "ts", ["ts", "event_id"], delay=timedelta(days=1), sink=sink, checkpoint=ckpt)
    kept = sorted((r["batch_id"], r["event_id"]) for r in run.on_time(spark, s.schema).collect())
    late = sorted((r["batch_id"], r["event_id"]) for r in run.late(spark, s.schema).collect())
    progress = {r["batch_id"]: (r["rows"], r["late"], r["repeats"]) for r in run.progress(spark).collect()}
    assert kept == [(0, 1), (0, 2), (0, 3), (1, 4), (2, 6), (3, 3), (3, 7), (4, 8)]
    assert late == [(2, 5), (4, 4)]
    assert progress == {0: (4, 0, 1), 1: (2, 0, 1), 2: (3, 1, 1), 3: (2, 0, 0), 4: (3, 1, 1)}
    assert len(kept) + len(late) + sum(p[2] for p in progress.values()) == len(ROWS)
    # State: only batches that reach past the mark are read.
    assert run.watermark(4) == at(8) and run.open_batches(4) == [3]


def test_a_restarted_run_goes_on(spark, tmp_path):
    path = str(tmp_path / "in")
    sink, ckpt = stream_paths(spark, "test-late")
    landed(spark, path, [r for r in ROWS if r[3] < 3])
    for part in (None, [r for r in ROWS if r[3] >= 3]):
        s = landed(spark, path, part) if part else snapshot_stream(
            spark, path, spark.createDataFrame([], ROW).schema, max_files_per_trigger=1)
        run = dedupe_with_late(s, ["event_id"], "ts", ["ts", "event_id"], delay=timedelta(days=1), sink=sink, checkpoint=ckpt)
    kept = sorted(r["event_id"] for r in run.on_time(spark, s.schema).collect())
    assert kept == [1, 2, 3, 3, 4, 6, 7, 8] and run.late(spark, s.schema).count() == 2
    fresh = LateRows(sink, "ts", timedelta(days=1))
    fresh.batches = {r["batch_id"]: tuple(r) for r in run.progress(spark).collect()}
    assert fresh.watermark(5) == at(8)


def test_daily_counts_lose_nothing(spark, tmp_path):
    s = landed(spark, str(tmp_path / "in"), ROWS)
    sink, ckpt = stream_paths(spark, "test-daily")
    out = daily_counts_with_late(s, "ts", F.col("kind") == "b", delay=timedelta(days=1), sink=sink, checkpoint=ckpt)
    got = {r["day"]: (r["n_events"], r["n_hits"], r["n_late"]) for r in out.collect()}
    assert got == {None: (2, 0, 0), "2025-06-01": (2, 0, 0), "2025-06-02": (2, 0, 1), "2025-06-03": (1, 1, 0),
                   "2025-06-04": (2, 2, 1), "2025-06-08": (1, 1, 0), "2025-06-09": (2, 0, 0)}
    assert sum(n + late for n, _, late in got.values()) == len(ROWS)
