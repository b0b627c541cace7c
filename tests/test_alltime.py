"""The stored all-time table: what a merge rewrites, what it reads, and what it survives."""

import os

import pytest
from pyspark.sql import functions as F

from newslake.operators.alltime import AllTimeTable
from test_plans import plan_of

ROW = "id string, published_at string, title string, seq long"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


@pytest.fixture
def stored(spark, tmp_path):
    df = frame(spark, [])
    return AllTimeTable(spark, str(tmp_path / "all"), df.schema, key="id", time="published_at", ties=["seq"], buckets=64)


def test_two_batches(spark, stored):
    assert stored.read().count() == 0 and stored.newest(5).count() == 0 and stored.manifest() == []
    first = [(f"a{i}", f"2025-0{1 + i % 4}-{10 + i % 15}T08:00:00", f"t{i}", i) for i in range(200)]
    first += [("a1", "2025-02-01T00:00:00", "repeat", 900), (None, "2025-01-05T00:00:00", "no id", 901), ("u", None, "undated", 902)]
    assert stored.merge(frame(spark, first).repartition(3), first=["seq"]) == {
        "existing": 0, "incoming": 203, "kept": 202, "dropped": 1}
    before = files(stored.path + "/data")
    second = [("a5", "2025-04-20T00:00:00", "seen", 1), ("n1", "2025-04-30T00:00:00", "new", 2), ("n1", "2025-01-01T00:00:00", "later", 3),
              ("n2", "2025-05-01T00:00:00", "newest", 4), (None, "2025-04-01T00:00:00", "no id", 5)]
    assert stored.merge(frame(spark, second), first=["seq"]) == {"existing": 202, "incoming": 5, "kept": 3, "dropped": 2}
    after = files(stored.path + "/data")
    assert all(after[f] == t for f, t in before.items())  # nothing is written over
    new = {f.split("period=")[1].split("/")[0] for f in set(after) - set(before)}
    assert new == {"2025-04", "2025-05"}  # January to March keep their files
    assert {e["period"]: e["version"] for e in stored.manifest()} == {
        "undated": 1, "2025-01": 1, "2025-02": 1, "2025-03": 1, "2025-04": 2, "2025-05": 2}
    got = {(r["id"], r["title"]) for r in stored.read().collect()}
    assert stored.read().count() == 205 and len(got) == 204 and ("a1", "t1") in got and ("n1", "new") in got and ("a5", "t5") in got and ("u", "undated") in got
    newest = stored.newest(300).collect()
    times = [r["published_at"] for r in newest]
    assert times[:-1] == sorted(times[:-1], reverse=True) and times[-1] is None and len(times) == 205
    assert [r["id"] for r in stored.newest(2).collect()] == ["n2", "n1"]
    assert stored.newest(2).inputFiles() and all("period=2025-0" in f and "v=2" in f for f in stored.newest(2).inputFiles())


def test_files_are_sorted_newest_first(spark, stored):
    rows = [(f"k{i}", f"2025-03-{1 + (i * 7) % 28:02d}T00:00:00", "t", i) for i in range(500)]
    stored.merge(frame(spark, rows).repartition(4), first=["seq"])
    for f in files(stored.path + "/data"):
        times = [r["published_at"] for r in spark.read.parquet(f).collect()]
        assert times == sorted(times, reverse=True)


def test_seen_keys_prune_the_key_table(spark, stored, capsys):
    stored.merge(frame(spark, [(f"k{i}", "2025-03-01T00:00:00", "t", i) for i in range(500)]), first=["seq"])
    keys = spark.createDataFrame([("k3",), ("k400",), ("new",)], "id string")
    seen = stored.seen(keys)
    assert sorted(r["id"] for r in seen.collect()) == ["k3", "k400"]
    out = plan_of(seen, capsys)
    assert "dynamicpruningexpression(bucket" in out


def test_a_merge_that_died_leaves_no_trace(spark, stored):
    stored.merge(frame(spark, [("a", "2025-03-01T00:00:00", "t", 1)]), first=["seq"])
    # What a second merge had written before its manifest: data and keys of version 2.
    spark.read.parquet(stored.path + "/data/v=1").write.parquet(stored.path + "/data/v=2")
    spark.createDataFrame([("b", 1)], "id string, bucket int").write.partitionBy("bucket").parquet(stored.path + "/keys/v=2")
    os.makedirs(stored.path + "/manifest/v=2")
    assert stored.version() == 1 and stored.read().count() == 1
    assert stored.merge(frame(spark, [("b", "2025-04-01T00:00:00", "t", 1)]), first=["seq"])["kept"] == 1
    assert sorted(r["id"] for r in stored.read().collect()) == ["a", "b"]


def test_hot_period_and_empty_batch(spark, stored):
    rows = spark.range(3000).select(
        F.concat(F.lit("k"), "id").alias("id"), F.lit("2025-03-01T00:00:00").alias("published_at"), F.lit("t").alias("title"),
        F.col("id").alias("seq"))
    stored.merge(rows, first=["seq"])
    assert stored.merge(rows, first=["seq"]) == {"existing": 3000, "incoming": 3000, "kept": 0, "dropped": 3000}
    assert stored.merge(rows.limit(0), first=["seq"])["incoming"] == 0 and stored.version() == 1
