"""Landed JSON arrays, first-seen dedupe and compaction on the 21 hourly snapshots."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newslake.operators.dedupe import dedupe_articles, dedupe_first, dedupe_snapshot_items, key_chain
from newslake.sources.json_files import read_json_arrays, with_seq

KEPT_PER_FILE = [10, 3, 1, 8, 2, 8, 8, 5, 7, 3, 3, 7, 4, 4, 5, 0, 2, 1, 2, 0, 0]


@pytest.fixture(scope="module")
def snapshots(spark, snapshot_files):
    rows, rejects = read_json_arrays(spark, snapshot_files)
    return with_seq(rows), rejects


def test_read_all_rows_in_order(snapshots):
    rows, rejects = snapshots
    assert rows.count() == 210 and rejects.count() == 0
    per_file = Counter(r["file"] for r in rows.select("file").collect())
    assert set(per_file.values()) == {10}


def test_dedupe_key_chain_first_seen(snapshots):
    rows, _ = snapshots
    kept = dedupe_snapshot_items(rows, order=["seq"])
    assert kept.count() == 83
    files = sorted({r["file"] for r in rows.select("file").collect()})
    per_file = Counter(r["file"] for r in kept.select("file").collect())
    assert [per_file.get(f, 0) for f in files] == KEPT_PER_FILE
    days = Counter(r["d"] for r in kept.select(F.substring("published_at", 1, 10).alias("d")).collect())
    assert days == {"2025-06-20": 4, "2025-06-21": 79}


def test_dedupe_whole_object(snapshots):
    rows, _ = snapshots
    obj_cols = ["source", "url", "title", "published_at", "content", "platforms_mentioned"]
    kept = dedupe_articles(rows.select(*obj_cols, "seq"), order=["seq"], object_cols=obj_cols)
    assert kept.count() == 146


def test_dedupe_idempotent(snapshots):
    rows, _ = snapshots
    once = dedupe_snapshot_items(rows, order=["seq"])
    twice = dedupe_snapshot_items(once, order=["seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_null_key_kept_empty_key_deduped(spark):
    df = spark.createDataFrame(
        [(1, None, "", ""), (2, None, "", ""), (3, None, None, None), (4, None, None, None)],
        "pos int, id string, url string, title string",
    )
    kept = dedupe_snapshot_items(df, order=["pos"])
    assert sorted(r["pos"] for r in kept.collect()) == [1, 3, 4]


def test_hot_key_is_collapsed_map_side(spark):
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"))
    out = dedupe_first(df, F.col("k"), ["pos"])
    assert [r["pos"] for r in out.collect()] == [0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "min_by" in plan.lower() or "sortaggregate" in plan.lower() or "objecthashaggregate" in plan.lower()


def test_bad_inputs(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "lone.json").write_text('{"url": "b"}')
    (tmp_path / "broken.json").write_text('[{"url": "a"}')
    (tmp_path / "ok.json").write_text(json.dumps([{"url": "u1", "title": "t"}, {"url": "u2"}]))
    rows, rejects = read_json_arrays(spark, str(tmp_path / "*.json"))
    assert sorted(r["url"] for r in rows.collect()) == ["u1", "u2"]
    reasons = {r["file"]: r["reason"] for r in rejects.collect()}
    assert reasons == {"lone.json": "not a list", "broken.json": "malformed JSON"}
    missing_rows, missing_rejects = read_json_arrays(spark, str(tmp_path / "nothing_here_*.json"))
    assert missing_rows.count() == 0 and missing_rejects.count() == 0


def test_key_chain(spark):
    df = spark.createDataFrame([("", None, "t"), (None, "", ""), ("i", "u", "t")], "id string, url string, title string")
    assert [r[0] for r in df.select(key_chain("id", "url", "title")).collect()] == ["t", "", "i"]
