"""Objects and tables over many files: the keyed digest, retention by partition name, packed parts, source-side limits."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from newslake.operators.alltime import AllTimeTable
from newslake.operators.compaction import packed_files, write_packed
from newslake.operators.digest import read_digest_object, write_digest_object
from newslake.operators.retention import drop_expired_partitions, partition_names
from test_plans import plan_of

DIGEST = "day string, status string, seq long, title string, url string, platforms_mentioned array<string>"


@pytest.fixture
def many_files(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4000",
             "spark.sql.files.openCostInBytes": "1000"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_digest_object_with_a_hot_day(spark, tmp_path, many_files):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        day = "2025-06-10" if i % 3 == 0 else f"2025-06-{1 + i % 28:02d}"
        rows.append((day, None, i // 2, f'"t" {i} ]}} {{ \n é', rng.choice([None, f"http://x/{i}"]), [f"p{i % 3}", 'q"]}']))
    rows += [("2025-06-29", "no company in the news", None, None, None, None), ("2025-05-31", "no company in the news", None, None, None, None)]
    digest = spark.createDataFrame(rows, DIGEST).repartition(5)
    path = write_digest_object(digest, str(tmp_path / "object"), ["seq"])
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert len(parts) > 2
    got = json.loads("".join(open(os.path.join(path, p), encoding="utf-8").read() for p in parts))
    assert list(got) == sorted({r[0] for r in rows})
    for day, entry in got.items():
        own = [r for r in rows if r[0] == day]
        if own[0][1]:
            assert entry == {"status": "no company in the news"}
        else:
            want = [(r[2], {"title": r[3], "url": r[4], "platforms_mentioned": r[5]}) for r in own]
            assert sorted(map(json.dumps, entry["articles"])) == sorted(json.dumps(a) for _, a in want)
            seq = {json.dumps(a): s for s, a in want}
            order = [seq[json.dumps(a)] for a in entry["articles"]]
            assert order == sorted(order)
    back = read_digest_object(spark, path)
    key = lambda r: (r["day"], r["status"], r["title"], r["url"], tuple(r["platforms_mentioned"] or ()))
    assert sorted(map(key, back.collect()), key=str) == sorted(map(key, digest.collect()), key=str)
    none = write_digest_object(digest.limit(0), str(tmp_path / "none"), ["seq"])
    assert json.loads("".join(open(os.path.join(none, p)).read() for p in sorted(os.listdir(none)) if p.startswith("part-"))) == {}
    assert read_digest_object(spark, none).count() == 0


def test_retention_opens_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["news_2025-06-01.json", "news_2025-06-15.json", "all_news.json", "notes_7.json", "bad_2025-99-99.json"]
    spark.createDataFrame([(n, i) for i, n in enumerate(names)], "file string, v int").write.partitionBy("file").parquet(path)
    for folder in os.listdir(path):  # files that no reader could open
        for f in os.listdir(os.path.join(path, folder)) if "=" in folder else []:
            if f.endswith(".parquet"):
                open(os.path.join(path, folder, f), "wb").write(b"no parquet")
    assert drop_expired_partitions(spark, path, "2025-06-16T12:00:00", 5) == ["file=news_2025-06-01.json"]
    assert sorted(partition_names(spark, path)) == sorted(f"file={n}" for n in names[1:])
    assert drop_expired_partitions(spark, path, "2025-06-16T12:00:00", 5) == []


def test_parts_are_packed_by_bytes_in_order(spark, tmp_path):
    rng = random.Random(2)
    sizes = {(d, h): rng.randrange(50, 400) for d in range(1, 84) for h in range(24)}  # 1,992 hourly parts
    parts = spark.createDataFrame([(f"{d:03d}_{h:02d}", f"d{d:03d}", b) for (d, h), b in sizes.items()], "name string, day string, bytes long")
    plan = packed_files(parts, 1000).collect()
    assert len(plan) == len(sizes)
    files = {}
    for r in sorted(plan, key=lambda r: r["name"]):
        files.setdefault((r["day"], r["bin"]), []).append(r["name"])
    size = {f: sum(sizes[int(n[:3]), int(n[4:])] for n in ns) for f, ns in files.items()}
    last = {d: max(b for e, b in files if e == d) for d, _ in files}
    assert all(600 <= s <= 1400 for (d, b), s in size.items() if b != last[d]) and max(size.values()) <= 1400
    for d in last:  # bins follow each other in the order of names
        assert [n for b in range(last[d] + 1) for n in files.get((d, b), [])] == sorted(n for (e, _), ns in files.items() if e == d for n in ns)
    rows = parts.where("day <= 'd004'").select(F.col("name").alias("part"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("seq"))
    path = write_packed(rows, spark.createDataFrame(plan, "name string, day string, bin int"), str(tmp_path / "p"), "part", ["part", "seq"])
    for d, folders, fs in os.walk(path):
        own = [f for f in fs if f.endswith(".parquet")]
        assert len(own) <= 1
        if own:
            got = [(r["part"], r["seq"]) for r in spark.read.parquet(os.path.join(d, own[0])).collect()]
            assert got == sorted(got)


def test_source_limit_opens_the_newest_periods_and_pushes_the_predicate(spark, tmp_path, capsys):
    rows = [(f"u{i}", "en" if i % 10 == 0 else "de", f"2025-{1 + i % 6:02d}-{1 + i % 28:02d}T00:00:00", i) for i in range(600)]
    df = spark.createDataFrame(rows, "url string, lang string, published_at string, seq long")
    stored = AllTimeTable(spark, str(tmp_path / "s"), df.schema, key="url", time="published_at", ties=["seq"], buckets=8, cluster=["lang"])
    stored.merge(df, first=["seq"])
    wanted = sorted((r for r in rows if r[1] == "en"), key=lambda r: r[3])
    wanted.sort(key=lambda r: r[2], reverse=True)
    few = stored.newest_where(5, F.col("lang") == "en")
    assert [r["url"] for r in few.collect()] == [r[0] for r in wanted[:5]]
    periods = {f.split("period=")[1].split("/")[0] for f in few.inputFiles()}
    assert len(periods) <= 2
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan_of(few, capsys)
    assert [r["url"] for r in stored.newest_where(1000, F.col("lang") == "en").collect()] == [r[0] for r in wanted]
    assert stored.newest_where(3, F.col("lang") == "xx").count() == 0
