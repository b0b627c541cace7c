"""RSS/XML and payload sources, and the streaming first-seen table over snapshots."""

import json

from pyspark.sql import functions as F

from newslake.operators.dedupe import key_chain
from newslake.session import scratch_path
from newslake.sources.feeds import (
    feed_rejects, landed_texts, parse_feeds, payload_articles, read_rss_items, rss_articles, union_sources,
)
from newslake.sources.json_files import read_json_arrays
from newslake.streaming.ingest import run_first_seen, snapshot_stream

RSS = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title> Rates rise </title><link>https://a/1</link><description><![CDATA[<b>Central</b> bank]]></description>
<pubDate>Sat, 21 Jun 2025 01:47:00 GMT</pubDate></item>
<item><title>No summary</title><link>https://a/2</link><description></description></item>
<item><link>https://a/3</link></item>
</channel></rss>"""


def test_rss_collectors(spark, tmp_path):
    (tmp_path / "Markets.xml").write_text(RSS)
    items = read_rss_items(spark, str(tmp_path / "Markets.xml"))
    bb = rss_articles(items, "bloomberg").orderBy("pos").collect()
    assert [r["source"] for r in bb] == ["Bloomberg – Markets [RSS]"] * 3
    assert bb[0]["content"] == "<b>Central</b> bank" and bb[0]["published_at"] == "Sat, 21 Jun 2025 01:47:00 GMT"
    assert bb[2]["title"] == "" and bb[2]["published_at"] == ""
    cnbc = rss_articles(items, "cnbc").orderBy("pos").collect()
    assert cnbc[0]["title"] == "Rates rise" and cnbc[0]["source"] == "Markets [RSS]"
    both = union_sources([("cnbc", rss_articles(items, "cnbc")), ("bloomberg", rss_articles(items, "bloomberg"))])
    assert sorted({r["source_ord"] for r in both.collect()}) == [0, 6]


def test_malformed_feed_is_skipped(spark, tmp_path):
    (tmp_path / "Good.xml").write_text(RSS)
    (tmp_path / "Bad.xml").write_text("<rss><channel><item><title>broken</ti")
    items = read_rss_items(spark, str(tmp_path / "*.xml"))
    assert {r["file"] for r in items.collect()} == {"Good.xml"}


def test_rejects_and_whole_feeds(spark, tmp_path):
    (tmp_path / "Mixed.xml").write_text(RSS.replace("No summary", "Bare & ampersand"))
    (tmp_path / "Empty.xml").write_text("<rss><channel></channel></rss>")
    (tmp_path / "Good.xml").write_text(RSS)
    at = str(tmp_path / "*.xml")
    parsed = parse_feeds(landed_texts(spark, at))
    assert [(r["file"], r["pos"], r["reason"]) for r in feed_rejects(parsed).collect()] == [("Mixed.xml", 1, "malformed item")]
    got = sorted((r["file"], r["pos"]) for r in read_rss_items(spark, at).collect())
    assert got == [("Good.xml", 0), ("Good.xml", 1), ("Good.xml", 2), ("Mixed.xml", 0), ("Mixed.xml", 2)]
    whole = read_rss_items(spark, at, whole_feed=True)
    assert {r["file"] for r in whole.collect()} == {"Good.xml"}
    labels = spark.createDataFrame([("Good.xml", "Top Markets")], "file string, label string")
    named = rss_articles(read_rss_items(spark, at), "bloomberg", labels=labels)
    assert {r["source"] for r in named.collect()} == {"Bloomberg – Top Markets [RSS]", "Bloomberg – Mixed [RSS]"}
    assert read_rss_items(spark, str(tmp_path / "none-*.xml")).count() == 0


def test_payloads(spark):
    ok = {"status": "ok", "articles": [
        {"source": {"name": "Wire"}, "title": "T", "url": "u", "publishedAt": "2025-06-21T00:00:00Z", "content": "", "description": "D"},
        {"source": {"name": None}, "title": None, "url": None, "publishedAt": None, "description": None},
    ]}
    bad = {"status": "error", "articles": [{"title": "x"}]}
    df = spark.createDataFrame([(1, json.dumps(ok)), (2, json.dumps(bad))], "id long, p string")
    news = payload_articles(df, "p", "newsapi", keep=("id",)).orderBy("pos").collect()
    assert len(news) == 2 and news[0]["source"] == "Wire [NewsAPI]" and news[0]["content"] == "D"
    gn = payload_articles(df, "p", "gnews").orderBy("pos").collect()
    assert gn[1]["source"] == "N/A [GNews]" and gn[1]["url"] == "" and gn[1]["content"] == ""


def test_stream_first_seen_equals_batch(spark, snapshot_files, tmp_path):
    rows, _ = read_json_arrays(spark, snapshot_files)
    land = tmp_path / "landed"
    # one Parquet file per hourly snapshot, landed in name order
    for i, f in enumerate(sorted({r["file"] for r in rows.select("file").collect()})):
        part = rows.filter(F.col("file") == f).drop("platforms_mentioned", "keywords", "published_parsed")
        part.coalesce(1).write.parquet(str(land / f"snap={i:02d}"))
    schema = spark.read.parquet(str(land / "snap=00")).schema
    stream = snapshot_stream(spark, str(land / "*"), schema, max_files_per_trigger=1)
    stream = stream.withColumn("key", key_chain(F.col("id"), F.col("url"), F.col("title")))
    base = scratch_path(spark, "test-stream")
    progress = []
    out = run_first_seen(
        stream, key="key", order=["file", "pos"], sink=f"{base}/sink", checkpoint=f"{base}/ckpt", progress=progress
    )
    assert out.count() == 83
    assert sum(m["rows_in"] for m in progress) == 210
