"""Landed-file selection and exclusion, sinks and the German snapshot job."""

import os


from newslake.operators.digest import daily_digest, write_digest
from newslake.operators.filters import exclude_files
from newslake.plans.jobs import finanzen_snapshot
from newslake.sinks.writers import flatten_lists, write_json
from newslake.sources.json_files import daily_batch_glob, quarter_glob, read_json_arrays, snapshot_glob, write_if_any


def _land(tmp_path, names):
    for n in names:
        (tmp_path / n).write_text('[{"url": "%s", "title": "t", "published_at": "2025-06-21T01:00:00"}]' % n)


def test_globs_select_by_name(spark, tmp_path):
    _land(tmp_path, [
        "news_2025-06-21.json", "news_2025-06-21_b.json", "news_2025-06-20.json", "news_2025_Q2.json",
        "finanzen_2025-06-21_0207.json", "finanzen_2025-06-20_2300.json", "news_filtered_for_companies_of_interest.json",
        "all_news.json",
    ])
    d = str(tmp_path)
    files = lambda g: sorted({r["file"] for r in read_json_arrays(spark, g)[0].select("file").collect()})
    assert files(daily_batch_glob(d, "2025-06-21")) == ["news_2025-06-21.json", "news_2025-06-21_b.json"]
    assert files(snapshot_glob(d, "2025-06-21")) == ["finanzen_2025-06-21_0207.json"]
    assert files(quarter_glob(d)) == ["news_2025_Q2.json"]
    every, _ = read_json_arrays(spark, d + "/news_*.json")
    kept = sorted({r["file"] for r in every.filter(exclude_files("file")).collect()})
    assert "news_filtered_for_companies_of_interest.json" not in kept and "news_2025_Q2.json" in kept


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "2025-06-20T10:00:00", "A", "u1", ["X", "Y"]), (2, "2025-06-21T10:00:00", "B", "u2", [])],
        "seq long, published_at string, title string, url string, platforms_mentioned array<string>",
    )
    flat = flatten_lists(df).collect()
    assert [r["platforms_mentioned"] for r in flat] == ["X, Y", ""]
    out = write_digest(daily_digest(df, order=["seq"]), str(tmp_path / "digest"), order=["seq"])
    assert sorted(d for d in os.listdir(out) if d.startswith("day=")) == ["day=2025-06-20", "day=2025-06-21"]
    back = spark.read.json(out)
    assert back.count() == 2
    assert write_if_any(df.limit(0), str(tmp_path / "none")) is False
    write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_finanzen_snapshot(spark, tmp_path):
    rss = """<rss><channel>
    <item><title>Übernahme: Börse prüft Großbank-Deal</title><link>https://f/1</link>
    <pubDate>Sat, 21 Jun 2025 01:47:00 GMT</pubDate></item>
    </channel></rss>"""
    (tmp_path / "feed.xml").write_text(rss)
    row = finanzen_snapshot(spark, str(tmp_path / "feed.xml")).first()
    assert row["title"] == "Uebernahme: Boerse prueft Grossbank-Deal"
    assert row["published_at"] == "2025-06-21T01:47:00"
    assert row["source"] == "finanzen.net" and "boerse" in row["content"].split(", ")
