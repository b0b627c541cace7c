"""The whole flow on the landed snapshots: compact -> merge -> tag -> digest -> enrich."""

import pytest
from pyspark.sql import functions as F

from newslake.plans.jobs import (
    collect_batch, combine_snapshots, digest_batch, enrich_batch, merge_batch, tag_batch,
)
from newslake.schemas import ENRICHED_COLUMNS, NO_HIT_STATUS
from newslake.sinks.writers import write_csv


@pytest.fixture(scope="module")
def compacted(spark, snapshot_files):
    kept, rejects = combine_snapshots(spark, snapshot_files)
    assert rejects.count() == 0
    return kept


def test_flow(spark, compacted, entity_csv, tmp_path):
    assert compacted.count() == 83
    merged, quarter = merge_batch(None, compacted, processing_date="2025-06-22")
    assert merged.count() == 83 and {r[0] for r in quarter.select("quarter").distinct().collect()} == {"2025_Q2"}
    again, _ = merge_batch(merged, compacted, processing_date="2025-06-22")
    assert again.count() == 83  # re-merging the same batch adds nothing

    csv = spark.read.option("header", True).csv(entity_csv)
    for sep in (";", None):
        tagged = tag_batch(merged.drop("origin"), csv, alias_sep=sep, boundary="python")
        assert tagged.filter(F.size("platforms_mentioned") > 0).count() == 0
    tagged = tag_batch(merged.drop("origin"), csv)
    digest = digest_batch(tagged).collect()
    assert sorted((r["day"], r["status"]) for r in digest) == [
        ("2025-06-20", NO_HIT_STATUS), ("2025-06-21", NO_HIT_STATUS)
    ]

    lex = spark.createDataFrame([("dax", 0.5), ("verlust", -0.75)], "term string, polarity double")
    enriched = enrich_batch(merged.drop("origin"), lex)
    assert enriched.columns == ENRICHED_COLUMNS and enriched.count() == 83
    out = write_csv(enriched, str(tmp_path / "enriched_csv"))
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ENRICHED_COLUMNS and back.count() == 83


def test_collect_batch(spark, tmp_path):
    rss = """<rss><channel><item><title>Credit fund raises capital</title><link>https://x/1</link>
    <description>Lending platform news. Credit markets.</description><pubDate>Sat, 21 Jun 2025 01:47:00 GMT</pubDate></item>
    </channel></rss>"""
    (tmp_path / "Markets.xml").write_text(rss)
    (tmp_path / "news.json").write_text(
        '{"status": "ok", "articles": [{"source": {"name": "Wire"}, "title": "Loan book", "url": "u", '
        '"publishedAt": "2025-06-21T00:00:00Z", "description": "Banks lend more"}]}'
    )
    batch = collect_batch(spark, {"bloomberg": str(tmp_path / "Markets.xml"), "newsapi": str(tmp_path / "news.json")})
    rows = sorted(batch.collect(), key=lambda r: r["source_ord"])
    assert [r["source"] for r in rows] == ["Bloomberg – Markets [RSS]", "Wire [NewsAPI]"]
    assert all(len(r["keywords"]) > 0 for r in rows)
    assert collect_batch(spark, {"newsapi": str(tmp_path / "news.json")}, query="zebra", filtering=True).count() == 0


def test_quarter_is_merged_on_its_own(spark):
    cols = "id string, url string, title string, content string, published_at string, seq long"
    known = spark.createDataFrame([("a", "u", "t", "c", "2025-05-01", 0)], cols)
    batch = spark.createDataFrame([("a", "u", "t", "c", "2025-05-01", 1), ("b", "v", "t", "c", "2025-07-01", 2)], cols)
    merged, quarter = merge_batch(known, batch, processing_date="2025-07-02")
    assert [r["id"] for r in merged.collect()] == ["b", "a"]  # newest first
    assert sorted((r["quarter"], r["id"]) for r in quarter.collect()) == [("2025_Q3", "a"), ("2025_Q3", "b")]
    _, again = merge_batch(merged, batch, processing_date="2025-07-03", quarter_table=quarter)
    assert again.count() == 2


def test_unknown_collector_kind_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown collector"):
        collect_batch(spark, {"crunchbase": str(tmp_path)})
