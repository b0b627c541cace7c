"""Physical-plan properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from newslake.plans import catalog
from conftest import SF_SMALL
from newslake.operators.dedupe import dedupe_first
from newslake.operators.merge import merge_upsert


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_no_cartesian_or_nested_loop_joins(spark, capsys, name):
    if name.startswith("stream_"):
        pytest.skip("streaming queries run to completion before returning")
    out = plan_of(catalog.all_queries()[name](spark, SF_SMALL), capsys)
    assert "CartesianProduct" not in out and "BroadcastNestedLoopJoin" not in out


def test_dedupe_combines_map_side(spark, capsys):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"), F.lit("x").alias("v"))
    out = plan_of(dedupe_first(df, F.col("k"), ["pos"]), capsys)
    tree = out.split("\n\n")[0]
    # partial aggregate below the exchange, final aggregate above it; no window sort
    assert tree.count("Aggregate") >= 2 and "Exchange" in tree and "Window" not in tree


def test_merge_filters_history_with_broadcast_batch_keys(spark, capsys):
    existing = spark.range(0, 10000).select(F.col("id").alias("k"), F.lit(0).alias("seq"))
    batch = spark.range(9990, 10010).select(F.col("id").alias("k"), F.lit(1).alias("seq"))
    out = plan_of(merge_upsert(existing, batch, key="k", order=["seq"]), capsys)
    assert "BroadcastHashJoin LeftSemi" in out and "LeftAnti" in out


def test_digest_never_collects_a_day(spark, capsys):
    out = plan_of(catalog.all_queries()["daily_digest"](spark, SF_SMALL), capsys)
    assert "collect_list" not in out and "collect_set" not in out


def test_ranked_keywords_collect_nothing(spark, capsys):
    out = plan_of(catalog.all_queries()["keywords_ranked"](spark, SF_SMALL), capsys)
    assert "collect_" not in out and "ObjectHashAggregate" not in out


def test_every_document_gets_a_language(spark):
    rows = catalog.all_queries()["language_id"](spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count() and {r["held_out"] for r in rows} == {True, False}
