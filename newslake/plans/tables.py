"""Loaders for the driver's test tables and the article view built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.dates import iso_seconds
from newslake.operators.normalize import normalized_title_content
from newslake.session import pin_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


# Text tables and their ids: the per-row work on them is CPU-heavy (regex, tokens).
TEXT_TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "benchmark": "item_id"}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its files split: for a pass with little work on each row."""
    pin_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = scan(spark, sf_dir, name)
    key = TEXT_TABLE_KEYS.get(name)
    return spread(df, key) if key else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition by ``key`` when the table has fewer files than the cluster has cores.

    Large tables (many files, many row groups) are left alone: their scan already splits
    into many balanced tasks. A table in a handful of single-row-group files would run all
    per-row text work in one task -- a file split into byte ranges still puts its only row
    group in one range, so the split count is not a usable signal; the file count is. The
    partition count equals the shuffle-partition setting, so a later join or aggregate on
    ``key`` reuses this partitioning instead of shuffling again.
    """
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 -- no SparkContext on this client (e.g. Spark Connect)
        return df
    if len(df.inputFiles()) >= cores:
        return df
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, 1), key)


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as raw articles: ``id, seq, source, lang, url, title, content``.

    Narrow projection only (no join): derived per-document columns are computed here so
    that later joins move small rows, never whole texts.
    """
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        "source",
        "lang",
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("title"),
    )
    title, content = normalized_title_content(docs)
    return docs.select(
        "id",
        F.col("id").alias("seq"),
        "source",
        "lang",
        F.concat(F.lit("doc://"), F.col("id").cast("string")).alias("url"),
        title.alias("title"),
        content.alias("content"),
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, published_at)`` from events: the publication stamp of each document."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), iso_seconds("ts").alias("published_at")
    )


def with_published(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left-join the publication stamp by id (equi-join; the planner picks broadcast vs. shuffle)."""
    return df.join(event_times(spark, sf_dir), "id", "left")
