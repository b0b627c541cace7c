"""Per-day digest with zero-hit days kept (AGG1, AGG2, JOI4, FIL4, FIL5, PRJ6, ORD2).

The digest is produced in *long form*: one row per (day, hit article) plus one status
row per day without hits. That is the distributed shape of the keyed-object digest: no
day's articles are ever collected into one array, one task or the driver, so a day that
holds a third of all articles costs the same as any other. ``write_digest`` stores it
partitioned by day, sorted by the article order within each day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.functions.dates import extract_day
from newslake.functions.text import as_col, strip
from newslake.schemas import NO_HIT_STATUS
from newslake.session import materialize
from newslake.sinks.writers import write_framed


def with_day(df: DataFrame, published: Column | str = "published_at", formats: str = "iso") -> DataFrame:
    """Add ``day`` (``yyyy-MM-dd`` string or NULL) from a raw published string (SCA11)."""
    return df.withColumn("day", extract_day(F.coalesce(as_col(published), F.lit("")), formats))


def daily_digest(
    df: DataFrame,
    *,
    order: list[str],
    tags: str = "platforms_mentioned",
    published: Column | str = "published_at",
    formats: str = "iso",
) -> DataFrame:
    """Long-form digest: ``day, status, <order cols>, title, url, platforms_mentioned``.

    Rows without an extractable day vanish from both days and hits (FIL5). A day with at
    least one tagged article contributes one row per such article (``status`` NULL),
    ordered by ``order``; a day without any contributes a single row with
    ``status = 'no company in the news'``.
    """
    dated = with_day(df, published, formats).filter(F.col("day").isNotNull())
    is_hit = F.coalesce(F.size(F.col(tags)) > 0, F.lit(False))
    hits = dated.filter(is_hit).select(
        "day",
        F.lit(None).cast("string").alias("status"),
        *order,
        strip(F.coalesce(F.col("title"), F.lit(""))).alias("title"),
        F.col("url"),
        F.col(tags).alias("platforms_mentioned"),
    )
    quiet_days = (
        dated.groupBy("day")
        .agg(F.count_if(is_hit).alias("_hits"))
        .filter(F.col("_hits") == 0)
        .select(
            "day",
            F.lit(NO_HIT_STATUS).alias("status"),
            *[F.lit(None).cast(df.schema[o].dataType).alias(o) for o in order],
            F.lit(None).cast("string").alias("title"),
            F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("array<string>").alias("platforms_mentioned"),
        )
    )
    return hits.unionByName(quiet_days)


def digest_day_status(
    df: DataFrame,
    *,
    hit: Column,
    published: Column | str = "published_at",
    formats: str = "iso",
) -> DataFrame:
    """One row per day: ``day, status, n_articles, n_hits`` -- a pure partial aggregate."""
    dated = with_day(df, published, formats).filter(F.col("day").isNotNull())
    return (
        dated.groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_articles"), F.count_if(F.coalesce(hit, F.lit(False))).alias("n_hits"))
        .withColumn("status", F.when(F.col("n_hits") > 0, F.lit("hits")).otherwise(F.lit(NO_HIT_STATUS)))
        .select("day", "status", "n_articles", "n_hits")
    )


def write_digest(digest: DataFrame, path: str, order: list[str]) -> str:
    """Write the long-form digest as JSON lines, one folder per day, article order kept.

    Range partitioning on ``(day, order)`` splits a hot day over several tasks (several
    files in its folder) instead of sending it whole to one task, and keeps the files of
    a day in article order.
    """
    (
        digest.repartitionByRange("day", *order)
        .sortWithinPartitions("day", *order)
        .write.mode("overwrite")
        .partitionBy("day")
        .json(path)
    )
    return path


ARTICLE = "title string, url string, platforms_mentioned array<string>"
_DAY_LINE = r'^"(\d{4}-\d{2}-\d{2})":'


def write_digest_object(digest: DataFrame, path: str, order: list[str]) -> str:
    """SNK6: the digest as one JSON object keyed by day, over as many files as there are ranges.

    ``cat part-*`` is ``{"day": {"articles": [..]}, "day": {"status": ".."}, ..}``, days ascending, articles in
    order. Rows are dealt to ranges of (day, order) and numbered there; a row only has to know whether its number is
    the first or the last of its day, so no day is gathered, whatever it holds.
    """
    keys = ["day", *order]
    dealt = digest.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_n", F.monotonically_increasing_id())
    numbered = materialize(dealt, "digest-rows")
    ends = numbered.groupBy("day").agg(F.min("_n").alias("_first"), F.max("_n").alias("_last"))
    article = F.to_json(F.struct("title", "url", "platforms_mentioned"), {"ignoreNullFields": "false"})
    start = F.concat(F.lit('\n"'), "day", F.lit('":{'))
    line = F.when(F.col("status").isNotNull(), F.concat(start, F.substr(F.to_json(F.struct("status")), F.lit(2)))).otherwise(F.concat(
        F.when(F.col("_n") == F.col("_first"), F.concat(start, F.lit('"articles":['))).otherwise(""),
        F.lit("\n"), article, F.when(F.col("_n") == F.col("_last"), F.lit("\n]}")).otherwise("")))
    return write_framed(numbered.join(ends, "day").select(line.alias("line"), "_n"), path, ["_n"], "{", "}")


def read_digest_object(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_digest_object``: ``day, status, title, url, platforms_mentioned``.

    Articles and days stand on lines of their own. Each byte range carries its last day to its articles; what stands
    before a range's first day belongs to the last day of the ranges before, one small row a range.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value")
    found = F.nullif(F.regexp_extract("value", _DAY_LINE, 1), F.lit(""))
    before = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("found", found).withColumn("day", F.last("found", ignorenulls=True).over(before))
    parts = lines.groupBy("file", "block").agg(F.max_by("found", F.when(F.col("found").isNotNull(), F.col("n"))).alias("last"))
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row a byte range
    parts = parts.withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).select("file", "block", "carried")
    rows = lines.join(parts, ["file", "block"]).withColumn("day", F.coalesce("day", "carried"))
    status = F.get_json_object(F.concat(F.lit("{"), F.regexp_replace("value", _DAY_LINE, '"d":'), F.lit("}")), "$.d.status")
    rows = rows.where(F.col("value").startswith('{"') | F.col("value").endswith('"}')).select(
        "day", F.when(F.col("found").isNotNull(), status).alias("status"),
        F.explode(F.array(F.from_json(F.when(F.col("found").isNull(), F.col("value")), ARTICLE))).alias("a"))
    return rows.select("day", "status", "a.title", "a.url", "a.platforms_mentioned")


__all__ = ["daily_digest", "digest_day_status", "read_digest_object", "with_day", "write_digest", "write_digest_object"]
