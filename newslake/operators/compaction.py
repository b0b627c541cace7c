"""Snapshot compaction (SNK7): many hourly snapshots -> one deduped daily partition.

Each day's snapshot rows are deduplicated first-seen by ``(snapshot, position)`` with the
DED2 key chain. The key includes the day, so the aggregate spreads over days and keys;
partial aggregation collapses repeated items map-side. Removing the compacted parts is a
separate maintenance step after the write has succeeded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.functions.text import as_col
from newslake.operators.dedupe import dedupe_first, key_chain


def compact_snapshots(
    df: DataFrame,
    *,
    day: Column | str,
    key: Column | None = None,
    order: list[Column | str],
) -> DataFrame:
    """First-seen item per ``(day, key)``; ``key`` defaults to ``id or url or title``.

    Rows with a NULL key are all kept (they cannot be deduped). Adds ``day`` if given as
    an expression.
    """
    d = as_col(day)
    if key is None:
        ident = F.col("id") if "id" in df.columns else F.lit(None).cast("string")
        key = key_chain(ident, F.col("url"), F.col("title"))
    with_day = df.withColumn("day", d) if not (isinstance(day, str) and day == "day") else df
    full_key = F.when(key.isNotNull(), F.concat_ws("\u0001", F.col("day").cast("string"), key))
    return dedupe_first(with_day, full_key, order, null_key="keep")


def write_daily(df: DataFrame, path: str) -> str:
    """Write compacted rows, one partition per day, replacing only the days present."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    return path


def packed_files(parts: DataFrame, target_bytes: int) -> DataFrame:
    """SNK7: (name, day, bin): parts of a day put into files of about ``target_bytes``, in the order of their names.

    Over names and sizes alone, one row a part. A part starts a new file where the bytes before it have filled
    another multiple of the target, so every file but a day's last is within a part's size of it.
    """
    before = Window.partitionBy("day").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    return parts.withColumn("bin", F.floor(filled / F.lit(target_bytes)).cast("int")).select("name", "day", "bin")


def write_packed(df: DataFrame, plan: DataFrame, path: str, part: str, order: list[str]) -> str:
    """Write rows (``part`` names theirs) as one file per (day, bin) of ``packed_files``, in ``order``."""
    placed = df.join(plan.withColumnRenamed("name", part), part)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(n, "day", "bin").sortWithinPartitions("day", "bin", *order)
    dealt.write.mode("overwrite").partitionBy("day", "bin").parquet(path)
    return path


__all__ = ["compact_snapshots", "packed_files", "write_daily", "write_packed"]
