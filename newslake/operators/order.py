"""Newest-first ordering and source-side top-n (ORD1, TOP2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.dates import time_tuple_to_ts
from newslake.functions.text import as_col


def _opt(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def sort_timestamp(df: DataFrame) -> Column:
    """``published_parsed`` (UTC) else ISO ``published`` else ISO ``published_at`` else epoch 0."""
    return F.coalesce(
        time_tuple_to_ts(_opt(df, "published_parsed", "array<int>")).cast("timestamp"),
        F.try_to_timestamp(_opt(df, "published")),
        F.try_to_timestamp(_opt(df, "published_at")),
        F.lit(0).cast("timestamp"),
    )


def newest_first(df: DataFrame, seq: list[Column | str], ts: Column | None = None) -> DataFrame:
    """Stable newest-first sort: timestamp descending, ties in ``seq`` order (range-partitioned)."""
    key = sort_timestamp(df) if ts is None else ts
    return df.withColumn("_sort_ts", key).orderBy(F.desc("_sort_ts"), *[as_col(s).asc() for s in seq]).drop("_sort_ts")


def newest_n(df: DataFrame, n: int, seq: list[Column | str], ts: Column | None = None) -> DataFrame:
    """The ``n`` newest rows (source page cap): a top-k, planned as TakeOrderedAndProject."""
    return newest_first(df, seq, ts).limit(n)


__all__ = ["newest_first", "newest_n", "sort_timestamp"]
