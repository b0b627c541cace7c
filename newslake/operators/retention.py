"""Retention by the date embedded in a file/partition name (FIL8, SNK8).

``as_of`` is an argument, never the clock. With a timestamp ``as_of`` the rule is exact:
a name's date expires when its midnight is earlier than ``as_of - days``. A bare date
``as_of`` means "some time during that day", i.e. dates up to ``as_of - days`` expire.
Names without a date, and the all-time table, are always kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.text import as_col
from newslake.session import delete_path

NAME_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"
ALWAYS_KEEP = ("all_news.json",)


def name_day(name: Column | str) -> Column:
    """DATE of the first ``dddd-dd-dd`` in the name (NULL when absent or not a date)."""
    return F.try_to_date(F.nullif(F.regexp_extract(as_col(name), NAME_DATE_PATTERN, 1), F.lit("")), "yyyy-MM-dd")


def expired_flag(name: Column | str, as_of: str, days: int = 5) -> Column:
    d = name_day(name)
    if len(as_of.strip()) <= 10:
        too_old = d <= F.date_sub(F.to_date(F.lit(as_of)), days)
    else:
        cutoff = F.to_timestamp_ntz(F.lit(as_of)) - F.make_interval(days=F.lit(days))
        too_old = F.to_timestamp_ntz(d) < cutoff
    return F.coalesce(too_old & ~as_col(name).isin(*ALWAYS_KEEP), F.lit(False))


def retain(df: DataFrame, name: str, as_of: str, days: int = 5) -> DataFrame:
    """Rows/partitions that survive retention."""
    return df.filter(~expired_flag(name, as_of, days))


def expired(df: DataFrame, name: str, as_of: str, days: int = 5) -> DataFrame:
    """Rows/partitions that retention removes (the complement of ``retain``)."""
    return df.filter(expired_flag(name, as_of, days))


def drop_expired_partitions(spark: SparkSession, path: str, as_of: str, days: int = 5) -> list[str]:
    """SNK8: delete the expired partition folders of a table, judged by their names; returns the names.

    Only the folder is listed: no data file is opened, and what has no date in its name stays.
    """
    names = partition_names(spark, path)
    if not names:
        return []
    listed = spark.createDataFrame([(n,) for n in names], "name string")  # one row a partition
    gone = sorted(r["name"] for r in expired(listed, "name", as_of, days).collect())
    for name in gone:
        delete_path(spark, f"{path.rstrip('/')}/{name}")
    return gone


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """The folders of a partitioned table, ``column=value`` each."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]


__all__ = ["drop_expired_partitions", "expired", "expired_flag", "name_day", "partition_names", "retain"]
