"""Sinks (SNK1, SNK2, SNK5): JSON lines, JSON arrays, Parquet tables and the flattened CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.session import delete_path, materialize

LIST_SEPARATOR = ", "


def flatten_lists(df: DataFrame, sep: str = LIST_SEPARATOR) -> DataFrame:
    """Join every ``array<string>`` column with ``sep`` (the CSV export's list form)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.coalesce(F.array_join(F.col(f.name), sep), F.lit("")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """SNK2: CSV with header, list columns flattened."""
    flatten_lists(df).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """SNK1: full overwrite as JSON lines (non-ASCII kept as is)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return path


def write_framed(lines: DataFrame, path: str, order: list[str], opened: str, closed: str) -> str:
    """Write the ``line`` column in order as one framed object over many files: ``cat part-*`` is the object.

    Lines are separated by commas. Rows are dealt to ranges of ``order``, and a row only has to know whether it is
    the first of all, which is row 0 of the first range; the closing frame is a row behind all others. No task
    holds more than its range.
    """
    spark = lines.sparkSession
    end = spark.range(1).select(F.lit(1).alias("__end"), F.lit("").alias("line"), *[
        F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in order])
    keys = ["__end", *order]
    rows = lines.select(F.lit(0).alias("__end"), "line", *order).unionByName(end)
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    first, last = F.monotonically_increasing_id() == 0, F.col("__end") == 1
    framed = F.concat(F.when(first, F.lit(opened)).otherwise(F.when(last, "").otherwise(",")), F.col("line"),
                      F.when(last, F.lit(closed)).otherwise(""))
    dealt.select(framed.alias("value")).write.mode("overwrite").text(path)
    return path


def write_json_array(df: DataFrame, path: str, order: list[str], drop: list[str] | None = None) -> str:
    """SNK1: one JSON array in the order of ``order``, an element a line, as the parts of a folder.

    ``drop`` names columns that only give the order. NULL fields are written as null.
    """
    fields = [c for c in df.columns if c not in (drop or [])]
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return write_framed(df.select(line.alias("line"), *order), path, order, "[", "]")


def rewrite_partitions(spark, path: str, change, partition_by: list[str], only: Column | None = None) -> str:
    """Rewrite the partitions of a Parquet table in place (SNK5, SNK8): ``change`` maps the old rows to the new.

    ``only`` limits the work to the partitions it selects. The new rows are written beside the table first, so
    the table is never read while it is overwritten; a partition that loses all its rows is emptied.
    """
    table = spark.read.parquet(path)
    old = table if only is None else table.where(only)
    new = materialize(change(old), "rewrite")
    emptied = old.select(*partition_by).distinct().join(new.select(*partition_by).distinct(), partition_by, "left_anti")
    folders = ["/".join(f"{c}={row[c]}" for c in partition_by) for row in emptied.collect()]
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    for folder in folders:
        delete_path(spark, f"{path}/{folder}")
    return path


__all__ = ["flatten_lists", "rewrite_partitions", "write_csv", "write_framed", "write_json", "write_json_array"]
