"""The landed entity table (SRC3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.schemas import ENTITY_CSV_SCHEMA


def read_entity_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Entity rows with their place ``row`` = (file, position in the file), the order in which aliases win.

    Columns are taken by their header. A file is read by one task from top to bottom (quoted cells may hold
    line ends), so its row ids ascend in file order.
    """
    raw = (
        spark.read.option("header", True).option("multiLine", True).option("enforceSchema", False)
        .schema(ENTITY_CSV_SCHEMA).csv(paths)
    )
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("pos"))
    return raw.select("*", place.alias("row"))


__all__ = ["read_entity_csv"]
