"""Run metrics as DataFrames (AGG6, SNK9): counts per source/file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.operators.filters import has_tags


def source_metrics(df: DataFrame, by: str = "source") -> DataFrame:
    """Per group: articles, valid articles, tagged articles, total content characters."""
    valid = F.col("valid") if "valid" in df.columns else F.lit(True)
    tagged = has_tags() if "platforms_mentioned" in df.columns else F.lit(False)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_articles"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(tagged).alias("n_tagged"),
        F.sum(F.length(F.coalesce(F.col("content"), F.lit("")))).cast("long").alias("n_chars"),
    )


__all__ = ["source_metrics"]
