"""Landed JSON-array files -> rows in file order, with a rejects table (SRC1, SRC2, SRC8, SRC9).

A landed batch is one JSON array per file. Each file is read whole (the format needs the
full text to parse), parsed with ``from_json`` into ``array<struct>`` and exploded with
its position, so ``(file, pos)`` carries the first-seen order. Files that are not arrays
(a lone object, malformed text) are *not* wrapped or dropped silently: they land in the
rejects frame with a reason. A file holding ``[]`` is an empty source, not an error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.text import PY_WHITESPACE, as_col
from newslake.operators.filters import exclude_files
from newslake.schemas import ARTICLE_SCHEMA

# Fixed value: what names the extracts that are no input themselves.
DIGESTS = ("filtered_for_companies_of_interest",)
REJECT_SCHEMA = "file string, reason string"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_json_arrays(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType = ARTICLE_SCHEMA,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: rows are ``file, pos, <schema fields>``; rejects ``file, reason``.

    A missing path gives two empty frames (an empty source, as the reference treats it).
    """
    out_schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("pos", T.IntegerType())] + list(schema.fields)
    )
    try:
        raw = spark.read.text(paths, wholetext=True).select(
            F.col("_metadata.file_name").alias("file"), F.col("value")
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, out_schema), spark.createDataFrame([], REJECT_SCHEMA)
    n = F.json_array_length("value")
    # Parse each file once; ``posexplode_outer`` + a filter on the position avoids the
    # inferred size/not-null filter that would parse the whole file again.
    parsed = raw.filter(n.isNotNull()).select("file", F.from_json("value", T.ArrayType(schema)).alias("_arr"))
    rows = (
        parsed.select("file", F.posexplode_outer("_arr").alias("pos", "item"))
        .filter(F.col("pos").isNotNull())
        .select("file", "pos", "item.*")
    )
    trimmed = F.trim(F.col("value"), F.lit(PY_WHITESPACE))
    reason = (
        F.when(trimmed == F.lit(""), F.lit("empty file"))
        .when(F.get_json_object("value", "$").isNotNull() | trimmed.startswith("{") & trimmed.endswith("}"), F.lit("not a list"))
        .otherwise(F.lit("malformed JSON"))
    )
    rejects = raw.filter(n.isNull()).select("file", reason.alias("reason"))
    return rows, rejects


def with_seq(df: DataFrame, *, origin: int = 0) -> DataFrame:
    """Add ``seq = struct(origin, file, pos)``: the first-seen order of landed rows."""
    return df.withColumn("seq", F.struct(F.lit(origin).alias("origin"), F.col("file"), F.col("pos")))


# Landed-file naming (SRC2): each selection is a path glob, so only matching files are listed.
def daily_batch_glob(base: str, day: str) -> str:
    return f"{base.rstrip('/')}/news_{day}*.json"


def snapshot_glob(base: str, day: str) -> str:
    return f"{base.rstrip('/')}/finanzen_{day}_*.json"


def quarter_glob(base: str) -> str:
    return f"{base.rstrip('/')}/news_*_Q*.json"


def select_names(name: Column | str, as_of: str, *, excluded: tuple[str, ...] = DIGESTS) -> Column:
    """The selections (SRC2, FIL11) that a landed file's name belongs to, for tables partitioned by it.

    ``batch``: the day's batches; ``snapshots``: the hourly snapshots of the day before (the ones to be compacted);
    ``quarters``: quarter tables; ``articles``: every JSON file but the all-time table and filtered extracts. ``as_of``
    is the day (SCA13), never the clock. Each test is a LIKE on the name, so a filter on a selection prunes partitions.
    """
    n = as_col(name)
    day = F.to_date(F.lit(as_of))
    today, yesterday = F.date_format(day, "yyyy-MM-dd"), F.date_format(F.date_sub(day, 1), "yyyy-MM-dd")
    tests = {
        "batch": n.startswith(F.concat(F.lit("news_"), today)) & n.endswith(".json"),
        "snapshots": n.startswith(F.concat(F.lit("finanzen_"), yesterday, F.lit("_"))) & n.endswith(".json"),
        "quarters": n.like("news\\_%\\_Q%.json"),
        "articles": n.like("%.json") & exclude_files(n, contains=excluded),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(k)) for k, test in tests.items()]))


def write_if_any(df: DataFrame, path: str, fmt: str = "json") -> bool:
    """SRC9: write only when there is at least one row; returns whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(fmt).save(path)
    return True


__all__ = [
    "daily_batch_glob", "quarter_glob", "read_json_arrays",
    "select_names", "snapshot_glob", "with_seq", "write_if_any",
]
