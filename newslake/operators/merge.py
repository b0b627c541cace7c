"""Upsert of a batch into an accumulated table (SNK3, SNK4, JOI6, SET2).

``existing`` is the big side (all history), ``batch`` the increment. The merge never
re-deduplicates history: it dedupes the batch first-seen, once, into a written table,
finds which batch keys already exist, and appends the rest. Finding the existing keys is a
*semi-join of existing against the batch keys*: while the keys' measured bytes allow, the
batch keys are broadcast and existing is filtered map-side without a shuffle; otherwise
both sides shuffle on the key (AQE handles skew). ``new_rows`` is what a table that is
appended to needs; ``merge_upsert`` puts history in front of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.dates import quarter_label
from newslake.operators.dedupe import dedupe_first
from newslake.session import BROADCAST_BYTES, materialize


def new_rows(existing: DataFrame, batch: DataFrame, *, key: str, order: list[Column | str]) -> DataFrame:
    """The batch rows whose key is new, first-seen within the batch; rows without a key as they are."""
    # First-seen per key inside the batch: one partial aggregate, keys already distinct.
    fresh = materialize(dedupe_first(batch.filter(F.col(key).isNotNull()), F.col(key), order, null_key="drop"), "merge-batch")
    keys = fresh.select(key)
    size = keys.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()[0] or 0
    seen = existing.select(key).join(F.broadcast(keys) if 4 * size <= BROADCAST_BYTES else keys, key, "left_semi")
    # Rows without a key cannot match anything.
    return fresh.join(seen, key, "left_anti").unionByName(batch.filter(F.col(key).isNull()))


def merge_upsert(existing: DataFrame, batch: DataFrame, *, key: str, order: list[Column | str]) -> DataFrame:
    """``existing`` plus the batch rows whose key is new, first-seen within the batch.

    Both frames carry the key column ``key`` (NULL keys are kept, as in DED2) and the
    ``order`` columns. The result has ``existing``'s columns plus ``origin``.
    """
    added = new_rows(existing, batch, key=key, order=order)
    return existing.withColumn("origin", F.lit("existing")).unionByName(
        added.withColumn("origin", F.lit("batch")), allowMissingColumns=True)


def merge_metrics(existing: DataFrame, batch: DataFrame, added: DataFrame) -> DataFrame:
    """Run metrics in long form ``(metric, value)``: existing, incoming, kept, dropped.

    ``added`` is what ``new_rows`` gave. One aggregate over the three, each read once.
    """
    rows = existing.select(F.lit("existing").alias("m")).unionByName(batch.select(F.lit("incoming").alias("m")))
    rows = rows.unionByName(added.select(F.lit("kept").alias("m")))
    n = rows.agg(*[F.count_if(F.col("m") == m).alias(m) for m in ("existing", "incoming", "kept")])
    named = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("existing", "incoming", "kept")]
    dropped = F.struct(F.lit("dropped").alias("metric"), (F.col("incoming") - F.col("kept")).alias("value"))
    return n.select(F.inline(F.array(*named, dropped)))


def merge_quarter(
    quarter_table: DataFrame,
    batch: DataFrame,
    *,
    key: str,
    order: list[Column | str],
    processing_date: Column | str,
) -> DataFrame:
    """SNK4: upsert into a table partitioned by ``quarter``.

    The quarter of a batch row is that of its *processing date*, not of the article.
    Keys are unique within a quarter partition, so the merge key is ``(quarter, key)``;
    writing the result with ``partitionOverwriteMode=dynamic`` rewrites only the touched
    quarters.
    """
    pd = F.col(processing_date) if isinstance(processing_date, str) else processing_date
    b = batch.withColumn("quarter", quarter_label(pd))
    qkey = "_qkey"
    ex = quarter_table.withColumn(qkey, F.concat_ws("\u0001", "quarter", F.col(key).cast("string")))
    bk = b.withColumn(
        qkey, F.when(F.col(key).isNotNull(), F.concat_ws("\u0001", "quarter", F.col(key).cast("string")))
    )
    merged = merge_upsert(ex, bk, key=qkey, order=order)
    return merged.drop(qkey)


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Write a new version of a table to ``path`` (never the path being read)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return path


__all__ = ["merge_metrics", "merge_quarter", "merge_upsert", "new_rows", "write_table"]
