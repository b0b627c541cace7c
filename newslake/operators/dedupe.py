"""Deterministic first-seen deduplication (DED1, DED2).

"First" is defined by explicit order columns (``seq``: file, position...), never by row
order. The plan is one hash-partitioned aggregate: ``min_by(row, order)`` per key is a
partial aggregate, so every map task collapses its copies of a key *before* the shuffle.
A hot key (even a third of all rows) therefore ships one row per map task, not all of its
copies; there is no window sort over a skewed partition. Rows whose key is NULL bypass
the aggregate entirely (they would all hash to one reducer) and are unioned back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import as_col, or_chain


def object_key(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Canonical whole-object key: SHA-256 of the JSON of the fields in sorted-name order."""
    names = sorted(cols or df.columns)
    return F.sha2(F.to_json(F.struct(*[F.col(n) for n in names])), 256)


def key_chain(*cols: Column | str) -> Column:
    """``a or b or c``: first non-empty value, else the last operand as is (may be NULL or '')."""
    return or_chain(*[as_col(c).cast("string") for c in cols])


def dedupe_first(
    df: DataFrame,
    key: Column,
    order: list[Column | str],
    *,
    null_key: str = "keep",
) -> DataFrame:
    """Keep the first row (lowest ``order``) of every key; the output has ``df``'s columns.

    ``null_key='keep'`` keeps every row whose key is NULL (cannot be deduped reliably);
    ``'drop'`` discards them.
    """
    cols = df.columns
    keyed = df.withColumn("_dkey", key)
    order_struct = F.struct(*[as_col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    firsts = (
        keyed.filter(F.col("_dkey").isNotNull())
        .groupBy("_dkey")
        .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order_struct).alias("_first"))
        .select("_first.*")
    )
    if null_key == "keep":
        return firsts.unionByName(keyed.filter(F.col("_dkey").isNull()).select(*cols))
    if null_key == "drop":
        return firsts
    raise ValueError(f"unknown null_key {null_key!r}")


def dedupe_articles(df: DataFrame, order: list[Column | str], object_cols: list[str] | None = None) -> DataFrame:
    """DED1: key = ``link`` or ``id`` or the canonical JSON of the whole object."""
    link = F.col("link") if "link" in df.columns else F.lit(None).cast("string")
    ident = F.col("id") if "id" in df.columns else F.lit(None).cast("string")
    key = key_chain(link, ident, object_key(df, object_cols))
    return dedupe_first(df, key, order, null_key="keep")


def dedupe_snapshot_items(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """DED2: key = ``id`` or ``url`` or ``title``; a NULL key keeps the row, ``''`` title is a key."""
    ident = F.col("id") if "id" in df.columns else F.lit(None).cast("string")
    return dedupe_first(df, key_chain(ident, F.col("url"), F.col("title")), order, null_key="keep")


__all__ = ["dedupe_articles", "dedupe_first", "dedupe_snapshot_items", "key_chain", "object_key"]
