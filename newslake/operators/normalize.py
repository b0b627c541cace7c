"""Article projection, normalization and validation (narrow: no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.text import as_col, nonempty, or_chain, strip, truncate_title
from newslake.schemas import ARTICLE_FIELDS


def _opt(df: DataFrame, name: str) -> Column:
    """A column if present, else a typed NULL (optional fields of the wide schema)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def uniform_articles(
    df: DataFrame,
    *,
    source: Column | str,
    url: Column | str,
    title: Column | str,
    published_at: Column | str,
    content: Column | str,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """The uniform article projection every collector emits (PRJ1).

    ``platforms_mentioned`` starts as an empty ``array<string>``; ``extra`` carries
    ordering/provenance columns (``seq``, ``source_ord``...) through.
    """
    cols = [
        as_col(source).cast("string").alias("source"),
        as_col(url).cast("string").alias("url"),
        as_col(title).cast("string").alias("title"),
        as_col(published_at).cast("string").alias("published_at"),
        as_col(content).cast("string").alias("content"),
        F.array().cast("array<string>").alias("platforms_mentioned"),
    ]
    cols += [c.alias(n) for n, c in (extra or {}).items()]
    return df.select(*cols)


def normalized_title_content(df: DataFrame) -> tuple[Column, Column]:
    """``title <- (title or headline)``, ``content <- (content or text)``, both stripped (PRJ3).

    A whitespace-only title is truthy, so it does not fall to ``headline``; stripped to
    ``''`` it then falls to the first 120 characters of the content (plus an ellipsis).
    """
    t = strip(F.coalesce(or_chain(_opt(df, "title"), _opt(df, "headline"), F.lit("")), F.lit("")))
    c = strip(F.coalesce(or_chain(_opt(df, "content"), _opt(df, "text"), F.lit("")), F.lit("")))
    title = F.when(t != F.lit(""), t).otherwise(truncate_title(c))
    return title, c


def normalize_articles(df: DataFrame, *, on_error: str = "quarantine") -> DataFrame:
    """Normalize title/content and flag invalid rows (both empty) -- FIL9.

    Adds ``valid`` (boolean) and ``reject_reason``. ``on_error='fail'`` raises before any
    write if an invalid row exists; ``'quarantine'`` keeps them, flagged by ``valid``.
    """
    title, content = normalized_title_content(df)
    out = (
        df.withColumn("_t", title)
        .withColumn("_c", content)
        .withColumn("valid", (F.col("_t") != F.lit("")) | (F.col("_c") != F.lit("")))
        .withColumn(
            "reject_reason",
            F.when(~F.col("valid"), F.lit("missing both title and content")),
        )
        .withColumn("title", F.col("_t"))
        .withColumn("content", F.col("_c"))
        .drop("_t", "_c")
    )
    if on_error == "fail":
        bad = out.filter(~F.col("valid")).limit(1).collect()
        if bad:
            raise ValueError(f"data validation failed: {bad[0].asDict()}")
    elif on_error != "quarantine":
        raise ValueError(f"unknown on_error {on_error!r}")
    return out


def haystack(title: Column | str = "title", content: Column | str = "content", order: str = "title_first") -> Column:
    """Lowercased match text: ``title + ' ' + content`` (tagger) or content first (analyzer)."""
    t = F.coalesce(as_col(title), F.lit(""))
    c = F.coalesce(as_col(content), F.lit(""))
    parts = (t, c) if order == "title_first" else (c, t)
    return F.lower(F.concat(parts[0], F.lit(" "), parts[1]))


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """Prefix ``base`` unless the link already starts with ``http`` (PRJ7)."""
    h = as_col(href)
    return F.when(h.startswith("http"), h).otherwise(F.concat(as_col(base), h))


__all__ = [
    "absolute_url", "haystack", "nonempty", "normalize_articles",
    "normalized_title_content", "uniform_articles",
]
