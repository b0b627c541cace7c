"""Lexicon sentiment (SEN1): tokens -> lexicon equi-join -> mean polarity -> label.

The lexicon is an input table ``(term, polarity)`` (optionally with ``lang``), broadcast only while
its measured bytes allow; else the join shuffles on the term. A score depends on the row's own text
alone: token counts are kept per digest of the text (and language), so rows that share an id never
share a score, and equal texts are scored alike. Tokens are counted per text before they meet the
lexicon, so a frequent word is one row per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions.arrays import explode_with_pos
from newslake.functions.text import as_col, lower_tokens
from newslake.session import BROADCAST_BYTES

# Label thresholds (strict inequalities).
POSITIVE_ABOVE = 0.1
NEGATIVE_BELOW = -0.1


def sentiment_label(score: Column | str) -> Column:
    s = as_col(score)
    return (
        F.when(s > F.lit(POSITIVE_ABOVE), F.lit("positive"))
        .when(s < F.lit(NEGATIVE_BELOW), F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def text_key(df: DataFrame, text: Column | str, by_lang: bool) -> Column:
    parts = [F.coalesce(as_col(text), F.lit(""))]
    if by_lang:
        parts.append(F.concat(F.lit("\u0000"), F.coalesce(F.col("lang"), F.lit("\u0000"))))
    return F.md5(F.concat(*parts).cast("binary"))


def sentiment_scores(df: DataFrame, lexicon: DataFrame, *, text: Column | str = "content") -> DataFrame:
    """``(_skey, sentiment_score)`` of the distinct texts with at least one lexicon token."""
    by_lang = "lang" in lexicon.columns and "lang" in df.columns
    keys = ["lang", "term"] if by_lang else ["term"]
    # Texts with repeats count alike: the mean of n equal texts is that of one.
    toks = explode_with_pos(
        df.withColumn("_skey", text_key(df, text, by_lang)), ["_skey", *(["lang"] if by_lang else [])],
        lower_tokens(F.coalesce(as_col(text), F.lit(""))), "_pos", "term",
    ).groupBy("_skey", *keys).agg(F.count(F.lit(1)).alias("n"))
    lex = lexicon.select(*keys, F.col("polarity").cast("double").alias("polarity"))
    size = lex.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    lex = F.broadcast(lex) if 4 * size <= BROADCAST_BYTES else lex
    return toks.join(lex, keys, "inner").groupBy("_skey").agg(
        (F.sum(F.col("polarity") * F.col("n")) / F.sum("n")).alias("sentiment_score"))


def with_sentiment(df: DataFrame, lexicon: DataFrame, *, text: Column | str = "content") -> DataFrame:
    """Add ``sentiment_score`` (0.0 without lexicon tokens) and ``sentiment_label``."""
    by_lang = "lang" in lexicon.columns and "lang" in df.columns
    scores = sentiment_scores(df, lexicon, text=text)
    return (
        df.withColumn("_skey", text_key(df, text, by_lang)).join(scores, "_skey", "left").drop("_skey")
        .withColumn("sentiment_score", F.coalesce(F.col("sentiment_score"), F.lit(0.0)))
        .withColumn("sentiment_label", sentiment_label("sentiment_score"))
    )


__all__ = ["sentiment_label", "sentiment_scores", "text_key", "with_sentiment"]
