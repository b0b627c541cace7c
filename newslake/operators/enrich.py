"""The 13-column enrichment (PRJ5): entities, category, sentiment, keywords, risk flag.

Row-local expressions (substring entity lists, the category cascade, split keywords,
the risk flag, the date prefix) are one narrow projection; sentiment is the only
aggregate, computed per distinct text and joined back by the text's digest (rows that share an
id keep their own scores). The text column is dropped before that join, so the join moves short
rows, never whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.dates import date_prefix
from newslake.functions.text import or_chain
from newslake.operators.classify import classify, insolvency_risk
from newslake.operators.keywords import simple_keywords
from newslake.operators.match import detect_entities
from newslake.operators.sentiment import sentiment_label, sentiment_scores, text_key
from newslake.schemas import ENRICHED_COLUMNS


def enrich_articles(df: DataFrame, lexicon: DataFrame, *, id_col: str = "id", texts: DataFrame | None = None, **lists) -> DataFrame:
    """``id`` plus the enriched columns, in their fixed order.

    ``texts`` (``id, content``) is what sentiment scores; by default ``df`` itself. Pass the
    articles *before* joins that only add columns (e.g. the publication time), so the
    scoring branch does not repeat them.

    ``lists`` may override the entity lists of ``detect_entities`` (platforms,
    competitors, funds, brand_keywords), ``cascade`` of ``classify`` and the
    ``insolvency`` terms of the risk flag.
    """
    cascade = lists.pop("cascade", None)
    risk_terms = lists.pop("insolvency", None)
    content = F.coalesce(F.col("content"), F.lit(""))
    title = F.coalesce(F.col("title"), F.lit(""))
    published = F.col("published_at") if "published_at" in df.columns else F.lit(None).cast("string")
    if "published" in df.columns:
        published = or_chain(published, F.col("published"))
    text = F.concat(content, F.lit(" "), title)
    base = df.withColumn("_text", text)
    tagged = detect_entities(base, text=F.col("_text"), **lists)
    by_lang = "lang" in lexicon.columns and "lang" in df.columns
    narrow = tagged.select(
        F.col(id_col), text_key(df, content, by_lang).alias("_skey"),
        date_prefix(published).alias("date"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        title.alias("title"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        (classify(F.col("_text")) if cascade is None else classify(F.col("_text"), cascade)).alias("category"),
        "platforms_mentioned", "competitors_mentioned", "funds_mentioned", "companies_mentioned",
        simple_keywords(F.col("_text")).alias("keywords"),
        (insolvency_risk(content) if risk_terms is None else insolvency_risk(content, risk_terms)).alias("insolvency_risk"),
    )
    scored = df if texts is None else texts
    scores = sentiment_scores(scored, lexicon, text=content)
    out = narrow.join(scores, "_skey", "left").withColumn(
        "sentiment_score", F.coalesce(F.col("sentiment_score"), F.lit(0.0))
    ).withColumn("sentiment_label", sentiment_label("sentiment_score"))
    return out.select(id_col, *ENRICHED_COLUMNS)


__all__ = ["enrich_articles"]
