"""Fixed schemas of the article data model."""

from __future__ import annotations

from pyspark.sql import types as T

STR = T.StringType()
STR_ARRAY = T.ArrayType(T.StringType())

# Core article fields, in the order the collectors emit them.
ARTICLE_FIELDS = ["source", "url", "title", "published_at", "content", "platforms_mentioned"]

# The wider article schema: optional fields seen in landed batches.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("source", STR),
        T.StructField("url", STR),
        T.StructField("title", STR),
        T.StructField("published_at", STR),
        T.StructField("content", STR),
        T.StructField("platforms_mentioned", STR_ARRAY),
        T.StructField("link", STR),
        T.StructField("id", STR),
        T.StructField("headline", STR),
        T.StructField("text", STR),
        T.StructField("published", STR),
        T.StructField("published_parsed", T.ArrayType(T.IntegerType())),
        T.StructField("keywords", STR_ARRAY),
    ]
)

# Enriched output, in its fixed column order.
ENRICHED_COLUMNS = [
    "date", "source", "title", "url", "category", "sentiment_label", "sentiment_score",
    "platforms_mentioned", "competitors_mentioned", "funds_mentioned", "companies_mentioned",
    "keywords", "insolvency_risk",
]
ENRICHED_LIST_COLUMNS = [
    "platforms_mentioned", "competitors_mentioned", "funds_mentioned", "companies_mentioned", "keywords",
]

# Entity dictionary as landed (CSV) and as used (one row per alias).
ENTITY_CSV_SCHEMA = T.StructType(
    [T.StructField("entity_name", STR), T.StructField("category", STR), T.StructField("aliases", STR)]
)

NO_HIT_STATUS = "no company in the news"
