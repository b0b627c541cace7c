"""End-to-end batch jobs over landed files, one function per stage of the news flow.

collect (feeds/payloads -> one batch) -> compact (hourly snapshots -> day) -> merge
(batch -> all-time and quarter tables) -> tag (entity dictionary) -> digest (per day)
-> enrich (entities, category, sentiment, keywords, risk). Every stage takes and returns
DataFrames; the ``write_*`` helpers persist a stage's output as a new table version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.dates import quarter_label
from newslake.operators.dedupe import dedupe_first, key_chain, object_key
from newslake.operators.digest import daily_digest
from newslake.operators.enrich import enrich_articles
from newslake.operators.filters import QUERY, apply_query_filter
from newslake.operators.keywords import with_ranked_keywords
from newslake.operators.language import identify_language
from newslake.operators.match import entity_dictionary, tag_entities
from newslake.operators.merge import merge_quarter, merge_upsert
from newslake.operators.normalize import normalize_articles
from newslake.operators.order import newest_first
from newslake.sources.feeds import COLLECTORS, landed_texts, payload_articles, read_rss_items, rss_articles, union_sources
from newslake.sources.json_files import read_json_arrays, with_seq
from newslake.schemas import ARTICLE_FIELDS

PAYLOAD_KINDS = ("newsapi", "gnews")


def collect_batch(
    spark: SparkSession,
    landed: dict[str, str | list[str]],
    *,
    query: str = QUERY,
    filtering: bool = False,
    top_k: int = 10,
    labels: DataFrame | None = None,
    collected: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Collector flow: every landed source -> uniform articles -> union -> keywords.

    ``landed`` maps a collector kind to its landed files (RSS XML, or JSON payloads for
    ``newsapi``/``gnews``); ``labels`` names feeds by file (``rss_articles``); ``collected`` holds
    articles that are already uniform, such as those of ``section_articles``. ``seq`` orders the batch: collector order, file, position.
    """
    frames = []
    for kind, paths in landed.items():
        if kind in PAYLOAD_KINDS:
            raw = landed_texts(spark, paths)
            arts = payload_articles(raw, "value", kind, keep=("file",))
        elif kind in COLLECTORS and kind != "crunchbase":
            arts = rss_articles(read_rss_items(spark, paths, whole_feed=COLLECTORS[kind].whole_feed), kind, labels=labels)
        else:
            raise ValueError(f"unknown collector kind {kind!r}; pages are collected by section_articles")
        frames.append((kind, apply_query_filter(arts, query, enabled=filtering)))
    for kind, arts in (collected or {}).items():
        frames.append((kind, apply_query_filter(arts, query, enabled=filtering)))
    batch = union_sources(frames)
    batch = batch.withColumn("seq", F.struct("source_ord", "file", "pos")).withColumn(
        "id", F.sha2(F.to_json(F.col("seq")), 256)
    )
    text = F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "), F.coalesce(F.col("content"), F.lit("")))
    return with_ranked_keywords(batch.withColumn("_kw_text", text), id_col="id", text="_kw_text", top_k=top_k).drop(
        "_kw_text", "id"
    )


def finanzen_snapshot(
    spark: SparkSession, paths: str | list[str], *, top_k: int = 10, profile: DataFrame | None = None,
) -> DataFrame:
    """German feed snapshot: transliterated title, ISO time, content = ranked title keywords.

    The keyword ranking runs on the transliterated title (one short text per item), the
    top terms joined with ``', '`` become the content, as the snapshot writer stores them. With a
    language ``profile`` (``train_profile``) each title loses the stopwords of its own language.
    """
    from newslake.sources.feeds import finanzen_articles

    items = finanzen_articles(read_rss_items(spark, paths))
    keyed = items.withColumn("_kid", F.sha2(F.to_json(F.struct("file", "pos")), 256))
    lang_col = None
    if profile is not None:
        keyed = keyed.join(identify_language(keyed, profile, id_col="_kid", text="title", out="_lang"), "_kid")
        lang_col = "_lang"
    kw = with_ranked_keywords(keyed, id_col="_kid", text="title", top_k=top_k, lang_col=lang_col).drop("_lang")
    return kw.withColumn("content", F.array_join("keywords", ", ")).drop("_kid", "keywords")


def combine_snapshots(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Snapshot compaction: hourly JSON arrays -> first-seen items (``id or url or title``)."""
    rows, rejects = read_json_arrays(spark, paths)
    rows = with_seq(rows)
    ident = F.col("id")
    kept = dedupe_first(rows, key_chain(ident, F.col("url"), F.col("title")), ["seq"], null_key="keep")
    return kept, rejects


def article_key(df: DataFrame, object_cols: list[str] | None = None) -> Column:
    """Merge key: ``link or id or url``, else the canonical whole object."""
    cols = object_cols or [c for c in ARTICLE_FIELDS if c in df.columns]
    link = F.col("link") if "link" in df.columns else F.lit(None).cast("string")
    ident = F.col("id") if "id" in df.columns else F.lit(None).cast("string")
    return key_chain(link, ident, F.col("url"), object_key(df, cols))


def merge_batch(
    existing: DataFrame | None, batch: DataFrame, *, processing_date: str, quarter_table: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All-time and quarter upserts of one batch (SNK3, SNK4). Returns (all_time, quarter table).

    The two tables are merged on their own: an article known to the all-time table still enters the
    quarter of the processing date if that quarter does not hold it. Both come newest first (ORD1).
    """
    b = batch.withColumn("_key", article_key(batch))

    def known(df: DataFrame | None, like: DataFrame) -> DataFrame:
        if df is None:
            return like.limit(0)
        return (df.drop("origin") if "origin" in df.columns else df).withColumn("_key", article_key(df))

    day = F.to_date(F.lit(processing_date))
    merged = merge_upsert(known(existing, b), b, key="_key", order=["seq"]).drop("_key")
    with_quarter = b.withColumn("quarter", quarter_label(day))
    quarter = merge_quarter(
        known(quarter_table, with_quarter), b, key="_key", order=["seq"], processing_date=day).drop("_key")
    return newest_first(merged, ["seq"]), newest_first(quarter, ["seq"])


def tag_batch(articles: DataFrame, entities_csv: DataFrame, *, alias_sep: str | None = ";", boundary: str = "lenient", on_error: str = "quarantine", order: str | None = None) -> DataFrame:
    """Tagger flow: validate/normalize (FIL9, PRJ3) then whole-word dictionary tags (JOI1).

    ``platforms_mentioned`` is replaced whole, so re-tagging is idempotent (SNK5).
    """
    norm = normalize_articles(articles, on_error=on_error)
    dictionary = entity_dictionary(entities_csv, alias_sep=alias_sep, order=order)
    return tag_entities(norm, dictionary, boundary=boundary)


def digest_batch(tagged: DataFrame, *, formats: str = "iso") -> DataFrame:
    """Digest flow over tagged rows (valid ones only)."""
    return daily_digest(tagged.filter(F.col("valid")), order=["seq"], formats=formats)


def enrich_batch(articles: DataFrame, lexicon: DataFrame, **lists) -> DataFrame:
    """Analyzer flow: the 13 enriched columns per article (id = row key)."""
    keyed = articles.withColumn("_eid", article_key(articles))
    return enrich_articles(keyed, lexicon, id_col="_eid", **lists).drop("_eid")


__all__ = [
    "article_key", "collect_batch", "combine_snapshots", "finanzen_snapshot", "digest_batch", "enrich_batch", "merge_batch", "tag_batch",
]
