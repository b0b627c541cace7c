"""Landed feed files and API payloads -> uniform articles (SRC4, SRC5, PRJ1, PRJ2, SET1).

Collectors differ only in labels and fallback rules, so each is a row of
``COLLECTORS``: the label template, whether the title/content are stripped, and whether
a fallback applies when the first field is *absent* (``presence``) or also when it is
*empty* (``empty``). Feeds are cut at their items, each parsed by ``from_xml``; search-API
payloads are JSON documents exploded on ``articles``. What cannot be read gives a reject row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.functions.dates import iso_seconds, parse_published
from newslake.functions.text import or_chain, strip, transliterate_de
from newslake.operators.normalize import uniform_articles

RSS_ITEM_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("pubDate", T.StringType()),
        T.StructField("published", T.StringType()),
        T.StructField("guid", T.StringType()),
    ]
)

_SRC = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source", _SRC),
                        T.StructField("author", T.StringType()),
                        T.StructField("title", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("url", T.StringType()),
                        T.StructField("publishedAt", T.StringType()),
                        T.StructField("content", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

class Collector(NamedTuple):
    """Label template and rules of one collector."""

    label: str
    stripped: bool  # title and content
    summary: str  # fallback: presence, empty or none
    published: str
    whole_feed: bool = False  # one broken item drops the feed


# Per-collector label templates and fallback rules, in union order.
COLLECTORS = {
    "bloomberg": Collector("Bloomberg – {name} [RSS]", False, "presence", "none"),
    "newsapi": Collector("{name} [NewsAPI]", False, "empty", "none"),
    "gnews": Collector("{name} [GNews]", False, "none", "none"),
    "investing": Collector("{name}", False, "none", "none"),
    "sec": Collector("SEC Press Releases [RSS]", False, "none", "none"),
    "crunchbase": Collector("{name}", False, "empty", "none"),
    "cnbc": Collector("{name} [RSS]", True, "empty", "presence", True),
    "yahoo": Collector("{name} [RSS]", True, "empty", "empty", True),
    "sifted": Collector("Sifted — {name} [RSS]", False, "presence", "none"),
    "finanzen": Collector("finanzen.net", False, "none", "none"),
}
UNION_ORDER = ["bloomberg", "newsapi", "gnews", "investing", "sec", "crunchbase", "cnbc", "yahoo", "sifted"]


ITEM_START = r"(?i)(?=<item[\s>])"
ITEM = r"(?is)^(<item\b.*?</item\s*>)"


def landed_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, value)`` of landed files; paths that match nothing give no rows."""
    try:
        raw = spark.read.text(paths, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, value string")
    return raw.select(F.col("_metadata.file_name").alias("file"), "value")


def parse_feeds(raw: DataFrame) -> DataFrame:
    """``file, pos, item, broken``: every ``item`` element of ``(file, value)`` feeds, in feed order.

    A feed is cut at its items, so ``pos`` is the item's place in its own file whatever other files there
    are, and one broken item does not hide the others. A feed without any item gives one row with ``pos`` -1,
    broken unless the feed is closed properly.
    """
    parts = F.split("value", ITEM_START)
    parts = raw.select("file", "value", F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))).alias("_items"))
    end = F.rtrim("value", F.lit(" \t\r\n"))
    rows = parts.select("file", end.alias("_feed"), F.posexplode_outer("_items").alias("pos", "_part"))
    rows = rows.withColumn("xml", F.nullif(F.regexp_extract("_part", ITEM, 1), F.lit("")))
    schema = T.StructType([*RSS_ITEM_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    item = F.from_xml("xml", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = rows.withColumn("item", item)
    closed = F.col("_feed").rlike(r"(?i)</(?:rss|feed|rdf:RDF)>$")
    return rows.select(
        "file", F.coalesce("pos", F.lit(-1)).alias("pos"), "item",
        F.when(F.col("pos").isNull(), ~closed).otherwise(
            F.col("item").isNull() | F.col("item._corrupt_record").isNotNull()).alias("broken"),
    )


def read_rss_items(spark: SparkSession, paths: str | list[str], *, whole_feed: bool = False) -> DataFrame:
    """RSS ``item`` elements of landed feed files: ``file, pos, <item fields>``.

    Broken items are left out and reported by ``feed_rejects``; with ``whole_feed`` a feed that holds a broken
    item contributes nothing, as the collectors that check the parser's flag do it.
    """
    return feed_items(parse_feeds(landed_texts(spark, paths)), whole_feed=whole_feed)


def feed_items(parsed: DataFrame, *, whole_feed: bool = False) -> DataFrame:
    """The sound items of ``parse_feeds`` rows."""
    items = parsed.where(~F.col("broken") & (F.col("pos") >= 0))
    if whole_feed:
        items = items.join(parsed.where("broken").select("file").distinct(), "file", "left_anti")
    return items.select("file", "pos", *[F.col(f"item.{f.name}").alias(f.name) for f in RSS_ITEM_SCHEMA.fields])


def feed_rejects(parsed: DataFrame) -> DataFrame:
    """``(file, pos, reason)`` of what ``parse_feeds`` could not read."""
    reason = F.when(F.col("pos") < 0, F.lit("no item")).otherwise(F.lit("malformed item"))
    return parsed.where("broken").select("file", "pos", reason.alias("reason"))


def payload_rejects(df: DataFrame, payload: Column | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(<keep>, reason)`` of payloads that give no articles: malformed JSON, an error status, no list."""
    text = F.col(payload) if isinstance(payload, str) else payload
    parsed = df.select(*keep, text.alias("_t"), F.from_json(text, PAYLOAD_SCHEMA).alias("_p"))
    sound = F.try_parse_json("_t").isNotNull()
    reason = (
        F.when(~sound, F.lit("malformed JSON"))
        .when(F.coalesce(F.col("_p.status"), F.lit("ok")) != "ok", F.lit("error status"))
        .when(F.col("_p.articles").isNull(), F.lit("no articles"))
    )
    return parsed.select(*keep, reason.alias("reason")).where("reason is not null")


def _label(kind: str, name: Column) -> Column:
    template = COLLECTORS[kind].label
    if "{name}" not in template:
        return F.lit(template)
    pre, post = template.split("{name}")
    return F.concat(F.lit(pre), name, F.lit(post))


def rss_articles(
    items: DataFrame, kind: str, feed_name: Column | None = None, extra: dict[str, Column] | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Uniform articles from RSS items under one collector's rules (PRJ1, PRJ2).

    ``summary`` is the item's description (the feed parser's name for it). ``presence``
    fallback applies only when the field is absent (NULL); ``empty`` also when ``''``.
    The feed's name is ``feed_name``, else that of its file in the config table ``labels(file,
    label)``, else the file name without its ending.
    """
    _, stripped, summary_rule, pub_rule, _ = COLLECTORS[kind]
    if labels is not None:
        items = items.join(labels.select("file", F.col("label").alias("_label")), "file", "left")
        feed_name = F.coalesce(F.col("_label"), F.regexp_replace(F.col("file"), r"\.[^.]*$", ""))
    name = feed_name if feed_name is not None else F.regexp_replace(F.col("file"), r"\.[^.]*$", "")
    summary = F.coalesce(F.col("summary"), F.col("description")) if "summary" in items.columns else F.col("description")
    if summary_rule == "presence":
        content = F.coalesce(summary, F.col("description"), F.lit(""))
    elif summary_rule == "empty":
        content = F.coalesce(or_chain(summary, F.col("description")), F.lit(""))
    else:
        content = F.coalesce(summary, F.lit(""))
    published = F.coalesce(F.col("published"), F.col("pubDate")) if "published" in items.columns else F.col("pubDate")
    if pub_rule == "presence":
        pub = F.coalesce(published, F.col("pubDate"), F.lit(""))
    elif pub_rule == "empty":
        pub = F.coalesce(or_chain(published, F.col("pubDate")), F.lit(""))
    else:
        pub = F.coalesce(published, F.lit(""))
    title = F.coalesce(F.col("title"), F.lit(""))
    if stripped:
        title, content = strip(title), strip(content)
    return uniform_articles(
        items, source=_label(kind, name), url=F.coalesce(F.col("link"), F.lit("")), title=title,
        published_at=pub, content=content,
        extra={"file": F.col("file"), "pos": F.col("pos"), **(extra or {})},
    )


def finanzen_articles(items: DataFrame) -> DataFrame:
    """The German feed: transliterated title, ISO ``published_at`` from the parsed date."""
    return uniform_articles(
        items, source=F.lit("finanzen.net"), url=F.col("link"), title=transliterate_de(F.col("title")),
        published_at=iso_seconds(parse_published(F.col("pubDate"))), content=F.lit(""),
        extra={"file": F.col("file"), "pos": F.col("pos")},
    )


def payload_articles(df: DataFrame, payload: Column | str, kind: str = "newsapi", keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode a search-API payload (JSON text) into uniform articles (SRC5).

    A payload whose ``status`` is not ``ok`` (the HTTP/API error case) yields no rows.
    ``keep`` names columns of ``df`` carried through (ids, file names); ``pos`` is the
    article's position in its payload.
    """
    p = F.from_json(F.col(payload) if isinstance(payload, str) else payload, PAYLOAD_SCHEMA)
    # Parse once into a column; ``posexplode_outer`` avoids the size/not-null filter that
    # Catalyst infers for ``posexplode`` (which would re-run the JSON parse per row).
    parsed = df.select(*keep, p.alias("_p"))
    ok_articles = F.when(F.coalesce(F.col("_p.status"), F.lit("ok")) == F.lit("ok"), F.col("_p.articles"))
    rows = (
        parsed.select(*keep, F.posexplode_outer(ok_articles).alias("pos", "a"))
        .filter(F.col("pos").isNotNull())
    )
    a = F.col("a")
    if kind == "newsapi":
        name, url, title, pub = a["source"]["name"], a["url"], a["title"], a["publishedAt"]
        content = F.coalesce(or_chain(a["content"], a["description"]), F.lit(""))
    elif kind == "gnews":
        name = F.coalesce(a["source"]["name"], F.lit("N/A"))
        url, title, pub = (F.coalesce(a[k], F.lit("")) for k in ("url", "title", "publishedAt"))
        content = F.coalesce(a["description"], F.lit(""))
    else:
        raise ValueError(f"unknown payload kind {kind!r}")
    extra = {k: F.col(k) for k in keep}
    extra["pos"] = F.col("pos")
    return uniform_articles(rows, source=_label(kind, name), url=url, title=title, published_at=pub, content=content, extra=extra)


def union_sources(frames: list[tuple[str, DataFrame]]) -> DataFrame:
    """SET1: UNION ALL in collector order with ``source_ord`` recording that order."""
    out = None
    for kind, df in frames:
        ordered = df.withColumn("source_ord", F.lit(UNION_ORDER.index(kind) if kind in UNION_ORDER else len(UNION_ORDER)))
        out = ordered if out is None else out.unionByName(ordered, allowMissingColumns=True)
    return out


__all__ = [
    "COLLECTORS", "PAYLOAD_SCHEMA", "RSS_ITEM_SCHEMA", "UNION_ORDER", "Collector", "feed_items", "feed_rejects",
    "finanzen_articles", "landed_texts", "parse_feeds", "payload_articles", "payload_rejects", "read_rss_items",
    "rss_articles", "union_sources",
]
