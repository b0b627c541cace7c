"""Queries for the source operators: uniform union, API payloads, HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.dates import iso_seconds
from newslake.functions.text import NAMED_REFERENCES, strip, truncate_title
from newslake.plans import sqlparts as S
from newslake.plans.registry import query
from newslake.plans.tables import doc_articles, table
from newslake.session import materialize
from newslake.sources.html import site_base

BLOCKS_RE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)"
BASE_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"
ANCHOR_RE = r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a\s*>"""


def decode_sql(x: str) -> str:
    """The named character references (the tables' texts hold no numeric ones)."""
    for ent, ch in NAMED_REFERENCES:
        x = f"replace({x}, {S.lit(ent)}, {S.lit(ch)})"
    return x


def strip_tags_sql(x: str) -> str:
    return S.strip(decode_sql(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


def first_tag_sql(body: str, tag: str) -> str:
    return strip_tags_sql(f"regexp_extract({body}, {S.lit(rf'(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>')}, 1)")


PAGES_CTE = f"pg AS (SELECT page_id, url, html, regexp_replace(html, {S.lit(BLOCKS_RE)}, '', 'g') AS body FROM pages)"


def _text_article_sql(text: str) -> tuple[str, str]:
    c = S.strip(f"coalesce({text}, '')")
    return S.title_from(c), c


_bt, _bc = _text_article_sql("text")
UNION_SQL = f"""WITH {S.ARTICLES_CTE}, {PAGES_CTE}
SELECT 0 AS source_ord, source || ' [Docs]' AS source, url, title, content FROM art
UNION ALL
SELECT 1, regexp_extract(url, {S.lit(HOST_RE)}, 1) || ' [Web]', url, {first_tag_sql('body', 'title')}, {first_tag_sql('body', 'p')} FROM pg
UNION ALL
SELECT 2, 'Benchmark [Bench]', 'bench://' || CAST(item_id AS VARCHAR), {_bt}, {_bc} FROM benchmark
UNION ALL
SELECT 3, 'Chat – ' || role || ' [Chat]', 'chat://' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR), {_bt}, {_bc}
FROM conversations
"""


@query("uniform_union", UNION_SQL)
def q_uniform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.normalize import uniform_articles
    from newslake.sources.html import page_meta

    docs = doc_articles(spark, sf_dir)
    docs_u = uniform_articles(
        docs, source=F.concat("source", F.lit(" [Docs]")), url="url", title="title",
        published_at=F.lit(""), content="content", extra={"source_ord": F.lit(0)},
    )
    pages = table(spark, sf_dir, "pages")
    meta = page_meta(pages.select("page_id", "url", "html"), id_col="page_id", keep=("url",))
    pages_u = uniform_articles(
        meta, source=F.concat(F.regexp_extract("url", HOST_RE, 1), F.lit(" [Web]")), url="url",
        title="title", published_at=F.lit(""), content="first_p", extra={"source_ord": F.lit(1)},
    )

    def text_rows(df: DataFrame, source, url, ord_: int) -> DataFrame:
        c = strip(F.coalesce(F.col("text"), F.lit("")))
        return uniform_articles(df, source=source, url=url, title=truncate_title(c), published_at=F.lit(""),
                                content=c, extra={"source_ord": F.lit(ord_)})

    bench = text_rows(table(spark, sf_dir, "benchmark"), F.lit("Benchmark [Bench]"),
                      F.concat(F.lit("bench://"), F.col("item_id").cast("string")), 2)
    conv = text_rows(
        table(spark, sf_dir, "conversations"), F.concat(F.lit("Chat – "), "role", F.lit(" [Chat]")),
        F.concat(F.lit("chat://"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")), 3,
    )
    out = docs_u.unionByName(pages_u).unionByName(bench).unionByName(conv)
    return out.select("source_ord", "source", "url", "title", "content")


PAYLOAD_SQL = """SELECT event_id, 0 AS pos, event_type || ' [NewsAPI]' AS source,
       'https://events.example/' || CAST(event_id AS VARCHAR) AS url, 'Event ' || CAST(event_id AS VARCHAR) AS title,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published_at,
       CASE WHEN event_type IN ('view', 'click') THEN 'k=' || json_extract_string(props, '$.k') ELSE props END AS content
FROM events WHERE event_type <> 'error'
"""


@query("payload_explode", PAYLOAD_SQL)
def q_payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event becomes a landed search-API payload (error events: a failed call)."""
    from newslake.sources.feeds import payload_articles

    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    article = F.struct(
        F.struct(F.lit(None).cast("string").alias("id"), et.alias("name")).alias("source"),
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("k="), F.get_json_object("props", "$.k")).alias("description"),
        F.concat(F.lit("https://events.example/"), F.col("event_id").cast("string")).alias("url"),
        iso_seconds("ts").alias("publishedAt"),
        F.when(et == "view", F.lit("")).when(et == "click", F.lit(None)).otherwise(F.col("props")).alias("content"),
    )
    payload = F.to_json(F.struct(
        F.when(et == "error", F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.array(article).alias("articles"),
    ))
    rows = payload_articles(ev.select("event_id", payload.alias("payload")), "payload", "newsapi", keep=("event_id",))
    return rows.select("event_id", "pos", "source", "url", "title", "published_at", "content")


LINKS_SQL = f"""WITH {PAGES_CTE},
l AS (SELECT page_id, url, regexp_extract_all(body, {S.lit(ANCHOR_RE)}, 1) AS hrefs,
             regexp_extract_all(body, {S.lit(ANCHOR_RE)}, 2) AS inners FROM pg),
q AS (SELECT page_id, url, unnest(hrefs) AS raw, unnest(inners) AS inner_html,
             unnest(range(len(hrefs))) AS pos FROM l),
u AS (SELECT *, {decode_sql("""regexp_replace(raw, '^["'']|["'']$', '', 'g')""")} AS href FROM q)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, {strip_tags_sql('inner_html')} AS text,
       CASE WHEN starts_with(href, 'http') THEN href ELSE regexp_extract(url, {S.lit(BASE_RE)}, 1) || href END AS abs_url
FROM u
"""


@query("html_links", LINKS_SQL)
def q_html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.sources.html import page_links

    return page_links(table(spark, sf_dir, "pages"))


QUOTING_SQL = """SELECT page_id, pos, CASE pos WHEN 0 THEN 'http://h/c?x=1&y=' || CAST(page_id AS VARCHAR) WHEN 1 THEN '/bare' ELSE '/Ω"é' END AS href,
       CASE pos WHEN 0 THEN 'single é ’' WHEN 1 THEN 'bare' ELSE 'double &#xD800;' END AS text
FROM pages CROSS JOIN (VALUES (0), (1), (2)) AS p(pos)
"""


@query("html_links_quoting", QUOTING_SQL)
def q_html_links_quoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in single, no and double quotes, with character references in links and texts."""
    from newslake.sources.html import page_links

    pid = F.col("page_id").cast("string")
    added = F.concat(
        F.lit("<A class=x HREF = 'http://h/c?x=1&amp;y="), pid, F.lit("'>single &#233; &#x2019;</A><script><a href='no'>no</a></script>"),
        F.lit("<a href=/bare>bare</a><a data-x='1' href=\"/&#937;&quot;&#xe9;\">double &#xD800;</a>"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url", added.alias("html"))
    return page_links(pages).select("page_id", "pos", "href", "text")


FEED_KINDS = 5  # every fifth event's feed is broken in one way or another


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed per event with two items; by id the second one is sound, holds a bare &, or is cut off."""
    ev = table(spark, sf_dir, "events").select("event_id")
    eid = F.col("event_id").cast("string")
    first = F.concat(F.lit("<item><title>A &amp; "), eid, F.lit("</title><link>http://x/"), eid, F.lit("</link></item>"))
    kind = F.col("event_id") % FEED_KINDS
    second = (
        F.when(kind == 1, F.concat(F.lit("<item><title>B & "), eid, F.lit("</title></item></channel></rss>")))
        .when(kind == 2, F.concat(F.lit("<item><title>cut "), eid))
        .otherwise(F.concat(F.lit("<item><title>B "), eid, F.lit("</title><description/></item></channel></rss>")))
    )
    feed = F.concat(F.lit("<?xml version='1.0'?><rss><channel><title>feed</title>"), F.when(kind != 4, first).otherwise(""),
                    F.when(kind != 4, second).otherwise(F.lit("</channel></rss>")))
    return ev.select("event_id", F.concat(F.lit("f"), eid, F.lit(".xml")).alias("file"), feed.alias("value"))


FEED_ITEMS_SQL = f"""WITH e AS (SELECT event_id, 'f' || CAST(event_id AS VARCHAR) || '.xml' AS file, event_id % {FEED_KINDS} AS k FROM events)
SELECT file, 0 AS pos, 'A & ' || CAST(event_id AS VARCHAR) AS title, k NOT IN (1, 2) AS in_whole FROM e WHERE k <> 4
UNION ALL SELECT file, 1, 'B ' || CAST(event_id AS VARCHAR), true FROM e WHERE k IN (0, 3)
"""


@query("feed_items", FEED_ITEMS_SQL)
def q_feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound items with their place in the feed; ``in_whole``: also kept where a broken item drops its feed."""
    from newslake.sources.feeds import feed_items, parse_feeds

    parsed = materialize(parse_feeds(_feeds(spark, sf_dir)), "parsed-feeds")  # read three times below
    whole = feed_items(parsed, whole_feed=True).select("file", "pos", F.lit(True).alias("in_whole"))
    return feed_items(parsed).join(whole, ["file", "pos"], "left").select(
        "file", "pos", "title", F.coalesce("in_whole", F.lit(False)).alias("in_whole"))


FEED_REJECTS_SQL = f"""SELECT 'f' || CAST(event_id AS VARCHAR) || '.xml' AS file, 1 AS pos, 'malformed item' AS reason
FROM events WHERE event_id % {FEED_KINDS} IN (1, 2)
"""


@query("feed_rejects", FEED_REJECTS_SQL)
def q_feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.sources.feeds import feed_rejects, parse_feeds

    return feed_rejects(parse_feeds(_feeds(spark, sf_dir)))


PAYLOAD_REJECTS_SQL = """SELECT event_id, CASE event_type WHEN 'error' THEN 'error status' WHEN 'view' THEN 'malformed JSON'
  ELSE 'no articles' END AS reason FROM events WHERE event_type IN ('error', 'view', 'click')
"""


@query("payload_rejects", PAYLOAD_REJECTS_SQL)
def q_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.sources.feeds import payload_rejects

    et = F.col("event_type")
    payload = (
        F.when(et == "error", F.lit('{"status": "error", "message": "limit"}'))
        .when(et == "view", F.lit('{"status": "ok", "articles": ['))
        .when(et == "click", F.lit('{"status": "ok"}'))
        .otherwise(F.lit('{"status": "ok", "articles": [{"title": "t"}]}'))
    )
    return payload_rejects(table(spark, sf_dir, "events").select("event_id", payload.alias("p")), "p", keep=("event_id",))


META_SQL = f"""WITH {PAGES_CTE}
SELECT page_id, {first_tag_sql('body', 'title')} AS title, {first_tag_sql('body', 'h1')} AS h1,
       {first_tag_sql('body', 'p')} AS first_p
FROM pg
"""


@query("html_article_meta", META_SQL)
def q_html_article_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.sources.html import page_meta

    return page_meta(table(spark, sf_dir, "pages"))


SECTION_SIZE = 8


def _section_pages(pages: DataFrame) -> DataFrame:
    """One section page per site and block of ``SECTION_SIZE`` consecutive page ids.

    Each group is bounded by construction (at most ``SECTION_SIZE`` teasers), so the
    grouped concatenation never gathers an unbounded group.
    """
    base = site_base("url")
    path = F.replace(F.substr(F.col("url"), F.length(base) + 1), F.lit("&"), F.lit("&amp;"))
    third = F.col("page_id") % 3
    link = (
        F.when(third == 0, F.concat(F.lit('"'), base, path, F.lit('"')))  # absolute
        .when(third == 1, F.concat(F.lit("'"), path, F.lit("'")))
        .otherwise(F.concat(F.lit('"'), path, F.lit('"')))
    )
    frag = F.concat(
        F.lit("<h2><a href="), link, F.lit(">Story "), F.col("page_id").cast("string"),
        F.lit('</a></h2><div class="meta">by desk</div><p>Teaser '), F.col("page_id").cast("string"), F.lit("</p>"),
    )
    grouped = pages.select(
        base.alias("base"), F.floor(F.col("page_id") / SECTION_SIZE).alias("block"), "page_id", frag.alias("frag")
    ).groupBy("base", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "frag"))), lambda x: x["frag"]), "").alias("body")
    )
    return grouped.select(
        F.concat("base", F.lit("#"), F.col("block").cast("string")).alias("section"),
        "base",
        F.concat(F.lit("<html><body><h2>Latest</h2><p>intro</p>"), F.col("body"), F.lit("</body></html>")).alias("html"),
    )


def _ld_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a synthesized JSON-LD block whose shape depends on the page language."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    stamp = F.date_format(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("page_id").cast("int")),
        "yyyy-MM-dd'T'HH:mm:ss",
    )
    pid = F.col("page_id").cast("string")
    tag_open, tag_close = F.lit('<script type="application/ld+json">'), F.lit("</script>")
    en = F.concat(tag_open, F.lit('{"@type":"NewsArticle","datePublished":"'), stamp, F.lit('+02:00","description":"D'), pid, F.lit('"}'), tag_close)
    fr = F.concat(tag_open, F.lit('[{"@type":"WebPage","name":"x"},{"@type":"NewsArticle","uploadDate":"'), stamp,
                  F.lit('","articleBody":"B'), pid, F.lit('"}]'), tag_close)
    de = F.concat(tag_open, F.lit('{"@type": "NewsArticle", "description": '), tag_close,
                  tag_open, F.lit('{"@type":"NewsArticle","datePublished":"not a date","description":"G'), pid, F.lit('"}'), tag_close)
    other = F.concat(tag_open, F.lit('{"@type":"WebPage"}'), tag_close)
    block = F.when(lang == "en", en).when(lang == "fr", fr).when(lang == "de", de).otherwise(other)
    return pages.select("page_id", F.concat("html", block).alias("html"))


DEEP_SQL = f"""WITH p AS (
  SELECT page_id, url, regexp_extract(url, {S.lit(BASE_RE)}, 1) AS base, CAST(floor(page_id / {SECTION_SIZE}) AS BIGINT) AS block,
         regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 MINUTE, '%Y-%m-%d') AS d
  FROM pages
), a AS (
  SELECT base || '#' || CAST(block AS VARCHAR) AS section, block,
         CAST(row_number() OVER (PARTITION BY base, block ORDER BY page_id) AS BIGINT) AS pos,
         'Story ' || CAST(page_id AS VARCHAR) AS title, url, page_id,
         CASE lang WHEN 'en' THEN 'D' WHEN 'fr' THEN 'B' WHEN 'de' THEN 'G' ELSE 'Teaser ' END || CAST(page_id AS VARCHAR) AS content,
         CASE lang WHEN 'en' THEN d WHEN 'fr' THEN d WHEN 'de' THEN 'not a date' ELSE '' END AS published
  FROM p
)
SELECT section, pos, title, url, page_id, content, published FROM a
WHERE block % 4 <> 0 OR contains(lower(title || ' ' || content), 'teaser') OR contains(lower(title || ' ' || content), 'story 1')
"""


@query("link_deep_join", DEEP_SQL)
def q_link_deep_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page collector: absolute and relative links, JSON-LD or teaser text, sections with keyword lists."""
    from newslake.sources.html import section_articles

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    sections = _section_pages(pages)
    block = F.split_part("section", F.lit("#"), F.lit(2)).cast("long")
    words = F.array(F.lit("teaser"), F.lit("story 1"))
    config = sections.select("section", F.when(block % 4 == 0, words).otherwise(F.array().cast("array<string>")).alias("keywords"))
    fetched = pages.select("page_id", "url").join(_ld_pages(spark, sf_dir), "page_id")
    out = section_articles(sections, fetched, config, keep=("page_id",))
    return out.select(
        F.col("source").alias("section"), F.col("pos").cast("long").alias("pos"), "title", "url", "page_id", "content",
        F.col("published_at").alias("published"),
    )


JSONLD_SQL = """WITH p AS (
  SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 MINUTE, '%Y-%m-%d') AS d
  FROM pages
)
SELECT page_id,
       CASE lang WHEN 'de' THEN 'not a date' ELSE d END AS published,
       CASE lang WHEN 'en' THEN 'D' WHEN 'fr' THEN 'B' ELSE 'G' END || CAST(page_id AS VARCHAR) AS snippet
FROM p WHERE lang IN ('en', 'fr', 'de')
"""


@query("jsonld_news", JSONLD_SQL)
def q_jsonld_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.sources.html import jsonld_article

    return jsonld_article(_ld_pages(spark, sf_dir))
