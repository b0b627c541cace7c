"""Named queries over the driver's test tables, each with its DuckDB oracle SQL.

Every query reads whole tables (``documents``, ``events``, ``pages``...) and runs the
package's operators on them; small parameter tables (a test dictionary, a lexicon)
are fixed values, like the reference's own keyword lists. Array outputs are flattened
to strings (``|``-joined, sorted where the operator sorts) so the oracle compares values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.digest import daily_digest, digest_day_status
from newslake.operators.match import dictionary_from_pairs, tag_entities
from newslake.plans import sqlparts as S
from newslake.plans.registry import query
from newslake.plans.tables import doc_articles, with_published


def joined(col: str, sep: str = "|"):
    return F.coalesce(F.array_join(F.col(col), sep), F.lit(""))


# Test dictionary: words that occur in the generated documents (the entity CSV's aliases
# do not), plus aliases that only occur inside longer words (``lend``) and multi-word ones.
TEST_DICTIONARY = [
    ("Thé Holding", "the"),
    ("Und Partners", "und"),
    ("License Capital", "license"),
    ("License Capital", "licence"),
    ("Lend Co", "lend"),
    ("Lendable", "lendable inc."),
    ("Accial Capital", "accial capital"),
    ("Accial Capital Fund 1", "accial capital fund 1"),
]


# As many aliases as a real dictionary has: most of them occur nowhere.
FULL_DICTIONARY = TEST_DICTIONARY + [(f"Holding {i}", f"zq{i} {('capital', 'fund', '& co', 'lending')[i % 4]}") for i in range(300)]


def _test_dictionary(spark: SparkSession) -> DataFrame:
    return dictionary_from_pairs(spark, FULL_DICTIONARY)


def _tag_sql_parts() -> str:
    branches = [
        f"SELECT id, {S.lit(e)} AS entity FROM hay WHERE {S.word_match('h', a.lower())}"
        for e, a in FULL_DICTIONARY
    ]
    return (
        "hay AS (SELECT id, lower(title || ' ' || content) AS h FROM art),\n"
        "m AS (" + "\nUNION ALL ".join(branches) + "),\n"
        "tags AS (SELECT hay.id, coalesce(array_to_string(list_sort(list_distinct(list(m.entity))), '|'), '') AS platforms\n"
        "         FROM hay LEFT JOIN m ON hay.id = m.id GROUP BY hay.id)"
    )


def _tag_docs(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    arts = doc_articles(spark, sf_dir)
    return tag_entities(arts, _test_dictionary(spark), strategy=strategy)


TAG_SQL = f"WITH {S.ARTICLES_CTE}, {_tag_sql_parts()}\nSELECT id, platforms FROM tags"


@query("tag_entities_word", TAG_SQL)
def q_tag_entities_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tag_docs(spark, sf_dir, "literal").select("id", joined("platforms_mentioned").alias("platforms"))


@query("tag_entities_anchor", TAG_SQL)
def q_tag_entities_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tag_docs(spark, sf_dir, "join").select("id", joined("platforms_mentioned").alias("platforms"))


SHARED_URL_SQL = f"""WITH {S.ARTICLES_CTE}, {_tag_sql_parts()}
SELECT art.id, 'src://' || coalesce(source, '') AS url, platforms AS literal_platforms, platforms AS join_platforms
FROM art JOIN tags ON art.id = tags.id
"""


def _shared_url(df: DataFrame) -> DataFrame:
    """Articles that name their source as URL: a few URLs for all rows."""
    return df.withColumn("url", F.concat(F.lit("src://"), F.coalesce(F.col("source"), F.lit(""))))


@query("tag_shared_url", SHARED_URL_SQL)
def q_tag_shared_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share a URL keep their own tags, whatever way the dictionary travels."""
    arts, d = _shared_url(doc_articles(spark, sf_dir)), _test_dictionary(spark)
    out = tag_entities(tag_entities(arts, d, strategy="literal", out="a"), d, strategy="join", out="b")
    return out.select("id", "url", joined("a").alias("literal_platforms"), joined("b").alias("join_platforms"))


EXTRACT_DAY_SQL = (
    "coalesce(nullif(regexp_extract({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}', 0), ''), "
    "CASE WHEN regexp_matches({x}, '^\\d{{8}}(T.*)?$') "
    "THEN strftime(try_strptime(substring({x}, 1, 8), '%Y%m%d'), '%Y-%m-%d') END)"
)


def extract_day_sql(x: str, rfc822: bool = False) -> str:
    base = EXTRACT_DAY_SQL.format(x=x)
    if not rfc822:
        return base
    rfc = (
        f"strftime(try_strptime(nullif(regexp_extract({x}, '(\\d{{1,2}} [A-Za-z]{{3}} \\d{{4}})', 1), ''), "
        f"'%d %b %Y'), '%Y-%m-%d')"
    )
    return base[:-1] + f", {rfc})"


def _spread_days(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication stamps over more than a year, so some days are quiet; every eleventh row has no date."""
    from newslake.functions.dates import iso_seconds
    from newslake.plans.tables import table

    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts")
    moved = F.col("ts") + F.make_dt_interval(days=(F.col("id") % 400).cast("int"))
    stamp = F.when(F.col("id") % 11 == 0, F.lit("n/a")).otherwise(iso_seconds(moved))
    return df.join(ev.select("id", stamp.alias("published_at")), "id", "left")


def tagged_dated_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag on the narrow document rows, drop the text, then attach the publication stamp.

    The tagged rows are written once as a table in the checkpoint folder (the tagging
    stage's output, SNK5) and read back: the digest consumes them twice (hit rows and
    day status), and the lineage is cut after the expensive text work.
    """
    from newslake.session import materialize

    tagged = tag_entities(doc_articles(spark, sf_dir), _test_dictionary(spark), strategy="auto")
    narrow = _spread_days(tagged.drop("content"), spark, sf_dir).select(
        "id", "seq", "title", "url", "published_at", "platforms_mentioned"
    )
    return materialize(narrow, "tagged-articles")


DIGEST_SQL = f"""WITH {S.ARTICLES_CTE}, {_tag_sql_parts()},
dated AS (
  SELECT a.id, a.seq, a.title, a.url, t.platforms, {extract_day_sql("coalesce(p.stamp, '')")} AS day
  FROM art a JOIN tags t ON a.id = t.id LEFT JOIN (
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a'
      ELSE strftime(ts + CAST(event_id % 400 AS INTEGER) * INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') END AS stamp FROM events
  ) p ON a.id = p.event_id
),
valid AS (SELECT * FROM dated WHERE day IS NOT NULL)
SELECT day, CAST(NULL AS VARCHAR) AS status, seq, {S.strip('title')} AS title, url, platforms
FROM valid WHERE platforms <> ''
UNION ALL
SELECT day, 'no company in the news' AS status, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS title,
       CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS platforms
FROM valid GROUP BY day HAVING count(*) FILTER (WHERE platforms <> '') = 0
"""


@query("daily_digest", DIGEST_SQL)
def q_daily_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = daily_digest(tagged_dated_docs(spark, sf_dir), order=["seq"])
    return digest.select(
        "day", "status", "seq", "title", "url",
        F.array_join(F.col("platforms_mentioned"), "|").alias("platforms"),
    )


DIGEST_OBJECT_SQL = f"SELECT day, status, title, url, platforms FROM ({DIGEST_SQL})"


@query("digest_object", DIGEST_OBJECT_SQL)
def q_digest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: the digest written as one object keyed by day over many files, read back."""
    from newslake.operators.digest import read_digest_object, write_digest_object
    from newslake.session import scratch_path

    digest = daily_digest(tagged_dated_docs(spark, sf_dir), order=["seq"])
    path = write_digest_object(digest, scratch_path(spark, "digest-object"), ["seq"])
    return read_digest_object(spark, path).select(
        "day", "status", "title", "url", F.array_join(F.col("platforms_mentioned"), "|").alias("platforms"))


SOURCE_QUERY_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT a.id, a.url, p.published_at FROM art a LEFT JOIN pub p ON a.id = p.id
WHERE a.lang = 'en' AND a.source <> 'src0' AND contains(lower(a.title), 'the')
ORDER BY p.published_at DESC NULLS LAST, a.id LIMIT 100
"""


@query("source_query", SOURCE_QUERY_SQL)
def q_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10, TOP2: language, source and searched-field predicates with the newest-first page cap, on the stored table."""
    from newslake.operators.alltime import AllTimeTable
    from newslake.session import scratch_path

    arts = with_published(doc_articles(spark, sf_dir).drop("content"), spark, sf_dir)
    stored = AllTimeTable(spark, scratch_path(spark, "source-table"), arts.schema, key="url", time="published_at",
                          ties=["id"], buckets=16, cluster=["lang"])
    stored.merge(arts, first=["seq"])
    wanted = (F.col("lang") == "en") & (F.col("source") != "src0") & F.lower("title").contains("the")
    return stored.newest_where(100, wanted).select("id", "url", "published_at")


# --------------------------------------------------------------------------- articles

DIGEST_STATUS_SQL = f"""WITH e AS (
  SELECT event_type = 'error' AND event_id % 29 = 0 AS hit,
         {extract_day_sql("CASE WHEN event_id % 13 = 0 THEN 'undated' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END")} AS day FROM events
)
SELECT day, CASE WHEN count(*) FILTER (WHERE hit) > 0 THEN 'hits' ELSE 'no company in the news' END AS status,
       count(*) AS n_articles, count(*) FILTER (WHERE hit) AS n_hits
FROM e WHERE day IS NOT NULL GROUP BY day
"""


@query("digest_status_only", DIGEST_STATUS_SQL)
def q_digest_status_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.functions.dates import iso_seconds
    from newslake.plans.tables import table

    stamp = F.when(F.col("event_id") % 13 == 0, F.lit("undated")).otherwise(iso_seconds("ts"))
    ev = table(spark, sf_dir, "events").select(stamp.alias("published_at"), "event_type", "event_id")
    return digest_day_status(ev, hit=(F.col("event_type") == "error") & (F.col("event_id") % 29 == 0))


NORMALIZE_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT a.id, a.source, a.lang, a.url, a.title, a.content, p.published_at,
       (a.title <> '' OR a.content <> '') AS valid
FROM art a LEFT JOIN pub p ON a.id = p.id
"""


@query("normalize_articles", NORMALIZE_SQL)
def q_normalize_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.normalize import normalize_articles
    from newslake.plans.tables import table

    raw = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "source", "lang",
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
    )
    arts = normalize_articles(raw)
    return with_published(arts, spark, sf_dir).select(
        "id", "source", "lang", "url", "title", "content", "published_at", "valid"
    )


# An OR query in the collector's syntax over words present in the documents; the
# missing space before one ``OR`` is kept on purpose (the split ignores it).
TEST_QUERY = "license OR avecOR Mit OR zebra crossing"


def _terms_sql(hay: str, terms: list[str]) -> str:
    return S.any_contains(hay, terms)


QUERY_FILTER_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT id, url FROM art
WHERE {_terms_sql("lower(title || ' ' || content)", [t.strip().lower() for t in TEST_QUERY.split("OR")])}
"""


@query("query_filter_or", QUERY_FILTER_SQL)
def q_query_filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.filters import apply_query_filter

    return apply_query_filter(doc_articles(spark, sf_dir), TEST_QUERY, enabled=True).select("id", "url")


# Section config: keyword lists for some sections, none (keep all) for the others.
TEST_SECTIONS = [("src0", ["license", "und"]), ("src1", ["the"]), ("src2", ["zebra"]), ("src3", [])]


def _sections_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEST_SECTIONS, "section string, keywords array<string>")


def _sections_sql() -> str:
    rows = ", ".join(
        f"({S.lit(s)}, [{', '.join(S.lit(k) for k in kws)}]::VARCHAR[])" for s, kws in TEST_SECTIONS
    )
    return f"(VALUES {rows}) AS sec(section, keywords)"


SECTION_FILTER_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT a.id, a.source FROM art a LEFT JOIN {_sections_sql()} ON a.source = sec.section
WHERE sec.keywords IS NULL OR len(sec.keywords) = 0
   OR len(list_filter(sec.keywords, lambda k: contains(lower(a.title || ' ' || a.content), k))) > 0
"""


@query("section_keyword_filter", SECTION_FILTER_SQL)
def q_section_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.filters import section_keyword_filter

    arts = doc_articles(spark, sf_dir)
    return section_keyword_filter(arts, _sections_df(spark), section_col="source").select("id", "source")


# Test lists for the substring detectors and the cascade (words present in documents).
TEST_LISTS = {
    "platforms": ["lend", "the", "und"],
    "competitors": ["license", "zebra"],
    "funds": ["accial capital", "und"],
    "brand_keywords": ["licen"],
}
TEST_CASCADE = [
    ("exaloan_reputation", ["licence"]),
    ("competitor", ["license"]),
    ("regulation", ["gesetz", "mit"]),
    ("funding", ["und"]),
    ("partnership", ["avec"]),
    ("insolvency_risk", ["the"]),
    ("platform", ["le"]),
]
TEST_RISK_TERMS = ["license", "pour"]


def _detect_sql_cols(low: str) -> str:
    L = TEST_LISTS
    return (
        f"array_to_string({S.list_filter_contains(low, L['platforms'])}, ', ') AS platforms_mentioned, "
        f"array_to_string({S.list_filter_contains(low, L['competitors'])}, ', ') AS competitors_mentioned, "
        f"array_to_string({S.list_filter_contains(low, L['funds'])}, ', ') AS funds_mentioned, "
        f"CASE WHEN {S.any_contains(low, L['brand_keywords'])} THEN 'exaloan' ELSE '' END AS companies_mentioned"
    )


DETECT_SQL = f"""WITH {S.ARTICLES_CTE}, x AS (SELECT id, lower(content || ' ' || title) AS low FROM art)
SELECT id, {_detect_sql_cols("low")} FROM x
"""


def _flat(df: DataFrame, cols: list[str], sep: str = ", ") -> DataFrame:
    return df.select(*[F.coalesce(F.array_join(F.col(c), sep), F.lit("")).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("detect_entities_substring", DETECT_SQL)
def q_detect_entities_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.match import detect_entities

    arts = doc_articles(spark, sf_dir)
    text = F.concat(F.col("content"), F.lit(" "), F.col("title"))
    out = detect_entities(arts, text=text, **TEST_LISTS).select(
        "id", "platforms_mentioned", "competitors_mentioned", "funds_mentioned", "companies_mentioned"
    )
    return _flat(out, ["platforms_mentioned", "competitors_mentioned", "funds_mentioned", "companies_mentioned"])


SUBSTRING_INDEX_SQL = """WITH t AS (
  SELECT DISTINCT substring(lower(text), 1 + CAST(doc_id % 40 AS INTEGER), 2 + CAST(doc_id % 9 AS INTEGER)) AS term FROM documents
), d AS (SELECT doc_id AS id, lower(coalesce(text, '')) AS low FROM documents)
SELECT id, coalesce(string_agg(term, '|' ORDER BY term), '') AS terms, count(term) AS n
FROM d LEFT JOIN t ON length(term) > 0 AND contains(low, term) GROUP BY id
"""


@query("substring_index", SUBSTRING_INDEX_SQL)
def q_substring_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI2 with a list as long as the table: one term from every document, looked for in all documents."""
    from newslake.operators.match import tag_substrings
    from newslake.plans.tables import scan, table

    docs, listed = (read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text") for read in (table, scan))
    terms = listed.select(F.substr(F.lower("text"), (1 + F.col("id") % 40).cast("int"), (2 + F.col("id") % 9).cast("int")).alias("term"))
    return tag_substrings(docs, terms, text="text", out="terms").select(
        "id", F.array_join("terms", "|").alias("terms"), F.size("terms").cast("long").alias("n"))


def _cascade_sql(low: str) -> str:
    parts = " ".join(f"WHEN {S.any_contains(low, terms)} THEN {S.lit(label)}" for label, terms in TEST_CASCADE)
    return f"CASE {parts} ELSE 'unknown' END"


CLASSIFY_SQL = f"""WITH {S.ARTICLES_CTE}, x AS (SELECT id, lower(content || ' ' || title) AS low FROM art)
SELECT id, {_cascade_sql("low")} AS category FROM x
"""


@query("classify_articles", CLASSIFY_SQL)
def q_classify_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.classify import classify

    arts = doc_articles(spark, sf_dir)
    return arts.select("id", classify(F.concat(F.col("content"), F.lit(" "), F.col("title")), TEST_CASCADE).alias("category"))


RISK_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT id, {S.any_contains("lower(content)", TEST_RISK_TERMS)} AS insolvency_risk FROM art
"""


@query("risk_flag", RISK_SQL)
def q_risk_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.classify import insolvency_risk

    return doc_articles(spark, sf_dir).select("id", insolvency_risk("content", TEST_RISK_TERMS).alias("insolvency_risk"))


def keywords_simple_sql(text: str) -> str:
    split = f"string_split_regex({S.strip(f'replace(lower({text}), {S.lit(",")}, {S.lit(" ")})')}, '{S.WS_CLASS}+')"
    return f"list_sort(list_distinct(list_filter({split}, lambda t: length(t) > 3)))"


KEYWORDS_SIMPLE_SQL = f"""WITH {S.ARTICLES_CTE}
SELECT id, array_to_string({keywords_simple_sql("content || ' ' || title")}, '|') AS keywords FROM art
"""


@query("keywords_simple", KEYWORDS_SIMPLE_SQL)
def q_keywords_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.keywords import simple_keywords

    arts = doc_articles(spark, sf_dir)
    kw = simple_keywords(F.concat(F.col("content"), F.lit(" "), F.col("title")))
    return arts.select("id", F.array_join(kw, "|").alias("keywords"))


# Test lexicon (term, polarity): multiples of 1/4 so sums are exact in any order.
TEST_LEXICON = [
    ("the", 0.25), ("and", 0.5), ("und", -0.75), ("le", 0.25), ("la", -0.25),
    ("des", 1.0), ("der", -0.5), ("license", -1.0), ("avec", 0.75), ("por", 0.5),
]


def _lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEST_LEXICON, "term string, polarity double")


def sentiment_sql(texts_cte: str) -> str:
    return f"""lex AS (SELECT * FROM {S.values(TEST_LEXICON, ["term", "polarity"])}),
toks AS (SELECT id, unnest(regexp_extract_all(lower(coalesce(txt, '')), '[\\p{{L}}\\p{{N}}]+')) AS term FROM {texts_cte}),
sc AS (SELECT toks.id, avg(lex.polarity) AS s FROM toks JOIN lex ON toks.term = lex.term GROUP BY toks.id),
sent AS (
  SELECT t.id, coalesce(sc.s, 0.0) AS score FROM {texts_cte} t LEFT JOIN sc ON t.id = sc.id
)"""


SENTIMENT_SQL = f"""WITH texts AS (
  SELECT 'd:' || CAST(doc_id AS VARCHAR) AS id, text AS txt FROM documents
  UNION ALL
  SELECT 'c:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), text FROM conversations
), {sentiment_sql("texts")}
SELECT id, round(score, 6) AS sentiment_score,
       CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label
FROM sent
"""


@query("sentiment_lexicon", SENTIMENT_SQL)
def q_sentiment_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.sentiment import with_sentiment
    from newslake.plans.tables import table

    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d:"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("content")
    )
    conv = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c:"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("content"),
    )
    out = with_sentiment(docs.unionByName(conv), _lexicon(spark))
    return out.select("id", F.round("sentiment_score", 6).alias("sentiment_score"), "sentiment_label")


ENRICH_SQL = f"""WITH {S.ARTICLES_CTE},
texts AS (SELECT id, content AS txt FROM art),
{sentiment_sql("texts")},
x AS (SELECT a.*, p.published_at, lower(a.content || ' ' || a.title) AS low,
             a.content || ' ' || a.title AS full_text
      FROM art a LEFT JOIN pub p ON a.id = p.id)
SELECT x.id,
       CASE WHEN length(coalesce(published_at, '')) >= 10 THEN substring(published_at, 1, 10) ELSE '' END AS date,
       source, title, url, {_cascade_sql("low")} AS category,
       CASE WHEN sent.score > 0.1 THEN 'positive' WHEN sent.score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       round(sent.score, 6) AS sentiment_score,
       {_detect_sql_cols("low")},
       array_to_string({keywords_simple_sql("full_text")}, ', ') AS keywords,
       {S.any_contains("lower(content)", TEST_RISK_TERMS)} AS insolvency_risk
FROM x JOIN sent ON x.id = sent.id
"""


@query("enrich_articles", ENRICH_SQL)
def q_enrich_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.enrich import enrich_articles
    from newslake.schemas import ENRICHED_LIST_COLUMNS

    base = doc_articles(spark, sf_dir)
    arts = with_published(base, spark, sf_dir)
    out = enrich_articles(
        arts, _lexicon(spark), texts=base.select("id", "content"),
        cascade=TEST_CASCADE, insolvency=TEST_RISK_TERMS, **TEST_LISTS,
    ).withColumn("sentiment_score", F.round("sentiment_score", 6))
    return _flat(out, ENRICHED_LIST_COLUMNS)


ENRICH_SHARED_SQL = f"""WITH {S.ARTICLES_CTE},
texts AS (SELECT id, content AS txt FROM art),
{sentiment_sql("texts")}
SELECT 'src://' || coalesce(source, '') AS url, title, round(sent.score, 6) AS sentiment_score,
       CASE WHEN sent.score > 0.1 THEN 'positive' WHEN sent.score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label
FROM art JOIN sent ON art.id = sent.id
"""


@query("enrich_shared_url", ENRICH_SHARED_SQL)
def q_enrich_shared_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analyzer job over articles whose only key is a shared URL: each is scored by itself."""
    from newslake.plans.jobs import enrich_batch

    arts = _shared_url(doc_articles(spark, sf_dir)).drop("id")
    return enrich_batch(arts, _lexicon(spark)).select(
        "url", "title", F.round("sentiment_score", 6).alias("sentiment_score"), "sentiment_label"
    )


OBJECT_DEDUPE_SQL = f"""WITH {S.ARTICLES_CTE},
r AS (SELECT id, lang, content, row_number() OVER (PARTITION BY title, content, lang ORDER BY seq) AS rn FROM art)
SELECT id, lang, content FROM r WHERE rn = 1
"""


@query("dedupe_object", OBJECT_DEDUPE_SQL)
def q_dedupe_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.dedupe import dedupe_articles

    # The object carries no link/id, so its key is the canonical JSON of the whole object.
    arts = doc_articles(spark, sf_dir).select("seq", "title", "content", "lang")
    out = dedupe_articles(arts, order=["seq"], object_cols=["title", "content", "lang"])
    return out.select(F.col("seq").alias("id"), "lang", "content")


def _blanked_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with blanked fields: whitespace title, empty content, headline fallback."""
    from newslake.plans.tables import table

    src = F.col("source")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(src == "src3", F.lit("   ")).alias("title"),
        F.when(src == "src4", F.concat(F.lit("Headline "), F.col("doc_id").cast("string"))).alias("headline"),
        F.when(src.isin("src3", "src5"), F.lit("")).otherwise(F.col("text")).alias("content"),
        F.when(src == "src5", F.lit("")).alias("text"),
    )


VALIDATE_SQL = f"""WITH raw AS (
  SELECT doc_id AS id,
         CASE WHEN source = 'src3' THEN '   ' END AS title,
         CASE WHEN source = 'src4' THEN 'Headline ' || CAST(doc_id AS VARCHAR) END AS headline,
         CASE WHEN source IN ('src3', 'src5') THEN '' ELSE text END AS content,
         CASE WHEN source = 'src5' THEN '' END AS text
  FROM documents
), n AS (
  SELECT id, {S.strip("coalesce(nullif(title, ''), nullif(headline, ''), '')")} AS t,
         {S.strip("coalesce(nullif(content, ''), nullif(text, ''), '')")} AS c
  FROM raw
)
SELECT id, (t <> '' OR c <> '') AS valid,
       CASE WHEN t <> '' THEN t ELSE {S.title_from('c')} END AS title,
       CASE WHEN t = '' AND c = '' THEN 'missing both title and content' END AS reject_reason
FROM n
"""


@query("validate_split", VALIDATE_SQL)
def q_validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.normalize import normalize_articles

    return normalize_articles(_blanked_docs(spark, sf_dir)).select("id", "valid", "title", "reject_reason")


def _translit_sql(x: str) -> str:
    from newslake.functions.text import GERMAN_TRANSLITERATION

    out = x
    for a, b in GERMAN_TRANSLITERATION:
        out = f"replace({out}, {S.lit(a)}, {S.lit(b)})"
    return out


TRANSLIT_SQL = f"SELECT doc_id AS id, lang, {_translit_sql('text')} AS text_ascii FROM documents"


@query("transliterate_de", TRANSLIT_SQL)
def q_transliterate_de(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.functions.text import transliterate_de
    from newslake.plans.tables import table

    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), "lang", transliterate_de("text").alias("text_ascii"))


SOURCE_METRICS_SQL = f"""WITH {S.ARTICLES_CTE}, {_tag_sql_parts()}
SELECT a.source, count(*) AS n_articles, count(*) FILTER (WHERE a.title <> '' OR a.content <> '') AS n_valid,
       count(*) FILTER (WHERE t.platforms <> '') AS n_tagged, CAST(sum(length(a.content)) AS BIGINT) AS n_chars
FROM art a JOIN tags t ON a.id = t.id GROUP BY a.source
"""


@query("source_metrics", SOURCE_METRICS_SQL)
def q_source_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.metrics import source_metrics

    tagged = _tag_docs(spark, sf_dir, "auto").withColumn(
        "valid", (F.col("title") != F.lit("")) | (F.col("content") != F.lit(""))
    )
    return source_metrics(tagged, "source")


ALIAS_DICT_SQL = """WITH raw AS (
  SELECT doc_id AS rn, 'Doc ' || CAST(doc_id AS VARCHAR) AS entity_name, lang AS category,
         ' ' || upper(source) || ' ;' || lang || ';;' AS aliases
  FROM documents
), parts AS (
  SELECT rn, entity_name, category, unnest(string_split(aliases, ';')) AS part,
         unnest(range(len(string_split(aliases, ';')))) AS pi
  FROM raw
), cand AS (
  SELECT lower(trim(part)) AS alias, trim(entity_name) AS entity, category,
         row_number() OVER (PARTITION BY lower(trim(part)) ORDER BY rn DESC, pi DESC) AS r
  FROM parts WHERE trim(part) <> ''
)
SELECT alias, entity, category FROM cand WHERE r = 1
"""


@query("alias_dictionary", ALIAS_DICT_SQL)
def q_alias_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.match import entity_dictionary
    from newslake.plans.tables import table

    raw = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("entity_name"),
        F.col("lang").alias("category"),
        F.concat(F.lit(" "), F.upper("source"), F.lit(" ;"), F.col("lang"), F.lit(";;")).alias("aliases"),
        F.col("doc_id").alias("_order"),
    )
    return entity_dictionary(raw, alias_sep=";", order="_order")
