"""Statistical text operators: language identification and ranked keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.plans import sqlparts as S
from newslake.plans.registry import query
from newslake.plans.tables import table

LANG_SQL = """WITH d AS (SELECT doc_id AS id, lang, lower(coalesce(text, '')) AS t FROM documents),
ch AS (SELECT id, lang, t, regexp_extract_all(t, '(?s)(.)', 1) AS c FROM d),
gl AS (
  SELECT id, lang, t, c
      || list_transform(list_zip(c[1:greatest(len(c) - 1, 0)], c[2:]), lambda x: x[1] || x[2])
      || list_transform(list_zip(c[1:greatest(len(c) - 2, 0)], c[2:greatest(len(c) - 1, 0)], c[3:]), lambda x: x[1] || x[2] || x[3]) AS gs
  FROM ch
),
grams AS (SELECT id, lang, unnest(gs) AS gram FROM gl),
prof AS (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL AND id % 2 = 0 GROUP BY lang, gram),
stats AS (SELECT lang, sum(n) AS n_lang FROM prof GROUP BY lang),
v AS (SELECT count(DISTINCT gram) AS v FROM prof),
sh AS (SELECT grams.id, prof.lang, sum(ln(prof.n + 1)) AS s FROM grams JOIN prof ON grams.gram = prof.gram GROUP BY grams.id, prof.lang),
tot AS (SELECT id, greatest(length(t), 0) + greatest(length(t) - 1, 0) + greatest(length(t) - 2, 0) AS tt FROM d),
cand AS (
  SELECT tot.id, tot.tt, stats.lang, coalesce(sh.s, 0.0) - tot.tt * ln(stats.n_lang + v.v) AS score
  FROM tot CROSS JOIN stats CROSS JOIN v LEFT JOIN sh ON sh.id = tot.id AND sh.lang = stats.lang
),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) AS rk FROM cand)
SELECT id, CASE WHEN tt > 0 THEN lang ELSE 'en' END AS lang_pred, id % 2 <> 0 AS held_out FROM r WHERE rk = 1
"""


@query("language_id", LANG_SQL)
def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train gram profiles on the labelled documents of even id, then score all; those of odd id are held out."""
    from newslake.operators.language import identify_language, train_profile

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", F.col("text").alias("content"))
    profile = train_profile(docs.where("id % 2 = 0"), lang="lang", text="content")
    return identify_language(docs, profile).withColumn("held_out", F.col("id") % 2 != 0)


def _stopwords_sql() -> str:
    from newslake.operators.keywords import all_stopwords

    return "(" + ", ".join(S.lit(w) for w in all_stopwords()) + ")"


KEYWORDS_RANKED_SQL = f"""WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT id, unnest(regexp_split_to_array(t, '[.!?\\n]+')) AS sentence,
         unnest(range(len(regexp_split_to_array(t, '[.!?\\n]+')))) AS s_idx
  FROM d
),
tk AS (SELECT id, s_idx, regexp_extract_all(sentence, '[\\p{{L}}\\p{{N}}]+') AS toks FROM s),
tk2 AS (SELECT * FROM tk WHERE len(toks) > 0),
nsent AS (SELECT id, count(*) AS n_sent FROM tk2 GROUP BY id),
o AS (SELECT id, s_idx, unnest(toks) AS tok, unnest(range(len(toks))) AS t_pos FROM tk2),
o2 AS (
  SELECT *, lower(tok) AS term,
         lag(lower(tok)) OVER (PARTITION BY id, s_idx ORDER BY t_pos) AS lft,
         lead(lower(tok)) OVER (PARTITION BY id, s_idx ORDER BY t_pos) AS rgt
  FROM o
),
c AS (SELECT * FROM o2 WHERE term NOT IN {_stopwords_sql()}),
f AS (
  SELECT id, term, count(*) AS tf,
         count(*) FILTER (WHERE regexp_matches(substring(tok, 1, 1), '\\p{{Lu}}') AND t_pos > 0) AS tf_upper,
         count(*) FILTER (WHERE tok = upper(tok) AND tok <> lower(tok) AND length(tok) > 1) AS tf_acronym,
         median(s_idx) AS med, count(DISTINCT s_idx) AS sf,
         count(lft) AS left_n, count(DISTINCT lft) AS left_d, count(rgt) AS right_n, count(DISTINCT rgt) AS right_d
  FROM c GROUP BY id, term
),
g AS (
  SELECT f.*, nsent.n_sent,
         avg(tf) OVER (PARTITION BY f.id) AS mean_tf, stddev_pop(tf) OVER (PARTITION BY f.id) AS std_tf,
         max(tf) OVER (PARTITION BY f.id) AS max_tf
  FROM f JOIN nsent ON f.id = nsent.id
),
h0 AS (
  SELECT id, term, CAST(tf AS DOUBLE) AS tf,
         greatest(tf_upper, tf_acronym) / (1.0 + ln(tf)) AS cas,
         ln(ln(3.0 + med)) AS pos,
         tf / (mean_tf + std_tf) AS norm,
         1.0 + ((CASE WHEN left_n > 0 THEN left_d / left_n ELSE 0.0 END)
              + (CASE WHEN right_n > 0 THEN right_d / right_n ELSE 0.0 END)) * tf / max_tf AS rel,
         sf / n_sent AS spread
  FROM g
),
h AS (SELECT id, term, tf, rel * pos / (cas + norm / rel + spread / rel) AS h FROM h0),
r AS (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY h / (tf * (1.0 + h)), term) AS rk FROM h)
SELECT d.id, coalesce(string_agg(term, '|' ORDER BY rk), '') AS keywords
FROM d LEFT JOIN r ON d.id = r.id AND rk <= 10 GROUP BY d.id
"""


@query("keywords_ranked", KEYWORDS_RANKED_SQL)
def q_keywords_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.keywords import with_ranked_keywords

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return with_ranked_keywords(docs, id_col="id", text="content", top_k=10).select(
        "id", F.array_join("keywords", "|").alias("keywords")
    )


_PLAIN = "SELECT doc_id AS id, coalesce(text, '') AS t FROM documents"
COLLECTED_SQL = KEYWORDS_RANKED_SQL.replace(_PLAIN, _PLAIN.replace("coalesce(text", "coalesce(source, '') || ' ' || coalesce(text"))


@query("collected_keywords", COLLECTED_SQL)
def q_collected_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8, FIL2: two collectors' articles, united with the query filter at its default (off), then given keywords."""
    from newslake.operators.normalize import uniform_articles
    from newslake.plans.jobs import collect_batch

    docs = table(spark, sf_dir, "documents")

    def collected(rows: DataFrame) -> DataFrame:
        return uniform_articles(
            rows, source=F.col("lang"), url=F.lit(None), title=F.col("source"), published_at=F.lit(""), content=F.col("text"),
            extra={"file": F.lit("documents"), "pos": F.col("doc_id")})

    batch = collect_batch(spark, {}, collected={
        "first": collected(docs.where("lang = 'en'")), "second": collected(docs.where("lang <> 'en' OR lang IS NULL"))})
    return batch.select(F.col("pos").alias("id"), F.array_join("keywords", "|").alias("keywords"))
