"""Queries of the operators in this subpackage over the given tables.

Each query applies its operator, with production parameters, to its whole table and derives the digest
columns of its contract from the operator's output. ``SQL`` holds DuckDB SQL where SQL can express one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import (
    chat, decontam, embedding_join, filter_audit, fracsketch, langid, runs, sentencepieces, sharding, simhash, tokenids,
    toxicity, wrapper,
)
from newslake.llm.common import fold, read_table
from newslake.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


#: The conversation added to the table: its texts are full of control strings.
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"),
    )
    made = chat.format_conversations(rows.unionByName(added))
    read = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("lost", chat.loss_text(F.col("segments")))
    newline = F.lit("\n")
    listed = F.transform("turns", lambda x: F.concat(x["role"], newline, x["text"], newline))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *, replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\t') AS escaped,
         row_number() OVER w AS k, lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || CASE WHEN role IN ('system', 'user', 'assistant') THEN role
    ELSE '@' || replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\t'), ':', '\c') END
    || ': ' || escaped || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN before IS NULL
    WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
    WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END
    AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM t GROUP BY conv_id
"""

def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, fold("doc_id", 5) != 0)
    return toxicity_scores(docs, model)


def toxicity_scores(docs: DataFrame, model: toxicity.Model) -> DataFrame:
    scored = docs.select("doc_id", "text").select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
        toxicity.score_udf(model)(F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs, fold("doc_id", 3) != 1)
    return docs.select("doc_id", "text").select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(True)).alias("held_out"),
        langid.predict_udf(model)(F.col("text")).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", sentencepieces.roundtrip_udf(PIECES)(F.col("text")).alias("r")
    ).select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-files")
    tokenids.write_token_files(docs, path, BYTE_PAIRS)
    copies = docs.groupBy("doc_id").count().select("doc_id", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("copy"))
    return tokenids.look_up(spark, path, copies).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: The audited filters over texts, by letter; E, the duplicates, is the operator's own.
AUDITED = {
    "A": filter_audit.too_short(200),
    "B": filter_audit.too_repetitive(50),
    "C": filter_audit.too_many("A-Z", 2),
    "D": filter_audit.holds_any("#$%&*|"),
}


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_audit.audit_filters(docs, labels, AUDITED, "E")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), j AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN j USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, mask
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b
), o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a JOIN f b ON b.b <> a.b JOIN f c ON c.b NOT IN (a.b, b.b) JOIN f d ON d.b NOT IN (a.b, b.b, c.b)
  JOIN f e ON e.b NOT IN (a.b, b.b, c.b, d.b)
), s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS gone
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (gone | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & gone <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & gone = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM cells, s GROUP BY part, filter_order, step, bit, gone
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth document by the hash of its id, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(words):
        n = F.size(words).cast("long")
        g = F.floor(h / 10).cast("long")
        start = g % F.greatest(n, F.lit(1))
        period = 1 + F.floor((n - start) / (3 + g % 8)).cast("long")
        changed = F.transform(words, lambda w, i: F.when(i < start, w).otherwise(
            F.get(words, (start + (i - start) % period).cast("int"))))
        return F.array_join(changed, " ")

    words = filter_audit.words_of(F.coalesce("text", F.lit("")))
    # An array of one, so that the words are a bound variable: they are cut once for a text.
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), 0)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeated_tails(read_table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fracsketch.compare_with_edits(read_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"),
        fracsketch.fingerprint_column("sketch").alias("fingerprint"),
        fracsketch.fingerprint_column("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next",
        "edited_in_own",
    )


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_sharding": op2_sharding,
    "op3_chat": op3_chat,
    "op4_toxicity": op4_toxicity,
    "op5_embedding_join": op5_embedding_join,
    "op6_simhash": op6_simhash,
    "op7_langid": op7_langid,
    "op8_decontamination": op8_decontamination,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_token_ids": op10_token_ids,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fingerprints": op13_fingerprints,
}

SQL = {"op3_chat": OP3_SQL, "op11_filter_audit": OP11_SQL}
