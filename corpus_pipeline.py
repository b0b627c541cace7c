"""The corpus pipeline: five stages over ``documents``, each a step of ``newslake.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the
next stage's ``docs``. The first four keep the columns of ``documents`` and drop rows; the last encodes what
is left. Rows are judged by themselves (stages 1, 2 and 4 are filters without a shuffle) except for near
duplicates, where one document of each group stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import decontam, langid, sentencepieces, simhash, toxicity
from newslake.llm.common import fold, prepare, read_table
from newslake.llm.queries import PIECES
from newslake.session import materialize

TOXIC_FROM = 0.5


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches ``TOXIC_FROM`` go."""
    prepare(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return docs.where(toxicity.score_udf(model)(F.col("text")) < TOXIC_FROM)


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter at all, or no language ahead of the others.

    How far ahead follows from the number of languages and from held-out labelled rows. Where no row has a known
    language nothing can be learned, and every document with a letter stays.
    """
    prepare(spark)
    model = langid.train(docs, fold("doc_id", 3) != 1)
    if not model.langs:
        return docs.where(F.col("text").rlike("\\p{L}"))
    bound = langid.rejection_bound(docs, model, fold("doc_id", 3) == 1)
    found = langid.predict_udf(model)(F.col("text"))
    return docs.where(found["score"] >= max(bound, 1e-9))


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    prepare(spark)
    return simhash.keep_one_per_group(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    prepare(spark)
    return decontam.without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digests of ids and decoded text that show the round trip."""
    prepare(spark)
    coded = docs.select("doc_id", "text").select(
        "doc_id", sentencepieces.encoded_udf(PIECES)(F.col("text")).alias("r")
    )
    return coded.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256", "r.ids")


STAGES = [
    ("toxicity", stage_toxicity),
    ("language", stage_language),
    ("simhash", stage_simhash),
    ("decontamination", stage_decontamination),
    ("sentencepiece", stage_sentencepiece),
]

#: A learned model, a similarity search and a tokenizer: not for SQL (brute-force tests in tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
