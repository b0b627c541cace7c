"""The pipeline's stages: planted cases, contracts, edge cases; queries of the subpackage against SQL."""

import os

import duckdb
import pytest

import corpus_pipeline
from newslake.llm import decontam, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, score double"


@pytest.fixture(scope="module")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("test tables not available")
    return SF


def test_stage_list_is_the_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "simhash", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_decide_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()
    base = docs.orderBy("doc_id").first()
    odd = [
        (10**9, base["text"] + " ", "en", "x", 1, 0.1),  # a near copy
        (10**9 + 1, "Before it. " + item["text"] + " After it.", "en", "x", 1, 0.1),
        (10**9 + 2, None, "en", "x", 1, None), (10**9 + 3, "", None, None, None, None), (None, "12 34 ...", None, None, None, None),
    ]
    rows = docs.select("doc_id", "text", "lang", "source", docs["n_chars"].cast("int").alias("n_chars")).selectExpr("*", "0.5D AS score")
    rows = rows.unionByName(spark.createDataFrame(odd, COLUMNS))
    at = rows
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, sf_dir)
        if name == "sentencepiece":
            assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            assert out.count() == at.count()
            break
        assert out.columns == rows.columns, name
        kept, before = [r["doc_id"] for r in out.select("doc_id").collect()], at.count()
        assert 0 < len(kept) <= before
        if name == "language":
            assert not {10**9 + 2, 10**9 + 3, None} & set(kept)
        if name == "simhash":
            assert 10**9 not in kept and len(kept) == len(set(kept))
        if name == "decontamination":
            assert 10**9 + 1 not in kept
            bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            dirty = {r["doc_id"] for r in decontam.contained_items(at, bench).collect()}
            assert {r["doc_id"] for r in at.select("doc_id").collect()} - dirty == set(kept)
        at = spark.createDataFrame(out.collect(), out.schema)


def test_stages_take_empty_tables(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_held_out_toxicity(spark, sf_dir):
    rows = queries.op4_toxicity(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    clean = [r for r in rows if r["held_out"] and r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)


def test_chat_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    res = con.execute(queries.SQL["op3_chat"])
    cols = [d[0] for d in res.description]
    want = sorted(res.fetchall())
    df = queries.op3_chat(spark, sf_dir)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
