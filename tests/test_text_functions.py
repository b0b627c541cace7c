"""Scalar column functions: strip, boundaries, dates, transliteration, titles."""

import re

import pytest
from pyspark.sql import functions as F

from newslake.functions import dates as D
from newslake.functions import text as T
from newslake.operators.normalize import normalize_articles


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("o")).first()["o"]


def test_strip_matches_python(spark):
    s = "　\t  héllo wörld \n\x85\xa0"
    assert one(spark, T.strip, s) == s.strip()


def test_or_chain_python_semantics(spark):
    df = spark.createDataFrame([("", None, "x"), (None, "", ""), ("a", "b", "c")], "a string, b string, c string")
    out = [r[0] for r in df.select(T.or_chain("a", "b", "c")).collect()]
    assert out == ["x", "", "a"]


@pytest.mark.parametrize(
    "alias,text,python,lenient",
    [
        ("lend", "calendar", False, False),
        ("lend", "we lend money", True, True),
        ("x", "xê", False, False),
        ("lendable inc.", "lendable inc. raised", False, True),
        ("lendable inc.", "lendable inc.x", True, True),
        ("accial capital", "accial capital fund 1", True, True),
    ],
)
def test_boundary_patterns_java(spark, alias, text, python, lenient):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(
        F.col("t").rlike(T.boundary_pattern(alias, "python")).alias("p"),
        F.col("t").rlike(T.boundary_pattern(alias, "lenient")).alias("l"),
    ).first()
    assert (got["p"], got["l"]) == (python, lenient)
    # the python policy reproduces re's \b on the lowercased text
    assert bool(re.search(rf"\b{re.escape(alias)}\b", text)) == python


def test_transliterate(spark):
    assert one(spark, T.transliterate_de, "Äpfel Öl Übermaß") == "Aepfel Oel Uebermass"


def test_title_from_long_content(spark):
    content = "a" * 121
    df = spark.createDataFrame([(None, None, content, None)], "title string, headline string, content string, text string")
    out = normalize_articles(df).first()
    assert out["title"] == "a" * 120 + "…" and out["valid"]


def test_whitespace_title_falls_to_content_not_headline(spark):
    df = spark.createDataFrame([("  ", "H", "C", None)], "title string, headline string, content string, text string")
    assert normalize_articles(df).first()["title"] == "C"


def test_both_empty_invalid(spark):
    df = spark.createDataFrame([("", None, "", None)], "title string, headline string, content string, text string")
    out = normalize_articles(df).first()
    assert out["valid"] is False and out["reject_reason"]
    with pytest.raises(ValueError):
        normalize_articles(df, on_error="fail")


@pytest.mark.parametrize(
    "raw,iso,rfc",
    [
        ("Sat, 21 Jun 2025 01:47:00 GMT", None, "2025-06-21"),
        ("x 2025-06-21 y", "2025-06-21", "2025-06-21"),
        ("2025-06-21T08:00:00", "2025-06-21", "2025-06-21"),
        ("20250621", "2025-06-21", "2025-06-21"),
        ("2025-99-99", "2025-99-99", "2025-99-99"),
        ("", None, None),
        ("n/a", None, None),
    ],
)
def test_extract_day(spark, raw, iso, rfc):
    df = spark.createDataFrame([(raw,)], "r string")
    got = df.select(D.extract_day("r", "iso").alias("a"), D.extract_day("r", "iso+rfc822").alias("b")).first()
    assert (got["a"], got["b"]) == (iso, rfc)


def test_date_prefix_and_quarter(spark):
    df = spark.createDataFrame([("Sat, 21 Jun 2025", "2025-05-03")], "r string, d string")
    got = df.select(D.date_prefix("r").alias("p"), D.quarter_label(F.to_date("d")).alias("q")).first()
    assert got["p"] == "Sat, 21 Ju" and got["q"] == "2025_Q2"


def test_time_tuple(spark):
    df = spark.createDataFrame([([2025, 6, 21, 1, 47, 0, 5, 172, 0],)], "a array<int>")
    got = df.select(D.iso_seconds(D.time_tuple_to_ts("a")).alias("s")).first()["s"]
    assert got == "2025-06-21T01:47:00"
