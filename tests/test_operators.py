"""Classification, sentiment, retention, digest, merge and ordering operators."""

from pyspark.sql import functions as F

from newslake.operators.classify import classify, insolvency_risk
from newslake.operators.digest import daily_digest, digest_day_status
from newslake.operators.filters import apply_query_filter, query_terms
from newslake.operators.keywords import ranked_keywords, simple_keywords
from newslake.operators.merge import merge_metrics, merge_upsert, new_rows
from newslake.operators.order import newest_first
from newslake.operators.retention import expired, retain
from newslake.operators.sentiment import sentiment_label, with_sentiment
from newslake.schemas import NO_HIT_STATUS


def test_cascade_first_hit_wins(spark):
    df = spark.createDataFrame([("fund debt",), ("debt only",), ("Exaloan credit",), ("nothing",)], "t string")
    assert [r[0] for r in df.select(classify("t")).collect()] == ["funding", "insolvency_risk", "exaloan_reputation", "unknown"]


def test_risk_uses_content_only(spark):
    df = spark.createDataFrame([("Debt talks",), ("all fine",)], "c string")
    assert [r[0] for r in df.select(insolvency_risk("c")).collect()] == [True, False]


def test_sentiment_bounds(spark):
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.11,), (-0.11,)], "s double")
    assert [r[0] for r in df.select(sentiment_label("s")).collect()] == ["neutral", "neutral", "positive", "negative"]


def test_sentiment_mean_with_repeats(spark):
    arts = spark.createDataFrame([(1, "good good bad"), (2, "nothing here")], "id long, content string")
    lex = spark.createDataFrame([("good", 0.5), ("bad", -1.0)], "term string, polarity double")
    got = {r["id"]: (r["sentiment_score"], r["sentiment_label"]) for r in with_sentiment(arts, lex).collect()}
    assert got == {1: (0.0, "neutral"), 2: (0.0, "neutral")}


def test_retention(spark):
    df = spark.createDataFrame(
        [("news_2025-06-16.json",), ("news_2025-06-17.json",), ("notes.json",), ("all_news.json",)], "f string"
    )
    gone = [r[0] for r in expired(df, "f", "2025-06-21").collect()]
    kept = [r[0] for r in retain(df, "f", "2025-06-21").collect()]
    assert gone == ["news_2025-06-16.json"]
    assert sorted(kept) == ["all_news.json", "news_2025-06-17.json", "notes.json"]
    # exact rule with a time of day
    assert [r[0] for r in expired(df, "f", "2025-06-21T00:00:00").collect()] == []


def test_digest_long_form(spark):
    df = spark.createDataFrame(
        [
            (1, "2025-06-20T10:00:00", " A ", "u1", ["X"]),
            (2, "2025-06-20T11:00:00", "B", "u2", []),
            (3, "2025-06-21", "C", None, []),
            (4, "Sat, 21 Jun 2025 01:47:00 GMT", "D", "u4", ["Y"]),
        ],
        "seq long, published_at string, title string, url string, platforms_mentioned array<string>",
    )
    out = {(r["day"], r["seq"]): (r["status"], r["title"]) for r in daily_digest(df, order=["seq"]).collect()}
    assert out == {("2025-06-20", 1): (None, "A"), ("2025-06-21", None): (NO_HIT_STATUS, None)}
    rfc = {(r["day"], r["seq"]) for r in daily_digest(df, order=["seq"], formats="iso+rfc822").collect()}
    assert ("2025-06-21", 4) in rfc
    status = {r["day"]: (r["n_articles"], r["n_hits"]) for r in digest_day_status(df, hit=F.size("platforms_mentioned") > 0).collect()}
    assert status == {"2025-06-20": (2, 1), "2025-06-21": (1, 0)}


def test_merge_twice_equals_once(spark):
    existing = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "k long, v string, seq int")
    batch = spark.createDataFrame([(2, "b2", 0), (3, "c", 1), (3, "c2", 2)], "k long, v string, seq int")
    once = merge_upsert(existing, batch, key="k", order=["seq"]).drop("origin")
    twice = merge_upsert(once, batch, key="k", order=["seq"]).drop("origin")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a", 0), (2, "b", 1), (3, "c", 1)]
    m = {r["metric"]: r["value"] for r in merge_metrics(existing, batch, new_rows(existing, batch, key="k", order=["seq"])).collect()}
    assert m == {"existing": 2, "incoming": 3, "kept": 1, "dropped": 2}


def test_query_filter(spark):
    terms = spark.range(1).select(query_terms("a OR bOR c").alias("t"), query_terms(F.lit("X OR ")).alias("u")).first()
    assert terms["t"] == ["a", "b", "c"] and terms["u"] == ["x", ""]
    df = spark.createDataFrame([("Credit news", ""), ("other", "x")], "title string, content string")
    assert apply_query_filter(df, "credit OR loan").count() == 2  # switch off by default
    assert apply_query_filter(df, "credit OR loan", enabled=True).count() == 1


def test_newest_first_stable(spark):
    df = spark.createDataFrame(
        [(0, "2025-06-20T10:00:00", None), (1, None, None), (2, "2025-06-21T10:00:00", None), (3, None, [2025, 6, 22, 0, 0, 0])],
        "seq int, published string, published_parsed array<int>",
    )
    assert [r["seq"] for r in newest_first(df, ["seq"]).collect()] == [3, 2, 0, 1]


def test_keywords(spark):
    df = spark.createDataFrame([(1, "Loans, loans and CREDIT lines. Credit risk rises. Banks lend"), (2, "")], "id long, content string")
    kw = {r["id"]: r["k"] for r in df.select("id", simple_keywords("content").alias("k")).collect()}
    assert kw[1] == ["banks", "credit", "lend", "lines.", "loans", "rises.", "risk"]
    assert kw[2] == []
    ranked = {r["id"]: r["keywords"] for r in ranked_keywords(df, top_k=3).collect()}
    assert 1 in ranked and len(ranked[1]) == 3 and 2 not in ranked
    de = spark.createDataFrame([(1, "Die Bank und die Kredite. Die Bank wächst.", "de")], "id long, content string, lang string")
    by_lang = ranked_keywords(de, lang_col="lang", top_k=5).first()["keywords"]
    assert "die" not in by_lang and "und" not in by_lang and "bank" in by_lang


def test_property_retained_and_expired_partition_all(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.one_of(st.dates().map(lambda d: f"news_{d.isoformat()}.json"), st.text(max_size=8)), max_size=12),
           st.dates(), st.integers(min_value=0, max_value=30))
    def check(names, as_of, days):
        df = spark.createDataFrame([(n,) for n in names], "f string")
        kept = retain(df, "f", as_of.isoformat(), days).count()
        gone = expired(df, "f", as_of.isoformat(), days).count()
        assert kept + gone == len(names)

    check()


def test_property_digest_days_are_distinct_valid_days(spark):
    import __spark_entry__ as entry
    from conftest import SF_SMALL

    digest = entry.queries()["daily_digest"](spark, SF_SMALL)
    days = {r["day"] for r in digest.select("day").distinct().collect()}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    moved = F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 400).cast("int"))
    dated = docs.join(ev, docs.doc_id == ev.event_id).where("event_id % 11 <> 0")
    expected = {r["d"] for r in dated.select(F.date_format(moved, "yyyy-MM-dd").alias("d")).distinct().collect()}
    assert digest.where("status is not null").count() > 0  # quiet days are there
    assert days == expected


def test_grams_are_cut_by_code_point(spark):
    from newslake.operators.language import explode_grams, gram_total

    df = spark.createDataFrame([(1, "a😀b"), (2, "É"), (3, "")], "id long, t string")
    grams = explode_grams(df, ["id"], "t").groupBy("id").agg(F.sort_array(F.collect_list("gram")).alias("g"))
    assert {r["id"]: r["g"] for r in grams.collect()} == {1: sorted(["a", "😀", "b", "a😀", "😀b", "a😀b"]), 2: ["é"]}
    assert [r[0] for r in df.orderBy("id").select(gram_total("t")).collect()] == [6, 1, 0]
