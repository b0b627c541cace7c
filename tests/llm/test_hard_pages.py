"""Main text of pages that are deep, long or broken, and the bounds of what the learned operators read."""

import random
import time

import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from newslake.llm import common, langid, toxicity, wrapper
from test_ops import docs_frame, main_texts, page, words


def test_deep_long_and_broken_pages_take_seconds():
    rng = random.Random(1)

    def deep(n):
        return wrapper.Page("<html><body>" + "<div>" * n + words(rng, 3) + "</div>" * n + "</body></html>")

    def long(n):
        return wrapper.Page("<html><body>" + "".join(
            f"<p>{words(rng, 2)} {'<a>x</a>' * rng.randrange(4)}{'<b><i>y</i></b>' * rng.randrange(3)}</p>" for _ in range(n)) + "</body></html>")

    start = time.process_time()
    a, b = deep(5000), deep(5000)
    assert len(wrapper.align(a, b)) == len(a.label)
    a, b = long(10_000), long(10_000)
    assert len(wrapper.align(a, b)) > 10_000
    broken = wrapper.Page("<p>start</p>" + "<div title='abc>text " * 100_001 + "<p>end</p>")
    assert broken.blocks[0][1] == "start" and broken.blocks[-1][1] == "end"
    assert wrapper.layout("<div title=\"x " * 100_000) == ""
    assert time.process_time() - start < 60


def test_unclosed_quotes_leave_no_markup_in_the_text():
    got = wrapper.Page('<p>one</p><div title="abc>two</div><p>three</p>')
    assert [t for _, t in got.blocks] == ["one", "two", "three"]
    assert [t for _, t in wrapper.Page("<p>a <b x='>'>c</b> 1 < 2 and 3 > 2</p> d <i").blocks] == ["a c 1 < 2 and 3 > 2", "d <i"]


def test_long_child_lists_match_like_short_ones(monkeypatch):
    """Where runs are common, the match by runs is as large as the exact one."""
    rng = random.Random(3)
    for _ in range(30):
        shared = ["".join(rng.choice(["<p></p>", "<ul><li></li></ul>", "<h2></h2>"]) for _ in range(3)) for _ in range(8)]
        one = "".join(s + ("<div><i></i></div>" if rng.random() < 0.3 else "") for s in shared)
        two = "".join(s + ("<table></table>" if rng.random() < 0.3 else "") for s in shared)
        a, b = wrapper.Page(one), wrapper.Page(two)
        exact = len(wrapper.align(a, b))
        monkeypatch.setattr(wrapper, "EXACT_CELLS", 20)
        assert len(wrapper.align(a, b)) >= 0.9 * exact
        monkeypatch.undo()


def test_deep_pages_as_a_job(spark):
    rng = random.Random(2)
    rows = [(i, "http://deep.example/x", "<div>" * 700 + words(rng, 9) + "</div>" * 700) for i in range(6)]
    got = main_texts(spark, rows)
    assert len(got) == 6 and all(len(t.split()) == 9 for t in got.values())


def test_pages_of_one_shape_are_aligned_once(monkeypatch):
    """And elements of one name are read once; what is kept of both has a bound."""
    rng = random.Random(5)
    calls, align = [], wrapper.align
    monkeypatch.setattr(wrapper, "align", lambda a, b: calls.append(a) or align(a, b))
    shapes = ["<div class='x-{k}'><p>{t}</p></div>", "<div class='x-{k}'><p>{t}</p><p>{t}</p><i>{t}</i></div>"]
    pages = [page(shapes[i % 2].format(t=words(rng, 5), k=i)) for i in range(60)]
    f = pd.DataFrame({"host": "a", "ref": "r", "html": pages, "h": range(60), "ref_html": pages[0], "template": [[]] * 60,
                      "page_id": range(60), "url": "u"})
    (votes,) = wrapper._votes(iter([f]))
    assert len(calls) == 2
    ref = wrapper.Page(pages[0])
    for source, got in zip(pages, votes[["node", "text", "words", "size"]].itertuples(index=False)):
        own = wrapper.Page(source)
        assert list(zip(*got))[1:] == wrapper.vote(own, ref, align(own, ref))
    calls.clear()
    monkeypatch.setattr(wrapper, "MATCHES", 1)
    (texts,) = wrapper._extract(iter([f]))
    assert len(calls) == 60 and all(texts["text"].str.len() > 0)
    wrapper._known_element.cache_clear()
    for i in range(50):
        wrapper.Page(f"<p class=one><a href='{'x' * 300}{i}'>")
    assert wrapper._known_element.cache_info().currsize == 1


def test_whole_pages_are_not_shuffled_for_the_votes(spark, monkeypatch):
    rng, plans, write = random.Random(6), {}, wrapper.materialize

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(wrapper, "materialize", written)
    same = page(f"<div>Site name</div><p>{words(rng, 9)}</p>")
    texts = [words(rng, 9) for _ in range(6)]
    rows = [(i, "http://a.example/", page(f"<div>Site name</div><p>{t}</p>")) for i, t in enumerate(texts)]
    rows += [(10 + i, "http://a.example/", same) for i in range(90)]  # one vote: not enough to make its text template
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = main_texts(spark, rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "MapInPandas" in plans["page-votes"] and "Exchange hashpartitioning" not in plans["page-votes"]
    assert [got[i] for i in range(6)] == texts and got[10] in same and "Site" not in got[10]


def test_compound_names_of_small_elements(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(8):  # every page has a host of its own: no template, only names
        story = words(rng, 80)
        small = "".join(f"<div class='{c}'>{words(rng, 4)}</div>" for c in (
            "sidebar-left", "comment-list", "comment_body", "top-menu", "site-footer", "ad-slot", "cookie-banner"))
        body = f"<div class='layout has-sidebar content-with-menu'><div class='post-body'><p>{story}</p></div>{small}</div>"
        rows.append((i, f"http://h{i}.example/x", page(body)))
        want[i] = story
    assert main_texts(spark, rows) == want


# ---------------------------------------------------------------- bounds of samples

def test_a_hot_id_does_not_pass_the_bound_of_the_toxicity_sample(spark):
    rows = [(7, f"text number {i} of the hot id") for i in range(300)] + [(7, "one row many times")] * 300
    rows += [(i, f"other text {i}") for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 160)], "doc_id long, toxic int")
    few = toxicity.training_rows(docs_frame(spark, rows), labels, F.lit(True), 40).collect()
    assert len(few) == 40
    whole = toxicity.training_rows(docs_frame(spark, rows), labels, F.lit(True)).collect()
    assert len(whole) == len({(r["doc_id"], r["text"]) for r in whole}) == 361
    assert {r["y"] for r in whole if r["doc_id"] == 7} == {1}
    assert toxicity.train(docs_frame(spark, rows), labels, F.lit(True), 40).bias < 0


def test_language_bound_and_windows(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 40)
    rng = random.Random(10)
    parts = {"aa": ["tha", "ing", "wor"], "bb": ["çou", "eux", "lé"]}
    say = lambda g, n: " ".join("".join(rng.choice(parts[g]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(g, 60), g) for i in range(200) for g in [list(parts)[i % 2]]]
    rows += [(5000, rows[0][1], "aa")] * 3 + [(6000, say("aa", 20_000), "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, common.fold("doc_id", 3) != 1)
    bound = langid.rejection_bound(docs, model, common.fold("doc_id", 3) == 1)
    scores = [r["p"]["score"] for r in docs.select(langid.predict_udf(model)("text").alias("p")).collect()]
    assert 0.4 < bound < 0.9 and sum(s >= bound for s in scores) >= 0.99 * len(scores)
    assert langid.rejection_bound(docs, langid.Model([], {}), F.lit(True)) == 0.0
    few = langid._smallest(docs.select("lang", F.xxhash64("doc_id").alias("k")).distinct(), "k", "lang", 7)
    assert sorted(r["n"] for r in few.groupBy("lang").agg(F.count("*").alias("n")).collect()) == [7, 7]
    kept = {(r["lang"], r["k"]) for r in few.collect()}
    want = {}
    for r in docs.select("lang", F.xxhash64("doc_id").alias("k")).distinct().collect():
        want.setdefault(r["lang"], []).append(r["k"] % (1 << 64))
    assert kept == {(g, k - (1 << 64) if k >= 1 << 63 else k) for g, ks in want.items() for k in sorted(ks)[:7]}


def test_language_stage_without_known_languages(spark):
    rows = [(i, t, None, "s") for i, t in enumerate(["some text here", "другой", "12 34", "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.stage_language(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1] and kept.columns == docs.columns


def test_held_out_accuracy_on_the_given_tables(spark):
    from newslake.llm import queries

    sf = "/root/testdata/sf0.01"
    docs = queries.read_table(spark, sf, "documents").select("doc_id", "lang")
    got = queries.op7_langid(spark, sf).join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 200 and sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)
    labels = queries.read_table(spark, sf, "labels").select("doc_id", "toxic")
    tox = queries.op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    bad, good = [r["score"] for r in tox if r["toxic"] == 1], [r["score"] for r in tox if r["toxic"] == 0]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert auc >= 0.9 and sum(b >= 0.5 for b in bad) >= 0.5 * len(bad)
