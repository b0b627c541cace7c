"""What must not grow with the input: rows that are shuffled, files that are listed, state that a task holds."""

import re

from pyspark.sql import functions as F

from test_plans import plan_of


def test_grams_of_a_text_are_not_shuffled(spark, capsys, monkeypatch):
    from newslake.operators import language

    rows = [(1, "thing thing", "en"), (2, "ding dong", "en"), (3, "une chose", "fr"), (4, "le la les", "fr")]
    profile = language.train_profile(spark.createDataFrame(rows, "id long, text string, lang string"))
    texts = [(7, "thing"), (7, "thing"), (7, "les"), (None, "la chose"), (None, None), (8, ""), (8, "𝒳é"), (9, "dong thing")]
    docs = spark.createDataFrame(texts, "id long, content string")
    out = language.identify_language(docs, profile)
    assert not re.search(r"hashpartitioning\(_[^)]*gram", plan_of(out, capsys))
    want = [("None", "en"), ("None", "fr"), ("7", "en"), ("7", "en"), ("7", "fr"), ("8", "en"), ("9", "en")]
    got = sorted((str(r["id"]), r["lang_pred"]) for r in out.collect())
    assert len(got) == 8 and [x for x in want if x not in got] == []
    monkeypatch.setattr(language, "BROADCAST_BYTES", 1000)  # several blocks of the profile
    assert sorted((str(r["id"]), r["lang_pred"]) for r in language.identify_language(docs, profile).collect()) == got


def test_keywords_of_single_rows_need_no_shuffle_of_occurrences(spark, capsys):
    from newslake.operators import keywords

    texts = ["Loans, loans and CREDIT lines. Credit risk rises! Banks lend. The Bank of loans", "", None, "the of 12 a. Ab ab AB",
             "\u00dcber Gr\u00f6\u00dfe und Gr\u00f6\u00dfe.\nBank bank. Nordix NORDIX x"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, content string")
    out = keywords.ranked_keywords(docs)
    tree = plan_of(out, capsys).split("\n\n")[0]
    assert "Exchange" not in tree and "Aggregate" not in tree and "Sort" not in tree
    want = {r["id"]: r["keywords"] for r in keywords._merged_keywords(docs, "id", "content", 10, None, None).collect()}
    assert {r["id"]: r["keywords"] for r in out.collect()} == want and set(want) == {0, 3, 4}
    again = docs.unionByName(docs.where("id = 0")).unionByName(spark.createDataFrame([(3, "Zebra zebra"), (None, "Zebra")], docs.schema))
    merged = {r["id"]: r["keywords"] for r in keywords._merged_keywords(again, "id", "content", 10, None, None).collect()}
    rows = keywords.with_ranked_keywords(again).collect()
    assert len(rows) == 8 and all(r["keywords"] == (merged.get(r["id"], []) if r["id"] is not None else []) for r in rows)


def test_rejected_arrays_hold_fifty_events(spark, tmp_path):
    from newslake.plans import catalog

    spark.sql("select id as event_id, cast(id % 7 as long) as user_id, 'view' as event_type, "
              "timestamp'2024-01-01 00:00:00' as ts from range(1000)").write.parquet(str(tmp_path / "events.parquet"))
    got = catalog.all_queries()["json_array_rejects"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("malformed JSON", 3)]
    assert "/ 50)" in catalog.all_sql()["json_array_rejects"]
    assert catalog.all_queries()["json_array_files"](spark, str(tmp_path)).count() == 750


def test_retention_folders_do_not_grow_with_undated_names(spark, tmp_path, monkeypatch):
    from newslake.operators import retention
    from newslake.plans import catalog

    spark.sql("select id as event_id, id as user_id, if(id % 10 = 0, 'click', 'view') as event_type, "
              "if(id = 10, null, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 30 as int))) as ts "
              "from range(300)").write.parquet(str(tmp_path / "events.parquet"))
    listed, names = [], retention.partition_names
    monkeypatch.setattr(retention, "partition_names", lambda *a: listed.append(names(*a)) or listed[-1])
    got = catalog.all_queries()["retention_partitions"](spark, str(tmp_path)).collect()
    want = catalog.all_queries()["retention_keep"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and 0 < len(got) < 300
    assert len(listed[0]) <= 31


def test_rejection_bound_reads_every_held_out_row(spark):
    import numpy as np

    from newslake.llm import langid

    model = langid.Model(["x", "y"], langid._init(2, 4, np.random.default_rng(1)))
    rows = [(i, "".join(chr(97 + (i * j * j + j) % 26) for j in range(3 + i % 11)), "x") for i in range(1500)]
    docs = spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string")
    scores = [r[0] for r in spark.createDataFrame(rows, docs.schema).select(langid.predict_udf(model)("text")["score"]).collect()]
    low = float(np.percentile(scores, 1))
    assert abs(langid.rejection_bound(docs, model, F.lit(True)) - (min(0.5, low) + 0.1 * max(0.0, low - 0.5))) < 1e-12


def test_long_child_lists_are_matched_exactly(monkeypatch):
    import random

    from newslake.llm import wrapper

    rng = random.Random(5)
    kinds = ["<p></p>", "<ul><li></li></ul>", "<ul><li></li><li><b></b></li></ul>", "<h2></h2>", "<div><i></i></div>", "<div><b></b><i></i></div>"]
    for n in (3, 20, 60):
        a, b = (wrapper.Page("".join(rng.choice(kinds) for _ in range(n + k))) for k in (0, 4))
        monkeypatch.setattr(wrapper, "EXACT_CELLS", 10**9)
        exact = wrapper.align(a, b)
        monkeypatch.setattr(wrapper, "EXACT_CELLS", 8)
        assert wrapper.align(a, b) == exact
