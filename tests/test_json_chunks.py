"""JSON arrays over many byte ranges, against the parser of the standard library."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.sinks.writers import write_json_array
from newslake.sources.json_chunks import scan_json_arrays

SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("meta", T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.LongType()))])),
])


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "200"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def items(rng, n):
    hard = ['say "hi"', "a}b{c", "[x]", "back\\slash", "\\", '\\"', "}", "{", "é漢😀", "", "line\nbreak", "],[", "},{"]
    return [{"url": f"u{i}", "title": " ".join(rng.choice(hard) for _ in range(rng.randrange(6))),
             "tags": [rng.choice(hard) for _ in range(rng.randrange(3))],
             "meta": rng.choice([None, {"a": rng.choice(hard), "b": [1, i]}])} for i in range(n)]


def found(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r["file"], r["pos"])):
        out.setdefault(r["file"], []).append((r["pos"], r.asDict(recursive=True)))
    return {f: [{k: v for k, v in d.items() if k not in ("file", "pos")} for p, d in rs] for f, rs in out.items()
            if [p for p, _ in rs] == list(range(len(rs)))}


def test_arrays_over_many_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    want = {}
    for k, (n, form) in enumerate([(120, {}), (60, {"indent": 2}), (1, {}), (40, {"separators": (",", ":"), "ensure_ascii": False}),
                                   (0, {}), (7, {"indent": 1})]):
        data = items(rng, n)
        if k == 3:
            data[10]["title"] = "long }{\"] " * 900  # an element over several ranges
        (tmp_path / f"a{k}.json").write_text(rng.choice(["", " \n"]) + json.dumps(data, **form) + rng.choice(["", "\n"]), encoding="utf-8")
        if n:
            want[f"a{k}.json"] = data
    whole = json.dumps(items(rng, 30))
    for name, text in [("cut.json", whole[:-40]), ("cut2.json", whole[:-1]), ("one.json", '{"url": "u", "meta": {"a": "]"}}'), ("no.json", ""),
                       ("blank.json", " \n "), ("word.json", "hello"), ("more.json", whole + "]"), ("brace.json", "}")]:
        (tmp_path / name).write_text(text)
    rows, rejects = scan_json_arrays(spark, str(tmp_path) + "/*.json", SCHEMA)
    assert found(rows) == want
    assert {(r["file"], r["pos"], r["reason"]) for r in rejects.collect()} == {
        ("cut.json", None, "malformed JSON"), ("cut2.json", None, "malformed JSON"), ("one.json", None, "not a list"),
        ("blank.json", None, "empty file"), ("word.json", None, "malformed JSON"), ("more.json", None, "malformed JSON"),
        ("brace.json", None, "malformed JSON")}


def test_malformed_elements_are_rejects_of_their_own(spark, tmp_path, small_ranges):
    (tmp_path / "x.json").write_text('[{"url": "a"}, {"url": }, {"url": "b"} {"url": "c"}, 5, {"url": "d"}, {"url": "e"}]')
    rows, rejects = scan_json_arrays(spark, str(tmp_path), SCHEMA)
    assert sorted((r["pos"], r["url"]) for r in rows.collect()) == [(0, "a"), (2, "b"), (5, "e")]
    assert sorted((r["pos"], r["reason"]) for r in rejects.collect()) == [(i, "malformed element") for i in (1, 3, 4)]


def test_written_array_is_read_back_as_one(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    data = [{**d, "k": i} for i, d in enumerate(items(rng, 400))]
    df = spark.createDataFrame([(d["k"], d["url"], d["title"]) for d in data], "k long, url string, title string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_json_array(df.repartition(6), str(tmp_path / "out"), ["k"], drop=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) > 1
    assert [d["title"] for d in json.loads("".join(p.read_text() for p in parts))] == [d["title"] for d in data]
    rows, rejects = scan_json_arrays(spark, path, SCHEMA, joined=True)
    got = rows.orderBy("pos").select("pos", "title").collect()
    assert [(r["pos"], r["title"]) for r in got] == [(i, d["title"]) for i, d in enumerate(data)]
    assert rejects.count() == 0
    write_json_array(df.limit(0), str(tmp_path / "none"), ["k"])
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == []
    rows, rejects = scan_json_arrays(spark, str(tmp_path / "none"), SCHEMA, joined=True)
    assert rows.count() == 0 and rejects.count() == 0


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    text = json.dumps([{"url": f"u{i}", "title": "t" * 500} for i in range(12_000)])  # 6 MB on one line
    (tmp_path / "all_news.json").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        records = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert records.rdd.getNumPartitions() >= 6
        rows, _ = scan_json_arrays(spark, str(tmp_path), SCHEMA)
        assert rows.agg(F.count("*"), F.max("pos"), F.count_distinct("url")).first() == (12_000, 11_999, 12_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
