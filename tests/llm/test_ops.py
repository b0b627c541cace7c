"""Operators of newslake.llm against brute force, with edge cases: NULLs, empty and long texts, repeats,
empty tables, extra columns whose names clash with internal ones."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece
import tokenizers
import xxhash
from pyspark.sql import functions as F

import public_tokenizers as P
from newslake.llm import (
    chat, common, decontam, embedding_join, langid, sentencepieces, sharding, simhash, tokenids, toxicity, wrapper,
)
from newslake.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, key string, fp long, component_id long, bucket int"
LONG = "lorem ipsum dolor sit amet " * 6000


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "k", 1, 2, 3) for i, t in rows], DOCS)


EDGE = [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, LONG), (5, "alpha beta gamma delta epsilon zeta"),
        (5, "alpha beta gamma delta epsilon zeta"), (None, "no id here at all, really"), (7, " \n\t "), (8, "Ünïcode 漢字 😀 \x00 end")]


# ---------------------------------------------------------------- connected components, grouping

def test_components_match_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(900, 900 + i) for i in range(1, 60)]
    parent = common.unlinked_labels(1000)
    common.union_pairs(parent, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    top = common.roots(parent, np.arange(1000))
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r["node"]: r["component"] for r in common.connected_components(df).collect()} == {n: top[n] for n in nodes}
    assert common.connected_components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 1 main text

def page(body, title="t"):
    return f"<html><head><title>{title}</title><script>var a='<p>x</p>';</script></head><body>{body}</body></html>"


def test_main_text_rules(spark):
    rows = [
        (1, "http://a.x/1", page("<nav><a>menu</a></nav><header>top</header><div class='ad'>buy</div><article><h1>T&amp;T</h1>"
                                 "<p>one  <b>two</b><br>three<p>four</p><form>f</form><div class='comments'>c</div></article>"
                                 "<aside>side</aside><footer>foot</footer>")),
        (2, None, None), (3, "http://a.x/3", ""), (4, "http://a.x/4", "plain text only"),
        (5, "http://b.x/5", page("<div><p>a&nbsp;b &#8217;</p><ul><li>x<li>y</ul></div><div id='sidebar'>z</div>")),
        (5, "http://b.x/5", "<p>unclosed <b>bold<p>next <!-- hidden --> part"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = sorted((r["page_id"], r["text"]) for r in wrapper.extract_main_text(df).collect())
    assert got == sorted([(1, "T&T\none two three\nfour"), (2, ""), (3, ""), (4, "plain text only"), (5, "a b ’\nx\ny"),
                          (5, "unclosed bold\nnext part")])
    assert wrapper.extract_main_text(df.limit(0)).count() == 0


def test_wrapper_finds_template_without_markup_names(spark):
    """Pages of plain divs: what all pages share is template, what varies is content, copies do not vote."""
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(30):
        paras = [" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(rng.randrange(1, 5))]
        body = "<div><div>Site name</div><div>Home News</div></div><div>" + "".join(f"<p>{p}</p>" for p in paras) \
            + "</div><div><div>All rights reserved</div></div>"
        rows.append((i, "http://plain.example/x", page(body)))
        want[i] = "\n".join(paras)
    rows += [(100 + k, "http://copies.example/", rows[0][2]) for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrapper.extract_main_text(df).collect()}
    assert {i: got[i] for i in want} == want
    assert got[100].startswith("Site name") and want[0] in got[100]  # one page, twenty times: no template


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))


def main_texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in wrapper.extract_main_text(df).collect()}


def test_wrapper_finds_template_longer_than_the_articles(spark):
    rng = random.Random(7)
    rows, want, legal = [], {}, words(rng, 75)  # 600 characters
    for i in range(30):
        want[i] = words(rng, 25)
        rows.append((i, "http://long.example/x", page(f"<div><div>{legal}</div></div><div><p>{want[i]}</p></div>")))
    story = words(rng, 25)  # near copies of one article: one vote together, so their article stays
    for i in range(100, 500):
        want[i] = f"{story}\nread {i} times"
        rows.append((i, "http://long.example/x", page(
            f"<div><div>{legal}</div></div><div><p>{story}</p><span>read {i} times</span></div>")))
    want = {i: t.replace("\n", " ") for i, t in want.items()}
    assert {i: t.replace("\n", " ") for i, t in main_texts(spark, rows).items()} == want


def test_every_layout_has_a_wrapper(spark):
    """Page-specific names on upper elements, a layout under 1% of its host, and pages of a layout of their own."""
    rng = random.Random(8)
    rows, want = [], {}

    def add(host, body, attrs=""):
        i = len(rows)
        want[i] = words(rng, 20)
        rows.append((i, f"http://{host}/x", f"<html><body {attrs}>{body.format(text=want[i], i=words(rng, 1))}</body></html>"))

    plain = "<div>Site name</div><div><p>{text}</p></div><div>All rights reserved</div>"
    for k in range(20):  # every page with names of its own
        add("slugs.example", "<div class='{i}'>" + plain + "</div>", f"class='{words(rng, 1)}' id='{words(rng, 1)}'")
    for k in range(900):
        add("big.example", plain)
    for k in range(6):  # under 1% of the pages
        add("big.example", "<section>Imprint line</section><table><tr><td>{text}</td></tr></table>")
    add("big.example", plain + "<section></section>")  # a layout of its own: aligned with the most similar one
    assert main_texts(spark, rows) == want


def test_names_do_not_drop_the_story(spark):
    rng = random.Random(9)
    story, ad = words(rng, 60), words(rng, 4)
    card = f"<article><h3>{ad}</h3></article>"
    bodies = {
        "layout": f"<div class='layout has-sidebar'><article><p>{story}</p></article></div>",
        "policy": f"<div class='social-policy related-article'><p>{story}</p></div><div class='ad-3'>{ad}</div>",
        "sidebar": f"<div class='sidebar' id='no-sidebar'><div class='ad'>{ad}</div><p>{story}</p></div>",
        "form": f"<form><input><p>{story}</p><div class='comments'>{ad}</div></form>",
        "comments": f"<div><p>{story}</p></div><div class='comments'><p>{words(rng, 90)}</p></div>",
    }
    rows = [(i, f"http://{k}.example/", page(b)) for i, (k, b) in enumerate(bodies.items())]
    assert main_texts(spark, rows) == {i: story for i in range(len(bodies))}
    cards = main_texts(spark, [(1, "http://cards.example/", page(f"<div><p>{story}</p></div><div>{card}{card}</div>"))])
    assert story in cards[1]
    rows = []  # a constant notice without a whole name of the list goes by the votes
    for i in range(20):
        rows.append((i, "http://votes.example/", page(
            f"<div class='cookie-bar'>{story}</div><div class='related'><p>{words(rng, 80)} x</p></div>")))
    got = main_texts(spark, rows)
    assert all(story not in t and t.endswith(" x") for t in got.values())


def test_tree_matching_is_largest(spark):
    def best(a, b, p, q):
        if a.label[p] != b.label[q]:
            return 0
        x, y = a.children[p], b.children[q]
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + best(a, b, x[i], y[j]))
        return 1 + m[-1][-1]

    rng = random.Random(2)

    def tree(depth):
        tag = rng.choice(["div", "section", "span"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)) + f"</{tag}>"

    for _ in range(60):
        a, b = wrapper.Page(tree(3)), wrapper.Page(tree(3))
        assert len(wrapper.align(a, b)) == best(a, b, 0, 0)


# ---------------------------------------------------------------- 2 sharding

def brute_capacity(sizes, shards):
    def needed(c):
        n, cur = 1, 0
        for s in sizes:
            if cur + s > c:
                n, cur = n + 1, 0
            cur += s
        return n
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        m = (lo + hi) // 2
        lo, hi = (lo, m) if needed(m) <= shards else (m + 1, hi)
    return lo


@pytest.mark.parametrize("hot", [0, 400])
def test_sharding_is_minimax_and_atomic(spark, hot, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(sharding, "CANDIDATES", 5)  # several search rounds
    texts = ["x" * rng.randrange(1, 400) + str(i) for i in range(500)] + ["same text " * 20] * hot
    rows = sharding.shard_documents(docs_frame(spark, list(enumerate(texts)))).collect()
    load, place, slots = {}, {}, {}
    for r in rows:
        t = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + 1, zlib.crc32(t.encode()), "bytes", None)
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        assert place.setdefault(t, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(texts)
    total, group = sum(load.values()), {}
    for t in texts:
        group[t] = group.get(t, 0) + len(t) + 1
    keyed = {hashlib.md5(t.encode()).hexdigest(): n for t, n in group.items()}
    limit = total / (16 * sharding.LARGE_PER_SHARD)
    order = [n for _, n in sorted((-n, n) for n in keyed.values() if n > limit)] + [
        n for k, n in sorted(keyed.items()) if n <= limit]
    alone, done = 0, 0
    while order[alone] * (16 - alone) >= total - done:
        done, alone = done + order[alone], alone + 1
    assert max(n for s, n in load.items() if s >= alone) == brute_capacity(order[alone:], 16 - alone)
    assert len(load) == 16


def test_sharding_edges(spark):
    rows = sharding.shard_documents(docs_frame(spark, EDGE)).collect()
    assert len(rows) == len(EDGE) and {r["shard"] for r in rows} <= set(range(16))
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    assert sharding.shard_documents(docs_frame(spark, EDGE).limit(0)).count() == 0


# ---------------------------------------------------------------- 3 chat

def test_chat_roundtrip(spark):
    texts = ["\\### Assistant: </turn> ok", "####", "</turn>\n### User: x", "\\s\\h\\t\\", None, "", "tail \\", "#", "<", "😀"]
    rng = random.Random(4)
    rows, want = [], {}
    for c in range(40):
        turns = [(k, rng.choice(["system", "user", "assistant", None, "to:ol"]), rng.choice(texts)) for k in range(rng.randrange(1, 9))]
        rows += [(c, *t) for t in turns]
        want[c] = [(r or "", x or "") for _, r, x in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit("clash"))
    made = chat.format_conversations(df)
    got = made.select("conv_id", "formatted", "valid", "error_at", chat.read_turns(F.col("formatted")).alias("t"),
                      chat.loss_text(F.col("segments")).alias("lost"), "segments").collect()
    for r in got:
        assert [(x["role"], x["text"]) for x in r["t"]] == want[r["conv_id"]]
        assert r["lost"] == "".join(x for role, x in want[r["conv_id"]] if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        state, ok = "start", True
        moves = {(a, b): c for a, b, c in chat.TEMPLATE.moves}
        for role, _ in want[r["conv_id"]]:
            ok = ok and (state, role) in moves
            state = moves.get((state, role), state)
        assert r["valid"] == (ok and state == "assistant") and (r["error_at"] is None) == ok
    assert chat.format_conversations(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 4 toxicity

def test_toxicity_learns_and_handles_edges(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["tree", "house", "river", "stone", "cloud", "field"])
    texts = [" ".join(word() for _ in range(30)) + (" you vile grub" if i % 4 == 0 else "") for i in range(600)]
    docs = docs_frame(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(0, 0), (None, 1), (1, None)],
                                   "doc_id long, toxic int")
    may = common.fold("doc_id", 5) != 0
    model = toxicity.train(docs, labels, may)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score_udf(model)("text").alias("s")).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(600))
    edge = docs_frame(spark, EDGE).select(toxicity.score_udf(model)("text").alias("s")).collect()
    assert all(0.0 <= r["s"] < 0.5 for r in edge)
    empty = toxicity.train(docs, labels.limit(0), may)
    assert len(empty.index) == 0 and toxicity.train(docs.limit(0), labels, may).bias < 0


def test_ftrl_is_the_published_update():
    rows = [(np.array([1, 2]), 1), (np.array([2, 3]), 0), (np.array([1]), 1)] * 30
    z, n, zb, nb = {}, {}, 0.0, 0.0
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def w(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - np.sign(zi) * l1) / ((b + ni**0.5) / a + l2)

    for _ in range(2):
        for x, y in rows:
            bias = toxicity.PRIOR_BIAS - zb / ((b + nb**0.5) / a)
            g = 1 / (1 + np.exp(-(sum(w(i) for i in x) + bias))) - y
            for i in x:
                s = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / a
                z[i], n[i] = z.get(i, 0.0) + g - s * w(i), n.get(i, 0.0) + g * g
            sb = ((nb + g * g) ** 0.5 - nb**0.5) / a
            zb, nb = zb + g - sb * (bias - toxicity.PRIOR_BIAS), nb + g * g
    m = toxicity.fit_ftrl(rows, bits=4, epochs=2)
    assert {int(i): pytest.approx(v) for i, v in zip(m.index, m.weight)} == {i: w(i) for i in z if w(i)}


# ---------------------------------------------------------------- 5 embeddings

def brute_links(vectors, t=0.95):
    unit = [embedding_join.unit(v) for v in vectors]
    n, parent, count = len(vectors), list(range(len(vectors))), [0] * len(vectors)
    find = lambda i: i if parent[i] == i else find(parent[i])
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= t:
                count[i] += 1
                count[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return count, [find(i) for i in range(n)]


def test_embedding_join_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", 16)  # many cells and blocks
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 8))
    vectors = [(base[i % 12] + rng.normal(size=8) * rng.choice([0.02, 0.15, 0.6])).tolist() for i in range(240)]
    vectors += [vectors[0]] * 40 + [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] + [0.0] * 6, [1e300] * 8, [1.0] * 8, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    df = df.withColumn("cell", F.lit("clash")).withColumn("v", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_join.near_duplicates(df).collect()}
    count, top = brute_links(vectors)
    assert got == {i: (count[i], top[i], top[i] == i) for i in range(len(vectors))}
    assert embedding_join.near_duplicates(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 6 SimHash

def brute_fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    sh = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_matches_spark_hash_and_brute_force(spark):
    for t in ["", None, "a", "A b C d", "Ünï É x y z", "a\x0bb\x0cc d e f g", LONG[:2000], "a b c d " * 40]:
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    one = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert simhash.fingerprint("A B C D") == one % (1 << 64)


@pytest.mark.parametrize("block", [4096, 8])
def test_links_join_exactly_the_fingerprints_within_the_distance(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # 8: keys are split into block pairs
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(12):
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                f ^= 1 << b
            fps.add(f)
    fps |= {1 << i for i in range(30)} | {0}
    fps = sorted(fps)
    parent = common.unlinked_labels(len(fps))
    a, b = zip(*[(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    common.union_pairs(parent, np.array(a), np.array(b))
    top = common.roots(parent, np.arange(len(fps)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    links = simhash.fingerprint_links(df).collect()
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 4 for r in links)
    at = {signed(x): i for i, x in enumerate(fps)}
    got = common.unlinked_labels(len(fps))
    common.union_pairs(got, np.array([at[r["a"]] for r in links]), np.array([at[r["b"]] for r in links]))
    assert np.array_equal(common.roots(got, np.arange(len(fps))), top)


def test_simhash_groups_and_edges(spark):
    found = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs_frame(spark, EDGE)).collect()}
    assert found[5, f"{brute_fingerprint(EDGE[0][1]):016x}"] == 1
    assert found[2, "0" * 16] == found[3, "0" * 16] == found[7, "0" * 16] == 2
    assert found[None, f"{brute_fingerprint(EDGE[6][1]):016x}"] is None
    kept = simhash.keep_one_per_group(docs_frame(spark, EDGE + [(5, EDGE[0][1])]))
    assert kept.columns == docs_frame(spark, EDGE).columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 4), (False, 8), (True, 0)]
    assert simhash.near_duplicates(docs_frame(spark, EDGE).limit(0)).count() == 0


def test_one_id_over_unlinked_texts_loses_none(spark):
    rng = random.Random(11)
    text = lambda: " ".join(f"w{rng.randrange(9000)}" for _ in range(300))
    shared, alone, hot, no_id = text(), text(), [text() for _ in range(40)], text()
    near = lambda t: t + " end"
    rows = [(3, shared), (5, near(shared)), (5, alone), *[(7, t) for t in hot], (None, no_id), (None, near(no_id))]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.keep_one_per_group(docs_frame(spark, rows)).collect())
    assert [t for i, t in kept if i] == [t for _, t in sorted([(3, shared), (5, alone), *[(7, t) for t in hot]])]
    assert len([t for i, t in kept if not i]) == 1  # near copies without an id: one of them
    again = simhash.keep_one_per_group(docs_frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in again) == kept


# ---------------------------------------------------------------- 7 language

def test_gru_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) * 0.3 for k, v in langid._init(3, 4, rng).items()}
    x, y, m = rng.integers(1, 256, (6, 5)), rng.integers(0, 3, 5), np.ones((6, 5))
    m[5, 2] = 0
    _, g = langid.loss_and_gradients(x, y, m, p)
    for k in p:
        for _ in range(4):
            i = tuple(rng.integers(0, n) for n in p[k].shape)
            if k[0] == "W":
                i = (i[0], x[rng.integers(6), rng.integers(5)])
            keep, e = p[k][i], 1e-5
            p[k][i] = keep + e
            up = langid.loss_and_gradients(x, y, m, p)[0]
            p[k][i] = keep - e
            down = langid.loss_and_gradients(x, y, m, p)[0]
            p[k][i] = keep
            assert (up - down) / 2 / e == pytest.approx(g[k][i], abs=1e-7)


def test_language_id_learns_and_handles_edges(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 60)
    rng = random.Random(10)
    parts = {"aa": ["tha", "ing", "wor"], "bb": ["çou", "eux", "lé"], "cc": ["sch", "ung", "ä"]}
    say = lambda g, n: " ".join("".join(rng.choice(parts[g]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(g, 40), g) for i in range(240) for g in [list(parts)[i % 3]]] + [(999, say("aa", 9), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, common.fold("doc_id", 3) != 1)
    assert model.langs == ["aa", "bb", "cc"]
    got = docs.select("doc_id", "lang", langid.predict_udf(model)("text").alias("p")).where("lang is not null").collect()
    assert np.mean([r["p"]["lang_pred"] == r["lang"] for r in got]) > 0.97
    edge = docs_frame(spark, EDGE + [(9, "123 ... 45")]).select("doc_id", langid.predict_udf(model)("text").alias("p")).collect()
    und = {r["doc_id"] for r in edge if r["p"]["lang_pred"] == "und"}
    assert und == {2, 3, 7, 9} and all(0.0 <= r["p"]["score"] <= 1.0 for r in edge)
    none = langid.train(docs.limit(0), F.lit(True))
    assert docs.select(langid.predict_udf(none)("text").alias("p")).first()["p"]["lang_pred"] == "und"


def test_langid_writes_few_files(spark, monkeypatch):
    """Intermediate tables of narrow or few rows are not a file for every shuffle partition."""
    files, write = {}, langid.materialize

    def counted(rows, name):
        table = write(rows, name)
        files[name] = len(table.inputFiles())
        return table

    monkeypatch.setattr(langid, "materialize", counted)
    monkeypatch.setattr(langid, "STEPS", 2)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        docs = spark.range(600).selectExpr(
            "id doc_id", "concat('words and more of them ', id) text", "if(id % 2 = 0, 'en', 'de') lang")
        langid.rejection_bound(docs, langid.train(docs, F.col("doc_id") < 400), F.col("doc_id") >= 400)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert files.keys() == {"langid-keys", "langid-sample", "langid-windows", "langid-held-out"}
    assert max(files.values()) <= 8 and files["langid-sample"] == 1


def test_pooling_covers_the_whole_text(monkeypatch):
    """Windows of a long text weigh by their positions, whatever the batch they are computed in."""
    p = langid._init(2, 4, np.random.default_rng(1))
    model = langid.Model(["x", "y"], p)
    text = bytes(np.random.default_rng(2).integers(1, 256, 700).astype(np.uint8))
    whole = langid.document_probabilities([text, b"abc"], model)
    parts = [text[i:i + langid.WINDOW] for i in range(0, 700, langid.WINDOW)]
    each = langid.document_probabilities(parts, model)
    pooled = (each * np.array([[len(x)] for x in parts])).sum(axis=0) / 700
    assert np.allclose(whole[0], pooled, atol=1e-4)
    monkeypatch.setattr(langid, "LANES", 2)
    assert np.allclose(langid.document_probabilities([text, b"abc"], model), whole, atol=1e-5)


# ---------------------------------------------------------------- 8 decontamination

def brute_contained(docs, items, n=5, t=0.8):
    out = set()
    for d, x in docs:
        w = decontam.words_of(x)
        for i, y in items:
            v = decontam.words_of(y)
            if i is None or not v:
                continue
            k = min(n, len(v))
            own = {tuple(v[a:a + k]) for a in range(len(v) - k + 1)}
            if len(own & {tuple(w[a:a + k]) for a in range(len(w) - k + 1)}) >= t * len(own) - 1e-9:
                out.add((d, i))
    return out


def test_decontamination_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ENTRIES", 40)  # several blocks of sketches
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 4, 5, 6, 12, 40])))) for i in range(30)]
    items += [(50, None), (51, ""), (None, "w1 w2"), (52, items[20][1])]
    docs = list(EDGE)
    for d in range(100, 220):
        w = [word() for _ in range(rng.randrange(0, 300))]
        v = items[rng.randrange(30)][1].split()
        for _ in range(rng.randrange(0, max(1, len(v) // 8) + 1)):  # some copies are damaged
            v[rng.randrange(len(v))] = "zz"
        at = rng.randrange(len(w) + 1)
        docs.append((d, ", ".join(w[:at]) + " " + " ".join(v).upper() + ". " + " ".join(w[at:])))
    df = docs_frame(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contained(docs, items)
    got = [(r["doc_id"], r["item_id"]) for r in decontam.contained_items(df, bench).collect()]
    assert set(got) == want and len(want) > 60
    clean = decontam.without_benchmark(df, bench)
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in {x for x, _ in want})
    assert clean.columns == df.columns
    assert decontam.contained_items(df.limit(0), bench).count() == 0
    assert decontam.contained_items(df, bench.limit(0)).count() == 0


# ---------------------------------------------------------------- 9 SentencePiece

PIECES = P.path("piece_bpe_32k.model")


def test_sentencepiece_equals_the_library(spark):
    sp, c = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepieces.Coder(PIECES)
    rng = random.Random(12)
    parts = ["aaaaaaaa", "  ", "\n", "the quick", "ﬁ½", "漢字", "é́", "\x00", "▁", "<s>", "</s>", "<unk>", "0123", "....", "\t", "😀👍🏽",
             "　", "​", "def f(x):", "ааа", "ß", "﻿", "<0x0A>", "ers.", "-- ", "don't"]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.6 else chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0xD7FF)]))
                     for _ in range(rng.randrange(14))) for _ in range(6000)]
    texts += ["".join(rng.choice("abelnorst ") for _ in range(rng.randrange(30))) for _ in range(3000)] + [LONG]
    for t in texts:
        ids = sp.encode(t)
        assert c.encode(t) == ids and c.decode(ids) == sp.decode(ids), t
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randrange(8))]
        assert c.decode(ids) == sp.decode(ids), ids
    df = docs_frame(spark, EDGE)
    rows = df.select("doc_id", "text", sentencepieces.encode_udf(PIECES)("text").alias("ids"),
                     sentencepieces.encoded_udf(PIECES)("text").alias("r")).withColumn("back", sentencepieces.decode_udf(PIECES)("ids"))
    for r in rows.collect():
        ids = sp.encode(r["text"] or "")
        assert r["ids"] == ids == r["r"]["ids"] and r["back"] == sp.decode(ids) and r["r"]["n_tokens"] == len(ids)
        assert r["r"]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_memos_stay_bounded():
    c = sentencepieces.Coder(PIECES)
    c.word_ids.size = c.part_ids.size = 50
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = " ".join(f"word{i} thing{i * 7}" for i in range(400))
    assert c.encode(text) == sp.encode(text) and len(c.word_ids) <= 50 and len(c.part_ids.old) <= 50


def test_digests_come_from_word_records():
    """Words that share prefixes, stems with punctuation, long runs without a space, all with memos that turn over."""
    c, sp = sentencepieces.Coder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    c.word_ids.size = c.part_ids.size = c.prefixes.size = 40
    rng = random.Random(15)
    syllables = ["th", "ing", "er", "on", "nd", "ción", "é", "ñ", "a", "Q", "ß", "漢", "x1"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6))) + rng.choice(["", "", ".", ",\nEnd", "...", "'s", "!?"])

    texts = [" ".join(word() for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    texts += ["".join(rng.choice(syllables) for _ in range(n)) for n in (20, 60, 63, 64, 65, 5000)] + ["", None, " ", "\n", "a  b "]
    for t in texts:
        ids = sp.encode(t or "")
        n, ids_sha, text_sha, found = c.roundtrip(t)
        assert (n, found.tolist()) == (len(ids), ids), t
        assert ids_sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert text_sha == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert len(c.prefixes) <= 40


def test_word_records_are_small():
    """A worker keeps many words: a word costs its packed ids, not their decimal text and bytes as well."""
    c, sp = sentencepieces.Coder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [" ".join(f"{x}ening{y}, {x}{y}ation" for y in "abcdefghij") for x in ("th", "re", "on", "ciudad")] + ["", None, "a  b "]
    for t, (n, ids_sha, text_sha, found) in zip(texts, c.roundtrips(texts), strict=True):
        ids = sp.encode(t or "")
        assert (n, found.tolist()) == (len(ids), ids)
        assert ids_sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert text_sha == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert c.roundtrips([]) == []
    assert all(type(v) is bytes and len(v) == 2 * len(sp.encode(w)) for w, v in c.word_ids.items())
    assert c.word_ids.size + c.prefixes.size <= 150_000


# ---------------------------------------------------------------- 10 token ids

def test_memo_keeps_letters_once():
    """Letters with different punctuation behind them are one entry of the memo; ids are the library's."""
    path = P.path("byte_bpe_50k.json")
    enc, lib = tokenids.Encoder(path), tokenizers.Tokenizer.from_file(path)
    ends = ["", ".", ",", "...", "!?", ")", "###", "'s", "'", "1", "\nand", "é", "é.", "漢,"]
    texts = ["one " + " ".join(w + e for w in ("house", "Ärger", "niño") for e in ends), "go.", "'tis, x. 漢. .", "", None]
    found = enc.encode(texts)
    for t, raw in zip(texts, found, strict=True):
        assert np.frombuffer(raw, f"<u{enc.width}").tolist() == lib.encode(t or "", add_special_tokens=False).ids
    assert "house" in enc.words and not {f"house{e}" for e in (".", ",", "...", "!?", ")", "###")} & enc.words.keys()


def test_perfect_hash_is_minimal():
    for n in (1, 2, 3, 17, 256, 700):
        h = tokenids.key_hash(np.arange(n) * 3 - 5, np.zeros(n, np.int64))
        seed, pilots = tokenids.build_mph(h)
        assert sorted(tokenids.lookup(h, seed, pilots, n)) == list(range(n))


def test_pilots_are_the_first_that_fit_and_a_batch_is_encoded_at_once():
    for n in (5, 64, 300):
        h = tokenids.key_hash(np.arange(n) * 11, np.zeros(n, np.int64))
        seed, pilots = tokenids.build_mph(h)
        cell = tokenids._cells(h, seed, len(pilots))
        taken = set()
        for c in np.argsort(-np.bincount(cell, minlength=len(pilots)), kind="stable"):
            if len(own := h[cell == c]):
                slots = next(s for p in range(1 << 17) if len(s := set(tokenids._slots(own, np.array([p]), n).tolist()) - taken) == len(own))
                assert slots == set(tokenids._slots(own, pilots[c:c + 1], n).tolist())
                taken |= slots
    # Texts of usual length: a batch of them is one group, in which a word is met once.
    assert [len(g) for g in tokenids._text_groups(pd.Series(["x" * 3300] * 2000))] == [2000]
    assert [len(g) for g in tokenids._text_groups(pd.Series(["x" * 5_000_000] * 3))] == [2, 1]


def test_token_files_roundtrip(spark, monkeypatch):
    monkeypatch.setattr(tokenids, "BLOCK_IDS", 64)
    path, tok = P.path("byte_bpe_50k.json"), tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = EDGE + [(100 + i, f"text {i}  with\n\nparts 's don't 漢 {i * 37}") for i in range(300)] + [(None, "again")]
    out = scratch_path(spark, "test-tokens")
    tokenids.write_token_files(docs_frame(spark, docs), out, path, rows_per_shard=50)
    wanted = docs_frame(spark, docs).groupBy("doc_id").count().select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("copy"))
    extra = spark.createDataFrame([(-12345, 0), (1, 5)], "doc_id long, copy long")  # not in the index
    rows = tokenids.look_up(spark, out, wanted.unionByName(extra)).orderBy("start").collect()
    assert len(rows) == len(docs)
    start = 0
    by_id = {}
    for d, t in docs:
        by_id.setdefault(d, []).append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    assert [r["doc_id"] for r in rows] == sorted([d for d, _ in docs], key=lambda d: (d is not None, d or 0))
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids in by_id[r["doc_id"]] and (r["start"], r["n_tokens"]) == (start, len(ids))
        start += len(ids)
    empty = scratch_path(spark, "test-tokens")
    tokenids.write_token_files(docs_frame(spark, docs).limit(0), empty, path)
    assert tokenids.look_up(spark, empty, wanted).count() == 0


def test_piecewise_encoding_equals_whole_texts():
    enc, tok = tokenids.Encoder(P.path("byte_bpe_50k.json")), tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(13)
    parts = ["  ", "\n", "a", "the", "'s", " 's", "\t", "\xa0", "　", "é", "漢", "12", ".", " .", "\x1c", "\x85", "᠎", "​",
             "😀", "<|endoftext|>", " <|endoftext|>", "\r\n", " ", "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(8000)] + [None, "", LONG]
    whole = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == whole


def test_letter_words_of_all_bytes_go_to_the_model(monkeypatch):
    """Words that reach the model directly, over several generations of the memo."""
    monkeypatch.setattr(tokenids, "_PIECE_CACHE", 30)
    enc, tok = tokenids.Encoder(P.path("byte_bpe_50k.json")), tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert enc.direct
    rng = random.Random(14)
    letters = "abcXYZ" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    for _ in range(20):
        texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", ".", "\nQ", ",\nÀ?"])
                          for _ in range(rng.randrange(1, 30))) for _ in range(40)]
        whole = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == whole
