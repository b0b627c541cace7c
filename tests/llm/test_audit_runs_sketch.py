"""Filter audit, periodic runs and fingerprints against brute force, with edge cases."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from newslake.llm import filter_audit, fracsketch, queries, runs

DOCS = "doc_id long, text string, lang string, source string, part string, mask int, n long, runs int, sketch int"


def docs_frame(spark, rows):
    """Rows of (doc_id, text[, source]) with extra columns whose names clash with internal ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", "clash", 7, 7, 7, 7) for r in rows]
    return spark.createDataFrame(full, DOCS)


# ---------------------------------------------------------------- 11 filter audit

def brute_audit(rows, labels):
    """(part, order, step) -> the seven counts, by applying every order to the rows."""
    def fails(i, part, text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = ""
        out += "A" if len(w) < 200 else ""
        out += "B" if 100 * len(set(w)) < 50 * len(w) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
        out += "D" if re.search("[#$%&*|]", text) else ""
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            out += "E"
        return out

    judged = [(p or "", fails(i, p, t or ""), any(a == i and q == 1 for a, q, _ in labels if i is not None),
               any(a == i and x == 1 for a, _, x in labels if i is not None)) for i, t, p in rows]
    want = {}
    for part in {p for p, *_ in judged}:
        own = [r for r in judged if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                failing = sum(f in r[1] for r in own)
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                want[part, order, k + 1] = [
                    len(left), len(gone), failing - len(gone), sum(r[1] == f for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, k), v in want.items():
            if p == part:
                v.append(total[order[k - 1]])
    return want


def audited(docs, labels):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = filter_audit.audit_filters(docs, labels, queries.AUDITED, "E").collect()
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in cols] for r in got}


def test_filter_audit_equals_applying_every_order(spark):
    rng = random.Random(3)

    def text():
        n = rng.choice([0, 3, 199, 200, 260])
        pool = rng.choice([40, 5000])
        return " ".join(rng.choice(["w", "W"] if rng.random() < 0.3 else ["x"]) + str(rng.randrange(pool)) for _ in range(n)) \
            + rng.choice(["", " 5%", "\n\t"])

    rows = [(i, text(), rng.choice(["a", "b", None])) for i in range(120)]
    rows += [(200 + i, rows[7][1], "a") for i in range(60)]  # a third of the rows share a text
    rows += [(5, rows[5][1], rows[5][2]), (5, "other text of the same id", "b"), (None, rows[7][1], "a"), (None, None, ""), (9000, None, "b")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 3)] + [(3, 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(docs_frame(spark, rows), frame) == brute_audit(rows, labels)
    assert audited(docs_frame(spark, rows).limit(0), frame) == {}


def test_gray_walk_equals_counting_every_subset():
    rng = np.random.default_rng(1)
    for k in (1, 3, 5, 6):
        cells = rng.integers(0, 50, (3, 1 << k, 2))
        states = filter_audit.survivors_by_subset(cells)
        for subset in range(1 << k):
            alive = [m for m in range(1 << k) if not m & subset]
            assert (states[subset] == cells[:, alive].sum(axis=1)).all()


# ---------------------------------------------------------------- 12 periodic runs

def brute_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size, part = j - i + q, words[i:j + q]
            if size >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.add((i, size, q))
            i = j
    return sorted(out)


def brute_collapsed(words, found):
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        k, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.randrange(0, 80)
        words = [str(rng.randrange(k)) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            base = [str(rng.randrange(k)) for _ in range(rng.randrange(1, 8))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [base[i % len(base)] for i in range(rng.randrange(1, 40))]
        (found, collapsed), other = runs.find_runs([" ".join(words), "x x x x x x"])
        assert found == brute_runs(words)
        assert collapsed == brute_collapsed(words, found)
        assert other == ([(0, 6, 1)], "x")


def test_runs_in_long_texts():
    rng = random.Random(2)
    noise = [str(rng.randrange(40)) for _ in range(60_000)]
    block = [f"b{i}" for i in range(500)]
    words = noise[:30_000] + block * 5 + block[:123] + noise[30_000:] + ["z"] * 50_000
    (found, collapsed), = runs.find_runs([" ".join(words)])
    assert (30_000, 2_623, 500) in found and (62_623, 50_000, 1) in found
    assert [r for r in found if r[1] > 100] == [(30_000, 2_623, 500), (62_623, 50_000, 1)]
    assert collapsed == brute_collapsed(words, found)
    thue = [0]  # blocks of this sequence collide under polynomial hashes; it holds no cube
    while len(thue) < 1 << 14:
        thue += [1 - x for x in thue]
    assert runs.find_runs([" ".join(map(str, thue))])[0][0] == []


def test_runs_of_a_table(spark):
    rows = [(1, "a b a b a b a b c"), (2, None), (3, ""), (4, " \n\t "), (5, "q " * 7), (5, "q " * 7), (None, "no\xa0break no\xa0break end"),
            (7, "漢 😀 " * 4 + "漢")]
    got = runs.periodic_runs(docs_frame(spark, rows)).collect()
    found = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str)
    assert found == sorted([
        (1, [(0, 8, 2)], "a b c"), (2, [], ""), (3, [], ""), (4, [], ""), (5, [(0, 7, 1)], "q"), (5, [(0, 7, 1)], "q"),
        (None, [], "no\xa0break no\xa0break end"), (7, [(0, 9, 2)], "漢 😀")], key=str)
    assert runs.periodic_runs(docs_frame(spark, rows).limit(0)).count() == 0


def test_op12_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    docs = queries.read_table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found, r = brute_runs(words), got[doc_id]
        planted += bool(found)
        assert r["n_runs"] == len(found)
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest()
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
    assert planted


# ---------------------------------------------------------------- 13 fingerprints

def shingles(text):
    w = (text or "").encode().split()
    k = min(5, len(w))
    return {b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_sketches_estimate_containment_of_unequal_documents():
    rng = random.Random(4)
    words = [f"w{rng.randrange(3000)}" for _ in range(40_000)]
    long, short = " ".join(words), " ".join(words[5000:6500] + [f"n{i}" for i in range(500)])
    a, b = fracsketch.sketch(short), fracsketch.sketch(long)
    true = len(shingles(short) & shingles(long)) / len(shingles(short))
    assert abs(fracsketch.containment(a, b) - true) < 0.08
    assert abs(len(b) * fracsketch.SCALE / len(shingles(long)) - 1) < 0.06  # a fixed fraction, whatever the size
    halves = [" ".join(words[:20_000]), " ".join(words[19_996:])]
    assert np.array_equal(fracsketch.merged(*map(fracsketch.sketch, halves)), b)
    assert fracsketch.likeness(a, a) == 1 and fracsketch.likeness(a, b[:0]) == 0 and fracsketch.likeness(b[:0], b[:0]) == 1
    assert len(fracsketch.sketch("one")) == 1 and not len(fracsketch.sketch(" \n")) and not len(fracsketch.sketch(None))


def test_merged_fingerprints(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (1, 2, 60, 90, 3)]
    rows = [("big", texts[2]), ("big", texts[3]), ("big", texts[0]), ("small", texts[0]), ("small", texts[1]), ("none", "")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {}
    for r in fracsketch.merged_fingerprints(fracsketch.document_fingerprints(df), "doc_id").collect():
        got.setdefault(r["doc_id"], []).append(r["hash"])
    for key in ("big", "small"):
        want = fracsketch.sketch("")
        for k, t in rows:
            if k == key:
                want = fracsketch.merged(want, fracsketch.sketch(t))
        assert sorted(got[key]) == want.tolist()
    assert "none" not in got


def test_neighbours_and_edits(spark):
    rng = random.Random(5)

    def prose(n):
        return " ".join(f"w{rng.randrange(900)}é" for _ in range(n))

    shared = prose(300)
    rows = [(i * 7, prose(rng.choice([1, 4, 40, 200]))) for i in range(150)]
    rows += [(5000 + i, shared) for i in range(80)] + [(60, None), (61, ""), (62, "ab"), (8000, "😀" * 5)]
    rng.shuffle(rows)
    order = sorted(rows, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in fracsketch.compare_with_edits(docs_frame(spark, rows).repartition(5)).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        changed = fracsketch.edited(text, after)
        own, other, following = map(fracsketch.sketch, (text, changed, after))
        r = got[doc_id]
        assert (r["n_chars"], bytes(r["edited_sha"])) == (len(text), hashlib.sha256(changed.encode()).digest())
        assert (bytes(r["sketch"]), bytes(r["edited_sketch"])) == (fracsketch.packed(own), fracsketch.packed(other))
        assert (r["near_edited"], r["near_next"]) == (fracsketch.likeness(own, other), fracsketch.likeness(own, following))
    assert got[5010]["near_next"] == 1


def test_neighbours_edge_tables(spark):
    one = fracsketch.compare_with_edits(docs_frame(spark, [(3, "a b c d e f g h")])).collect()
    assert [(r["doc_id"], r["n_chars"], r["near_next"]) for r in one] == [(3, 15, 1.0)]
    assert fracsketch.compare_with_edits(docs_frame(spark, [(3, "x")]).limit(0)).count() == 0
    rows = [(5, "same text here")] * 40 + [(5, "another text of id five"), (None, "no id"), (None, None), (9, "z")]
    got = fracsketch.compare_with_edits(docs_frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert sum(r["doc_id"] == 5 and r["near_next"] == 1 for r in got) >= 39


def test_op13_query_separates_edits_from_neighbours(spark):
    got = queries.op13_fingerprints(spark, "/root/testdata/sf0.001").where(F.col("n_chars") > 500).collect()
    assert got and all(re.fullmatch("([0-9a-f]{8})+", r["fingerprint"]) for r in got)
    assert sum(r["near_edited"] > r["near_next"] for r in got) >= 0.97 * len(got)
