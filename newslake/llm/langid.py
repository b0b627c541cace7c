"""Language identification: a bidirectional GRU over UTF-8 bytes, trained in numpy.

Two gated recurrent networks read a window of bytes, one in each direction; at every byte a
softmax over both states gives the probability of each language (the network labels every
position). A document's probabilities are the mean over all its positions, over the whole
text: long texts are read as consecutive windows of ``WINDOW`` bytes, all windows of an Arrow
batch side by side, so one step is one small matrix product for thousands of windows.
Training is backpropagation through time with Adam on a bounded sample: at most ``DOCS_PER_LANG`` labelled
documents of a language, and of all windows of their whole texts at most ``WINDOWS_PER_LANG``, each window with
the same chance. Documents and windows are chosen by hash before they move; only windows reach the fit.

Defined results: a NULL text, or one without any letter, is ``und`` with score 0. Ties go to
the language that sorts first. With no labelled row at all every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import worker_belongs_to
from newslake.session import materialize

HIDDEN = 8
WINDOW = 128
LANES = 2048  # windows computed side by side: bounds the memory of a step
DOCS_PER_LANG = 300  # bound of the sample, smallest hash of id and text first
WINDOWS_PER_LANG = 6000  # bound of the windows of these documents, smallest hash first
STEPS, BATCH, RATE = 240, 192, 0.012
UNDETERMINED = "und"
SCHEMA = "lang_pred string, score double"


@dataclass
class Model:
    langs: list[str]
    params: dict[str, np.ndarray]


def _init(n_langs: int, hidden: int, rng) -> dict[str, np.ndarray]:
    p = {"V": rng.normal(0, 0.3, (n_langs, 2 * hidden)), "c": np.zeros((n_langs, 1))}
    for d in "fb":
        p["W" + d] = rng.normal(0, 0.3, (3 * hidden, 256))  # input weights, one column per byte
        p["U" + d] = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden))
        p["s" + d] = np.zeros((hidden, 1))  # bias inside the reset gate
    return {k: v.astype(np.float32) for k, v in p.items()}


def _run(x: np.ndarray, p: dict, d: str, keep: bool):
    """States of one direction for byte indices ``x`` [T, B], in reading order; gates too if ``keep``.

    Gates are the piecewise-linear sigmoid clip(a / 4 + 1 / 2, 0, 1), the candidate is clip(a, -1, 1):
    a fraction of the cost of exponentials, and the same in training and use. Read backwards, the padding (byte 0)
    of a short window comes first: the state stays zero there, so no window depends on its neighbours' lengths.
    """
    steps, lanes = x.shape
    w, u, s = p["W" + d].copy(), p["U" + d].copy(), p["s" + d]
    hid = u.shape[1]
    w[: 2 * hid] = w[: 2 * hid] * 0.25 + 0.5
    u[: 2 * hid] *= 0.25
    h = np.zeros((hid, lanes), w.dtype)
    states = np.empty((steps, hid, lanes), w.dtype)
    gates = []
    present = (x != 0).astype(w.dtype) if d == "b" else None
    a = g = None
    for t in range(steps):
        if keep:
            a = g = None
        a = np.take(w, x[t], axis=1, out=a, mode="clip")
        g = np.matmul(u, h, out=g)
        zr, n, q = a[: 2 * hid], a[2 * hid:], g[2 * hid:]
        zr += g[: 2 * hid]
        np.clip(zr, 0.0, 1.0, out=zr)
        z, r = zr[:hid], zr[hid:]
        q += s
        n += r * q
        np.clip(n, -1.0, 1.0, out=n)
        if keep:
            gates.append((z, r, n, q, h))
        h = np.subtract(h, n, out=states[t])
        h *= z
        h += n
        if present is not None:
            h *= present[t]
    return states, gates


def _probabilities(hf: np.ndarray, hb: np.ndarray, p: dict) -> np.ndarray:
    hid = hf.shape[0]
    o = p["V"][:, :hid] @ hf
    o += p["V"][:, hid:] @ hb
    o += p["c"]
    np.clip(o, -40.0, 40.0, out=o)
    np.exp(o, out=o)
    o *= 1.0 / o.sum(axis=0)
    return o


def loss_and_gradients(x: np.ndarray, y: np.ndarray, mask: np.ndarray, p: dict):
    """Mean cross-entropy over the positions of ``mask`` [T, B] and its gradients (BPTT)."""
    steps, lanes = x.shape
    hid = p["Uf"].shape[1]
    sf, gf = _run(x, p, "f", True)
    sb, gb = _run(x[::-1], p, "b", True)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    total, scale = 0.0, 1.0 / max(1.0, float(mask.sum()))
    df = np.empty_like(sf)
    db = np.empty_like(sb)
    lane = np.arange(lanes)
    for t in range(steps):
        hf, hb = sf[t], sb[steps - 1 - t]
        o = _probabilities(hf, hb, p)
        m = mask[t]
        total -= float((np.log(o[y, lane] + 1e-12) * m).sum()) * scale
        o[y, lane] -= 1.0
        o *= m * scale
        grad["V"] += o @ np.concatenate((hf, hb)).T
        grad["c"] += o.sum(axis=1, keepdims=True)
        back = p["V"].T @ o
        df[t], db[steps - 1 - t] = back[:hid], back[hid:]
    for d, xs, gates, dh_out in (("f", x, gf, df), ("b", x[::-1], gb, db)):
        u, dh = p["U" + d], np.zeros((hid, lanes), sf.dtype)
        inputs = np.empty((3 * hid, steps, lanes), sf.dtype)
        for t in range(steps - 1, -1, -1):
            z, r, n, q, h = gates[t]
            dh = dh + dh_out[t]
            if d == "b":
                dh *= xs[t] != 0
            dn = dh * (1 - z) * (np.abs(n) < 1)
            dz = dh * (h - n) * 0.25 * ((z > 0) & (z < 1))
            dr = dn * q * 0.25 * ((r > 0) & (r < 1))
            dq = dn * r
            dg = np.concatenate((dz, dr, dq))
            grad["U" + d] += dg @ h.T
            grad["s" + d] += dq.sum(axis=1, keepdims=True)
            inputs[:, t] = np.concatenate((dz, dr, dn))
            dh = dh * z + u.T @ dg
        flat = np.ascontiguousarray(xs).ravel()
        for k in range(3 * hid):
            grad["W" + d][k] = np.bincount(flat, weights=inputs[k].ravel(), minlength=256)
    return total, grad


def fit(windows: np.ndarray, labels: np.ndarray, n_langs: int, hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7):
    """Adam over random batches of byte windows [N, T] (0 pads); returns the parameters."""
    rng = np.random.default_rng(seed)
    p = _init(n_langs, hidden, rng)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for i in range(1, steps + 1):
        pick = rng.integers(0, len(windows), min(BATCH, len(windows)))
        x = np.ascontiguousarray(windows[pick].T).astype(np.intp)
        _, g = loss_and_gradients(x, labels[pick], (x != 0).astype(np.float32), p)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * min(1.0, 2.0 * (1 - i / (steps + 1))) * min(1.0, 1.0 / (norm + 1e-8))
        for k, v in g.items():
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            hat = first[k] / (1 - 0.9**i)
            p[k] -= rate * hat / (np.sqrt(second[k] / (1 - 0.99**i)) + 1e-8)
    return p


def _windows(raw: bytes, window: int = WINDOW) -> np.ndarray:
    n = -(-len(raw) // window)
    out = np.zeros(n * window, np.uint8)
    out[: len(raw)] = np.frombuffer(raw.replace(b"\0", b" "), np.uint8)  # 0 is the padding
    return out.reshape(n, window)


def document_probabilities(texts: list[bytes], model: Model) -> np.ndarray:
    """Mean language probabilities over all byte positions of every text, [len(texts), langs]."""
    p, n_langs = model.params, len(model.langs)
    total = np.zeros((len(texts), n_langs))
    blocks = [_windows(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(b) for b in blocks])
    length = np.array([len(t) for t in texts], dtype=np.float64)
    every = np.concatenate(blocks) if blocks else np.zeros((0, WINDOW), np.uint8)
    for at in range(0, len(every), LANES):
        part = every[at:at + LANES]
        size = (part != 0).sum(axis=1).max(initial=0)  # a group of short windows stops early
        x = np.ascontiguousarray(part[:, : max(1, int(size))].T).astype(np.intp)
        sf, _ = _run(x, p, "f", False)
        sb, _ = _run(x[::-1], p, "b", False)
        pooled = np.zeros((n_langs, x.shape[1]), np.float32)
        for t in range(len(x)):
            pooled += _probabilities(sf[t], sb[len(x) - 1 - t], p) * (x[t] != 0)
        for k in range(n_langs):
            total[:, k] += np.bincount(owner[at:at + LANES], weights=pooled[k], minlength=len(texts))
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-9) * (length > 0)[:, None]


def _smallest(rows: DataFrame, key: str, per: str, most: int) -> DataFrame:
    """Of distinct (per, key) rows the ``most`` with the smallest keys for every value of ``per``.

    A histogram of the keys (4,096 places a value) says how far to look; of what lies that near each map task hands
    on its smallest ``most`` keys.
    """
    place = F.shiftrightunsigned(key, 52).alias("place")
    counted = rows.select(per, place).groupBy(per, "place").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(per).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    near = counted.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("before") < most)
    found = rows.withColumn("place", place).join(near.select(per, "place"), [per, "place"])
    order = Window.partitionBy(per).orderBy("place", key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(per, key)


def _written(rows: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Narrow or few rows as a table of few files, by default an eighth of the shuffle's partitions.

    On folders of a plain file system Hadoop starts a process for every file it creates, out of the executor.
    """
    files = files or max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    return materialize(rows.coalesce(files), name)


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All windows of every text."""
    worker_belongs_to("langid")
    for f in frames:
        for lang, k, text in zip(f["lang"], f["k"], f["text"], strict=True):
            w = _windows(text.encode("utf-8", "replace"))
            for at in range(0, len(w), LANES):
                part = w[at:at + LANES]
                yield pd.DataFrame({"lang": lang, "k": k, "i": np.arange(at, at + len(part)), "w": [x.tobytes() for x in part]})


def train(docs: DataFrame, may_learn, docs_per_lang: int = DOCS_PER_LANG) -> Model:
    """Fit on at most ``docs_per_lang`` different rows of every language among the rows of ``may_learn``.

    The fit runs in one task on the sample's windows.
    """
    rows = (
        docs.select("doc_id", "text", "lang")
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0)).where(may_learn)
        .select("lang", "text", F.xxhash64("doc_id", "text").alias("k"))
    )
    keys = _written(rows.select("lang", "k").distinct(), "langid-keys")
    chosen = _written(_smallest(keys, "k", "lang", docs_per_lang), "langid-sample", 1)  # a bounded number a language
    sample = rows.join(F.broadcast(chosen), ["lang", "k"]).dropDuplicates(["lang", "k"])
    windows = _written(
        sample.select("lang", "k", "text").mapInPandas(_cut, "lang string, k long, i int, w binary")
        .withColumn("h", F.xxhash64("k", "i")), "langid-windows", 8)
    used = windows.join(F.broadcast(_smallest(windows.select("lang", "h"), "h", "lang", WINDOWS_PER_LANG)), ["lang", "h"])

    def fit_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = pd.concat([pd.DataFrame({"lang": [], "h": [], "w": []}), *frames], ignore_index=True)
        if not len(f):
            return
        f = f.sort_values(["lang", "h", "w"], kind="stable")
        langs = sorted(f["lang"].unique())
        windows = np.stack([np.frombuffer(w, np.uint8) for w in f["w"]])
        # Rare languages weigh as much as common ones: repeat their windows.
        y = f["lang"].map({g: i for i, g in enumerate(langs)}).to_numpy(dtype=np.int64)
        most = np.bincount(y).max()
        pick = np.concatenate([np.resize(np.flatnonzero(y == i), most) for i in range(len(langs))])
        p = fit(windows[pick], y[pick], len(langs))
        for name, v in p.items():
            yield pd.DataFrame({"langs": [langs], "name": [name], "shape": [list(v.shape)],
                                "value": [v.astype(np.float64).ravel()]})

    got = (
        used.select("lang", "h", "w").repartition(1)
        .mapInPandas(fit_task, "langs array<string>, name string, shape array<int>, value array<double>").collect()
    )
    if not got:
        return Model([], {})
    return Model(list(got[0]["langs"]), {r["name"]: np.array(r["value"], np.float32).reshape(r["shape"]) for r in got})


def predict_udf(model: Model):
    """Pandas UDF text -> struct(lang_pred, score)."""

    @F.pandas_udf(SCHEMA)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_belongs_to("langid")
        for texts in parts:
            lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            read = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.langs else []
            # A batch of very long texts goes through in groups of bounded size.
            group, size = [], 0
            for j, i in enumerate(read):
                raw = texts.iloc[i].encode("utf-8", "replace")
                group.append((i, raw))
                size += len(raw)
                if size >= LANES * WINDOW or j == len(read) - 1:
                    prob = document_probabilities([r for _, r in group], model)
                    best = prob.argmax(axis=1)
                    for (i_, _), b, q in zip(group, best, prob.max(axis=1), strict=True):
                        lang[i_], score[i_] = model.langs[b], min(1.0, float(q))
                    group, size = [], 0
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return predict


def rejection_bound(docs: DataFrame, model: Model, held_out) -> float:
    """The score under which a text is in none of the learned languages.

    A tenth of the way from chance (one in the number of languages) to what all but a hundredth of the labelled rows
    of ``held_out`` reach; chance if there are none. Every different row counts, and their scores alone are sorted.
    """
    if not model.langs:
        return 0.0
    chance = 1.0 / len(model.langs)
    known = docs.where(F.col("lang").isin(model.langs) & (F.length("text") > 0)).where(held_out).select(
        F.xxhash64("doc_id", "text").alias("k"), predict_udf(model)("text").alias("p"))
    scored = known.where(F.col("p.lang_pred") != UNDETERMINED).groupBy("k").agg(F.min("p.score").alias("score"))
    scores = _written(scored.select("score"), "langid-held-out")
    place = 0.01 * (scores.count() - 1)
    if place < 0:
        return chance
    # The scores on both sides of the place, of which the driver gets two.
    near = scores.orderBy("score").limit(int(place) + 2).orderBy(F.desc("score")).limit(2).collect()
    upper, lower = near[0]["score"], near[-1]["score"]
    low = lower + (place - int(place)) * (upper - lower)
    return min(chance, low) + 0.1 * max(0.0, low - chance)
