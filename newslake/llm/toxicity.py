"""Toxicity scoring: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text becomes the *set* of its hashed features: words, adjacent word pairs and pairs with one
word skipped. FTRL-proximal keeps an accumulated gradient and a squared-gradient sum per
coordinate, so frequent features get small steps and rare ones large steps, and L1 sets most
weights to exactly zero. What is left is a short list of (feature, weight) that travels with the
scoring tasks; scoring is one pass over the texts without a shuffle.

Defined results: NULL and empty texts have no features and get the score of the bias alone.
Repeated label rows of a document count once, with the larger label. A NULL id is never
learned from. Without any labelled row the model is the prior alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import worker_belongs_to

BITS = 20  # hashed feature space: bounds the weights at 2**20 whatever the corpus
MAX_TRAIN_ROWS = 8000  # bound of the labelled sample, smallest xxhash64(id) first
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.5
PRIOR_BIAS = -3.0
_WORD = re.compile(r"\w+")
_WORD_CACHE = 200_000  # entries of a task's word-hash memo; it is emptied when full


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


def hashed_features(text: str | None, memo: _WordHash, bits: int = BITS) -> np.ndarray:
    """Hashed words, word pairs and one-skip pairs of the whole text, with repeats."""
    words = _WORD.findall(text.lower()) if text else []
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    skip = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[2:] * np.uint64(0x165667B19E3779F9) + np.uint64(2)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate((h, pair, skip)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def table(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, dtype=np.float64)
        w[self.index] = self.weight
        return w


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-max(-35.0, min(35.0, x)))))


def fit_ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over (distinct features, label) rows, in the order given, ``epochs`` times."""
    z = np.zeros(1 << bits)
    n = np.zeros(1 << bits)
    zb, nb = 0.0, 0.0

    def weight(zi, ni):
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) > L1, w, 0.0)

    bias = PRIOR_BIAS
    for _ in range(epochs if rows else 0):
        for idx, y in rows:
            w = weight(z[idx], n[idx])
            bias = PRIOR_BIAS - zb / ((BETA + np.sqrt(nb)) / ALPHA)
            g = _sigmoid(float(w.sum()) + bias) - y
            s = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA
            z[idx] += g - s * w
            n[idx] += g * g
            sb = (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA
            zb += g - sb * (bias - PRIOR_BIAS)
            nb += g * g
    w = weight(z, n)
    index = np.flatnonzero(w)
    return Model(index, w[index], float(bias), bits)


def training_rows(docs: DataFrame, labels: DataFrame, may_learn, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(k, doc_id, text, y): at most ``max_rows`` different labelled rows for which the column ``may_learn`` holds.

    Bounded twice, by labelled ids and by different rows of them (ids may repeat), each by the smallest hashes, before
    any text moves.
    """
    sample = (
        labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(may_learn)
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .withColumn("k", F.xxhash64("doc_id")).orderBy("k", "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")).join(F.broadcast(sample), "doc_id")
    chosen = rows.select("row").distinct().orderBy("row").limit(max_rows)
    return rows.join(F.broadcast(chosen), "row").dropDuplicates(["row"]).select("k", "doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, may_learn, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the rows of ``training_rows``, in one task; only the non-zero weights come back."""
    texts = training_rows(docs, labels, may_learn, max_rows)

    def featurize(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_belongs_to("toxicity")
        memo = _WordHash()
        for f in frames:
            yield pd.DataFrame({
                "k": f["k"], "doc_id": f["doc_id"].astype(str), "y": f["y"],
                "x": [np.unique(hashed_features(t, memo)) for t in f["text"]],
            })

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = pd.concat([pd.DataFrame({"k": [], "doc_id": [], "y": [], "x": []}), *frames], ignore_index=True)
        f = f.assign(size=[len(x) for x in f["x"]]).sort_values(["k", "doc_id", "size"], kind="stable")
        rows = [(np.asarray(x, dtype=np.int64), int(y)) for x, y in zip(f["x"], f["y"], strict=True)]
        m = fit_ftrl(rows)
        yield pd.DataFrame({"i": np.append(m.index, -1), "w": np.append(m.weight, m.bias)})

    weights = (
        texts.mapInPandas(featurize, "k long, doc_id string, y int, x array<int>")
        .repartition(1).mapInPandas(fit, "i long, w double").collect()
    )
    got = {r["i"]: r["w"] for r in weights}
    bias = got.pop(-1, PRIOR_BIAS)
    index = np.array(sorted(got), dtype=np.int64)
    return Model(index, np.array([got[i] for i in index]), bias)


def score_udf(model: Model):
    """Pandas UDF text -> score in 0..1 with the model's sparse weights."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_belongs_to("toxicity")
        table, memo = model.table(), _WordHash()
        for texts in parts:
            out = np.empty(len(texts))
            for j, t in enumerate(texts):
                x = hashed_features(t, memo, model.bits)
                w = table[x]
                hit = np.unique(x[w != 0.0])
                out[j] = _sigmoid(float(table[hit].sum()) + model.bias)
            yield pd.Series(out)

    return score
