"""Periodic runs: stretches of words that repeat with a fixed period, found exactly.

A run is a maximal stretch of words with smallest period ``q`` and at least ``max(LEAST_WORDS, LEAST_TURNS * q)``
words. Every word of a run occurs at least ``LEAST_TURNS`` times inside it, so a word that occurs less often
within the current segment belongs to no run of it and splits the segment there; the pieces are split again by
their own frequencies until nothing changes (recursive frequency splitting). Ordinary prose falls apart after a
few rounds; all texts of a batch are split side by side.

What survives is scanned lag by lag. A run of ``4 * q`` words covers three whole blocks of ``q`` words on the
grid of multiples of ``q``, so only grid points whose three following blocks have the same hash are looked at
(n / q of them for a lag, n log n in all), and each is verified and extended on the words themselves.

Defined results: NULL, empty and blank texts have no words, no runs and an empty collapsed text. Words are cut
at ASCII white space and compared as they stand. Repeated rows keep their own rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import worker_belongs_to

LEAST_WORDS, LEAST_TURNS = 6, 4
_BATCH_CHARS = 2_000_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)

SCHEMA = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


def stable_segments(codes: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the segments in which every word occurs at least ``LEAST_TURNS`` times.

    ``segment`` numbers the text of every word, ascending.
    """
    done = []
    at = np.arange(len(codes))
    n_codes = int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        cell, _ = pd.factorize(segment * n_codes + codes[at])
        often = np.bincount(cell)[cell] >= LEAST_TURNS
        changed = np.zeros(int(segment[-1]) + 1, bool)
        changed[segment[~often]] = True
        still = changed[segment]
        if not still.all():
            own = at[~still]
            cut = np.flatnonzero(np.diff(segment[~still])) + 1
            first, end = own[np.concatenate(([0], cut))], own[np.concatenate((cut, [len(own)])) - 1] + 1
            done += [(a, b) for a, b in zip(first.tolist(), end.tolist()) if b - a >= LEAST_WORDS]
        keep = often & still
        at, segment = at[keep], segment[keep]
        if len(at):
            new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(segment) != 0)))
            segment = np.cumsum(new) - 1
            long = np.bincount(segment)[segment] >= LEAST_WORDS
            at, segment = at[long], segment[long]
            if len(at):
                segment = np.cumsum(np.concatenate(([False], np.diff(segment) != 0)))
    return sorted(done)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def _stretch(w: np.ndarray, q: int, first: int, end: int) -> tuple[int, int]:
    """Widen [first, end), on which w[i] == w[i + q], as far as that holds."""
    step = 64
    while first:
        a = max(0, first - step)
        differs = np.flatnonzero(w[a:first] != w[a + q:first + q])
        if len(differs):
            first = a + int(differs[-1]) + 1
            break
        first, step = a, step * 2
    step, stop = 64, len(w) - q
    while end < stop:
        b = min(stop, end + step)
        differs = np.flatnonzero(w[end:b] != w[end + q:b + q])
        if len(differs):
            end += int(differs[0])
            break
        end, step = b, step * 2
    return first, end


class _Found:
    """Runs of a segment as they are found, in order of period."""

    def __init__(self):
        self.runs: dict[tuple[int, int], int] = {}  # (first, end) -> period; the smallest comes first
        self.table = np.empty((0, 2), np.int64)

    def add(self, first: int, end: int, q: int) -> None:
        self.runs.setdefault((first, end), q)

    def outside(self, starts: np.ndarray, q: int) -> np.ndarray:
        """Those of ``starts`` whose three blocks of q words do not lie within a run found before."""
        if len(self.table) != len(self.runs):
            self.table = np.array(sorted(self.runs), np.int64).reshape(-1, 2)
        long = self.table[self.table[:, 1] - self.table[:, 0] >= 3 * q]
        if not len(long):
            return starts
        inside = np.zeros(len(starts), bool)
        place = np.searchsorted(long[:, 0], starts, "right") - 1
        for back in range(3):  # runs that hold three blocks overlap by less than two
            i = place - back
            inside |= (i >= 0) & (long[np.maximum(i, 0), 1] >= starts + 3 * q)
        return starts[~inside]


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    n = len(codes)
    found = _Found()
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(codes) * _powers(_BASE, n), dtype=np.uint64)))
    back = _powers(_INVERSE, n + 1)
    for q in range(1, n // LEAST_TURNS + 1):
        grid = sums[::q]
        block = (grid[1:] - grid[:-1]) * back[:(len(grid) - 1) * q:q]
        same = block[1:] == block[:-1]
        alike = np.flatnonzero(same[1:] & same[:-1])
        if not len(alike):
            continue
        heads = alike[np.concatenate(([True], np.diff(alike) != 1))] * q
        for at in found.outside(heads, q).tolist():
            if not np.array_equal(codes[at:at + 2 * q], codes[at + q:at + 3 * q]):
                continue
            first, end = _stretch(codes, q, at, at + 2 * q)
            if end + q - first >= max(LEAST_WORDS, LEAST_TURNS * q):
                found.add(first, end + q, q)
    return sorted((first, end - first, q) for (first, end), q in found.runs.items())


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that are not in a run behind its first period, joined by one space."""
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        words = [words[i] for i in kept.tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed text of every text."""
    words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    codes, _ = pd.factorize(flat) if len(flat) else (np.empty(0, np.int64), None)
    owner = np.repeat(np.arange(len(words)), size)
    found: list[list] = [[] for _ in texts]
    for a, b in stable_segments(codes, owner):
        i = int(owner[a])
        shift = a - int(first[i])
        found[i] += [(start + shift, length, q) for start, length, q in runs_of(codes[a:b])]
    return [(runs, _collapsed(ws, runs)) for runs, ws in zip(found, words, strict=True)]


def _slices(texts: list[str | None]) -> Iterator[slice]:
    """A batch in slices of bounded text length, at least one text each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= _BATCH_CHARS:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_belongs_to("runs")
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in _slices(texts):
            found, collapsed = zip(*find_runs(texts[part]))
            ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(found, _RUNS), pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``runs`` (array of start, length, period, in words) and ``collapsed`` text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + SCHEMA
    return rows.mapInArrow(_find, schema)
