"""Benchmark decontamination: size-partitioned containment MinHash, verified by exact containment.

Texts become lower-case word sequences and sets of five-word shingles. A benchmark item is short, a
document may be thousands of times longer, so the Jaccard similarity of the two says nothing; what is
searched is containment, |item and document| / |item| >= t. Containment MinHash sketches only the item:
its ``k`` smallest shingle hashes (bottom-k MinHash), and asks which of them occur in the document.

Items are partitioned by their number of shingles; each partition ``[2^i, 2^(i+1))`` has its own sketch
size ``k = floor((1 - t) u) + 1`` for its upper size ``u``. A document that contains at least ``t`` of an
item misses at most ``(1 - t) n`` of its shingles, fewer than ``k``, so at least one sketch entry occurs
in the document: the search cannot lose a true match at any document length. Candidates of a partition that
the document is too small for are dropped before they are verified on the words themselves: all distinct
shingles of the item against those of the whole document.

The benchmark is streamed through the driver in blocks of at most ``BLOCK_ENTRIES`` sketch entries. A block's
pass over the documents is finished and written before the next block is built, so driver and workers hold one
block (the driver also the rows of the next), whatever the benchmark's size. No pair of documents is ever
formed, and a passage shared by a third of the documents costs each of them one lookup.

Defined results: items with fewer than five words are one shingle of all their words; empty and NULL
items match nothing, empty and NULL documents contain nothing. Items of equal text match alike and each
is reported. Rows with NULL item ids are ignored; documents with NULL or repeated ids give their own rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from newslake.llm.common import worker_belongs_to
from newslake.session import materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BLOCK_ENTRIES = 500_000
_WORD = re.compile(r"\w+")
_WORD_CACHE = 200_000


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        h = self[word] = (zlib.crc32(raw) << 32 | zlib.adler32(raw)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        return h


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` words from the word hashes ``h``."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ h[i:len(h) - n + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[str], memo: _WordHash) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


class Sketches:
    """Bottom-k sketches of a block of items, by shingle length, as one sorted array of hashes."""

    def __init__(self, items: list[tuple[object, str]], n: int = SHINGLE_WORDS, t: float = THRESHOLD):
        memo = _WordHash()
        self.items, self.t = [], t
        entries: dict[int, list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            size = min(n, len(words))
            h = np.unique(shingle_hashes(_hashes(words, memo), size))
            upper = (1 << int(len(h)).bit_length()) - 1  # largest size of this item's partition
            k = int(np.floor((1.0 - t) * upper + 1e-9)) + 1
            for x in h[:k].tolist():
                entries.setdefault(size, []).append((x, len(self.items)))
            self.items.append((item_id, words, size, int(np.ceil(t * len(h) - 1e-9))))
        self.index = {}
        for size, pairs in entries.items():
            pairs.sort()
            hashes = np.array([p[0] for p in pairs], np.uint64)
            bits = np.zeros(1 << 16, bool)
            bits[hashes >> np.uint64(48)] = True  # most of a document's shingles stop here
            self.index[size] = (hashes, np.array([p[1] for p in pairs], np.int64), bits)

    def matches(self, text: str | None, memo: _WordHash) -> list[tuple[object, float]]:
        """(item id, containment) of the items that the text contains to at least ``t``."""
        words = words_of(text)
        if not words or not self.index:
            return []
        h = _hashes(words, memo)
        candidates: set[int] = set()
        for size, (hashes, owner, bits) in self.index.items():
            s = shingle_hashes(h, size)
            s = np.unique(s[bits[s >> np.uint64(48)]])
            lo, hi = np.searchsorted(hashes, s, "left"), np.searchsorted(hashes, s, "right")
            for a, b in zip(lo[hi > lo], hi[hi > lo], strict=True):
                candidates.update(owner[a:b].tolist())
        found, sets = [], {}
        for c in sorted(candidates):
            item_id, item_words, size, least = self.items[c]
            if len(words) - size + 1 < least:
                continue  # too few shingles to contain an item of this partition
            if size not in sets:
                sets[size] = _shingles(words, size)
            own = _shingles(item_words, size)
            share = len(own & sets[size]) / len(own)
            if share >= self.t - 1e-12:
                found.append((item_id, share))
        return found


def _blocks(benchmark: DataFrame, n: int, t: float) -> Iterator[list[tuple[object, str]]]:
    """The benchmark, the stated query set, in blocks whose sketches stay under the bound."""
    items, entries = [], 0
    rows = benchmark.select("item_id", "text").where("item_id is not null").toLocalIterator()
    for r in rows:
        cost = int((1 - t) * 2 * max(1, len(words_of(r["text"])))) + 2
        if items and entries + cost > BLOCK_ENTRIES:
            yield items
            items, entries = [], 0
        items.append((r["item_id"], r["text"]))
        entries += cost
    yield items


def _with_more(blocks: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Every block, and whether another follows."""
    block = next(blocks)
    for following in blocks:
        yield block, True
        block = following
    yield block, False


def contained_items(
    docs: DataFrame, benchmark: DataFrame, n: int = SHINGLE_WORDS, t: float = THRESHOLD
) -> DataFrame:
    """One row per (document, benchmark item) with containment of at least ``t``: doc_id, item_id, containment."""
    id_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = StructType([StructField("doc_id", id_type), StructField("item_id", item_type),
                         StructField("containment", DoubleType())])
    out = None
    for block, more in _with_more(_blocks(benchmark, n, t)):
        sketches = Sketches(block, n, t)

        def search(frames: Iterator[pd.DataFrame], sketches=sketches) -> Iterator[pd.DataFrame]:
            memo = _WordHash()
            for f in frames:
                got = [(d, i, c) for d, text in zip(f["doc_id"], f["text"], strict=True)
                       for i, c in sketches.matches(text, memo)]
                if got:
                    yield pd.DataFrame(got, columns=["doc_id", "item_id", "containment"])

        part = docs.select("doc_id", "text").mapInPandas(search, schema)
        if more or out is not None:  # the pass ends here, and with it the block's broadcast
            part = materialize(part, "decontam-block")
        out = part if out is None else out.unionByName(part)
    return out


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, n: int = SHINGLE_WORDS, t: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; all columns kept, no shuffle."""
    for block, more in _with_more(_blocks(benchmark, n, t)):
        docs = docs.where(_clean_udf(Sketches(block, n, t))(F.col("text")))
        if more:
            docs = materialize(docs, "decontam-block")
    return docs


def _clean_udf(sketches: Sketches):
    @F.pandas_udf("boolean")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_belongs_to("decontam")
        memo = _WordHash()
        for texts in parts:
            yield pd.Series([not sketches.matches(x, memo) for x in texts], dtype=bool)

    return clean
