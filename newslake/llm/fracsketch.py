"""Document fingerprints: threshold-scaled sketches of word shingles.

Every shingle of ``SHINGLE_WORDS`` words (fewer words: the whole sequence) is hashed to 32 bits; the sketch keeps
each distinct hash below ``2 ** 32 / SCALE``, a fixed fraction of the hash space whatever the document. So sketches
of very unequal documents are samples by the same rule: the share of a sketch that another holds estimates the
containment of the documents, their union is the sketch of the documents together, and no document is cut to a
fixed number of hashes. A text of which no hash is below the threshold keeps its smallest one, so every text with
a word has a fingerprint. The smallest hash of a union is among the kept ones, hence sketches stay mergeable.

``compare_with_edits`` sets a document against the one behind it in the order of ids, whole texts. Texts move once,
to sorted ranges of ids; a task holds two rows at a time. What a range cannot know, the text behind its last row,
it leaves as two rows (its first and its last text) that a second, small pass brings together: their number is
that of the ranges.

Defined results: NULL and empty texts have no words and the empty fingerprint; two empty sketches are alike (1), an
empty and a non-empty one are not (0). Order of ids: descending, NULL last; among repeated ids by the hash of the
text; repeats of one row follow each other in any order (their results are those of equal texts). A table of one
row is its own next document. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import worker_belongs_to
from newslake.session import materialize

SHINGLE_WORDS = 5
SCALE = 8
SEED = 13
_WORDS_KEPT = 200_000  # hashes of words remembered by a worker
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < _WORDS_KEPT:
            self[word] = value
        return value


_HASHES = _WordHashes()


def shingle_hashes(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """32-bit hashes of the word shingles of a text, in order, repeats included."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, np.uint32)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    h = w[:n].copy()
    for i in range(1, size):
        h *= _MULTIPLIER
        h += w[i:i + n]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.uint32)


def sketch(text: str | None, scale: int = SCALE, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes below ``2 ** 32 / scale``; the smallest hash if none is."""
    h = shingle_hashes(text, size)
    kept = np.unique(h[h < (1 << 32) // scale])
    return kept if len(kept) or not len(h) else h.min(keepdims=True)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two documents together: the kept hashes of both, a lone smallest hash only if nothing else is."""
    both = np.union1d(a, b)
    kept = both[both < (1 << 32) // scale]
    return kept if len(kept) else both[:1]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two documents from their sketches."""
    if not len(a) and not len(b):
        return 1.0
    both = _common(a, b)
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first document's shingles that the second holds."""
    return _common(a, b) / len(a) if len(a) else 1.0


def packed(s: np.ndarray) -> bytes:
    return s.astype(">u4").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32)


def fingerprint_column(raw):
    """The printed form of a packed sketch: eight lowercase hex digits a hash, ascending."""
    return F.lower(F.hex(raw))


def sketch_udf(scale: int = SCALE, size: int = SHINGLE_WORDS):
    """Pandas UDF text -> packed sketch (binary)."""

    @F.pandas_udf("binary")
    def made(texts: pd.Series) -> pd.Series:
        worker_belongs_to("fracsketch", _HASHES.clear)
        return pd.Series([packed(sketch(t, scale, size)) for t in texts], dtype=object)

    return made


def containment_udf():
    """Pandas UDF (packed sketch, packed sketch) -> estimated containment of the first document in the second."""

    @F.pandas_udf("double")
    def contained(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([containment(unpacked(x), unpacked(y)) if x is not None and y is not None else None
                          for x, y in zip(a, b, strict=True)], dtype=float)

    return contained


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE) -> DataFrame:
    """One row per document: doc_id, ``sketch`` (packed) and ``fingerprint`` (hex)."""
    made = docs.select(F.col(id_col).alias("doc_id"), sketch_udf(scale)(F.col(text_col)).alias("sketch"))
    return made.withColumn("fingerprint", fingerprint_column("sketch"))


def merged_fingerprints(sketches: DataFrame, key: str, scale: int = SCALE) -> DataFrame:
    """(key, hash): the sketch of all documents of each key together, one row a hash.

    In long form, so a key of any size is a hash aggregate, never one row or one task.
    """
    # Eight hex digits a hash, as printed; what comes of it is a long.
    h = F.explode(F.regexp_extract_all("fingerprint", F.lit("(.{8})")))
    rows = sketches.select(key, h.alias("h")).distinct().select(key, F.conv("h", 16, 10).cast("long").alias("hash"))
    least = rows.groupBy(F.col(key).alias("__key")).agg(F.min("hash").alias("__least"))
    kept = rows.where(F.col("hash") < (1 << 32) // scale)
    lone = least.where(F.col("__least") >= (1 << 32) // scale).select(F.col("__key").alias(key), F.col("__least").alias("hash"))
    return kept.unionByName(lone)


def edited(text: str, following: str) -> str:
    """A text whose second half gives way to as many code points from the start of the following text (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _result(text: str, own: np.ndarray, following: str, next_own: np.ndarray, scale: int) -> tuple:
    changed = edited(text, following)
    other = sketch(changed, scale)
    return (len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest(), packed(own), packed(other),
            likeness(own, other), likeness(own, next_own), containment(other, own))


_INNER, _FIRST, _LAST = 0, 1, 2
_RESULT = ["n_chars", "edited_sha", "sketch", "edited_sketch", "near_edited", "near_next", "edited_in_own"]
RESULT = ("n_chars long, edited_sha binary, sketch binary, edited_sketch binary, near_edited double, near_next double, "
          "edited_in_own double")
_PLACED = "kind int, range int, doc_id long, text string, " + RESULT


def _neighbours(scale: int):
    """Results of every row of a sorted range but its last; the texts of its first and last row."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_belongs_to("fracsketch", _HASHES.clear)
        own_range = TaskContext.get().partitionId()
        held = None
        for f in frames:
            out = []
            for doc_id, none, text in zip(f["key"].tolist(), f["no_key"].tolist(), f["text"].tolist(), strict=True):
                row = (None if none else doc_id, text, sketch(text, scale))
                if held is None:
                    out.append((_FIRST, own_range, None, text) + (None,) * len(_RESULT))
                else:
                    out.append((_INNER, own_range, held[0], None) + _result(held[1], held[2], text, row[2], scale))
                held = row
            yield _frame(out)
        if held is not None:
            yield _frame([(_LAST, own_range, held[0], held[1]) + (None,) * len(_RESULT)])

    return compare


def _frame(rows: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["kind", "range", "doc_id", "text", *_RESULT], dtype=object)
    for c in ("doc_id", "n_chars"):
        f[c] = f[c].astype("Int64")
    return f.astype({"kind": "int32", "range": "int32", "near_edited": float, "near_next": float, "edited_in_own": float})


def _boundary_udf(scale: int):
    @F.pandas_udf(RESULT)
    def compare(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        rows = [_result(t, sketch(t, scale), n, sketch(n, scale), scale) for t, n in zip(texts, following, strict=True)]
        return pd.DataFrame(rows, columns=_RESULT)

    return compare


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (``edited`` with the next document by descending
    id; after the last: the first), and their likeness.

    Columns: doc_id, ``sketch``, ``edited_sketch`` (packed), ``edited_sha`` (binary), n_chars, near_edited, near_next
    (Jaccard estimates), edited_in_own (containment estimate).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("key"), F.col(id_col).isNull().alias("no_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"),
    ).withColumn("tie", F.xxhash64("text"))
    # ``place`` only spreads repeats of one row over ranges.
    order = [F.col("no_key"), F.col("key").desc(), F.col("tie"), F.col("place")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "no_key", "text")
    placed = materialize(placed.mapInPandas(_neighbours(scale), _PLACED), "fingerprint-ranges")
    # One number per non-empty range: at most as many as there are shuffle partitions.
    ranges = sorted(r["range"] for r in placed.where(F.col("kind") == _LAST).select("range").collect())
    follows = spark.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1])), "range int, next_range int")
    first = placed.where(F.col("kind") == _FIRST).select(F.col("range").alias("next_range"), F.col("text").alias("next_text"))
    last = placed.where(F.col("kind") == _LAST).select("range", "doc_id", "text")
    ends = last.join(follows, "range").join(first, "next_range").select(
        "doc_id", _boundary_udf(scale)("text", "next_text").alias("r")).select("doc_id", "r.*")
    inner = placed.where(F.col("kind") == _INNER).select("doc_id", *_RESULT)
    return inner.unionByName(ends)
