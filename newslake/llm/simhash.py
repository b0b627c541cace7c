"""SimHash near-duplicates: deletion-variant signatures over 64-bit fingerprints.

Fingerprint: ASCII-lower-cased words (everything between ASCII white space), word shingles with
repeats, XXH64 (seed 42) of each; a bit is 1 if it is set in over half of the hashes.

Search: ``d`` differing bits spread over ``d // 2 + 1`` segments leave at least one segment with at
most one differing bit. Every segment is indexed under each of its one-wildcard variants (the segment
with one bit masked out), so two such fingerprints meet in an equality on (segment, wildcard, rest);
everything that meets is verified by XOR and popcount. Equal fingerprints are folded to one row first,
so groups of copies never enter the search. Rows that share a key are compared blockwise inside a
sorted partition and only a spanning set of the verified links leaves the task, never all pairs of a
group; keys with more than ``BLOCK`` fingerprints are split into block pairs over several tasks,
which compares everything and holds two blocks at a time.

Defined results: NULL and empty texts have fingerprint 0 and link like any other. Rows with a NULL id
take part in linking; the component id is the smallest non-NULL id reachable (NULL if there is none).
Repeated rows keep their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import connected_components, roots, sorted_groups, union_pairs, unlinked_labels
from newslake.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096  # fingerprints of one key that a task compares with each other
_SLICE = 1 << 18  # shingles counted at a time: bounds the memory of a very long text


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - k] + 1)).tolist()
    stops = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SLICE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _SLICE], stops[at:at + _SLICE])],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_udf(words_per_shingle: int = SHINGLE_WORDS):
    """Pandas UDF text -> fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        out = [fingerprint(t, words_per_shingle) for t in texts]
        return pd.Series(np.array(out, dtype=np.uint64).view(np.int64))

    return fp


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``max_bits // 2 + 1`` segments of a fingerprint."""
    n = max_bits // 2 + 1
    cut = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def variant_keys(max_bits: int):
    """Column array<long> of the one-wildcard segment variants of ``fp``.

    A key is wildcard position (6 bits) over the masked segment moved to the low bits; the position
    also names the segment, so keys of different segments never meet.
    """
    keys = []
    for first, width in segments(max_bits):
        seg = F.shiftrightunsigned(F.col("fp"), first).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(width):
            masked = seg.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i)))
            keys.append(masked.bitwiseOR(F.lit((first + i) << 40)))
    return F.array(*keys)


def _links_within(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (member, smallest member) of the fingerprints of one key."""
    n = len(fps)
    parent = unlinked_labels(n)
    step = max(1, (1 << 20) // n)
    for at in range(0, n, step):
        near = np.bitwise_count(fps[at:at + step, None] ^ fps[None, :]) <= max_bits
        i, j = np.nonzero(near)
        i = i + at
        up = i < j
        union_pairs(parent, i[up], j[up])
    top = roots(parent, np.arange(n))
    member = np.flatnonzero(top != np.arange(n))
    return fps[member], fps[top[member]]


def _link_task(max_bits: int):
    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_groups(frames, ["key", "block"]):
            block = f["block"].to_numpy()
            key, fps = f["key"].to_numpy(), f["fp"].to_numpy().view(np.uint64)
            changed = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            start, stop = np.concatenate(([0], changed)), np.concatenate((changed, [len(key)]))
            size = stop - start
            out_a, out_b = [], []
            # Runs of up to 8 rows, nearly all of them, are compared side by side.
            for gap in range(1, 8):
                rows = np.flatnonzero(size > gap)
                rows = rows[size[rows] <= 8]
                if not len(rows):
                    break
                for off in range(8 - gap):
                    r = rows[size[rows] > off + gap]
                    a, b = fps[start[r] + off], fps[start[r] + off + gap]
                    near = np.bitwise_count(a ^ b) <= max_bits
                    out_a.append(a[near])
                    out_b.append(b[near])
            for r in np.flatnonzero(size > 8):
                a, b = _links_within(fps[start[r]:stop[r]], max_bits)
                out_a.append(a)
                out_b.append(b)
            if out_a:
                a, b = np.concatenate(out_a), np.concatenate(out_b)
                a, b = a.view(np.int64), b.view(np.int64)
                pair = pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}).drop_duplicates()
                if len(pair):
                    yield pair

    return link


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect every two distinct fingerprints (long ``fp``) within ``max_bits``.

    A spanning set: two fingerprints within the distance are always joined by a chain of returned
    links, each of which is itself within the distance.
    """
    keyed = prints.select("fp", F.explode(variant_keys(max_bits)).alias("key"))
    large = (
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
        .select("key", F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks"))
    )
    large = materialize(large, "simhash-large-keys")
    if large.limit(1).count():
        keyed = keyed.join(large, "key", "left")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
        keyed = keyed.select("fp", "key", "blocks", F.coalesce(own, F.lit(0)).alias("own"), other.alias("other"))
        keyed = keyed.select(
            "fp", "key", (F.least("own", "other") * 65536 + F.greatest("own", "other")).alias("block")
        )
    else:
        keyed = keyed.withColumn("block", F.lit(0))
    dealt = keyed.repartition("key", "block").sortWithinPartitions("key", "block", "fp")
    return dealt.select("key", "block", "fp").mapInPandas(_link_task(max_bits), "a long, b long").distinct()


def _components(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row, and (fp, first_id, component, component_id) of every distinct fingerprint.

    ``component`` is a fingerprint and names one component; ``component_id`` may name several, since ids may repeat.
    """
    prints = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                    fingerprint_udf(words_per_shingle)(F.col(text_col)).alias("fp")),
        "simhash-prints",
    )
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    links = fingerprint_links(classes.select("fp"), max_bits)
    comp = connected_components(links).select(F.col("node").alias("fp"), "component")
    linked = classes.join(comp, "fp")
    first = materialize(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-first")
    named = materialize(
        classes.join(comp, "fp", "left").join(first, "component", "left")
        .select("fp", "first_id", F.coalesce("component", "fp").alias("component"),
                F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("component_id"))
                .alias("component_id")),
        "simhash-named",
    )
    return prints, named


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, ``fp`` (long), ``fingerprint`` (16 hex digits), ``component_id``."""
    prints, named = _components(docs, id_col, text_col, words_per_shingle, max_bits)
    return prints.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One document of each component: the smallest id, of its texts there the smallest fingerprint.

    An id may stay several times, with texts of different components. A document without an id stays only where
    no document of the component has one. Among rows of equal id and fingerprint the choice is by their hash.
    """
    prints, named = _components(docs, id_col, text_col, words_per_shingle, max_bits)
    kept = (
        named.where(F.col("first_id").eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min("component_id").alias("kept_id"), F.min("fp").alias("fp")).drop("component")
    )
    # One text of an id and fingerprint; n is how often its row repeats.
    rows = prints.groupBy("doc_id", "fp", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.groupBy("doc_id", "fp").agg(F.min(F.struct("text_hash", "n")).alias("t"))
    chosen = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["fp"] == kept["fp"]), "left_semi").select(
        F.col("doc_id").alias("__id"), F.col("t.text_hash").alias("__text"), F.col("t.n").alias("__n"))
    chosen = materialize(chosen, "simhash-chosen")

    def taken(which: DataFrame) -> DataFrame:
        """The documents of ``which``, found again by id and hash of the text: no text is fingerprinted twice."""
        same = docs[id_col].eqNullSafe(which["__id"]) & (F.xxhash64(docs[text_col]) == which["__text"])
        return docs.join(which, same, "left_semi")

    single = taken(chosen.where(F.col("__n") == 1))
    many = chosen.where(F.col("__n") > 1)
    if not many.limit(1).count():
        return single
    # Repeated rows: each map task keeps one of its own before anything moves.
    hashed = [c for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    one = (
        taken(many).groupBy(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__text"))
        .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*hashed)).alias("__row")).select("__row.*")
    )
    return single.unionByName(one)
