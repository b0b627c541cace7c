"""Token-id output: raw id payloads in shard files and a minimal perfect hash index for keyed access.

File format, two Parquet tables in one folder (readable wherever Spark reads, committed by Spark's writer):

* ``payload``: rows (shard, block, width, ids, keys, copies, offsets, lengths). ``ids`` is binary, little-endian unsigned
  16-bit ids (32-bit where the vocabulary needs it; ``width`` names the bytes an id) of consecutive documents
  in ascending key order, each with the end id; a block closes at ``BLOCK_IDS`` ids. ``keys``, ``copies``
  (0, 1, .. for repeated keys), ``offsets`` and ``lengths`` are the block's directory.
* ``index``: one row per bucket of about ``BUCKET_KEYS`` keys: a minimal perfect hash (pilots) that sends the
  bucket's n keys to n slots without gaps, and arrays by slot: a stored fingerprint, shard, block, offset in
  the block, length, and start (ids of all documents before). A lookup reads one bucket row, hashes twice,
  compares the fingerprint and cuts one slice of one block: constant time whatever the corpus.

The minimal perfect hash is hash-and-displace: keys fall into small cells; cells, largest first, get the first
pilot number that sends all their keys to free slots.

Documents are range-partitioned by key, so a shard holds a key range and shards follow each other in order.
Encoding goes piece by piece (a text cut before each space that precedes a non-space, where the pre-tokenizer
always cuts), memoized per Python worker up to a fixed size; equal to encoding the whole text.

Defined results: NULL and empty texts hold the end id alone; repeated keys are kept, each with its own copy
number; NULL keys sort first and are indexed like others; an empty table gives empty tables.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.llm.common import acyclic, sorted_groups, worker_belongs_to

END_ID = 2
BLOCK_IDS = 1 << 18
GROUP_CHARS = 8_000_000  # texts encoded together: the more, the fewer words are met again and again
BUCKET_KEYS = 256
ROWS_PER_SHARD = 20_000
_PIECE_CACHE = 250_000
_CUT = re.compile("(?= [^\\s\u180e\u200b\ufeff])")
_SPACES = re.compile(" (?:[\\s\u180e\u200b\ufeff]|\\Z)")  # a space that is no place to cut
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Bytes that a byte-level vocabulary shows as characters from 256 on, in order; all others show as themselves.
_SHOWN = {b: 256 + i for i, b in enumerate([*range(0, 33), *range(127, 161), 173])}
# The letters of _LETTERS as such a vocabulary shows them.
_SHOWN_LETTERS = {c: c.encode().decode("latin-1").translate(_SHOWN) for c in map(chr, range(256)) if _LETTERS.fullmatch(c)}
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII, but the apostrophe: it opens contractions
_STEM = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]+)")  # letters, then ASCII punctuation but the apostrophe
_NULL_KEY = -(1 << 63)  # with a negative copy number: a NULL key

PAYLOAD = "shard int, block int, width int, ids binary, keys array<long>, copies array<long>, offsets array<int>, lengths array<int>"
SLOTS = "fingerprint array<int>, shard array<int>, block array<int>, offset array<int>, length array<int>, start array<long>"
INDEX = "bucket int, buckets int, seed int, pilots array<int>, " + SLOTS


def _parts(word: str) -> list[tuple[bool, str]] | None:
    """Parts of a word that the pre-tokenizer always parts: lines, line ends, letters, punctuation behind them.

    Each with whether it stands behind the word's space; None if the word is one part.
    """
    lines = word.split("\n")
    if len(lines) > 1 and word.split() != lines:
        return None
    out = []
    for k, line in enumerate(lines):
        if k:
            out.append((False, "\n"))
        m = _STEM.fullmatch(line)
        out += [(k == 0, m.group(1)), (False, m.group(2))] if m else [(k == 0, line)]
    return out if len(out) > 1 else None


class Encoder:
    """Whole-text encoding by the tokenizers library, unseen words in one call for thousands."""

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.memo: dict[str, bytes] = {}  # ids of a piece
        self.words: dict[str, bytes] = {}  # ids of a word behind a space
        self.older: dict[str, bytes] = {}  # the generation before
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = any(" " in t or "\n" in t for t in added)  # such a token would forbid cutting
        self.code = "H" if self.width == 2 else "I"
        # Letters behind a space are one piece of a byte-level pre-tokenizer: the model takes it directly.
        plain = self.tokenizer.normalizer is None and self.tokenizer.pre_tokenizer is not None
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(" Zé") if plain else []
        self.direct = [piece for piece, _ in shown] == ["ĠZÃ©"]
        newline = self._ids(["\n"])[0]
        self.newline = newline if len(newline) == self.width else None

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in found]

    def _learn_words(self, unseen: list[str]) -> None:
        """Ids of words behind a space.

        Words of letters alone go to the tokenizer's model as one piece each; of the others thousands are encoded
        as one text, a line each, and cut at the line ends.
        """
        if self.direct:
            tokenize, words, code = self.tokenizer.model.tokenize, self.words, self.code
            rest = []
            for w in unseen:
                if w.isascii() and w.isalpha():
                    words[w] = array(code, [t.id for t in tokenize("Ġ" + w)]).tobytes()
                elif _LETTERS.fullmatch(w):
                    piece = "Ġ" + "".join([_SHOWN_LETTERS[c] for c in w])
                    words[w] = array(code, [t.id for t in tokenize(piece)]).tobytes()
                else:
                    rest.append(w)
            unseen = rest
        plain = [w for w in unseen if "\n" not in w] if self.newline else []
        end = int.from_bytes(self.newline, "little") if self.newline else -1
        for at in range(0, len(plain), 4096):
            part = plain[at:at + 4096]
            lines = "\n".join([" " + w for w in part]) + "\n"
            ids = np.array(self.tokenizer.encode(lines, add_special_tokens=False).ids, f"<u{self.width}")
            ends = np.flatnonzero(ids == end)
            if len(ends) != len(part):
                self.words.update(zip(part, self._ids([" " + w for w in part]), strict=True))
                continue
            raw, first = ids.tobytes(), 0
            for w, stop in zip(part, (ends * self.width).tolist(), strict=True):
                self.words[w] = raw[first:stop]
                first = stop + self.width
        rest = [w for w in unseen if "\n" in w] if self.newline else unseen
        self.words.update(zip(rest, self._ids([" " + w for w in rest]), strict=True))

    def _encode_simple(self, texts: list[str]) -> list[bytes]:
        """Texts in which every space is followed by a non-space: cut at all spaces.

        Words are cut, numbered and put together again by Arrow; Python sees each distinct word of a batch once,
        letters without the punctuation behind them.
        """
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        starts, words = cut.offsets.to_numpy(), cut.flatten()
        behind = np.ones(len(words), bool)
        behind[starts[:-1]] = False
        numbered = words.filter(pa.array(behind)).dictionary_encode()
        coded = self._words(numbered.dictionary)
        first = self._pieces(words.take(pa.array(starts[:-1])).to_numpy(zero_copy_only=False).tolist())
        table = pa.concat_arrays([coded, pa.array(first, pa.binary())])
        place = np.empty(len(words), np.int64)
        place[behind] = numbered.indices.to_numpy()
        place[starts[:-1]] = len(coded) + np.arange(len(texts))
        ids = table.take(pa.array(place))
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int32, len(ids) + 1, ids.offset * 4)[starts].tolist()
        data = data.to_pybytes() if data else b""
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words behind a space; what a memo keeps is the letters, not each with every punctuation."""
        ahead = pc.ascii_rtrim(words, characters=_PUNCTUATION)
        ended = pc.and_(pc.match_substring_regex(ahead, f"^{_LETTERS.pattern}$"), pc.not_equal(ahead, words))
        stems = pc.if_else(ended, ahead, words).dictionary_encode()
        distinct = stems.dictionary.to_pylist()
        self._learn(distinct)
        known = pa.array(list(map(self.words.__getitem__, distinct)), pa.binary()).take(stems.indices)
        with_tail = np.flatnonzero(ended.to_numpy(zero_copy_only=False))
        both = zip(words.take(with_tail).to_pylist(), ahead.take(with_tail).to_pylist(), strict=True)
        tails = pa.array([b"", *self._pieces([w[len(stem):] for w, stem in both])], pa.binary())
        tail_of = np.zeros(len(words), np.int64)
        tail_of[with_tail] = 1 + np.arange(len(with_tail))
        return pc.binary_join_element_wise(known, tails.take(pa.array(tail_of)), pa.scalar(b"", pa.binary()))

    def _learn(self, distinct: list[str]) -> None:
        """Put the ids of words behind a space into ``words``."""
        if len(self.words) > _PIECE_CACHE:
            self.words, self.older = {}, self.words
        seen = self.words
        unseen = set(distinct).difference(seen)
        known = unseen.intersection(self.older)
        seen.update({w: self.older[w] for w in known})
        unseen -= known
        # A word and the punctuation behind it, and the lines of a word, are encoded apart.
        plain, ended, apart = [], [], {}
        for w in unseen:
            if w.isalpha():
                plain.append(w)
                continue
            stem = w.rstrip(_PUNCTUATION)
            if len(stem) < len(w) and stem.isalpha():
                ended.append((w, stem, w[len(stem):]))
            elif parts := _parts(w):
                apart[w] = parts
            else:
                plain.append(w)
        stems = {stem for _, stem, _ in ended}
        stems.update(x for parts in apart.values() for behind_space, x in parts if behind_space)
        self._learn_words([*stems.difference(seen).union(plain)])
        bare = {x for parts in apart.values() for behind_space, x in parts if not behind_space}
        bare = list(bare.union(tail for _, _, tail in ended))
        ids_of = dict(zip(bare, self._pieces(bare), strict=True))
        for w, stem, tail in ended:
            seen[w] = seen[stem] + ids_of[tail]
        for w, parts in apart.items():
            seen[w] = b"".join([seen[x] if behind_space else ids_of[x] for behind_space, x in parts])

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        memo = self.memo
        if len(memo) > _PIECE_CACHE // 4:
            memo.clear()
        unseen = list(set(pieces).difference(memo))
        for at in range(0, len(unseen), 4096):
            part = unseen[at:at + 4096]
            memo.update(zip(part, self._ids(part), strict=True))
        return [memo[p] for p in pieces]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as packed little-endian integers, the end id not included."""
        out = [b""] * len(texts)
        simple = [i for i, t in enumerate(texts) if t and not self.whole and not _SPACES.search(t)]
        for i, ids in zip(simple, self._encode_simple([texts[i] for i in simple]), strict=True):
            out[i] = ids
        rest = set(range(len(texts))).difference(simple)
        for i in rest:
            if texts[i]:
                out[i] = b"".join(self._pieces([texts[i]] if self.whole else _CUT.split(texts[i])))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    worker_belongs_to("tokenids", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _text_groups(texts: pd.Series, chars: int = GROUP_CHARS) -> Iterator[list[int]]:
    """Positions in groups of bounded text length, at least one text each."""
    group, size = [], 0
    for i, t in enumerate(texts):
        group.append(i)
        size += len(t) if t else 0
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def _write_blocks(path: str, end_id: int):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        end = np.array([end_id], f"<u{enc.width}").tobytes()
        shard, block = TaskContext.get().partitionId(), 0
        ids, entries, size = [], [], 0
        last, copy = None, 0

        def row():
            keys, copies, offsets, lengths = (list(x) for x in zip(*entries, strict=True))
            return pd.DataFrame({"shard": [shard], "block": [block], "width": [enc.width], "ids": [b"".join(ids)],
                                 "keys": [keys], "copies": [copies], "offsets": [offsets], "lengths": [lengths]})

        for f in frames:
            for group in _text_groups(f["text"]):
                part = f.iloc[group]
                with acyclic():
                    coded = enc.encode(part["text"].tolist())
                for key, none, raw in zip(part["key"].tolist(), part["no_key"].tolist(), coded, strict=True):
                    copy = copy + 1 if (key, none) == last else 0
                    last = (key, none)
                    n = len(raw) // enc.width + 1
                    ids.append(raw + end)
                    entries.append((_NULL_KEY, -1 - copy, size, n) if none else (key, copy, size, n))
                    size += n
                    if size >= BLOCK_IDS:
                        yield row()
                        ids, entries, size, block = [], [], 0, block + 1
        if entries:
            yield row()

    return write


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer of a public integer hash, seeded."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return _mix(keys.astype(np.int64).view(np.uint64) ^ _mix(copies.astype(np.int64).view(np.uint64), 7), 3)


def _cells(h: np.ndarray, seed: int, n_cells: int) -> np.ndarray:
    return (_mix(h, 11 + seed) % np.uint64(n_cells)).astype(np.int64)


def _slots(h: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h ^ _mix(pilots.astype(np.uint64), 23), 29) % np.uint64(n)).astype(np.int64)


_PILOTS = _mix(np.arange(1 << 17), 23)
_FIRST_PILOTS = 64
_PILOT_BLOCKS = [(_FIRST_PILOTS, 1 << 10), *((1 << k, 2 << k) for k in range(10, 17))]


def build_mph(h: np.ndarray) -> tuple[int, np.ndarray]:
    """Seed and pilots of a minimal perfect hash of the distinct hashes ``h``."""
    n = len(h)
    n_cells = max(1, -(-n // 4))
    for seed in range(1000):
        cell = _cells(h, seed, n_cells)
        sizes = np.bincount(cell, minlength=n_cells)
        order = np.argsort(-sizes, kind="stable")
        grouped, ends = h[np.argsort(cell, kind="stable")], np.cumsum(sizes)
        taken, pilots = np.zeros(n, bool), np.zeros(n_cells, np.int64)
        # The slots of all keys under the first pilots, at once: most cells need no other.
        first = _slots(grouped[:, None], np.arange(_FIRST_PILOTS)[None, :], n)
        for c in order:
            if not sizes[c]:
                break
            own = range(ends[c] - sizes[c], ends[c])
            s = first[own.start:own.stop]
            k = next((k for k in np.flatnonzero(~taken[s].any(axis=0)).tolist() if len(set(s[:, k].tolist())) == len(own)), None)
            if k is not None:
                pilots[c], taken[s[:, k]] = k, True
                continue
            for at, stop in _PILOT_BLOCKS:
                tried, slots = np.arange(at, stop), []
                for x in grouped[own.start:own.stop]:  # each key is tried with what is left by those before
                    s = (_mix(x ^ _PILOTS[tried], 29) % np.uint64(n)).astype(np.int64)
                    free = ~taken[s]
                    for other in slots:
                        free &= other != s
                    free = np.flatnonzero(free)
                    tried, slots = tried[free], [*(other[free] for other in slots), s[free]]
                    if not len(tried):
                        break
                else:
                    pilots[c], taken[[s[0] for s in slots]] = tried[0], True
                    break
            else:
                break
        if taken.all():
            return seed, pilots
    raise ValueError("no perfect hash: two keys of a bucket have the same 64-bit hash")


def lookup(h: np.ndarray, seed: int, pilots: np.ndarray, n: int) -> np.ndarray:
    """Slots of the hashes ``h``; a key outside the index lands on any slot (compare its fingerprint)."""
    return _slots(h, pilots[_cells(h, seed, len(pilots))], n)


def fingerprints(h: np.ndarray) -> np.ndarray:
    return (_mix(h, 41) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _bucket(buckets) -> Column:
    return F.pmod(F.xxhash64("key", "copy"), F.lit(buckets)).cast("int")


def _build_index(buckets: int):
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_groups(frames, ["bucket"]):
            out = []
            for bucket, g in f.groupby("bucket", sort=False):
                h = key_hash(g["key"].to_numpy(), g["copy"].to_numpy())
                seed, pilots = build_mph(h)
                place = np.empty(len(h), np.int64)
                place[lookup(h, seed, pilots, len(h))] = np.arange(len(h))
                g = g.iloc[place]
                out.append((bucket, buckets, seed, pilots, fingerprints(h[place]),
                            *(g[c].to_numpy() for c in ("shard", "block", "offset", "length", "start"))))
            yield pd.DataFrame(out, columns=["bucket", "buckets", "seed", "pilots", "fingerprint", "shard", "block",
                                             "offset", "length", "start"])

    return build


def _directory(payload: DataFrame) -> DataFrame:
    """One row per document from the blocks' directories, with its place and its global start."""
    before = (Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sizes = payload.select(
        "shard", "block", (F.element_at("offsets", -1) + F.element_at("lengths", -1)).cast("long").alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(*before)), none).alias("shard_start"))
    blocks = sizes.select("shard", "block", F.coalesce(
        F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(*before)), none).alias("block_start"))
    entry = F.explode(F.arrays_zip("keys", "copies", "offsets", "lengths"))
    rows = payload.select("shard", "block", entry.alias("e"))
    return rows.join(blocks, ["shard", "block"]).join(shards, "shard").select(
        F.col("e.keys").alias("key"), F.col("e.copies").alias("copy"), "shard", "block",
        F.col("e.offsets").alias("offset"), F.col("e.lengths").alias("length"),
        (F.col("shard_start") + F.col("block_start") + F.col("e.offsets")).alias("start"),
    )


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
    text_col: str = "text", rows_per_shard: int = ROWS_PER_SHARD,
) -> None:
    """Write the payload and index tables of all documents under the folder ``path``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("key"),
        F.col(id_col).isNull().alias("no_key"), F.col(text_col).alias("text"),
    )
    n = rows.count()
    shards = max(1, -(-n // rows_per_shard), min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    null_first = F.col("no_key").desc()
    ordered = rows.repartitionByRange(shards, null_first, "key").sortWithinPartitions(
        null_first, "key", F.xxhash64("text"))
    ordered.mapInPandas(_write_blocks(tokenizer_path, end_id), PAYLOAD).write.parquet(f"{path}/payload")
    buckets = max(1, n // BUCKET_KEYS)
    places = _directory(spark.read.schema(PAYLOAD).parquet(f"{path}/payload")).withColumn("bucket", _bucket(buckets))
    (places.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_build_index(buckets), INDEX)
     .write.parquet(f"{path}/index"))


def read_token_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload"), spark.read.schema(INDEX).parquet(f"{path}/index")


def _find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of the wanted keys of every bucket row; keys whose fingerprint differs are not in the index."""
    for f in frames:
        for r in f.itertuples(index=False):
            h = key_hash(r.keys, r.copies)
            s = lookup(h, r.seed, np.asarray(r.pilots, np.int64), len(r.fingerprint))
            ok = r.fingerprint[s] == fingerprints(h)
            s = s[ok]
            yield pd.DataFrame({"key": r.keys[ok], "copy": r.copies[ok], "shard": r.shard[s], "block": r.block[s],
                                "offset": r.offset[s], "length": r.length[s], "start": r.start[s]})


def _cut_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The ids of the wanted documents of every block, by place alone."""
    for f in frames:
        for r in f.itertuples(index=False):
            ids = np.frombuffer(r.ids, f"<u{r.width}")
            own = [ids[a:a + n].astype("<u4") for a, n in zip(r.at, r.length, strict=True)]
            yield pd.DataFrame({"key": r.key, "copy": r.copy_no, "start": r.start, "n_tokens": [len(x) for x in own],
                                "ids": [x.tobytes() for x in own]})


def look_up(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Keyed access: doc_id, copy, start, n_tokens, ids (little-endian unsigned 32-bit) of the (doc_id, copy) rows.

    Wanted keys meet their bucket row, the hash names the place, places meet their block. What travels together is
    one bucket's or one block's keys, both bounded by the format. Keys that the index does not hold give no row.
    """
    payload, index = read_token_files(spark, path)
    first = index.select("buckets").first()
    keys = wanted.select(
        F.coalesce("doc_id", F.lit(_NULL_KEY)).alias("key"),
        F.when(F.col("doc_id").isNull(), -1 - F.col("copy")).otherwise(F.col("copy")).alias("copy"),
    )
    asked = (
        keys.withColumn("bucket", _bucket(first["buckets"] if first else 1)).groupBy("bucket")
        .agg(F.collect_list(F.struct("key", "copy")).alias("w"))
        .select("bucket", F.col("w.key").alias("keys"), F.col("w.copy").alias("copies"))
    )
    places = asked.join(index, "bucket").mapInPandas(
        _find, "key long, copy long, shard int, block int, offset int, length int, start long")
    by_block = (
        places.groupBy("shard", "block").agg(F.collect_list(F.struct("key", "copy", "offset", "length", "start")).alias("w"))
        .select("shard", "block", F.col("w.key").alias("key"), F.col("w.copy").alias("copy_no"), F.col("w.offset").alias("at"),
                F.col("w.length").alias("length"), F.col("w.start").alias("start"))
    )
    found = by_block.join(payload.select("shard", "block", "width", "ids"), ["shard", "block"]).mapInPandas(
        _cut_ids, "key long, copy long, start long, n_tokens long, ids binary")
    null = F.col("copy") < 0
    return found.select(
        F.when(~null, F.col("key")).alias("doc_id"), F.when(null, -1 - F.col("copy")).otherwise(F.col("copy")).alias("copy"),
        "start", "n_tokens", "ids",
    )
