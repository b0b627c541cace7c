"""SentencePiece (BPE) encoding by a table of last tokens per prefix, and decoding.

Every prefix of a word has exactly one last token: the only vocabulary piece that ends there and is
compatible with the last token of what stands before it. An Aho-Corasick automaton lists the pieces that
end at each position; the pair-compatibility test decides which of them is the one; walking the table
backwards from the end recovers the ids. No merge queue is run over the text.

Compatibility of (a, b): byte-pair encoding of a's text followed by b's gives exactly [a, b], that is, no
merge crosses the seam. At the moment of rank ``r`` the symbol left of the seam is the first node on a's
right spine of lower rank, and right of it the first node on b's left spine; a merge crosses iff two such
symbols join to a piece that is due before either is absorbed by its own parent (equal ranks: left first).

Pieces hold the space mark only at their front, so a text is cut before each run of space marks into words
that encode independently; words and pair tests are memoized per Python worker in dictionaries that are
bounded in size. A word's record is its packed ids and nothing else: workers hold many. What a group of texts' ids
read as in decimal and decode to is looked up by Arrow, id by id. Words share prefixes, so the table of a short word is filled from its
end, only where the walk back comes by, and what it finds about a prefix is kept for other words; a long run
of characters has a table of its own, filled from the front. Characters that no piece holds become byte pieces.

The vocabulary file is a parameter (a path that every worker can read). Defined results: NULL and empty
texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from newslake.llm.common import acyclic, worker_belongs_to

MARK = "▁"
_WORD_CACHE, _PART_CACHE, _PREFIX_CACHE, _PAIR_CACHE = 100_000, 50_000, 50_000, 250_000
_SHORT = 64  # characters of a part whose prefixes are shared with other parts
_UNRANKED = 1 << 60
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class _Memo(dict):
    """Results of ``make`` by key, in two generations of at most ``size``: what is in use stays."""

    def __init__(self, make, size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def find(self, key):
        """What is kept for a key, or None."""
        value = self.get(key)
        return self.old.get(key) if value is None else value

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


def _texts(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> tuple[memoryview, list[int]]:
    """The entries of all ``ids`` behind each other, and the places in them that belong to ``ends``."""
    found = table.take(pa.array(ids))
    _, places, data = found.buffers()
    places = np.frombuffer(places, np.int64)[found.offset + ends] if len(ids) else np.zeros(len(ends), np.int64)
    return memoryview(data or b"").cast("B"), places.tolist()


class Coder:
    """Encoder and decoder over one vocabulary file; the library only reads the file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_id, self.surface, self.is_byte = {}, [b""] * n, [False] * n
        self.id_of: dict[str, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface[i], self.is_byte[i] = bytes([int(piece[3:5], 16)]), True
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i) and not sp.is_unused(i):
                self.id_of[piece] = i
                self.surface[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces with an inner space mark are not supported")
        order = sorted(self.id_of.values(), key=lambda i: (-sp.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        # Rank of a piece = when it is made; a single character is there from the start.
        self.text = {i: p for p, i in self.id_of.items()}
        self.rank = {i: (rank[i] if len(p) > 1 else -1) for p, i in self.id_of.items()}
        self.length = [0] * n
        for p, i in self.id_of.items():
            self.length[i] = len(p)
        self._build_splits()
        self.pairs: list[dict[int, bool]] = [{} for _ in range(n)]
        self.n_pairs = 0
        self.decimal = pa.array([b",%d" % i for i in range(n)], pa.large_binary())
        self.decoded = pa.array(self.surface, pa.large_binary())
        self.dtype = np.dtype(np.uint16 if n <= 1 << 16 else np.int32)
        self.marked = {i for i, p in self.text.items() if p.startswith(MARK)}
        self.known = {p for p in self.id_of if len(p) == 1}
        self.unknown = re.compile(f"[^{''.join(map(re.escape, self.known))}]")
        after = {y for p in self.id_of for x, y in zip(p, p[1:]) if x.isalnum()}
        apart = {ch for p in self.id_of for ch in p if not ch.isalnum() and ch != MARK} - after
        # No merge joins the characters of ``apart`` to a letter or digit before them.
        cut = f"(?<=[^\\W_])(?=[{''.join(map(re.escape, sorted(apart)))}])|" if apart else ""
        self.cuts = re.compile(f"{cut}(?=\\n)|(?<=\\n)|(?<=[^{MARK}])(?={MARK})")
        self.apart = "".join(sorted(apart))
        packed = np.arange(n).astype(self.dtype).tobytes()
        self.single = [packed[at:at + self.dtype.itemsize] for at in range(0, len(packed), self.dtype.itemsize)]
        self.prefixes = _Memo(None, _PREFIX_CACHE)
        self.part_ids = _Memo(self._encode_part, _PART_CACHE)
        self.word_ids = _Memo(self._encode_word, _WORD_CACHE)

    def _build_splits(self) -> None:
        """The last merge of every piece, found in order of rank, and the automaton of reachable pieces.

        A piece is made from two pieces of lower rank whose pair is compatible; a piece without such
        a split never comes out of the merges and takes no part.
        """
        self.split: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        reachable = {i for i, r in self.rank.items() if r < 0}
        for i in sorted((i for i, r in self.rank.items() if r >= 0), key=self.rank.get):
            p = self.text[i]
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if (a in reachable and b in reachable and max(self.rank[a], self.rank[b]) < self.rank[i]
                        and self._compatible(a, b, self.rank[i])):
                    self.split[i] = (a, b)
                    reachable.add(i)
                    break
        for i in reachable:
            self.automaton.add_word(self.text[i], i)
        self.automaton.make_automaton()

    def _compatible(self, a: int, b: int, before: int = _UNRANKED) -> bool:
        """True if no merge of a rank under ``before`` crosses the seam between pieces a and b."""
        rank, split, text, id_of = self.rank, self.split, self.text, self.id_of
        absorbed_a = absorbed_b = before  # when the current symbols disappear into their parents
        while True:
            c = id_of.get(text[a] + text[b])
            if c is not None and rank[c] < absorbed_a and rank[c] < absorbed_b + (absorbed_b != before):
                return False
            # Go back in time: undo the later of the two symbols.
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b] or rank[b] < 0:
                absorbed_a = rank[a]
                a = split[a][1]
            else:
                absorbed_b = rank[b]
                b = split[b][0]

    def compatible(self, a: int, b: int) -> bool:
        """The memoized pair test."""
        known = self.pairs[a].get(b)
        if known is None:
            if self.n_pairs >= _PAIR_CACHE:
                self.n_pairs = 0
                for row in self.pairs:
                    row.clear()
            known = self.pairs[a][b] = self._compatible(a, b)
            self.n_pairs += 1
        return known

    def _encode_known(self, part: str) -> list[int]:
        """Ids of a part whose characters are all in the vocabulary."""
        last = [0] * (len(part) + 1)  # last token of every prefix
        length, pairs = self.length, self.pairs
        for end, t in self.automaton.iter(part):
            end += 1
            if last[end]:
                continue
            start = end - length[t]
            if start:
                before = last[start]
                ok = pairs[before].get(t)
                if ok is None:
                    ok = self.compatible(before, t)
                if not ok:
                    continue
            last[end] = t
        ids, end = [], len(part)
        while end:
            t = last[end]
            ids.append(t)
            end -= length[t]
        ids.reverse()
        return ids

    def _encode_short(self, part: str) -> bytes:
        """The packed ids of a part of at most ``_SHORT`` characters, all in the vocabulary."""
        found = list(self.automaton.iter(part))  # (last character, piece), by place
        return self._last(part, found, len(found))[0]

    def _last(self, prefix: str, found: list[tuple[int, int]], stop: int) -> tuple[bytes, int]:
        """The packed ids of a prefix and the last of them: its last token is the one match at its end that fits what stands before it."""
        end = len(prefix) - 1
        first = stop
        while first and found[first - 1][0] == end:
            first -= 1
        for _, t in found[first:stop]:
            size = self.length[t]
            if size > end:
                return self.single[t], t
            head = prefix[:-size]
            before = self.prefixes.find(head)
            if before is None:
                within = first
                while found[within - 1][0] > end - size:
                    within -= 1
                before = self._last(head, found, within)
                self.prefixes.keep(head, before)
            ok = self.pairs[before[1]].get(t)
            if ok is None:
                ok = self.compatible(before[1], t)
            if ok:
                return before[0] + self.single[t], t
        raise ValueError("a character without a piece")

    def _encode_part(self, part: str) -> bytes:
        if self.known.issuperset(part):
            return self._encode_short(part) if 0 < len(part) <= _SHORT else self._packed(self._encode_known(part))
        ids, at = [], 0
        for m in self.unknown.finditer(part):
            if at < m.start():
                ids += self._encode_known(part[at:m.start()])
            ids += [self.byte_id[x] for x in m.group().encode("utf-8", "replace")]
            at = m.end()
        if at < len(part):
            ids += self._encode_known(part[at:])
        return self._packed(ids)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _encode_word(self, word: str) -> bytes:
        """The packed ids of a word behind a space."""
        if word.isalpha():  # no place to cut
            return self._encode_part(MARK + word)
        stem = word.rstrip(self.apart)
        if stem != word and stem.isalpha():
            return self.word_ids[stem] + self.part_ids[word[len(stem):]]
        return b"".join(map(self.part_ids.__getitem__, self.cuts.split(MARK + word)))

    def packed(self, text: str | None) -> bytes:
        """The packed ids of a text."""
        if not text:
            return b""
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return b"".join(map(self.part_ids.__getitem__, self.cuts.split(MARK + text.replace(" ", MARK))))
        return b"".join(map(self.word_ids.__getitem__, text.split(" ")))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), self.dtype).tolist()

    def roundtrips(self, texts: Iterable[str | None]) -> list[tuple[int, str, str, np.ndarray]]:
        """Per text: number of ids, digest of the ids in decimal joined by commas, digest of the text decoded from them, the ids."""
        packed = list(map(self.packed, texts))
        ids = np.frombuffer(b"".join(packed), self.dtype)
        ends = np.cumsum([0, *map(len, packed)]) // self.dtype.itemsize
        listed, listed_ends = _texts(self.decimal, ids, ends)
        decoded, decoded_ends = _texts(self.decoded, ids, ends)
        out = []
        for k, n in enumerate(np.diff(ends).tolist()):
            a, b = decoded_ends[k], decoded_ends[k + 1]
            a += decoded[a:min(a + 1, b)] == b" "  # the space put in front of every text
            out.append((n, hashlib.sha256(listed[min(listed_ends[k] + 1, listed_ends[k + 1]):listed_ends[k + 1]]).hexdigest(),
                        hashlib.sha256(decoded[a:b]).hexdigest(), ids[ends[k]:ends[k + 1]].astype(np.intc)))
        return out

    def roundtrip(self, text: str | None) -> tuple[int, str, str, np.ndarray]:
        """What ``roundtrips`` gives for one text."""
        return self.roundtrips([text])[0]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.surface[i] for i in ids])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        # The space that encoding puts in front of every text; control pieces before it are empty.
        first = next((i for i in ids if self.surface[i]), None)
        return text[1:] if first in self.marked else text

    def _decode_broken(self, ids: list[int]) -> str:
        """Byte pieces that are no UTF-8 become one replacement character a byte."""
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            while run:
                try:
                    out.append(run.decode())
                    run = b""
                except UnicodeDecodeError as e:
                    out.append(run[: e.start].decode() + "�")
                    run = run[e.start + 1:]
            if i is not None:
                out.append(self.surface[i].decode())
        return "".join(out)


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for a vocabulary file, built once per Python worker."""
    worker_belongs_to("sentencepieces", _CODERS.clear)
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def _groups(texts: pd.Series, chars: int = 2_000_000) -> Iterator[pd.Series]:
    """A batch in slices of bounded text length, at least one text each: bounds the ids held at once."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= chars:
            yield texts.iloc[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield texts.iloc[first:]


def encode_udf(path: str):
    """Pandas UDF text -> array<int> of ids."""

    @F.pandas_udf("array<int>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = coder(path)
        for texts in parts:
            for group in _groups(texts):
                yield pd.Series([c.encode(t) for t in group], dtype=object)

    return encode


def decode_udf(path: str):
    """Pandas UDF array<int> -> text; NULL ids give the empty text."""

    @F.pandas_udf("string")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = coder(path)
        for rows in parts:
            yield pd.Series([c.decode(list(r)) if r is not None else "" for r in rows], dtype=object)

    return decode


def roundtrip_udf(path: str):
    """Pandas UDF text -> struct of the number of ids and digests of the ids and of the decoded text."""

    @F.pandas_udf(SCHEMA)
    def roundtrip(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = coder(path)
        for texts in parts:
            rows = []
            for group in _groups(texts):
                with acyclic():
                    rows += [row[:3] for row in c.roundtrips(group)]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return roundtrip


def encoded_udf(path: str):
    """Like ``roundtrip_udf``, with the ids themselves as a last field."""

    @F.pandas_udf(SCHEMA + ", ids array<int>")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = coder(path)
        for texts in parts:
            for group in _groups(texts):
                with acyclic():
                    rows = c.roundtrips(group)
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    return encoded
