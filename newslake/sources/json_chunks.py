"""Splittable scan of large JSON arrays: one array, any number of tasks (SRC1 beyond ``read_json_arrays``).

``read_json_arrays`` parses a file as one string, which suits an hourly snapshot and not an accumulated table.
Here the text source cuts files into byte ranges and records at every ``}``; nothing else about the layout
is assumed (one line, pretty-printed, any nesting, braces and quotes inside strings). Three steps:

1. Every byte range is reduced, without knowing what stands before it, to a transition of the parser: for
   both states it may begin in (outside or inside of a string) the change of depth, the parity of its
   unescaped quotes, and how often a ``}`` brings each relative depth about. One small row a range.
2. A prefix scan over those rows (a window per array) gives each range its true state, depth and the number
   of elements before it, and each array its verdict: opened by ``[``, closed, balanced.
3. The ranges are read again, each from its known state, and cut where depth returns to one. Elements that
   lie within a range are whole; the first and the last piece of a range meet their other part by element
   number, a few rows a range.

An escape never spans a ``}`` in JSON, so records are cut at it safely. Each element is parsed by itself with
``from_json``: a malformed element is a reject with its place and does not take the file with it. Files that
are no arrays give no rows and one reject each, with the reasons of ``read_json_arrays``. (Spark's file sources
skip files of zero bytes; these give nothing.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.schemas import ARTICLE_SCHEMA
from newslake.session import BROADCAST_BYTES, materialize

REJECTS = "file string, pos long, reason string"
_BAD = "__malformed"
_SPACE = r"[ \t\r\n]*"
_TRANSITIONS = (
    "fkey long, block long, n long, bytes long, parity int, delta array<long>, after array<map<long, long>>, head string")
_PIECES = "fkey long, idx long, piece long, text string"


class _Chars:
    """Quotes and brackets of a batch of records: what stands outside of strings under either starting state."""

    def __init__(self, column: pa.Array):
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        raw = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if buffers[2] else np.empty(0, np.uint8)
        self.bounds = offsets - offsets[0]
        self.ends = self.bounds[1:]
        slashes = np.flatnonzero(raw == 92)
        quotes = np.flatnonzero(raw == 34)
        if len(slashes):
            run = np.concatenate(([0], np.flatnonzero(np.diff(slashes) != 1) + 1))
            first = np.repeat(slashes[run], np.diff(np.append(run, len(slashes))))
            escaped = slashes[(slashes - first) % 2 == 0] + 1
            quotes = np.setdiff1d(quotes, escaped, assume_unique=True)
        opened = np.flatnonzero((raw == 123) | (raw == 91))
        closed = np.flatnonzero(raw == 93)
        # The records' own closing braces stand behind their last character, in this order at equal places.
        place = np.concatenate((opened, closed, self.ends))
        step = np.concatenate((np.ones(len(opened), np.int64), -np.ones(len(closed) + len(self.ends), np.int64)))
        own = np.concatenate((np.full(len(opened) + len(closed), -1), np.arange(len(self.ends))))
        # A brace that ends record k comes before the first character of record k + 1, which has the same place.
        order = np.lexsort((own < 0, place))
        self.place, self.step, self.own = place[order], step[order], own[order]
        self.inside = np.searchsorted(quotes, self.place) & 1
        self.quotes = quotes
        blank = np.isin(raw, (32, 9, 10, 13))
        seen = np.flatnonzero(~blank)
        self.head = chr(raw[seen[0]]) if len(seen) else None

    def braces(self, state: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Records whose closing brace stands outside of strings, the relative depth after it, the change of depth."""
        outside = self.inside == state
        depth = np.cumsum(np.where(outside, self.step, 0))
        closing = outside & (self.own >= 0)
        return self.own[closing], depth[closing], int(depth[-1]) if len(depth) else 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """((file, range), whether it begins, rows of the batch): records of a range come together and in order."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(c).to_numpy() for c in ("fkey", "block"))
        cut = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            key = (int(file[a]), int(block[a]))
            yield key, key != last, batch.slice(a, b - a)
            last = key


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("fkey", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("parity", pa.int32()),
        ("delta", pa.list_(pa.int64())), ("after", pa.list_(pa.map_(pa.int64(), pa.int64()))), ("head", pa.string())])

    def row(key, n, size, parity, delta, after, head):
        values = [key[0], key[1], n, size, parity, delta, [list(m.items()) for m in after], head]
        return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, schema, strict=True)], schema=schema)

    at = None
    for key, begins, rows in _runs(batches):
        if begins:
            if at is not None:
                yield row(at, n, size, parity, delta, after, head)
            at, n, size, parity, delta, after, head = key, 0, 0, 0, [0, 0], ({}, {}), None
        chars = _Chars(rows.column("value"))
        for state in (0, 1):
            _, depth, change = chars.braces(state ^ parity)
            for d, k in zip(*(x.tolist() for x in np.unique(depth + delta[state], return_counts=True)), strict=True):
                after[state][d] = after[state].get(d, 0) + k
            delta[state] += change
        parity ^= len(chars.quotes) & 1
        n += rows.num_rows
        size += int(chars.ends[-1]) + rows.num_rows
        head = head or chars.head
    if at is not None:
        yield row(at, n, size, parity, delta, after, head)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements by number; ``piece`` is NULL for whole ones, else the place of the range among its array's."""
    schema = pa.schema([("fkey", pa.int64()), ("idx", pa.int64()), ("piece", pa.int64()), ("text", pa.string())])

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema, strict=True)], schema=schema)

    held: list[str] = []
    at = None
    for key, begins, part in _runs(batches):
        out = []
        if begins:
            if at is not None:
                out.append((doc, idx, place, "".join(held)))
            at, held, seen, whole = key, [], 0, False
            state, depth, idx, place, n, doc = (
                part.column(c)[0].as_py() for c in ("state", "depth", "idx", "place", "n", "doc"))
            short = part.column("phantom")[0].as_py()
        chars = _Chars(part.column("value"))
        own, after, change = chars.braces(state)
        ends = own[after + depth == 1].tolist()
        texts = [t + "}" for t in part.column("value").to_pylist()]
        if short and seen + len(texts) == n:  # no brace ends the file
            texts[-1] = texts[-1][:-1]
            ends = [e for e in ends if e < len(texts) - 1]
        first = 0
        for e in ends:
            text = "".join([*held, *texts[first:e + 1]])
            out.append((doc, idx, None if whole else place, text))
            held, first, idx, whole = [], e + 1, idx + 1, True
        held += texts[first:]
        depth += change
        state ^= len(chars.quotes) & 1
        seen += len(texts)
        if out:
            yield rows(out)
    if at is not None:
        yield rows([(doc, idx, place, "".join(held))])


def _records(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("lineSep", "}").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("fkey"), F.col("_metadata.file_block_start").alias("block"), "value")


def _states(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """The prefix scan: every range with the state it begins in, and the verdict on its array."""
    in_file = Window.partitionBy("fkey").orderBy("block")
    b = blocks.join(files, "fkey").withColumn("ends_file", F.lead("block").over(in_file).isNull()).withColumn(
        "total", F.sum("bytes").over(Window.partitionBy("fkey")))
    # The last record of a file is closed by a brace only if the sizes say so.
    b = b.withColumn("phantom", F.col("ends_file") & (F.col("total") != F.col("size")))
    ordered = Window.partitionBy("doc").orderBy("path", "block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    b = b.withColumn("state", (F.coalesce(F.sum("parity").over(before), none) % 2).cast("int"))
    raw = F.get("delta", F.col("state"))
    unreal = F.col("phantom") & (F.col("state") == F.col("parity"))  # an outside brace that is not there
    b = b.withColumn("raw", raw).withColumn("unreal", unreal).withColumn("change", raw + F.when(unreal, 1).otherwise(0))
    b = b.withColumn("depth", F.coalesce(F.sum("change").over(before), none))
    to_one = F.coalesce(F.element_at(F.get("after", F.col("state")), 1 - F.col("depth")), none)
    ended = to_one - F.when(F.col("unreal") & (F.col("raw") == 1 - F.col("depth")), 1).otherwise(0)
    b = b.withColumn("ended", ended).withColumn("idx", F.coalesce(F.sum("ended").over(before), none)).withColumn(
        "place", F.row_number().over(ordered).cast("long"))
    whole = Window.partitionBy("doc")
    opened = F.min_by(F.when(F.col("head").isNotNull(), F.col("head")), F.when(F.col("head").isNotNull(), F.col("place"))).over(whole)
    closed = (F.sum("parity").over(whole) % 2 == 0) & (F.sum("change").over(whole) == 0)
    reason = (F.when(closed & opened.isNull(), F.lit("empty file")).when(closed & (opened == "["), F.lit(None).cast("string"))
              .when(closed & (opened == "{"), F.lit("not a list")).otherwise(F.lit("malformed JSON")))
    return b.select("fkey", "block", "doc", "n", "phantom", "state", "depth", "idx", "place", reason.alias("reason"))


def scan_json_arrays(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = ARTICLE_SCHEMA, *, joined: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: rows are ``file, pos, <schema fields>``, rejects ``file, pos, reason``.

    With ``joined`` the files are the parts of one array in the order of their paths (as ``write_json_array`` leaves
    them), and ``file`` is the name of the first part. Elements of an array that is cut off or no array at all give no
    rows. An element that is malformed or no object is a reject with its ``pos``; the others stay.
    """
    listed = spark.read.format("binaryFile").load(paths).select(
        F.xxhash64("_metadata.file_path").alias("fkey"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size"))
    if joined:
        first = listed.agg(F.min_by(F.struct("fkey", "name"), "path").alias("f")).first()["f"]
        files = listed.select("fkey", "path", "size", F.lit(first["fkey"] if first else 0).cast("long").alias("doc"))
        names = spark.createDataFrame([(first["fkey"], first["name"])] if first else [], "doc long, file string")
    else:
        files = listed.select("fkey", "path", "size", F.col("fkey").alias("doc"))
        names = listed.select(F.col("fkey").alias("doc"), F.col("name").alias("file"))
    blocks = _records(spark, paths).mapInArrow(_reduce, _TRANSITIONS)
    states = materialize(_states(blocks, files), "json-states")
    keys = ["fkey", "block"]
    wanted = states.where("reason IS NULL").drop("reason")
    if 100 * states.count() <= BROADCAST_BYTES:  # a row a range
        known = _records(spark, paths).join(F.broadcast(wanted), keys)
    else:
        placed = _records(spark, paths).withColumn("k", F.monotonically_increasing_id())
        known = placed.join(wanted, keys).repartition(*keys).sortWithinPartitions(*keys, "k")
    cut = materialize(
        known.select(*keys, "value", "doc", "n", "phantom", "state", "depth", "idx", "place").mapInArrow(_cut, _PIECES),
        "json-elements",
    ).withColumnRenamed("fkey", "doc")
    pieces = cut.where("piece IS NOT NULL").groupBy("doc", "idx").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), "").alias("text"))
    elements = cut.where("piece IS NULL").select("doc", "idx", "text").unionByName(pieces)
    tail = F.col("text").rlike(rf"^{_SPACE}(\[{_SPACE})?\]?{_SPACE}$")  # what stands behind the last element
    lead = F.when(F.col("idx") == 0, r"\[").otherwise(",")
    body = F.regexp_replace("text", F.concat(F.lit(f"^{_SPACE}"), lead, F.lit(_SPACE)), F.lit(""))
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    # A leading separator that is missing stays in the body, which then is no object.
    item = F.when(body.startswith("{"), F.from_json(body, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}))
    # Through a generator, so that an element is parsed once and not once a field.
    parsed = elements.where(~tail).join(names, "doc").select(
        "file", F.col("idx").alias("pos"), F.explode(F.array(item)).alias("item"))
    good = F.col("item").isNotNull() & F.col(f"item.{_BAD}").isNull()
    rows = parsed.where(good).select("file", "pos", *[F.col(f"item.`{f.name}`").alias(f.name) for f in schema.fields])
    bad = parsed.where(~good).select("file", "pos", F.lit("malformed element").alias("reason"))
    none = F.lit(None).cast("long").alias("pos")
    judged = states.where("reason IS NOT NULL").select("doc", "reason").distinct()
    of_files = judged.join(names, "doc").select("file", none, "reason")
    return rows, bad.unionByName(of_files)


__all__ = ["scan_json_arrays"]
