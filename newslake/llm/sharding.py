"""Sharding by the minimax contiguous partition of ordered atomic groups, in DataFrame operations only.

Documents with equal texts form one atomic group. The groups stand in a fixed order: the few large ones
first, by size, then all others by the MD5 of their text. The smallest feasible shard capacity is found by
search: a capacity is feasible if filling shards greedily from left to right needs no more than the given
number of shards. Each round tests ``CANDIDATES`` capacities at once (a search with that many ways instead
of two), so two or three rounds suffice; a greedy step of all candidates is one equality join of their
positions with the prefix sums of the one bucket each falls into. Then the order is cut at that capacity.
A group that is larger than an equal share of what is left fills a shard of its own before the search:
else the capacity that it forces would leave other shards empty.

The driver sees bounded data only: ``BUCKETS`` bucket sums, under ``LARGE_PER_SHARD`` large groups a shard,
the candidates and the cuts. A document finds its shard by comparing its key with the cut keys, and its slot
by counting in chunks of a hash of its id, so neither a hot group nor a whole shard meets in one task.

Law: ``bytes`` (sizes near equal). Size is the UTF-8 length plus 1. Defined results: NULL and empty texts
have size 1 and form one group; repeated rows keep a slot each; rows with NULL ids are sharded like others;
an empty table gives no rows; with fewer groups than shards the last shards stay empty.
"""

from __future__ import annotations

import bisect
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.session import materialize

SHARDS = 16
BUCKETS = 4096
CANDIDATES = 4096
LARGE_PER_SHARD = 64
CHUNK_ROWS = 4096


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("key"),
    )


def _prefix_sums(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Every group with its bucket (-1: large) and ``end``, the sum of all sizes up to and with it."""
    large = F.col("bytes") > F.lit(total / (shards * LARGE_PER_SHARD))
    groups = materialize(
        rows.groupBy("key").agg(F.sum("size").alias("bytes"))
        .withColumn("bucket", F.when(large, F.lit(-1)).otherwise(F.conv(F.substring("key", 1, 3), 16, 10).cast("int")))
        .withColumn("first", F.when(large, -F.col("bytes")).otherwise(F.lit(0))),
        "shard-groups",
    )
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.groupBy("bucket").agg(F.sum("bytes").alias("bucket_bytes")).select(
        "bucket", F.coalesce(F.sum("bucket_bytes").over(in_order), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("bucket").orderBy("first", "key")
    return materialize(
        groups.join(F.broadcast(before), "bucket")  # at most BUCKETS + 1 rows
        .select("bucket", "key", "bytes", (F.col("before") + F.sum("bytes").over(inside)).alias("end"))
        .sortWithinPartitions("bucket", "end"),
        "shard-prefix",
    )


class _Cutter:
    """Greedy filling of shards for many capacities at once over a table of prefix sums."""

    def __init__(self, spark: SparkSession, prefix: DataFrame):
        self.spark, self.prefix = spark, prefix
        ends = prefix.groupBy("bucket").agg(F.max("end").alias("end")).orderBy("bucket").collect()
        self.buckets, self.bucket_ends = [r["bucket"] for r in ends], [r["end"] for r in ends]

    def reach(self, targets: list[int]) -> list[int]:
        """For every target the largest prefix sum that does not exceed it."""
        rows, out = [], []
        for i, t in enumerate(targets):
            b = bisect.bisect_right(self.bucket_ends, t)
            out.append(self.bucket_ends[b - 1] if b else 0)
            if b < len(self.buckets):
                rows.append({"i": i, "bucket": self.buckets[b], "target": t})
        if rows:
            wanted = self.spark.range(1).select(F.inline(F.from_json(
                F.lit(json.dumps(rows)), "array<struct<i: int, bucket: int, target: bigint>>")))
            # The range reaches the scan; the rest of the table is skipped by its statistics.
            least, most = min(out[r["i"]] for r in rows), max(r["target"] for r in rows)
            found = (
                self.prefix.where(F.col("end").between(least, most))
                .join(F.broadcast(wanted), "bucket").where("end <= target").groupBy("i").agg(F.max("end").alias("end"))
            )
            for r in found.collect():
                out[r["i"]] = max(out[r["i"]], r["end"])
        return out

    def fill(self, start: int, total: int, shards: int, capacities: list[int]) -> list[list[int]]:
        """Cut positions of every capacity; it is feasible if the last one is ``total``."""
        cuts = [[start] for _ in capacities]
        for _ in range(shards):
            live = [i for i, c in enumerate(cuts) if c[-1] < total]
            if not live:
                break
            for i, end in zip(live, self.reach([min(total, cuts[i][-1] + capacities[i]) for i in live]), strict=True):
                cuts[i].append(end)
        return cuts

    def smallest(self, start: int, total: int, shards: int, low: int, high: int) -> list[int]:
        """Cuts for the smallest feasible capacity in low..high; ``high`` must be feasible."""
        best = None
        while low <= high:
            n = min(CANDIDATES, high - low + 1)
            tried = sorted({low + (high - low) * j // max(1, n - 1) for j in range(n)})
            cuts = self.fill(start, total, shards, tried)
            ok = next((j for j, c in enumerate(cuts) if c[-1] == total), None)
            if ok is None:  # all below the one that is known to be feasible
                low = tried[-1] + 1
                continue
            best = cuts[ok]
            low, high = (tried[ok - 1] + 1 if ok else tried[0]), tried[ok] - 1
        return best


def _number_of(value: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` lie below the value."""
    out = F.lit(0)
    for b in bounds:
        out = out + F.when(value > F.lit(b), 1).otherwise(0)
    return out


def _numbered(rows: DataFrame, total_rows: int, shards: int) -> DataFrame:
    """``slot``: gapless from 0 in every shard, counted by chunks of an id hash."""
    chunks = max(16, -(-total_rows // (shards * CHUNK_ROWS)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "key"), F.lit(chunks)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    here = Window.partitionBy("shard", "chunk").orderBy("doc_id", "key")
    return rows.withColumn("place", F.row_number().over(here)).join(sizes, ["shard", "chunk"]).withColumn(
        "slot", (F.col("before") + F.col("place") - 1).cast("long")
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL under this law) of every row."""
    spark = docs.sparkSession
    rows = materialize(_measured(docs, id_col, text_col), "shard-rows")
    whole = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = whole["bytes"] or 0
    if total:
        prefix = _prefix_sums(rows, total, shards)
        large = prefix.where("bucket = -1").orderBy("end").select("bytes", "end").collect()  # bounded
        start, alone = 0, []
        while len(alone) < min(len(large), shards - 1):
            size = large[len(alone)]["bytes"]
            if size * (shards - len(alone)) < total - start:
                break
            alone.append(large[len(alone)]["end"])
            start = alone[-1]
        cuts = alone
        if start < total:
            left = shards - len(alone)
            most = prefix.where(F.col("end") > start).agg(F.max("bytes")).first()[0]
            low = max(most, -(-(total - start) // left))
            cuts = alone + _Cutter(spark, prefix).smallest(start, total, left, low, low + most)[1:]
        cuts = cuts[:-1]
        by_key = [r["key"] for r in prefix.where((F.col("bucket") >= 0) & F.col("end").isin(cuts)).select("key").collect()]
        base = sum(1 for c in cuts if large and c <= large[-1]["end"])
        own = prefix.where("bucket = -1").select("key", _number_of(F.col("end"), cuts).alias("large_shard"))
        rows = rows.join(F.broadcast(own), "key", "left")  # under LARGE_PER_SHARD rows a shard
        small = F.lit(base) + _number_of(F.col("key"), sorted(by_key))
        rows = rows.withColumn("shard", F.coalesce(F.col("large_shard"), small).cast("int"))
    else:
        rows = rows.withColumn("shard", F.lit(0))
    return _numbered(rows, whole["n"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
