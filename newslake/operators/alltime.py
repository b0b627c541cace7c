"""The stored all-time table: sorted runs per period, a manifest, and a table of seen keys (SNK3, JOI6, ORD1, SNK9).

Layout under one folder::

    data/v=N/period=P/part-*       rows of a period, newest first, written by version N
    keys/v=N/bucket=B/part-*       keys that version N brought, by hash bucket
    manifest/v=N/                  one row a period: its folder, rows, newest and oldest time

``merge`` appends a batch: rows whose key the table has not seen, first-seen within the batch. History is not
read for that: the batch's keys meet the key table on (bucket, key), and the batch's buckets prune the key
table's partitions at run time. Only the periods that new rows fall into are rewritten (their old rows and
the new ones, sorted again); every other period keeps its files. The manifest is written last and is what
readers go by, so a merge that dies halfway leaves the table as it was, and repeating it replaces its leavings.
One writer at a time.

Run metrics come from the merge's own jobs: rows are counted as they are written (``Observation``), and what
the table held before is the manifest's sum.

Defined results: rows without a key are always kept; rows without a time form the period ``undated``, read last;
an empty batch makes no new version; a table without versions reads as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators.dedupe import dedupe_first
from newslake.session import BROADCAST_BYTES, materialize

UNDATED = "undated"
BUCKETS = 256
MANIFEST = "period string, version long, rows long, newest string, oldest string"


def month_of(time: Column) -> Column:
    """The period of a timestamp or ISO text: its month."""
    return F.substring(time.cast("string"), 1, 7)


class AllTimeTable:
    """A table at ``path``, unique by ``key``, newest first by ``time`` (then ``ties``), in periods."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, *, key: str, time: str, ties: list[str],
                 period: Callable[[Column], Column] = month_of, buckets: int = BUCKETS,
                 cluster: list[str] | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.time, self.ties, self.period, self.buckets = key, time, ties, period, buckets
        self.cluster = cluster or []  # columns that rows of a period are sorted by before their time

    # ---------------------------------------------------------------- manifest

    def _folders(self, below: str) -> list[str]:
        """Names of the folders below a place of the table."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}")
        files = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []

    def _exists(self, name: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def version(self) -> int:
        """The newest version whose manifest is complete; 0 for none."""
        found = [int(v.removeprefix("v=")) for v in self._folders("manifest")]
        return max((v for v in found if self._exists(f"manifest/v={v}/_SUCCESS")), default=0)

    def manifest(self, version: int | None = None) -> list:
        """One row a period, newest first: as long as the history has periods, whatever its rows."""
        version = self.version() if version is None else version
        if not version:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={version}").collect()
        return sorted(rows, key=lambda r: (r["period"] != UNDATED, r["period"]), reverse=True)

    def _read(self, entries: list) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self.path}/data/v={e['version']}/period={e['period']}" for e in entries])

    # ---------------------------------------------------------------- reading

    def _newest_first(self) -> list[Column]:
        return [F.col(self.time).desc_nulls_last(), *self.ties]

    def read(self) -> DataFrame:
        """All rows; every file is sorted newest first."""
        return self._read(self.manifest())

    def newest(self, n: int) -> DataFrame:
        """The ``n`` newest rows, in order: only the newest periods that hold so many are opened."""
        entries, held = [], 0
        for e in self.manifest():
            if held >= n:
                break
            entries.append(e)
            held += e["rows"]
        return self._read(entries).orderBy(*self._newest_first()).limit(n)

    def newest_where(self, n: int, predicate: Column) -> DataFrame:
        """SRC10: the ``n`` newest rows that satisfy a predicate, in order.

        Periods are opened from the newest on, twice as many each time, until so many rows are found; the predicate is
        pushed into the scan, and where the table is clustered by its columns row groups are skipped.
        """
        entries, opened = self.manifest(), 1
        while True:
            found = self._read(entries[:opened]).where(predicate)
            if opened >= len(entries) or found.limit(n).count() >= n:
                return found.orderBy(*self._newest_first()).limit(n)
            opened *= 2

    # ---------------------------------------------------------------- merging

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def seen(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (one column, distinct) that the table holds.

        The key table is read only in the buckets that the keys fall into.
        """
        version = self.version()
        if not version:
            return keys.limit(0)
        # The comparison on the bucket tells the planner that the batch side is worth pruning by.
        asked = keys.select(self.key, self._bucket()).where(F.col("bucket") >= 0)
        size = keys.agg(F.sum(F.octet_length(F.col(self.key).cast("string")) + 24)).first()[0] or 0
        held = self.spark.read.schema(T.StructType([
            self.schema[self.key], T.StructField("v", T.LongType()), T.StructField("bucket", T.IntegerType()),
        ])).parquet(f"{self.path}/keys").where(F.col("v") <= version).drop("v")
        asked = F.broadcast(asked) if 4 * size <= BROADCAST_BYTES else asked
        return held.join(asked, ["bucket", self.key], "left_semi").select(self.key).distinct()

    def merge(self, batch: DataFrame, *, first: list[str]) -> dict[str, int]:
        """Add a batch; ``first`` orders its rows for the choice among repeats. Returns the run's metrics."""
        version = self.version() + 1
        before = self.manifest(version - 1)
        incoming, kept = Observation(), Observation()
        counted = batch.select(*self.schema.names).observe(incoming, F.count(F.lit(1)).alias("rows"))
        fresh = materialize(dedupe_first(counted, F.col(self.key), first, null_key="keep"), "alltime-batch")
        keyed = fresh.where(F.col(self.key).isNotNull())
        new = keyed.join(self.seen(keyed.select(self.key)), self.key, "left_anti").unionByName(
            fresh.where(F.col(self.key).isNull())).select(*self.schema.names)
        named = self.period(F.col(self.time))
        period = F.coalesce(F.when(named.rlike("^[0-9A-Za-z_-]+$"), named), F.lit(UNDATED))
        new = materialize(new.withColumn("period", period), "alltime-new")
        touched = {r["period"] for r in new.select("period").distinct().collect()}  # periods, not rows
        existing = sum(e["rows"] for e in before)
        if not touched:
            return {"existing": existing, "incoming": incoming.get["rows"], "kept": 0, "dropped": incoming.get["rows"]}
        old = self._read([e for e in before if e["period"] in touched]).withColumn("period", period)
        rows = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
        order = ["period", *self.cluster, *self._newest_first()]
        # Counted behind the exchange: dealing into ranges samples the rows once more.
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.observe(kept, F.sum("__new").alias("rows")).drop("__new").write.mode("overwrite").partitionBy("period").parquet(
            f"{self.path}/data/v={version}")
        (new.where(F.col(self.key).isNotNull()).select(self.key, self._bucket()).repartition("bucket").sortWithinPartitions("bucket", self.key)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/v={version}"))
        text = F.col(self.time).cast("string")
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("period", T.StringType())])).parquet(
            f"{self.path}/data/v={version}")
        stats = written.groupBy("period").agg(
            F.lit(version).cast("long").alias("version"), F.count(F.lit(1)).alias("rows"), F.max(text).alias("newest"),
            F.min(text).alias("oldest"))
        kept_entries = self.spark.createDataFrame([tuple(e) for e in before if e["period"] not in touched], MANIFEST)
        kept_entries.unionByName(stats).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")
        n = kept.get["rows"]
        return {"existing": existing, "incoming": incoming.get["rows"], "kept": n, "dropped": incoming.get["rows"] - n}


__all__ = ["AllTimeTable", "month_of"]
