"""Queries over ``events`` and ``orders``: dedupe chains, compaction, ordering, days,
retention and batch merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.functions.dates import extract_day, iso_seconds
from newslake.plans.queries import extract_day_sql
from newslake.plans.registry import query
from newslake.plans.tables import table


def _snapshot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot items with the DED2 fields: id / url / title, some NULL or ''."""
    et = F.col("event_type")
    uid = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts",
        F.when(et == "purchase", uid).alias("id"),
        F.when(et.isin("click", "view"), F.concat(F.lit("u/"), uid, F.lit("/"), et))
        .when(et == "signup", F.lit("")).alias("url"),
        F.when(et == "signup", F.lit("")).alias("title"),
    )


DEDUPE_CHAIN_SQL = """WITH s AS (
  SELECT event_id, user_id, event_type, ts,
         CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) END AS id,
         CASE WHEN event_type IN ('click', 'view') THEN 'u/' || CAST(user_id AS VARCHAR) || '/' || event_type
              WHEN event_type = 'signup' THEN '' END AS url,
         CASE WHEN event_type = 'signup' THEN '' END AS title
  FROM events
), k AS (SELECT *, coalesce(nullif(id, ''), nullif(url, ''), title) AS key FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM k)
SELECT event_id, user_id, event_type FROM r WHERE key IS NULL OR rn = 1
"""


@query("dedupe_key_chain", DEDUPE_CHAIN_SQL)
def q_dedupe_key_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.dedupe import dedupe_snapshot_items

    out = dedupe_snapshot_items(_snapshot_items(spark, sf_dir), order=["ts", "event_id"])
    return out.select("event_id", "user_id", "event_type")


COMPACT_SQL = """WITH s AS (
  SELECT event_id, user_id, event_type, ts, strftime(ts, '%Y-%m-%d') AS day,
         strftime(ts, '%Y-%m-%d_%H') AS snapshot,
         CAST(user_id AS VARCHAR) || ':' || event_type AS url
  FROM events
), r AS (SELECT *, row_number() OVER (PARTITION BY day, url ORDER BY snapshot, ts, event_id) AS rn FROM s)
SELECT day, event_id, user_id, event_type FROM r WHERE rn = 1
"""


@query("compact_snapshots", COMPACT_SQL)
def q_compact_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.compaction import compact_snapshots

    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts",
        F.date_format("ts", "yyyy-MM-dd_HH").alias("snapshot"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("url"),
        F.lit(None).cast("string").alias("title"),
    )
    out = compact_snapshots(ev, day=F.date_format("ts", "yyyy-MM-dd"), order=["snapshot", "ts", "event_id"])
    return out.select("day", "event_id", "user_id", "event_type")


TOPN_SQL = """SELECT event_id, event_type FROM events
ORDER BY CASE WHEN event_type IN ('click', 'view', 'purchase') THEN date_trunc('second', ts) ELSE TIMESTAMP '1970-01-01' END DESC,
         event_id ASC LIMIT 100
"""


@query("newest_first_topn", TOPN_SQL)
def q_newest_first_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 newest by the fallback chain: time tuple, ISO ``published``, ISO ``published_at``, epoch."""
    from newslake.operators.order import newest_n

    et, ts = F.col("event_type"), F.col("ts")
    parts = F.array(*[F.date_format(ts, p).cast("int") for p in ("yyyy", "MM", "dd", "HH", "mm", "ss")])
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(et == "purchase", parts).alias("published_parsed"),
        F.when(et == "click", iso_seconds("ts")).otherwise(F.lit("n/a")).alias("published"),
        F.when(et == "view", iso_seconds("ts")).alias("published_at"),
    )
    return newest_n(ev, 100, seq=["event_id"]).select("event_id", "event_type")


def _raw_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    et, ts = F.col("event_type"), F.col("ts")
    raw = (
        F.when(et == "click", iso_seconds(ts))
        .when(et == "view", F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(et == "purchase", F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(et == "error", F.concat(F.lit("x "), F.date_format(ts, "yyyy-MM-dd"), F.lit(" y")))
        .otherwise(F.lit("n/a"))
    )
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))


RAW_STAMP_SQL = """CASE event_type
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  WHEN 'view' THEN strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')
  WHEN 'purchase' THEN strftime(ts, '%Y%m%dT%H%M%S')
  WHEN 'error' THEN 'x ' || strftime(ts, '%Y-%m-%d') || ' y'
  ELSE 'n/a' END"""

EXTRACT_DAY_Q_SQL = f"""WITH r AS (SELECT event_id, {RAW_STAMP_SQL} AS raw FROM events)
SELECT event_id, raw, {extract_day_sql("raw")} AS day_iso, {extract_day_sql("raw", rfc822=True)} AS day_rfc FROM r
"""


@query("extract_day", EXTRACT_DAY_Q_SQL)
def q_extract_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _raw_stamps(spark, sf_dir)
    return r.select(
        "event_id", "raw",
        extract_day("raw", "iso").alias("day_iso"),
        extract_day("raw", "iso+rfc822").alias("day_rfc"),
    )


RETENTION_AS_OF = "2024-01-20T12:00:00"
RETENTION_DAYS = 5


def _named_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    et = F.col("event_type")
    name = (
        F.when(et == "signup", F.lit("all_news.json"))
        .when(et == "view", F.concat(F.lit("notes_"), F.col("user_id").cast("string"), F.lit(".json")))
        .otherwise(F.concat(F.lit("news_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")))
    )
    return table(spark, sf_dir, "events").select("event_id", name.alias("file"))


def _retention_sql(keep: bool) -> str:
    cond = (
        "(d IS NOT NULL AND CAST(d AS TIMESTAMP) < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 5 DAY "
        "AND file <> 'all_news.json')"
    )
    return f"""WITH f AS (
  SELECT event_id, CASE event_type WHEN 'signup' THEN 'all_news.json'
                     WHEN 'view' THEN 'notes_' || CAST(user_id AS VARCHAR) || '.json'
                     ELSE 'news_' || strftime(ts, '%Y-%m-%d') || '.json' END AS file
  FROM events
), g AS (SELECT *, try_cast(nullif(regexp_extract(file, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS DATE) AS d FROM f)
SELECT event_id, file FROM g WHERE {"NOT " if keep else ""}coalesce({cond}, FALSE)
"""


@query("retention_keep", _retention_sql(True))
def q_retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.retention import retain

    return retain(_named_events(spark, sf_dir), "file", RETENTION_AS_OF, RETENTION_DAYS)


@query("retention_expired", _retention_sql(False))
def q_retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.retention import expired

    return expired(_named_events(spark, sf_dir), "file", RETENTION_AS_OF, RETENTION_DAYS)


@query("retention_partitions", _retention_sql(True))
def q_retention_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8, FIL11: the same files as partitions of a table, dropped by their names; what is left is read.

    Only names with a date can expire and have partitions of their own; the others, however many, share one.
    """
    from newslake.operators.retention import drop_expired_partitions, name_day
    from newslake.session import scratch_path

    path = scratch_path(spark, "named")
    undated = name_day("file").isNull()
    rows = _named_events(spark, sf_dir).withColumn("part", F.when(undated, "undated").otherwise(F.col("file")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.when(undated, F.pmod(F.xxhash64("event_id"), F.lit(tasks)))  # the shared partition is written by all tasks
    rows.repartition("part", dealt).write.partitionBy("part").parquet(path)
    drop_expired_partitions(spark, path, RETENTION_AS_OF, RETENTION_DAYS)
    return spark.read.parquet(path).select("event_id", "file")


PACKED_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
WHERE ts IS NOT NULL GROUP BY 1
"""


@query("compact_by_size", PACKED_SQL)
def q_compact_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: hourly parts packed into files of a target size by their names and bytes, read back by day."""
    from newslake.operators.compaction import packed_files, write_packed
    from newslake.session import materialize, scratch_path

    ev = table(spark, sf_dir, "events").where("ts IS NOT NULL").select(
        "event_id", "event_type", "ts", F.date_format("ts", "yyyy-MM-dd_HH").alias("part"))
    parts = ev.groupBy("part").agg(F.sum(F.octet_length("event_type") + 16).alias("bytes")).select(
        F.col("part").alias("name"), F.substring("part", 1, 10).alias("day"), "bytes")
    plan = materialize(packed_files(parts, 64 << 10), "packed")
    path = write_packed(ev, plan, scratch_path(spark, "packed-days"), "part", ["ts", "event_id"])
    back = spark.read.parquet(path).select(F.col("day").cast("string").alias("day"), "event_id")
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# Merge scenario on orders: the accumulated table holds the first order of every
# customer up to the cut; the incoming batch re-sends an overlapping half year.
MERGE_CUT = "1998-01-01"
BATCH_FROM = "1997-07-01"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def _existing_first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.dedupe import dedupe_first

    ex = _orders(spark, sf_dir).filter(F.col("o_orderdate") < F.lit(MERGE_CUT).cast("timestamp_ntz"))
    return dedupe_first(ex, F.col("o_custkey"), ["o_orderdate", "o_orderkey"])


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).filter(F.col("o_orderdate") >= F.lit(BATCH_FROM).cast("timestamp_ntz"))


MERGE_SQL = f"""WITH ex AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                 FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_CUT}') WHERE rn = 1
), b AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                 FROM orders WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}') WHERE rn = 1
)
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, 'existing' AS origin FROM ex
UNION ALL
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), 'batch' FROM b
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.o_custkey = b.o_custkey)
"""


@query("merge_upsert", MERGE_SQL)
def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.merge import merge_upsert

    merged = merge_upsert(
        _existing_first_orders(spark, sf_dir), _batch(spark, sf_dir),
        key="o_custkey", order=["o_orderdate", "o_orderkey"],
    )
    return merged.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "origin")


MERGE_METRICS_SQL = f"""WITH ex AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                 FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_CUT}') WHERE rn = 1
), b AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}'),
kept AS (SELECT count(DISTINCT o_custkey) AS n FROM b WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.o_custkey = b.o_custkey))
SELECT 'existing' AS metric, (SELECT count(*) FROM ex) AS value
UNION ALL SELECT 'incoming', (SELECT count(*) FROM b)
UNION ALL SELECT 'kept', (SELECT n FROM kept)
UNION ALL SELECT 'dropped', (SELECT count(*) FROM b) - (SELECT n FROM kept)
"""


@query("merge_metrics", MERGE_METRICS_SQL)
def q_merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.operators.merge import merge_metrics, new_rows

    ex, b = _existing_first_orders(spark, sf_dir), _batch(spark, sf_dir)
    return merge_metrics(ex, b, new_rows(ex, b, key="o_custkey", order=["o_orderdate", "o_orderkey"]))


def _alltime(spark: SparkSession, sf_dir: str):
    """The stored all-time table after two batches of orders, and the metrics of both merges."""
    from newslake.operators.alltime import AllTimeTable
    from newslake.session import scratch_path

    orders = _orders(spark, sf_dir)
    stored = AllTimeTable(
        spark, scratch_path(spark, "all-time"), orders.schema, key="o_custkey", time="o_orderdate", ties=["o_orderkey"],
        buckets=16)
    first = ["o_orderdate", "o_orderkey"]
    runs = [stored.merge(orders.filter(F.col("o_orderdate") < F.lit(MERGE_CUT).cast("timestamp_ntz")), first=first),
            stored.merge(_batch(spark, sf_dir), first=first)]
    return stored, runs


ALLTIME_SQL = f"""SELECT o_custkey, o_orderkey, o_orderdate FROM ({MERGE_SQL})"""


@query("alltime_merge", ALLTIME_SQL)
def q_alltime_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3, JOI6: two batches merged into the stored table, read back."""
    stored, _ = _alltime(spark, sf_dir)
    return stored.read().select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


ALLTIME_NEWEST_SQL = f"""SELECT o_custkey, o_orderkey, o_orderdate FROM ({MERGE_SQL})
ORDER BY o_orderdate DESC, o_orderkey LIMIT 200
"""


@query("alltime_newest", ALLTIME_NEWEST_SQL)
def q_alltime_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD1, TOP2, SRC10: the newest rows of the stored table, from the newest periods alone."""
    stored, _ = _alltime(spark, sf_dir)
    return stored.newest(200).select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


ALLTIME_METRICS_SQL = f"""WITH o AS (SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{MERGE_CUT}') AS a,
  count(DISTINCT o_custkey) FILTER (WHERE o_orderdate < TIMESTAMP '{MERGE_CUT}') AS ka,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}') AS b, count(DISTINCT o_custkey) AS k FROM orders)
SELECT 1 AS run, 'existing' AS metric, CAST(0 AS BIGINT) AS value FROM o UNION ALL SELECT 1, 'incoming', a FROM o
UNION ALL SELECT 1, 'kept', ka FROM o UNION ALL SELECT 1, 'dropped', a - ka FROM o
UNION ALL SELECT 2, 'existing', ka FROM o UNION ALL SELECT 2, 'incoming', b FROM o
UNION ALL SELECT 2, 'kept', k - ka FROM o UNION ALL SELECT 2, 'dropped', b - (k - ka) FROM o
"""


@query("alltime_metrics", ALLTIME_METRICS_SQL)
def q_alltime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK9, AGG6: what the merges counted while they wrote."""
    _, runs = _alltime(spark, sf_dir)
    return spark.createDataFrame(
        [(i + 1, m, v) for i, run in enumerate(runs) for m, v in run.items()], "run int, metric string, value long")


#: The batch is processed on one day, whatever its articles' dates: all of it goes to that day's quarter.
PROCESSED_ON = "1997-11-15"
QUARTER_SQL = f"""WITH q AS (
  SELECT *, CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter FROM orders
), ex AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quarter, o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                 FROM q WHERE o_orderdate < TIMESTAMP '{MERGE_CUT}') WHERE rn = 1
), b AS (
  SELECT * EXCLUDE (quarter), '1997_Q4' AS quarter
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM q WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}') WHERE rn = 1
), m AS (
  SELECT quarter, 'existing' AS origin FROM ex
  UNION ALL
  SELECT quarter, 'batch' FROM b WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.quarter = b.quarter AND ex.o_custkey = b.o_custkey)
)
SELECT quarter, count(*) AS n_rows, count(*) FILTER (WHERE origin = 'batch') AS n_added FROM m GROUP BY quarter
"""


@query("quarter_merge", QUARTER_SQL)
def q_quarter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newslake.functions.dates import quarter_label
    from newslake.operators.dedupe import dedupe_first
    from newslake.operators.merge import merge_quarter

    orders = _orders(spark, sf_dir).withColumn("quarter", quarter_label("o_orderdate"))
    before = orders.filter(F.col("o_orderdate") < F.lit(MERGE_CUT).cast("timestamp_ntz"))
    existing = dedupe_first(
        before, F.concat_ws("\u0001", "quarter", F.col("o_custkey").cast("string")), ["o_orderdate", "o_orderkey"]
    )
    merged = merge_quarter(
        existing, _batch(spark, sf_dir), key="o_custkey", order=["o_orderdate", "o_orderkey"],
        processing_date=F.to_date(F.lit(PROCESSED_ON)),
    )
    return merged.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("origin") == F.lit("batch")).alias("n_added")
    )
