"""Queries that land the given tables as files in the shared folder and read them back: sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslake.plans.registry import query
from newslake.plans.tables import table
from newslake.session import scratch_path

PER_FILE = 250
PER_REJECT_FILE = 50  # the rejects query lands smaller arrays

JSON_FILES_SQL = f"""SELECT CAST(event_id % {PER_FILE} AS INTEGER) AS pos, 'http://e/' || CAST(event_id AS VARCHAR) AS url,
       event_type AS title, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published_at
FROM events WHERE floor(event_id / {PER_FILE}) % 7 <> 3
"""


def _landed_arrays(spark: SparkSession, sf_dir: str, per_file: int = PER_FILE) -> str:
    """``per_file`` consecutive events a JSON array, an array a file; every seventh file is cut off.

    The files lie in one folder, an array being a row of the written table, so no folder is made or listed for each.
    """
    from newslake.functions.dates import iso_seconds

    ev = table(spark, sf_dir, "events")
    part = F.floor(F.col("event_id") / per_file)
    item = F.struct(
        "event_id", F.struct(F.concat(F.lit("http://e/"), F.col("event_id").cast("string")).alias("url"),
                             F.col("event_type").alias("title"), iso_seconds("ts").alias("published_at")).alias("a"))
    files = ev.select(part.alias("part"), item.alias("i")).groupBy("part").agg(F.sort_array(F.collect_list("i")).alias("l"))
    text = F.to_json(F.transform("l", lambda x: x["a"]))
    text = F.when(F.col("part") % 7 == 3, F.substr(text, F.lit(1), F.length(text) - 5)).otherwise(text)
    path = scratch_path(spark, "landed-json")
    files.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("json_array_files", JSON_FILES_SQL)
def q_json_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, SRC2, SNK1: JSON-array files, selected by name, one row per element with its place."""
    from newslake.sources.json_files import read_json_arrays

    rows, _ = read_json_arrays(spark, _landed_arrays(spark, sf_dir) + "/part-*.txt")
    return rows.select("pos", "url", "title", "published_at")


JSON_REJECTS_SQL = f"""SELECT 'malformed JSON' AS reason, count(*) AS files
FROM (SELECT DISTINCT floor(event_id / {PER_REJECT_FILE}) AS part FROM events) WHERE part % 7 = 3
"""


@query("json_array_rejects", JSON_REJECTS_SQL)
def q_json_array_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8: files that are no JSON list, with the reason."""
    from newslake.sources.json_files import read_json_arrays

    _, rejects = read_json_arrays(spark, _landed_arrays(spark, sf_dir, PER_REJECT_FILE) + "/part-*.txt")
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("files"))


ARRAY_SCAN_SQL = """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, 'doc://' || CAST(doc_id AS VARCHAR) AS url,
       source AS title, text AS content FROM documents
"""


@query("json_array_scan", ARRAY_SCAN_SQL)
def q_json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, SNK1, ORD3: all documents as one JSON array over many files, read back by byte ranges."""
    from newslake.sinks.writers import write_json_array
    from newslake.sources.json_chunks import scan_json_arrays

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), F.col("source").alias("title"),
        F.col("text").alias("content"))
    path = write_json_array(docs, scratch_path(spark, "all-news"), ["doc_id"], drop=["doc_id"])
    rows, _ = scan_json_arrays(spark, path, joined=True)
    return rows.select("pos", "url", "title", "content")


AS_OF = "2024-01-10"
SELECTION_SQL = """WITH f AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'news_' || strftime(ts, '%Y-%m-%d') || '.json'
    WHEN 1 THEN 'finanzen_' || strftime(ts, '%Y-%m-%d_%H') || '00.json' WHEN 2 THEN 'news_2024_Q1.json'
    WHEN 3 THEN 'all_news.json' ELSE 'news_filtered_for_companies_of_interest.json' END AS file FROM events WHERE ts IS NOT NULL
), s AS (
  SELECT 'batch' AS selection, * FROM f WHERE file LIKE 'news\\_2024-01-10%.json' ESCAPE '\\'
  UNION ALL SELECT 'snapshots', * FROM f WHERE file LIKE 'finanzen\\_2024-01-09\\_%.json' ESCAPE '\\'
  UNION ALL SELECT 'quarters', * FROM f WHERE file LIKE 'news\\_%\\_Q%.json' ESCAPE '\\'
  UNION ALL SELECT 'articles', * FROM f WHERE file <> 'all_news.json' AND NOT contains(file, 'filtered_for_companies_of_interest')
)
SELECT selection, file, row_number() OVER (PARTITION BY selection ORDER BY file) AS place, count(*) AS n FROM s GROUP BY selection, file
"""


@query("file_selection", SELECTION_SQL)
def q_file_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2, FIL11, ORD3, SCA13, SRC9: which landed files a job of a day reads, in the order of their names."""
    from newslake.sources.json_files import select_names, write_if_any

    kind, day = F.col("event_id") % 5, F.date_format("ts", "yyyy-MM-dd")
    name = (F.when(kind == 0, F.concat(F.lit("news_"), day, F.lit(".json")))
            .when(kind == 1, F.concat(F.lit("finanzen_"), F.date_format("ts", "yyyy-MM-dd_HH"), F.lit("00.json")))
            .when(kind == 2, F.lit("news_2024_Q1.json")).when(kind == 3, F.lit("all_news.json"))
            .otherwise(F.lit("news_filtered_for_companies_of_interest.json")))
    landed = scratch_path(spark, "named-files")
    table(spark, sf_dir, "events").where("ts IS NOT NULL").select("event_id", name.alias("file")).repartition("file").write.partitionBy(
        "file").parquet(landed)
    files = spark.read.parquet(landed).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    picked = files.select(F.explode(select_names("file", AS_OF)).alias("selection"), "file", "n")
    placed = picked.withColumn("place", F.row_number().over(Window.partitionBy("selection").orderBy("file")))  # one row a file
    out = scratch_path(spark, "selected")
    if not write_if_any(placed, out, "parquet"):
        return placed
    return spark.read.parquet(out).select("selection", "file", F.col("place").cast("long").alias("place"), "n")


CSV_SQL = """SELECT CAST(doc_id AS VARCHAR) AS id, lang || ', ' || source || ', "q", x' AS tags FROM documents"""


@query("csv_flattened", CSV_SQL)
def q_csv_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: lists are joined, written as CSV with a header, and read back."""
    from newslake.sinks.writers import write_csv

    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.array("lang", "source", F.lit('"q"'), F.lit("x")).alias("tags"))
    path = write_csv(docs, scratch_path(spark, "csv"))
    return spark.read.option("header", True).option("escape", "\\").csv(path)


ENTITY_SQL = """SELECT alias, arg_max(p_name, p_partkey) AS entity, arg_max(p_type, p_partkey) AS category FROM (
  SELECT p_partkey, p_name, p_type, unnest([lower(p_brand), lower(p_name) || ', ' || CAST(p_size AS VARCHAR)]) AS alias FROM part
) GROUP BY alias
"""


@query("entity_csv", ENTITY_SQL)
def q_entity_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, JOI8: the entity table as a CSV file in row order; the later row wins an alias."""
    from newslake.operators.match import entity_dictionary
    from newslake.sources.entities import read_entity_csv

    path = scratch_path(spark, "entities")
    cells = F.concat(F.col("p_brand"), F.lit(" ;; "), F.col("p_name"), F.lit(", "), F.col("p_size").cast("string"))
    table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("entity_name"), F.col("p_type").alias("category"), cells.alias("aliases")
    ).repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").drop("p_partkey").write.option(
        "header", True).csv(path)
    return entity_dictionary(read_entity_csv(spark, path), order="row")


DAILY_SQL = """WITH s AS (
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day,
         row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), user_id, event_type ORDER BY ts, event_id) AS rn FROM events
)
SELECT day, event_id, event_type FROM s WHERE rn = 1 AND day >= '2024-01-15' AND NOT (day = '2024-01-20' AND event_type = 'click')
"""


@query("daily_partitions", DAILY_SQL)
def q_daily_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7, SNK5, SNK8: compacted days as partitions; one day rewritten, expired days removed, read back."""
    from newslake.operators.compaction import compact_snapshots, write_daily
    from newslake.operators.retention import retain
    from newslake.sinks.writers import rewrite_partitions

    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("url"),
        F.lit(None).cast("string").alias("title"))
    days = compact_snapshots(ev, day=F.date_format("ts", "yyyy-MM-dd"), order=["ts", "event_id"])
    path = write_daily(days.select("day", "event_id", "event_type"), scratch_path(spark, "daily"))
    rewrite_partitions(spark, path, lambda d: d.where("event_type <> 'click'"), ["day"], F.col("day") == "2024-01-20")
    rewrite_partitions(
        spark, path, lambda d: retain(d.withColumn("day", F.col("day").cast("string")), "day", "2024-01-20T00:00:00", 5),
        ["day"], F.col("day") < "2024-01-16")
    back = spark.read.parquet(path)
    return back.select(F.col("day").cast("string").alias("day"), "event_id", "event_type")
