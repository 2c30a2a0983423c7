"""Files: paths, manifests, CSV, staging and load-once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import paths
from tidemark.operators.upsert import overwrite_partitions, read_table
from tidemark.plans.queries.registry import query, table
from tidemark.session import workspace
from tidemark.sources import manifest, staging, tables
from tidemark.streaming.incremental import append_batch, load_new_files


def _quarter() -> Column:
    return F.date_format(F.date_trunc("quarter", F.col("o_orderdate")), "yyyy-MM-dd")


QUARTER_SQL = "strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d')"


@query("path_metadata", f"""
SELECT o_orderkey, {QUARTER_SQL} AS scrape_date FROM orders
""")
def path_metadata(spark: SparkSession, d: str) -> DataFrame:
    root = workspace(spark, "dated")
    orders = table(spark, d, "orders").select("o_orderkey", _quarter().alias("scrape_date"))
    overwrite_partitions(orders, root, ["scrape_date"])
    files = spark.read.schema("o_orderkey bigint").parquet(root)
    return files.select(
        "o_orderkey", paths.scrape_date(F.col("_metadata.file_path")).alias("scrape_date")
    )


PATH_SPARK = """concat(CASE o_orderkey % 7 WHEN 5 THEN 'silver' WHEN 6 THEN 'elsewhere' ELSE 'bronze' END,
  '/', CASE o_orderkey % 11 WHEN 3 THEN 'other' ELSE 'site' END, '/team_', o_custkey, '/',
  CASE o_orderkey % 5 WHEN 0 THEN 'team_roster' WHEN 1 THEN 'player_detailed_stats_combined'
    WHEN 2 THEN 'player_detailed_stats_individual/player_id=7_x' WHEN 3 THEN 'league_teams'
    ELSE 'player_stats' END, '/', year(o_orderdate), '/scrape_date=', date_format(o_orderdate, 'yyyy-MM-dd'),
  CASE WHEN o_orderkey % 5 IN (1, 4) THEN '.csv' ELSE '.json' END)"""
PATHS_SQL = """
files AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS season,
  CASE o_orderkey % 7 WHEN 5 THEN 'silver' WHEN 6 THEN 'elsewhere' ELSE 'bronze' END AS root,
  CASE o_orderkey % 11 WHEN 3 THEN 'other' ELSE 'site' END AS source, o_orderkey % 5 AS kind,
  CASE o_orderkey % 7 WHEN 5 THEN 'silver' WHEN 6 THEN 'elsewhere' ELSE 'bronze' END ||
  '/' || CASE o_orderkey % 11 WHEN 3 THEN 'other' ELSE 'site' END || '/team_' || o_custkey || '/' ||
  CASE o_orderkey % 5 WHEN 0 THEN 'team_roster' WHEN 1 THEN 'player_detailed_stats_combined'
    WHEN 2 THEN 'player_detailed_stats_individual/player_id=7_x' WHEN 3 THEN 'league_teams'
    ELSE 'player_stats' END || '/' || year(o_orderdate) || '/scrape_date=' ||
  strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 5 IN (1, 4) THEN '.csv' ELSE '.json' END
  AS path FROM orders)
"""


def order_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.expr(PATH_SPARK).alias("path"))


@query("file_manifest", f"""
WITH {PATHS_SQL}
SELECT o_orderkey, path FROM files
WHERE season = 1997 AND source = 'site'
  AND (root = 'bronze' AND kind IN (0, 1, 2) OR root = 'silver' AND kind IN (1, 4))
ORDER BY path
""")
def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.manifest(order_paths(spark, d), "site", "bronze", "silver", season="1997")


@query("storage_key", f"""
WITH {PATHS_SQL},
judged AS (SELECT *, CASE WHEN root = 'elsewhere' THEN 'unsupported base path'
  WHEN source <> 'site' THEN 'unsupported source'
  WHEN root = 'bronze' AND kind = 4 THEN 'unsupported artifact' END AS reason FROM files)
SELECT o_orderkey, path, reason, CASE WHEN reason IS NULL THEN
  CASE root WHEN 'bronze' THEN 'raw' ELSE 'cleaned' END || substr(path, 7) END AS key
FROM judged
""")
def storage_key(spark: SparkSession, d: str) -> DataFrame:
    return manifest.upload_plan(order_paths(spark, d), "site", "bronze", "silver")


@query("file_listing", f"""
SELECT DISTINCT o_orderstatus AS team, {QUARTER_SQL} AS scrape_date, true AS has_bytes FROM orders
""")
def file_listing(spark: SparkSession, d: str) -> DataFrame:
    """Slices found by listing written files, without opening them."""
    root = workspace(spark, "listed")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("team"), _quarter().alias("scrape_date")
    )
    overwrite_partitions(orders, root, ["team", "scrape_date"])
    files = manifest.list_files(spark, root, "*.parquet")
    return files.groupBy(
        F.regexp_extract("path", "/team=([^/]*)/", 1).alias("team"),
        paths.scrape_date(F.col("path")).alias("scrape_date"),
    ).agg((F.min("bytes") > 0).alias("has_bytes"))


@query("csv_string_scan", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text, CAST(n_chars AS VARCHAR) AS n_chars,
       CASE lang WHEN 'fr' THEN NULL ELSE lang END AS note, lang, source
FROM documents
""")
def csv_string_scan(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts with quotes and line breaks through CSV; missing words come back as null."""
    root = workspace(spark, "csv")
    documents = table(spark, d, "documents").select(
        "doc_id", "text", "n_chars",
        F.when(F.col("lang") == "fr", "N/A").otherwise(F.col("lang")).alias("note"),
        "lang", "source",
    )
    tables.write_csv(documents, root, ["lang", "source"])
    read = tables.read_csv(
        spark, root, ["doc_id", "text", "n_chars", "note"], ["lang", "source"]
    )
    return read.withColumn("text", F.md5("text")).drop("_path")


@query("csv_plain_scan", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text, CASE lang WHEN 'fr' THEN 'N/A' WHEN 'de' THEN '' ELSE lang END
  AS note, source FROM documents
""")
def csv_plain_scan(spark: SparkSession, d: str) -> DataFrame:
    """The same scan without missing-value words: they stay text, and missing fields are empty."""
    root = workspace(spark, "csv")
    note = F.when(F.col("lang") == "fr", "N/A").when(F.col("lang") != "de", F.col("lang"))
    documents = table(spark, d, "documents").select("doc_id", "text", note.alias("note"), "source")
    tables.write_csv(documents, root, ["source"])
    read = tables.read_csv(spark, root, ["doc_id", "text", "note"], ["source"], missing=False)
    return read.withColumn("text", F.md5("text")).drop("_path")


@query("csv_block_scan", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text, CASE lang WHEN 'fr' THEN NULL ELSE lang END AS note, source
FROM documents
""")
def csv_block_scan(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts with quotes and line breaks, read by blocks that begin and end anywhere."""
    root = workspace(spark, "csv")
    note = F.when(F.col("lang") == "fr", "N/A").otherwise(F.col("lang"))
    documents = table(spark, d, "documents").select("doc_id", "text", note.alias("note"), "source")
    tables.write_csv(documents, root, ["source"])
    read = tables.read_csv_blocks(spark, root, ["doc_id", "text", "note"], ["source"])
    return read.withColumn("text", F.md5("text")).drop("_path")


STAGED = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("team", "season", "bronze_scrape_date", "player_id", "note")
])


@query("staging_append", f"""
SELECT o_orderstatus AS team, strftime(o_orderdate, '%Y') AS season, {QUARTER_SQL} AS bronze_scrape_date,
       CAST(o_orderkey AS VARCHAR) AS player_id, CAST(NULL AS VARCHAR) AS note, n AS rows_loaded
FROM orders, (SELECT count(*) AS n FROM orders), (SELECT unnest([1, 2]))
""")
def staging_append(spark: SparkSession, d: str) -> DataFrame:
    """Loaded twice: columns match by name in any case, and a forced load adds its rows again."""
    path = workspace(spark, "staging")
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("PLAYER_ID"), F.date_format("o_orderdate", "yyyy").alias("Season"),
        F.col("o_orderstatus").alias("Team"), _quarter().alias("bronze_Scrape_Date"),
        F.lit("x").alias("unknown_column"),
    )
    by = ["team", "season", "bronze_scrape_date"]
    staging.append_staging(orders, path, by, STAGED)
    loaded = staging.append_staging(orders, path, by, STAGED)
    return staging.read_staging(spark, path, STAGED).withColumn(
        "rows_loaded", F.lit(loaded).cast("bigint")
    )


@query("load_once", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate >= TIMESTAMP '1998-01-01' AS INTEGER) AS load_batch FROM orders
""")
def load_once(spark: SparkSession, d: str) -> DataFrame:
    """Two deliveries and a run in between that finds nothing: every row is loaded once."""
    root = workspace(spark, "once")
    orders = table(spark, d, "orders")
    early = F.col("o_orderdate") < F.to_timestamp(F.lit("1998-01-01"))

    def catch_up() -> None:
        load_new_files(
            spark, f"{root}/inbox", orders.schema, f"{root}/checkpoint",
            append_batch(f"{root}/staged"),
        )

    orders.filter(early).write.mode("append").parquet(f"{root}/inbox")
    catch_up()
    catch_up()
    orders.filter(~early).write.mode("append").parquet(f"{root}/inbox")
    catch_up()
    schema = T.StructType(
        [orders.schema["o_orderkey"], orders.schema["o_custkey"],
         T.StructField("load_batch", T.IntegerType())]
    )
    return read_table(spark, f"{root}/staged", schema)


@query("retention_drop", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS bronze_scrape_date FROM events
WHERE NOT CAST(ts AS DATE) < DATE '2024-01-31' - INTERVAL 14 DAY
""")
def retention_drop(spark: SparkSession, d: str) -> DataFrame:
    """Staged dates older than two weeks go as whole partitions."""
    path = workspace(spark, "expiring")
    events = table(spark, d, "events").select(
        "event_id", "user_id", F.lit("all").alias("team"), "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("bronze_scrape_date"),
    )
    overwrite_partitions(events, path, ["team", "event_type", "bronze_scrape_date"])
    staging.drop_expired(spark, path, dt.date(2024, 1, 31))
    return read_table(spark, path, events.schema).drop("team")
