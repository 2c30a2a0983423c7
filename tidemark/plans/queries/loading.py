"""Staging to history: dedup, upsert, audit. Line items stand in for staged rows.

Team and season are the return flag and line status, the player is the order,
the matchday the line number (line 7 has none, so there are keys with a null),
the version is the ship date. What was shipped before the cut is the history,
what came later is the new load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.dedup import keep_first, keep_first_across, keep_latest, top_n
from tidemark.operators.upsert import (
    merge_metrics, read_history, upsert, upsert_table,
)
from tidemark.plans.queries.registry import query, table
from tidemark.session import workspace

CUT = dt.datetime(1998, 7, 1)
KEYS = ["team", "season", "player_id", "matchday"]
BY = ["team", "season"]

STAGED_SQL = """
staged AS (
  SELECT l_returnflag AS team, l_linestatus AS season, l_orderkey AS player_id,
         nullif(l_linenumber, 7) AS matchday, strftime(l_shipdate, '%Y-%m-%d') AS transformed_at,
         l_partkey AS part, l_suppkey AS supplier, l_quantity AS quantity,
         l_extendedprice AS price
  FROM lineitem),
old AS (
  SELECT * FROM staged WHERE transformed_at < '1998-07-01'
  QUALIFY row_number() OVER (PARTITION BY team, season, player_id, matchday
    ORDER BY transformed_at DESC NULLS FIRST, part, supplier, quantity, price) = 1),
new AS (
  SELECT * FROM staged WHERE transformed_at >= '1998-07-01'
  QUALIFY row_number() OVER (PARTITION BY team, season, player_id, matchday
    ORDER BY transformed_at DESC NULLS FIRST, part, supplier, quantity, price) = 1)
"""
MERGED_SQL = f"""
WITH {STAGED_SQL}
SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM new WHERE new.team = old.team AND new.season = old.season
    AND new.player_id = old.player_id AND new.matchday = old.matchday)
UNION ALL SELECT * FROM new
"""


def staged_lines(spark: SparkSession, d: str, which: Column | None = None) -> DataFrame:
    lines = table(spark, d, "lineitem")
    return (lines if which is None else lines.filter(which)).select(
        F.col("l_returnflag").alias("team"),
        F.col("l_linestatus").alias("season"),
        F.col("l_orderkey").alias("player_id"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("matchday"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("transformed_at"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def history_and_load(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    shipped = F.col("l_shipdate")
    return (
        keep_latest(staged_lines(spark, d, shipped < F.lit(CUT)), KEYS, "transformed_at"),
        keep_latest(staged_lines(spark, d, shipped >= F.lit(CUT)), KEYS, "transformed_at"),
    )


@query("dedup_latest", """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey,
       l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY lineitem.l_shipdate DESC NULLS FIRST, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus) = 1
""")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    newest = keep_latest(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return newest.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("upsert_merge", MERGED_SQL)
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    history, load = history_and_load(spark, d)
    return upsert(history, load, KEYS)


@query("upsert_history_table", MERGED_SQL)
def upsert_history_table(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert on partition folders, loaded twice: the second time must change nothing
    for whole keys (rows with a null key are added again by rule, so the repeat leaves them out)."""
    history, load = history_and_load(spark, d)
    path = workspace(spark, "history")
    upsert_table(spark, path, history, KEYS, BY, history.schema)
    upsert_table(spark, path, load, KEYS, BY, history.schema)
    upsert_table(spark, path, load.filter(F.col("matchday").isNotNull()), KEYS, BY, history.schema)
    return read_history(spark, path, history.schema)


@query("load_summary_slice", f"""
WITH merged AS ({MERGED_SQL})
SELECT team, season, count(*) AS rows_in_history, count(DISTINCT player_id) AS distinct_players,
       max(transformed_at) AS latest_scrape_date
FROM merged WHERE (team, season) IN (
  SELECT (l_returnflag, l_linestatus) FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-07-01' AND l_returnflag <> 'A')
GROUP BY team, season
""")
def load_summary_slice(spark: SparkSession, d: str) -> DataFrame:
    """The summary of some slices only: their folders are found by a join while the query runs."""
    history, load = history_and_load(spark, d)
    path = workspace(spark, "history")
    upsert_table(spark, path, history, KEYS, BY, history.schema)
    upsert_table(spark, path, load, KEYS, BY, history.schema)
    asked = load.filter(F.col("team") != "A").select(*BY).distinct()
    return audit.load_summary(read_history(spark, path, history.schema, asked), BY, "player_id", "transformed_at")


@query("load_late_file", MERGED_SQL)
def load_late_file(spark: SparkSession, d: str) -> DataFrame:
    """The older file comes last: what the table has in a newer version stays."""
    history, load = history_and_load(spark, d)
    path = workspace(spark, "history")
    for rows in (load, history):
        upsert_table(spark, path, rows, KEYS, BY, history.schema, newer_wins="transformed_at")
    return read_history(spark, path, history.schema)


@query("merge_metrics", f"""
WITH {STAGED_SQL},
hit AS (SELECT count(*) AS n FROM new WHERE EXISTS (
  SELECT 1 FROM old WHERE new.team = old.team AND new.season = old.season
    AND new.player_id = old.player_id AND new.matchday = old.matchday))
SELECT (SELECT count(*) FROM new) - hit.n AS rows_inserted, hit.n AS rows_updated,
       (SELECT count(*) FROM new) AS rows_merged FROM hit
""")
def merge_metrics_query(spark: SparkSession, d: str) -> DataFrame:
    return merge_metrics(*history_and_load(spark, d), KEYS)


@query("load_after_upsert", f"""
WITH merged AS ({MERGED_SQL})
SELECT team, season, count(*) AS rows_in_history, count(DISTINCT player_id) AS distinct_players,
       max(transformed_at) AS latest_scrape_date
FROM merged GROUP BY ALL
""")
def load_after_upsert(spark: SparkSession, d: str) -> DataFrame:
    """After this load: rows, distinct players and newest snapshot of each team-season."""
    return audit.load_summary(upsert_merge(spark, d), BY, "player_id", "transformed_at")


@query("load_summary", """
SELECT user_id, event_type, count(*) AS rows_in_history,
       count(DISTINCT json_extract_string(props, '$.k')) AS distinct_players,
       max(strftime(ts, '%Y-%m-%d')) AS latest_scrape_date
FROM events GROUP BY ALL
""")
def load_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(
        "user_id", "event_type", F.get_json_object("props", "$.k").alias("player_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("bronze_scrape_date"),
    )
    return audit.load_summary(rows, ["user_id", "event_type"])


@query("rows_by_group", """
SELECT event_type, user_id, count(*) AS row_count FROM events GROUP BY ALL ORDER BY 1, 2
""")
def rows_by_group(spark: SparkSession, d: str) -> DataFrame:
    return audit.rows_by_group(table(spark, d, "events"), ["event_type", "user_id"])


@query("duplicate_keys", f"""
WITH {STAGED_SQL}
SELECT team, season, player_id, matchday, count(*) AS duplicate_count
FROM staged GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicate_keys(staged_lines(spark, d), KEYS)


@query("null_audit", """
SELECT count(*) AS total_rows,
       sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_quality,
       sum(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_toxic,
       sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_lang,
       sum(CASE WHEN source IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_source
FROM documents LEFT JOIN labels USING (doc_id)
""")
def null_audit(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return audit.null_audit(joined, ["quality", "toxic", "lang", "source"])


@query("table_row_counts", """
SELECT 'staging' AS table_name, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'history', count(*) FROM orders
""")
def table_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.table_row_counts(
        {"staging": table(spark, d, "lineitem"), "history": table(spark, d, "orders")}
    )


@query("spot_check_topk", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at
FROM events ORDER BY ts DESC, event_id LIMIT 25
""")
def spot_check_topk(spark: SparkSession, d: str) -> DataFrame:
    newest = audit.spot_check(table(spark, d, "events"), "ts", ["event_id"])
    return newest.select(
        "event_id", "user_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at"),
    )


@query("dedup_first_across", """
SELECT o_custkey, strftime(o_orderdate, '%Y') AS season, o_orderkey, o_orderstatus
FROM orders WHERE strftime(o_orderdate, '%Y') IN ('1998','1997','1996','1999','1995','2000','2001')
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
  list_position(['1998','1997','1996','1999','1995','2000','2001'], strftime(o_orderdate, '%Y')),
  o_orderkey) = 1
""")
def dedup_first_across(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy").alias("season"), "o_orderkey",
        "o_orderstatus",
    )
    seasons = ["1998", "1997", "1996", "1999", "1995", "2000", "2001"]
    return keep_first_across(orders, ["o_custkey"], "season", seasons, ["o_orderkey"])


@query("dedup_first", """
SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1
""")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice"
    )
    return keep_first(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query("topn_per_group", """
SELECT strftime(o_orderdate, '%Y') AS season, o_orderkey, o_custkey FROM orders
QUALIFY row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y') ORDER BY o_orderkey) <= 20
""")
def topn_per_group(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("season"), "o_orderkey", "o_custkey"
    )
    return top_n(orders, ["season"], ["o_orderkey"], 20)
