"""Snapshot selection, gates, lookups and fan-out. Events are dated slices of users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import capitalize_words
from tidemark.operators import fanout, gates, lookups, selection
from tidemark.plans.queries.registry import query, table

ASOF = dt.date(2024, 1, 31)
SLICED_SQL = """
sliced AS (SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS scrape_date
           FROM events)
"""


def sliced_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"),
    )


@query("latest_snapshot", f"""
WITH {SLICED_SQL}
SELECT s.* FROM sliced s JOIN (
  SELECT user_id, event_type, max(scrape_date) AS scrape_date FROM sliced GROUP BY ALL) m
USING (user_id, event_type, scrape_date)
""")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return selection.latest_snapshot(
        sliced_events(spark, d), ["user_id", "event_type"], "scrape_date"
    )


@query("requested_snapshot", f"""
WITH {SLICED_SQL} SELECT * FROM sliced WHERE scrape_date = '2024-01-15'
""")
def requested_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return selection.requested_snapshot(
        sliced_events(spark, d), ["user_id", "event_type"], "scrape_date", "2024-01-15"
    )


@query("staging_slice", f"""
WITH {SLICED_SQL}
SELECT * FROM sliced WHERE event_type = 'purchase' AND scrape_date = '2024-01-20'
""")
def staging_slice(spark: SparkSession, d: str) -> DataFrame:
    return selection.slice_rows(
        sliced_events(spark, d), season="purchase", date="2024-01-20",
        columns=("event_type", "scrape_date", "user_id"),
    )


@query("min_rows_gate", f"""
WITH {SLICED_SQL}
SELECT * FROM sliced WHERE user_id IN (
  SELECT user_id FROM sliced GROUP BY user_id HAVING count(*) >= 50)
""")
def min_rows_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.min_rows_gate(sliced_events(spark, d), ["user_id"])


@query("retention_filter", f"""
WITH {SLICED_SQL},
staged AS (SELECT event_id, user_id,
  CASE WHEN event_type <> 'error' THEN scrape_date END AS scrape_date FROM sliced)
SELECT * FROM staged
WHERE NOT coalesce(CAST(scrape_date AS DATE) < DATE '2024-01-31' - INTERVAL 14 DAY, false)
""")
def retention_filter(spark: SparkSession, d: str) -> DataFrame:
    staged = sliced_events(spark, d).select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("scrape_date")).alias("scrape_date"),
    )
    return gates.retained(staged, "scrape_date", ASOF)


@query("slice_outcome", f"""
WITH {SLICED_SQL},
requested AS (SELECT DISTINCT s.user_id, strftime(unnest(generate_series(DATE '2024-01-01',
  DATE '2024-01-30', INTERVAL 1 DAY)), '%Y-%m-%d') AS scrape_date FROM sliced s),
counted AS (SELECT user_id, scrape_date, count(*) AS n FROM sliced GROUP BY ALL)
SELECT user_id, scrape_date, coalesce(n, 0) AS rows,
       CASE WHEN n IS NULL THEN 'no output' WHEN n < 3 THEN 'too few rows' ELSE 'ok' END AS status
FROM requested LEFT JOIN counted USING (user_id, scrape_date)
""")
def slice_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Every user is asked for every day of the month."""
    events = sliced_events(spark, d)
    days = F.sequence(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 30)))
    requested = events.select("user_id").distinct().select(
        "user_id", F.explode(days.cast("array<string>")).alias("scrape_date")
    )
    return gates.slice_outcomes(requested, events, ["user_id", "scrape_date"], 3)


@query("lookup_default", """
SELECT o.o_orderkey, o.o_custkey, coalesce(s.s_name, 'club ' || o.o_custkey) AS club_name,
       CASE strftime(o_orderdate, '%Y') WHEN '1997' THEN '1997/1998' WHEN '1998' THEN '1998/1999'
         ELSE strftime(o_orderdate, '%Y') END AS season_label
FROM orders o LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey
ORDER BY club_name
""")
def lookup_default(spark: SparkSession, d: str) -> DataFrame:
    clubs = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("o_custkey"), F.col("s_name").alias("club_name")
    )
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey",
        lookups.label(
            F.date_format("o_orderdate", "yyyy"), {"1997": "1997/1998", "1998": "1998/1999"}
        ).alias("season_label"),
    )
    default = F.concat(F.lit("club "), F.col("o_custkey").cast("string"))
    return lookups.lookup_default(orders, clubs, "o_custkey", "club_name", default).orderBy(
        "club_name"
    )


@query("dimension_resolve", """
WITH known AS (
  SELECT 'building_' || s_suppkey AS team, s_name AS club_name,
         lower(replace(s_name, '#', '-')) AS club_slug, CAST(s_suppkey AS VARCHAR) AS club_id
  FROM supplier),
asked AS (
  SELECT lower(c_mktsegment) || '_' || c_custkey AS team,
         CASE WHEN c_acctbal > 0 THEN c_name END AS club_name,
         CASE WHEN c_nationkey < 12 THEN lower(replace(c_name, '#', '-')) END AS club_slug,
         CASE WHEN c_acctbal < 5000 THEN CAST(c_custkey AS VARCHAR) END AS club_id,
         lower(c_mktsegment) AS head, c_custkey
  FROM customer)
SELECT a.team, a.c_custkey,
  CASE WHEN k.team IS NOT NULL THEN k.club_name
       ELSE coalesce(a.club_name, upper(left(head, 1)) || substr(head, 2) || ' ' || c_custkey)
  END AS club_name,
  CASE WHEN k.team IS NOT NULL THEN k.club_slug
       ELSE coalesce(a.club_slug, replace(a.team, '_', '-')) END AS club_slug,
  CASE WHEN k.team IS NOT NULL THEN k.club_id ELSE coalesce(a.club_id, '985') END AS club_id,
  CASE WHEN k.team IS NOT NULL THEN 'known'
       WHEN a.club_name IS NOT NULL AND a.club_slug IS NOT NULL AND a.club_id IS NOT NULL
         THEN 'given' ELSE 'derived' END AS origin
FROM asked a LEFT JOIN known k ON k.team = a.team
""")
def dimension_resolve(spark: SparkSession, d: str) -> DataFrame:
    slug = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-")))
    known = table(spark, d, "supplier").select(
        F.concat(F.lit("building_"), F.col("s_suppkey").cast("string")).alias("team_key"),
        F.col("s_name").alias("club_name"), slug.alias("club_slug"),
        F.col("s_suppkey").cast("string").alias("club_id"),
    )
    name = F.col("c_name")
    asked = table(spark, d, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey").cast("string")).alias(
            "team"
        ),
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, name).otherwise("").alias("club_name"),
        F.when(F.col("c_nationkey") < 12, F.lower(F.replace(name, F.lit("#"), F.lit("-"))))
        .alias("club_slug"),
        F.when(F.col("c_acctbal") < 5000, F.col("c_custkey")).alias("club_id"),
    )
    return lookups.resolve_teams(asked, known)


@query("name_fallback", """
SELECT c_custkey,
  coalesce(CASE WHEN c_acctbal > 0 THEN c_name END,
           upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Nation ' || c_nationkey)
  AS player_name
FROM customer
""")
def name_fallback(spark: SparkSession, d: str) -> DataFrame:
    slug = F.concat_ws("-", F.col("c_mktsegment"), F.lit("NATION"), F.col("c_nationkey"))
    return table(spark, d, "customer").select(
        "c_custkey",
        lookups.first_name(
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(""),
            capitalize_words(slug, "-"),
        ).alias("player_name"),
    )


@query("fan_out", """
WITH seasons AS (SELECT unnest(['1996', '1997', '1998']) AS season),
teams AS (SELECT c_custkey AS team, c_name AS club_name FROM customer),
rosters AS (SELECT DISTINCT o_custkey AS team, strftime(o_orderdate, '%Y') AS season,
                            o_orderkey AS player_id FROM orders)
SELECT team, club_name, season, player_id, 'GB1' AS competition_code
FROM teams CROSS JOIN seasons JOIN rosters USING (team, season)
""")
def fan_out(spark: SparkSession, d: str) -> DataFrame:
    teams = table(spark, d, "customer").select(
        F.col("c_custkey").alias("team"), F.col("c_name").alias("club_name")
    )
    rosters = table(spark, d, "orders").select(
        F.col("o_custkey").alias("team"),
        F.date_format("o_orderdate", "yyyy").alias("season"),
        F.col("o_orderkey").alias("player_id"),
    )
    return fanout.work_list(teams, ["1996", "1997", "1998"], rosters)
