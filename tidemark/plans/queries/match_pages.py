"""Pages to links, cells and match rows.

The driver's ``pages`` have links and headings; tables come from ``orders``:
every order is rendered as one player page (heading, links, three tables) and
read back. The SQL side never sees the HTML, it works on the order's columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.functions import html as H
from tidemark.functions import urls as U
from tidemark.functions.text import entity_key, slug_to_name
from tidemark.operators import discovery
from tidemark.operators import pages as P
from tidemark.operators.lookups import label
from tidemark.operators.nest import flatten_rows
from tidemark.plans import season_load
from tidemark.plans.queries.registry import query, table
from tidemark.session import spread, workspace

SITE = "https://stats.example.com"

# --- rendering: what one order's page says ------------------------------------------

FACTS = {
    # 0 and 4: too few dated rows for a match table; 1: only rows without a matchday
    "kind": "o_orderkey % 8",
    "md": "CASE WHEN o_orderkey % 8 = 1 THEN 0 ELSE o_orderkey % 37 + 1 END",
    "minute": "o_orderkey % 90 + 1",
    "home": "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ' (' || (o_orderkey % 20 + 1) || '.)'"
            " ELSE o_orderpriority END",
    "venue": "CASE WHEN o_orderkey % 2 = 0 THEN 'H' END",
    "score": "(o_orderkey % 5) || ':' || (o_orderkey % 4)",
    "pos": "CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE 'CF' END",
    "goals": "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 3 AS STRING) END",
    "yellow": "CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey % 90 + 1) || '''' ELSE '' END",
    "red": "CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END",
    "rating": "(o_orderkey % 6) || '.' || (o_orderkey % 9 + 1)",
    "season": "CAST(year(o_orderdate) AS STRING)",
    "away": "'Club & Sons ' || o_custkey",
    "name": "CASE WHEN o_orderkey % 10 <> 0 THEN 'Player & Son ' || o_custkey END",
    "slug": "'player-' || o_custkey",
    # some pages have a table inside the match table, a NUL between rows, a tag with 5,000
    # attributes, and a first cell of 20,000 digits
    "nested": "CASE WHEN o_orderkey % 16 = 7 THEN 1 ELSE 0 END",
    "total": "CASE WHEN o_orderkey % 1000 = 3 THEN repeat('7', 20000) ELSE 'sum' END",
}
DAY_SPARK = (
    "CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'MMM d, yyyy')"
    " WHEN 1 THEN date_format(o_orderdate, 'M/d/yy') ELSE date_format(o_orderdate, 'MMM d, yy') END"
)
DAY_DUCK = (
    "CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%b %-d, %Y')"
    " WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%y') ELSE strftime(o_orderdate, '%b %-d, %y') END"
)
FACTS_SQL = (
    "facts AS (SELECT o_orderkey AS page_id, o_custkey, o_orderstatus, o_orderdate, "
    + ", ".join(f"{sql} AS {name}" for name, sql in FACTS.items())
    + f", {DAY_DUCK} AS day FROM orders)"
)

PAGE = """concat(
 '<!DOCTYPE html><html><head><style>td{color:red}</style>',
 '<script>var t = "<table><tr><td>no</td></tr></table>"; /* <h1>no</h1> */</script></head><body>',
 '<!-- <a href="/x/profil/spieler/1">no</a> -->',
 CASE WHEN name IS NULL THEN '' ELSE concat('<h1 class="head">\\n  #', page_id % 99 + 1,
   ' <b>Player</b> &amp;&#32;Son ', o_custkey, '</h1>') END,
 '<ul><li><a href="/', slug, '/profil/spieler/', o_custkey, '?a=1&amp;b=2#x">\\n Player  <i>', o_custkey,
 '</i></a></li><li><a href="', '""" + SITE + """/', slug, '/profil/spieler/', o_custkey, '">again</a></li>',
 '<li><a class=x href=/next-', page_id, '/profil/spieler/', page_id, '/></a></li>',
 '<li><a href="/profil/spieler/">bad</a></li>',
 '<li><a title="Old &quot;', o_orderstatus, '&quot;" href="/club-', o_custkey, '/startseite/verein/', o_custkey,
 '/saison_id/1990">x</a></li>',
 '<li><a href="/club-', o_custkey, '/startseite/verein/', o_custkey, '/saison_id/', season, '">untitled</a></li>',
 '<li><a title="Club &gt; ', o_custkey, '" href="/club-', o_custkey, '/startseite/verein/', o_custkey,
 '/saison_id/', season, '">x</a></li>',
 '<li><a href="/twin/startseite/verein/', o_custkey, '/saison_id/', season, '" title="twin">x</a></li>',
 '<li><a title="" href="/fc-', page_id, '/startseite/verein/', page_id + 1000000000, '/saison_id/', season,
 '"> </a></li></ul>',
 '<table><tr><td>Name</td><td>', o_custkey, '</td></tr></table>',
 '<TABLE CLASS="x"><tr><td>', md, '<td>', day, '<td>a<td>b<td>c<td>d<tr><td>', total, '<td><td><td><td><td></TABLE>',
 CASE WHEN page_id % 12 = 5 THEN '\\0' ELSE '' END,
 '<table class="items"><thead><tr><th>Day</th><th>Date</th></tr></thead><tbody>\\n',
 '<tr class="odd"', CASE WHEN page_id % 1000 = 3 THEN repeat(' a="b>"', 5000) ELSE '' END, '><td class="zentriert">\\n ', md, ' </td><td>', day, '</td>',
 CASE WHEN venue IS NULL THEN '' ELSE '<td>H</td>' END,
 '<td><a href="/h" title="a > b">', home, '</a></td>',
 '<td>Club <b>&amp; Sons</b> ', o_custkey, '</td><td><a href="/m"><span>', score, '</span></a></td><td>', pos, '</td>',
 '<td>', goals, '</td><td>', format_number(o_custkey, 0), '</td><td>&nbsp;</td><td>', yellow, '</td><td></td>',
 '<td>', red, '</td><td>', CASE WHEN venue IS NULL THEN '' ELSE concat(minute, '&#39;') END, '</td><td></td>',
 '<td>', rating, '</td><td>', minute, '\\'</td>',
 CASE WHEN page_id % 6 = 0 THEN '<td>late</td><td> </td><td>sub</td>' ELSE '' END, '</tr>\\n',
 '<tr><td>1</td><td>', day, '</td><td>short',
 CASE WHEN nested = 1 THEN '<table><tr><td>in</td></tr></table>' ELSE '' END, '</td></tr>',
 CASE WHEN page_id % 12 = 5 THEN '\\0' ELSE '' END,
 CASE WHEN kind IN (0, 4) THEN '' ELSE concat(
   '<tr><td>', CASE WHEN kind = 1 THEN 0 ELSE md + 1 END, '</td><td>', day,
   '</td><td>A</td><td></td><td></td><td></td><td>Calf problems</td><td></td><td>', o_orderstatus, '</td></tr>',
   '<tr><td>', CASE WHEN kind = 1 THEN 0 ELSE md + 2 END, '</td><td>', day,
   '</td><td>x</td><td>y</td><td>postponed</td><td>z</td></tr>') END,
 '</tbody></table></body></html>')"""


def order_pages(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").selectExpr(
        "o_orderkey AS page_id", "o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate",
        "o_orderpriority",
    )
    facts = spread(orders).withColumns({name: F.expr(sql) for name, sql in FACTS.items()}).withColumn(
        "day", F.expr(DAY_SPARK)
    )
    return facts.select(
        "page_id", "season", F.col("o_orderstatus").alias("team"),
        F.col("o_custkey").cast("string").alias("player_id"), "slug",
        F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd").alias("quarter"),
        F.expr(PAGE).alias("html"),
    )


# --- the driver's pages ---------------------------------------------------------------

TEXT_SQL = (  # entities the driver's pages hold, decoded; & last
    "replace(replace(regexp_replace(regexp_replace({0}, '&amp;?', '&', 'g'), "
    "'&quot;?', '\"', 'g'), '&copy;', '©'), '&middot;', '·')"
)


@query("link_extract", f"""
WITH found AS (
  SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
         regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages),
numbered AS (SELECT page_id, hrefs, texts, unnest(range(len(hrefs))) AS i FROM found)
SELECT page_id, CAST(i AS INTEGER) AS pos, {TEXT_SQL.format("hrefs[i + 1]")} AS href,
       {TEXT_SQL.format("trim(texts[i + 1])")} AS text
FROM numbered
""")
def link_extract(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "html")
    return P.page_links(pages).select("page_id", "pos", "href", "text")


@query("heading_extract", f"""
SELECT page_id, nullif(trim({TEXT_SQL.format("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}), '')
  AS heading FROM pages
""")
def heading_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", H.heading(F.col("html")).alias("heading"))


@query("url_parts", """
WITH cut AS (SELECT page_id, url,
  regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, path,
       nullif(split_part(path, '/', 2), '') AS first_segment,
       nullif(split_part(path, '/', 3), '') AS second_segment,
       len(list_filter(string_split(path, '/'), lambda x: x <> '')) AS segments
FROM cut
""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = U.path_segments(F.col("url"))
    return table(spark, d, "pages").select(
        "page_id", U.url_path(F.col("url")).alias("path"),
        F.get(parts, F.lit(0)).alias("first_segment"), F.get(parts, F.lit(1)).alias("second_segment"),
        F.size(parts).cast("bigint").alias("segments"),
    )


@query("url_build", f"""
SELECT c_custkey,
  '{SITE}/' || lower(c_mktsegment) || '/kader/verein/' || c_custkey || '/saison_id/' || (2000 + c_nationkey)
    || '/plus/1' AS roster_url,
  '{SITE}/' || CASE c_mktsegment WHEN 'MACHINERY' THEN 'machines' ELSE lower(c_mktsegment) END
    || '/startseite/wettbewerb/' || c_mktsegment || '/plus/?saison_id=' || (2000 + c_nationkey) AS league_url,
  '{SITE}/' || lower(replace(c_name, '#', '-')) || '/leistungsdatendetails/spieler/' || c_custkey
    || '/saison/' || (2000 + c_nationkey) || '/verein/0/liga/0/wettbewerb/GB1/pos/0/trainer_id/0/plus/1'
    AS player_url,
  '{SITE}/' || lower(c_mktsegment) || '/' || c_custkey AS joined_url
FROM customer
""")
def url_build(spark: SparkSession, d: str) -> DataFrame:
    base, number = F.lit(SITE), F.col("c_custkey").cast("string")
    season = (F.lit(2000) + F.col("c_nationkey")).cast("string")
    league = F.col("c_mktsegment")
    slug = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("-")))
    path = F.concat(F.lit("/x/../"), F.lower(league), F.lit("/./"), number)
    return table(spark, d, "customer").select(
        "c_custkey",
        U.roster_url(base, F.lower(league), number, season).alias("roster_url"),
        U.league_url(base, label(league, {"MACHINERY": "machines"}, F.lower(league)), league, season)
        .alias("league_url"),
        U.player_stats_url(base, slug, number, season, F.lit("GB1")).alias("player_url"),
        U.join_url(SITE, path).alias("joined_url"),
    )


# --- rendered pages: links --------------------------------------------------------------


@query("link_filter", f"""
WITH {FACTS_SQL}
SELECT page_id, 0 AS pos, 'club_' || CAST(o_custkey AS VARCHAR) AS team_key,
       'Club > ' || o_custkey AS club_name, 'club-' || o_custkey AS club_slug,
       CAST(o_custkey AS VARCHAR) AS club_id,
       '{SITE}/club-' || o_custkey || '/startseite/verein/' || o_custkey || '/saison_id/' || season AS team_url
FROM facts
UNION ALL
SELECT page_id, 1, 'fc_' || page_id, 'Fc ' || page_id, 'fc-' || page_id,
       CAST(page_id + 1000000000 AS VARCHAR),
       '{SITE}/fc-' || page_id || '/startseite/verein/' || (page_id + 1000000000) || '/saison_id/' || season
FROM facts
""".replace("STRING", "VARCHAR"))
def link_filter(spark: SparkSession, d: str) -> DataFrame:
    """Titled links of exactly the page's season, each club once, in page order."""
    pages = order_pages(spark, d).select("page_id", "season", "html")
    return P.league_clubs(pages, SITE).drop("season")


@query("squad_players", f"""
WITH {FACTS_SQL},
found AS (
  SELECT page_id, 1 AS rank, 'Player ' || o_custkey AS player_name, slug AS player_slug,
    CAST(o_custkey AS VARCHAR) AS player_id,
    '{SITE}/' || slug || '/profil/spieler/' || o_custkey || '?a=1&b=2#x' AS player_url
  FROM facts
  UNION ALL
  SELECT page_id, 2, 'Next ' || page_id, 'next-' || page_id, CAST(page_id AS VARCHAR),
    '{SITE}/next-' || page_id || '/profil/spieler/' || page_id || '/'
  FROM facts WHERE page_id <> o_custkey)
SELECT page_id, CAST(rank - 1 AS INTEGER) AS pos, player_name, player_slug, player_id, player_url
FROM found
""".replace("STRING", "VARCHAR"))
def squad_players(spark: SparkSession, d: str) -> DataFrame:
    """Players of a page, each id once in page order; links without an id are left out."""
    return P.squad_players(order_pages(spark, d).select("page_id", "html"), SITE)


@query("player_folder", f"""
WITH {FACTS_SQL}
SELECT page_id, coalesce(name, 'Player ' || o_custkey) AS player_name,
  'player_id=' || o_custkey || CASE WHEN name IS NULL THEN '_player-' ELSE '_player-son-' END || o_custkey
  AS entity
FROM facts
""".replace("STRING", "VARCHAR"))
def player_folder(spark: SparkSession, d: str) -> DataFrame:
    """Name of a page's player, from the heading or else from the address, and the folder for it."""
    name = F.coalesce(H.heading(F.col("html")), slug_to_name(F.col("slug")))
    named = order_pages(spark, d).select("page_id", "player_id", name.alias("player_name"))
    return named.select(
        "page_id", "player_name", entity_key(F.col("player_name"), F.col("player_id")).alias("entity")
    )


# --- rendered pages: tables ---------------------------------------------------------------

FULL = "kind NOT IN (0, 4)"
VALID = "kind NOT IN (0, 1, 4)"
STAT_TEXTS = """goals || '|' || regexp_replace(format('{:,}', o_custkey), '\\s', '') || '||' || yellow
    || '||' || red || '|' || coalesce(minute || '''' || left(venue, 0), '') || '||' || rating || '|' || minute || ''''"""


@query("table_rows", f"""
WITH {FACTS_SQL}, listed AS (
  SELECT page_id, 0 AS table_no, 0 AS row_no, 2 AS n, 'Name|' || o_custkey AS texts FROM facts
  UNION ALL SELECT page_id, 1, 0, 6, md || '|' || day || '|a|b|c|d' FROM facts
  UNION ALL SELECT page_id, 1, 1, 6, total || '|||||' FROM facts
  UNION ALL SELECT page_id, 2, 0, 0, '' FROM facts
  UNION ALL SELECT page_id, 2, 1,
      16 + CASE WHEN venue IS NULL THEN 0 ELSE 1 END + CASE WHEN page_id % 6 = 0 THEN 3 ELSE 0 END,
      md || '|' || day || '|' || coalesce(venue || '|', '') || home || '|' || away || '|' || score || '|' || pos
      || '|' || {STAT_TEXTS} || CASE WHEN page_id % 6 = 0 THEN '|late||sub' ELSE '' END FROM facts
  UNION ALL SELECT page_id, 2, 2, 3 + nested, '1|' || day || '|short' || CASE WHEN nested = 1 THEN ' in|in' ELSE '' END
    FROM facts
  UNION ALL SELECT page_id, 2, 3, 1, 'in' FROM facts WHERE nested = 1
  UNION ALL SELECT page_id, 3, 0, 1, 'in' FROM facts WHERE nested = 1
  UNION ALL SELECT page_id, 2, 3 + nested, 9, CASE WHEN kind = 1 THEN 0 ELSE md + 1 END || '|' || day
      || '|A||||Calf problems||' || o_orderstatus FROM facts WHERE {FULL}
  UNION ALL SELECT page_id, 2, 4 + nested, 6, CASE WHEN kind = 1 THEN 0 ELSE md + 2 END || '|' || day
      || '|x|y|postponed|z' FROM facts WHERE {FULL})
SELECT * FROM listed
""".replace("STRING", "VARCHAR"))
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    cells = P.table_cells(order_pages(spark, d).select("page_id", "html"))
    return cells.select(
        "page_id", "table_no", "row_no", F.size("cells").alias("n"),
        F.array_join("cells", "|").alias("texts"),
    )


@query("table_detect", f"""
WITH {FACTS_SQL}
SELECT page_id, CASE WHEN {FULL} THEN 2 END AS table_no FROM facts
""".replace("STRING", "VARCHAR"))
def table_detect(spark: SparkSession, d: str) -> DataFrame:
    return P.match_table_numbers(order_pages(spark, d).select("page_id", "html"))


@query("row_shape_filter", f"""
WITH {FACTS_SQL}, listed AS (
  SELECT page_id, 1 AS table_no, 0 AS row_no, md AS first_cell, false AS scored FROM facts
  UNION ALL SELECT page_id, 2, 1, md, true FROM facts
  UNION ALL SELECT page_id, 2, 3 + nested, md + 1, false FROM facts WHERE {FULL}
  UNION ALL SELECT page_id, 2, 4 + nested, md + 2, false FROM facts WHERE {FULL})
SELECT listed.page_id, table_no, row_no, CAST(first_cell AS VARCHAR) AS matchday, scored
FROM listed JOIN facts USING (page_id) WHERE kind <> 1
""".replace("STRING", "VARCHAR"))
def row_shape_filter(spark: SparkSession, d: str) -> DataFrame:
    cells = F.col("cells")
    rows = P.table_cells(order_pages(spark, d).select("page_id", "html")).filter(
        C.is_candidate(cells)
    )
    return rows.select(
        "page_id", "table_no", "row_no", F.get(cells, F.lit(0)).alias("matchday"),
        C.result_index(cells).isNotNull().alias("scored"),
    )


def _scored_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = P.table_cells(order_pages(spark, d).select("page_id", "html"))
    return rows.withColumn("at", C.result_index(F.col("cells"))).filter(F.col("at").isNotNull())


@query("match_context", f"""
WITH {FACTS_SQL}
SELECT page_id, CAST(3 + CASE WHEN venue IS NULL THEN 1 ELSE 2 END AS INTEGER) AS score_at, venue,
       home AS home_team, away AS away_team, score AS result, pos AS position
FROM facts
""".replace("STRING", "VARCHAR"))
def match_context(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored_rows(spark, d)
    cells, at = F.col("cells"), F.col("at")
    staged = rows.withColumn("context", C.match_context(C.before_result(cells, at)))
    return staged.select(
        "page_id", at.alias("score_at"), "context.*",
        F.get(cells, at).alias("result"), F.get(cells, at + 1).alias("position"),
    )


@query("stat_cells", f"""
WITH {FACTS_SQL}
SELECT page_id, nullif(goals, '') AS goals, format('{{:,}}', o_custkey) AS assists,
       CAST(NULL AS VARCHAR) AS own_goals, nullif(yellow, '') AS yellow_cards,
       CAST(NULL AS VARCHAR) AS second_yellow_red_cards, nullif(red, '') AS red_cards,
       CASE WHEN venue IS NOT NULL THEN minute || '''' END AS subbed_on_minute,
       CAST(NULL AS VARCHAR) AS subbed_off_minute, rating AS performance_rating,
       minute || '''' AS minutes_played,
       CASE WHEN page_id % 6 = 0 THEN 'late sub' END AS note
FROM facts
""".replace("STRING", "VARCHAR"))
def stat_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored_rows(spark, d)
    stats = C.stat_texts(C.tail(F.col("cells"), F.col("at") + 2))
    return rows.select("page_id", stats.alias("stats")).select("page_id", "stats.*")


@query("status_rows", f"""
WITH {FACTS_SQL}
SELECT page_id, 3 + nested AS row_no, 'A' AS venue, 'Calf problems ' || o_orderstatus AS note
FROM facts WHERE {FULL}
""".replace("STRING", "VARCHAR"))
def status_rows(spark: SparkSession, d: str) -> DataFrame:
    cells = F.col("cells")
    rows = P.table_cells(order_pages(spark, d).select("page_id", "html")).filter(
        C.is_status_row(cells)
    )
    return rows.select(
        "page_id", "row_no", C.at(cells, 2).alias("venue"),
        C.joined_note(C.tail(cells, 6)).alias("note"),
    )


MATCHES_SQL = f"""
matches AS (
  SELECT page_id, 1 AS row_no, coalesce(name, 'Player ' || o_custkey) AS player_name,
    CAST(o_custkey AS VARCHAR) AS player_id, season, 'GB1' AS competition_code,
    CAST(md AS BIGINT) AS matchday, day AS match_date, venue, home AS home_team, away AS away_team,
    score AS result, pos AS position, CAST(nullif(goals, '') AS BIGINT) AS goals,
    CAST(o_custkey AS BIGINT) AS assists, CAST(NULL AS BIGINT) AS own_goals,
    CAST(CASE WHEN yellow <> '' THEN minute END AS BIGINT) AS yellow_cards,
    CAST(NULL AS BIGINT) AS second_yellow_red_cards, CAST(NULL AS BIGINT) AS red_cards,
    CAST(CASE WHEN venue IS NOT NULL THEN minute END AS BIGINT) AS subbed_on_minute,
    CAST(NULL AS BIGINT) AS subbed_off_minute, CAST(rating AS DOUBLE) AS performance_rating,
    CAST(minute AS BIGINT) AS minutes_played,
    CASE WHEN page_id % 6 = 0 THEN 'late sub' END AS note
  FROM facts WHERE {VALID}
  UNION ALL
  SELECT page_id, 3 + nested, coalesce(name, 'Player ' || o_custkey), CAST(o_custkey AS VARCHAR), season, 'GB1',
    md + 1, day, 'A', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    'Calf problems ' || o_orderstatus
  FROM facts WHERE {VALID})
"""


def read_pages(spark: SparkSession, d: str) -> DataFrame:
    return P.read_match_pages(
        order_pages(spark, d), slug_to_name(F.col("slug")), F.col("player_id"), F.col("season"),
        F.lit("GB1"),
    )


@query("page_to_rows", f"WITH {FACTS_SQL}, {MATCHES_SQL} SELECT * FROM matches".replace(
    "STRING", "VARCHAR"))
def page_to_rows(spark: SparkSession, d: str) -> DataFrame:
    return flatten_rows(read_pages(spark, d), "player_stats", ["page_id"])


@query("page_outcome", f"""
WITH {FACTS_SQL}
SELECT season, CASE WHEN kind IN (0, 4) THEN 'no_table' WHEN kind = 1 THEN 'no_rows' ELSE 'ok' END
       AS page_outcome, count(*) AS pages, CAST(sum(CASE WHEN {VALID} THEN 2 ELSE 0 END) AS BIGINT) AS rows
FROM facts GROUP BY ALL
""".replace("STRING", "VARCHAR"))
def page_outcome(spark: SparkSession, d: str) -> DataFrame:
    """A page that cannot be read is counted, it does not end the run."""
    return read_pages(spark, d).groupBy("season", "page_outcome").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.size("player_stats")).alias("rows")
    )


@query("page_snapshot", f"""
WITH {FACTS_SQL}
SELECT page_id, o_orderstatus AS team, season, season || '/' || (CAST(season AS INT) + 1) AS season_label,
       CASE WHEN {VALID} THEN coalesce(name, 'Player ' || o_custkey) ELSE 'Player ' || o_custkey END
       AS player_name, CAST(o_custkey AS VARCHAR) AS player_id,
       CASE WHEN {VALID} THEN 2 ELSE 0 END AS rows,
       CASE WHEN {VALID} THEN (md || ' ' || score || ' ' || (md + 1)) END AS matches
FROM facts
""".replace("STRING", "VARCHAR"))
def page_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """One snapshot document per page; a page without rows keeps the name of its address."""
    labels = {str(year): f"{year}/{year + 1}" for year in range(1990, 2010)}
    documents = P.player_snapshots(
        read_pages(spark, d), F.col("team"), F.col("season"), label(F.col("season"), labels),
        F.lit("club"), slug_to_name(F.col("slug")), F.col("player_id"), F.lit("now"), ["page_id"],
    )
    words = F.transform(
        "player_stats", lambda r: F.concat_ws(" ", r["matchday"].cast("string"), r["result"])
    )
    return documents.select(
        "page_id", "team", "season", "season_label", "player_name", "player_id",
        F.size("player_stats").alias("rows"),
        F.when(F.size("player_stats") > 0, F.array_join(words, " ")).alias("matches"),
    )


# --- the whole way -----------------------------------------------------------------------

NOW = dt.datetime(2026, 3, 27, 12, tzinfo=dt.timezone.utc)
SCRAPED = "2026-03-27"

LOADED_SQL = f"""
WITH {FACTS_SQL}, {MATCHES_SQL},
keyed AS (SELECT o_orderstatus AS team, m.season, m.player_id, m.matchday
          FROM matches m JOIN facts USING (page_id)),
passed AS (SELECT * FROM keyed WHERE (team, season) IN (
  SELECT (team, season) FROM keyed GROUP BY team, season HAVING count(*) >= 50))
"""


def _delivery(spark: SparkSession, d: str) -> DataFrame:
    return order_pages(spark, d).select(
        "team", "season", "player_id", "html",
        F.concat(F.lit("Club "), F.col("team")).alias("club"),
        F.lit("GB1").alias("competition_code"),
        slug_to_name(F.col("slug")).alias("player_name"),
        F.lit(SCRAPED).alias("scrape_date"),
    )


def _loaded(spark: SparkSession, d: str, now: dt.datetime = NOW, times: int = 1) -> season_load.Loaded:
    tables = season_load.Tables(workspace(spark, "load"))
    for _ in range(times):
        done = season_load.run(spark, _delivery(spark, d), tables, "site", now, SCRAPED)
    return done


@query("season_load_summary", f"""
{LOADED_SQL}
SELECT team, season, count(DISTINCT (player_id, matchday)) AS rows_in_history,
       count(DISTINCT player_id) AS distinct_players, '{SCRAPED}' AS latest_scrape_date
FROM passed GROUP BY ALL
""".replace("STRING", "VARCHAR"))
def season_load_summary(spark: SparkSession, d: str) -> DataFrame:
    """Pages, snapshots, cleaning, staging, gate, dedup, upsert, summary in one run."""
    return _loaded(spark, d).summary


OUTCOME_SQL = f"""
{LOADED_SQL}
SELECT f.team, f.season, coalesce(k.n, 0) AS rows,
       CASE WHEN k.n IS NULL THEN 'no output' WHEN k.n < 50 THEN 'too few rows' ELSE 'ok' END AS status
FROM (SELECT DISTINCT o_orderstatus AS team, season FROM facts) f
LEFT JOIN (SELECT team, season, count(*) AS n FROM keyed GROUP BY ALL) k USING (team, season)
""".replace("STRING", "VARCHAR")


@query("season_load_outcome", OUTCOME_SQL)
def season_load_outcome(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d).outcomes


@query("season_load_backfill", OUTCOME_SQL)
def season_load_backfill(spark: SparkSession, d: str) -> DataFrame:
    """A date past the retention: its staged rows go, its outcome is still that of this load."""
    return _loaded(spark, d, NOW + dt.timedelta(days=26)).outcomes


INGEST_SQL = f"""
{LOADED_SQL}, merged AS (
  SELECT team, season, count(DISTINCT (player_id, matchday)) AS n FROM passed GROUP BY ALL)
SELECT f.team, f.season, coalesce(k.n, 0) AS rows_staged, INSERTED AS rows_inserted, UPDATED AS rows_updated,
       coalesce(m.n, 0) AS rows_merged, coalesce(m.n, 0) AS rows_in_history
FROM (SELECT DISTINCT o_orderstatus AS team, season FROM facts) f
LEFT JOIN (SELECT team, season, count(*) AS n FROM keyed GROUP BY ALL) k USING (team, season)
LEFT JOIN merged m USING (team, season)
""".replace("STRING", "VARCHAR")


@query("ingest_result", INGEST_SQL.replace("INSERTED", "coalesce(m.n, 0)").replace("UPDATED", "0::BIGINT"))
def ingest_result(spark: SparkSession, d: str) -> DataFrame:
    """Rows staged, merged and in history of every slice of a load."""
    return _loaded(spark, d).ingest


@query("season_load_twice", INGEST_SQL.replace("INSERTED", "0::BIGINT").replace("UPDATED", "coalesce(m.n, 0)"))
def season_load_twice(spark: SparkSession, d: str) -> DataFrame:
    """The same delivery again: slices below the gate stay out, all others change no key."""
    return _loaded(spark, d, times=2).ingest


# --- discovery -----------------------------------------------------------------------------


def league_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = order_pages(spark, d)
    return pages.select("page_id", F.lit("GB1").alias("league_id"), "season", "html")


def roster_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page as the roster of its first club."""
    pages = order_pages(spark, d)
    return pages.select(
        "page_id", F.concat(F.lit("club_"), F.col("player_id")).alias("team"), "season",
        F.concat(F.lit("Club > "), F.col("player_id")).alias("club"), F.col("player_id").alias("club_id"), "html",
    )


SEASONS = [str(year) for year in range(2001, 1994, -1)]
LABELS = {season: f"{season}/{int(season) + 1}" for season in SEASONS}


@query("league_document", f"""
WITH {FACTS_SQL}
SELECT page_id, 'GB1' AS league_id, season, season || '/' || (CAST(season AS INT) + 1) AS season_label,
  'now' AS scraped_at, 'club_' || o_custkey || ',fc_' || page_id AS teams, 2::BIGINT AS teams_found FROM facts
""".replace("STRING", "VARCHAR"))
def league_document(spark: SparkSession, d: str) -> DataFrame:
    """One league snapshot per page, clubs in page order."""
    documents = discovery.league_documents(league_pages(spark, d), SITE, F.lit("now"), LABELS)
    return documents.withColumn("teams", F.array_join("teams.team_key", ","))


@query("roster_document", f"""
WITH {FACTS_SQL}
SELECT page_id, 'club_' || o_custkey AS team, season, season || '/' || (CAST(season AS INT) + 1) AS season_label,
  'Club > ' || o_custkey AS club, CAST(o_custkey AS VARCHAR) AS club_id, 'now' AS scraped_at,
  'Player ' || o_custkey || CASE WHEN page_id <> o_custkey THEN ',Next ' || page_id ELSE '' END AS players
FROM facts
""".replace("STRING", "VARCHAR"))
def roster_document(spark: SparkSession, d: str) -> DataFrame:
    """One roster snapshot per page, players in page order."""
    documents = discovery.roster_documents(roster_pages(spark, d), SITE, F.lit("now"), LABELS)
    return documents.withColumn("players", F.array_join("players.player_name", ","))


@query("discover_work_list", f"""
WITH {FACTS_SQL}, players AS (
  SELECT o_custkey, season, CAST(o_custkey AS VARCHAR) AS player_id, 'Player ' || o_custkey AS player_name FROM facts
  UNION SELECT o_custkey, season, CAST(page_id AS VARCHAR), 'Next ' || page_id FROM facts WHERE page_id <> o_custkey)
SELECT 'club_' || o_custkey AS team, season, player_id, min(player_name) AS player_name, 'club-' || o_custkey AS club_slug,
  'GB1' AS competition_code
FROM players GROUP BY ALL
""".replace("STRING", "VARCHAR"))
def discover_work_list(spark: SparkSession, d: str) -> DataFrame:
    """League pages to clubs, roster pages to players, both to the list of player pages to read."""
    leagues = discovery.league_documents(league_pages(spark, d), SITE, F.lit("now"), LABELS)
    rosters = discovery.roster_documents(roster_pages(spark, d), SITE, F.lit("now"), LABELS)
    work = discovery.discover(leagues, rosters, SEASONS)
    return work.select("team", "season", "player_id", "player_name", "club_slug", "competition_code")
