"""Text, number and date rules over the tables' own texts and texts made from their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.plans.queries.registry import query, table

SPACE = text.SPACE_SQL
SPACES_SQL = " || ".join(f"chr({ord(char)})" for char in text.SPACES)


@query("string_clean", f"""
WITH padded AS (
  SELECT doc_id, chr(10) || ' ' || text || chr(9) || chr(160) AS t FROM documents),
cleaned AS (SELECT doc_id, trim(t, {SPACES_SQL}) AS t FROM padded)
SELECT doc_id, length(t) AS cleaned_length, md5(t) AS cleaned,
       md5(regexp_replace(t, '{SPACE}+', ' ', 'g')) AS collapsed
FROM cleaned
""")
def string_clean(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("\n "), F.col("text"), F.lit("\t "))
    return table(spark, d, "documents").select(
        "doc_id",
        F.length(text.clean_value(padded)).cast("bigint").alias("cleaned_length"),
        F.md5(text.clean_value(padded)).alias("cleaned"),
        F.md5(text.collapse_spaces(padded)).alias("collapsed"),
    )


@query("slug_functions", """
WITH n AS (
  SELECT p_partkey, p_name || ' ' || p_type || ' (' || p_size || ')' AS name,
         lower(replace(p_name, ' ', '-')) || '-' || p_brand || '-3RD' AS slug
  FROM part)
SELECT p_partkey, name,
  trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS team_key,
  replace(trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_'), '_', '-') AS team_slug,
  array_to_string(list_transform(string_split(slug, '-'),
    lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ') AS slug_name,
  'player_id=' || p_partkey || '_' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-')
    AS entity,
  'player_id=' || p_partkey AS bare_entity
FROM n
""")
def slug_functions(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" "), "p_type", F.lit(" ("), F.col("p_size"), F.lit(")"))
    slug = F.concat(
        F.lower(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))), F.lit("-"), "p_brand",
        F.lit("-3RD"),
    )
    number = F.col("p_partkey").cast("string")
    named = table(spark, d, "part").select("p_partkey", name.alias("name"), slug.alias("slug"))
    return named.select(
        "p_partkey", "name",
        text.team_key(F.col("name")).alias("team_key"),
        text.team_key_to_slug(text.team_key(F.col("name"))).alias("team_slug"),
        text.slug_to_name(F.col("slug")).alias("slug_name"),
        text.entity_key(F.col("name"), number).alias("entity"),
        text.entity_key(F.lit("(!)"), number).alias("bare_entity"),
    )


@query("entity_selector", """
SELECT p_partkey, p_name, p_type FROM part
WHERE regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') = 'redwidget'
   OR regexp_replace(lower(p_type), '[^a-z0-9]+', '', 'g') = 'redwidget'
""")
def entity_selector(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return parts.filter(text.matches_selector(F.col("p_name"), F.col("p_type"), "Red-Widget!"))


@query("split_name_rank", """
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 1 THEN c_name WHEN 2 THEN '' WHEN 3 THEN c_name || ' (b)'
    WHEN 4 THEN NULL ELSE c_name || ' (x.)' END AS team_name,
  CASE WHEN c_custkey % 6 IN (1, 2, 3) THEN CAST(c_nationkey AS BIGINT) END AS team_rank
FROM customer
""")
def split_name_rank(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("""CASE c_custkey % 6 WHEN 0 THEN concat(' ', c_name)
        WHEN 1 THEN concat(c_name, '  (', c_nationkey, '.)') WHEN 2 THEN concat('(', c_nationkey, '.)')
        WHEN 3 THEN concat(c_name, ' (b) (', c_nationkey, '.)\t') WHEN 4 THEN '  '
        ELSE concat(c_name, ' (x.)') END""")
    split = text.split_name_rank(value)
    return table(spark, d, "customer").select(
        "c_custkey", split["name"].alias("team_name"), split["rank"].alias("team_rank")
    )


@query("number_parse", """
WITH forms AS (
  SELECT *, CASE l_linenumber WHEN 1 THEN format('{:,.2f}', l_extendedprice)
    WHEN 2 THEN CAST(l_quantity AS BIGINT) || '''' WHEN 3 THEN CAST(l_discount AS VARCHAR)
    WHEN 4 THEN CASE l_suppkey % 4 WHEN 0 THEN 'inf' WHEN 1 THEN 'NaN' WHEN 2 THEN l_partkey || 'd'
      ELSE 'abc' END
    WHEN 5 THEN '' WHEN 6 THEN l_partkey || 'e2' ELSE ' +' || l_suppkey || '. ' END AS form
  FROM lineitem),
bare AS (
  SELECT *, trim(replace(form, ',', '')) AS t, trim(replace(replace(form, ',', ''), '''', '')) AS m
  FROM forms),
parsed AS (
  SELECT *,
    CASE WHEN regexp_matches(t, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$')
         THEN CAST(t AS DOUBLE) END AS f,
    CASE WHEN regexp_matches(m, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$')
         THEN CAST(m AS DOUBLE) END AS fm
  FROM bare)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, form, CAST(trunc(f) AS BIGINT) AS as_int,
       f AS as_float, lower(t) IN ('inf', 'nan') AS is_special, CAST(trunc(fm) AS BIGINT) AS as_minutes,
       CASE WHEN regexp_matches(form, '^[0-9]+''$') THEN CAST(trunc(fm) AS BIGINT)
            ELSE CAST(trunc(f) AS BIGINT) END AS as_stat,
       regexp_matches(form, '^[0-9]+''$') AS is_minutes
FROM parsed
""")
def number_parse(spark: SparkSession, d: str) -> DataFrame:
    form = F.expr("""CASE l_linenumber WHEN 1 THEN format_number(l_extendedprice, 2)
        WHEN 2 THEN concat(CAST(l_quantity AS BIGINT), "'") WHEN 3 THEN CAST(l_discount AS STRING)
        WHEN 4 THEN CASE l_suppkey % 4 WHEN 0 THEN 'inf' WHEN 1 THEN 'NaN'
          WHEN 2 THEN concat(l_partkey, 'd') ELSE 'abc' END
        WHEN 5 THEN '' WHEN 6 THEN concat(l_partkey, 'e2') ELSE concat(' +', l_suppkey, '. ') END""")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    forms = table(spark, d, "lineitem").select(*keys, form.alias("form"))
    value = F.col("form")
    parsed = forms.withColumn("number", numbers.to_float(value))
    special = F.isnan("number") | (F.abs("number") == float("inf"))
    return parsed.select(
        *keys, "form", numbers.to_int(value).alias("as_int"),
        F.when(~special, F.col("number")).alias("as_float"),
        F.coalesce(special, F.lit(False)).alias("is_special"),
        numbers.parse_minutes(value).alias("as_minutes"),
        numbers.parse_stat(value).alias("as_stat"),
        numbers.looks_like_minutes(value).alias("is_minutes"),
    )


DATE_FORMS = """CASE o_orderkey % 9 WHEN 0 THEN date_format(o_orderdate, 'MMM d, yyyy')
    WHEN 1 THEN date_format(o_orderdate, 'M/d/yy') WHEN 2 THEN date_format(o_orderdate, 'MMM dd, yy')
    WHEN 3 THEN concat('  ', date_format(o_orderdate, 'MMM d,  yyyy'), '\t')
    WHEN 4 THEN lower(date_format(o_orderdate, 'MMM d, yyyy'))
    WHEN 5 THEN concat('Feb 30, ', year(o_orderdate))
    WHEN 6 THEN concat(date_format(o_orderdate, 'M/d/'), o_orderkey % 20 + 60)
    WHEN 7 THEN date_format(o_orderdate, 'yyyy-MM-dd') ELSE '' END"""
DATES_SQL = """
WITH forms AS (
  SELECT o_orderkey, CASE o_orderkey % 9 WHEN 5 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN NULL
    WHEN 6 THEN TRY_CAST(format('{:04d}-{:02d}-{:02d}',
      CASE WHEN o_orderkey % 20 + 60 >= 69 THEN 1960 ELSE 2060 END + o_orderkey % 20,
      month(o_orderdate), day(o_orderdate)) AS DATE)
    ELSE CAST(o_orderdate AS DATE) END AS d
  FROM orders)
"""


@query("date_normalize", f"{DATES_SQL} SELECT o_orderkey, CAST(d AS VARCHAR) AS match_date_iso FROM forms")
def date_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", dates.iso_match_date(F.expr(DATE_FORMS)).alias("match_date_iso")
    )


@query("date_predicate", f"""{DATES_SQL}
SELECT o_orderkey, d IS NOT NULL AND o_orderkey % 9 <> 3 AS is_date FROM forms""")
def date_predicate(spark: SparkSession, d: str) -> DataFrame:
    """The predicate takes the text as it is: outer blanks make it no date."""
    return table(spark, d, "orders").select(
        "o_orderkey", dates.is_match_date(F.expr(DATE_FORMS)).alias("is_date")
    )
