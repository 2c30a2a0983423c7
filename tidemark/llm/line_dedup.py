"""Line deduplication over the whole corpus, in DataFrame functions only.

Lines are normalised, exploded and hashed; the distinct documents of each hash are counted; lines
over the threshold go, except in the smallest document that has them; what is left of a document is
put together by position.

A document's text moves once, to meet the positions it loses. Only hashes and positions go through
the counting. A line that a third of all documents share is counted by partial aggregation, and the
join that sends the verdict back reads written tables on both sides, so that Spark can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_over, packed

BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(lines: Column) -> Column:
    """Each line without blanks at its ends and with A-Z lower-cased.

    Only of plain ASCII does ``lower`` change no other letter; it reads bytes, ``translate`` looks up every one.
    """

    def lowered(line: Column) -> Column:
        ascii_ = F.octet_length(line) == F.char_length(line)
        return F.when(ascii_, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))

    return F.transform(F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS))), lowered)


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Tells rows with one id and different texts apart."""
    return [doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.length(text).alias("text_chars")]


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = 2) -> DataFrame:
    """``doc_id, text_hash, text_chars, positions``: the lines each document loses, where it loses any."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        *_row_key(F.col("doc_id"), F.col("text")), F.posexplode(line_keys(lines_of(F.col("text")))).alias("pos", "key")
    )
    # two hashes with unlike seeds: 128 bits
    hashed = rows.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "text_hash", "text_chars", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(71), "key").alias("h2")
    )
    hashed = hand_over(hashed, "line-hashes")
    seen = hashed.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("keeper"))
    repeated = hand_over(seen.filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"), "line-repeats")
    lost = hashed.join(repeated, ["h1", "h2"]).filter(F.col("doc_id") != F.col("keeper"))
    return lost.groupBy("doc_id", "text_hash", "text_chars").agg(F.collect_set("pos").alias("positions"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = 2) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` added, one row for each given.

    A line counts as the line without blanks at its ends and with A-Z lower-cased; shorter keys than
    ``min_chars`` never go. Lines repeated inside one document only stay. Rows with one id are one
    document: their common lines all stay if that id is the smallest holder. A null id neither loses
    lines nor counts as a holder; a null text is one empty line. If all lines go, the text is empty.
    """
    key = ["doc_id", "text_hash", "text_chars"]
    own = packed(docs).select("doc", *_row_key(F.col("doc.doc_id"), F.col("doc.text")))
    marked = own.join(dropped_lines(docs, min_chars, min_docs), key, "left").withColumn("lines", lines_of(F.col("doc.text")))
    n_dropped = F.coalesce(F.size("positions"), F.lit(0))
    # positions that stay, in order; array_except keeps the order of its first array
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("positions"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    text = F.when(F.col("positions").isNull(), F.coalesce(F.col("doc.text"), F.lit(""))).otherwise(kept)
    added = {"n_lines": F.size("lines").cast("long"), "n_dropped": n_dropped.cast("long"), "kept_text": text}
    given = [F.col(f"doc.`{c}`") for c in docs.columns if c not in added]
    return marked.select(*given, *[v.alias(k) for k, v in added.items()])


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row."""
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


KEY_SQL = r"translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
WITH lines AS (
  SELECT doc_id, pos, line, {KEY_SQL} AS key FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents)),
keys AS (
  SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.keeper AS gone
  FROM lines l LEFT JOIN keys k ON l.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
