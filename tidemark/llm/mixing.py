"""Mixing sources to target weights with hash thresholds, without a sort.

Every document has a hash of its id. A source that is to give R of its words takes the documents
below one hash value. That value is found from histograms: words by source and the leading hash
bits, the bucket in which the running total passes R, then the same inside that bucket alone, until
the hash has no more bits. Filtering by the value gives the mix; a larger budget with the same
hashes takes a superset (nested). Words beyond a source's size come from taking it twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hand_over, packed

#: The hash has 56 bits: four levels of 14, so a source's histogram has at most 16,384 rows.
LEVELS, LEVEL_BITS = 4, 14
HASH_BITS = LEVELS * LEVEL_BITS
MOST_COPIES = 2


def words(text: Column) -> Column:
    """Number of words between white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def unit_hash(doc_id: Column) -> Column:
    """56 bits of a document's MD5; a null id hashes as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int]) -> DataFrame:
    """``source, source_size, target``: words each source is to give.

    ``sizes`` has one row per source. Sources in order of code point (null last) take the weights
    in turn; together they are to give share[0]/share[1] of all words, no source more than
    ``MOST_COPIES`` times its own. Excess goes to the others by weight until none is above: with
    sources in order of size by weight, those before the first that stays below its bound are full.
    """
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    base = sizes.withColumn("w", F.get(cycle, place % len(weights)).cast("long"))
    base = base.withColumn("bound", F.col("source_size") * MOST_COPIES)
    order = [(F.col("bound") / F.col("w")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (
        base.withColumn("full", F.coalesce(F.sum("bound").over(before), F.lit(0)))
        .withColumn("w_rest", F.sum("w").over(rest))
        .withColumn("total", F.sum("source_size").over(every))
        # numerator and denominator are whole numbers, so each quotient is rounded once
        .withColumn("num", F.col("total") * share[0] - F.col("full") * share[1])
        .withColumn("den", F.col("w_rest") * share[1])
        .withColumn("is_open", F.col("num") / F.col("den") <= F.col("bound") / F.col("w"))
    )
    first = F.min(F.when(F.col("is_open"), F.struct(F.col("bound") / F.col("w"), F.col("source").isNull(), "source", "num", "den"))).over(every)
    filled = filled.withColumn("first", first)
    after = F.col("bound") / F.col("w") > F.col("first")["col1"]
    same = F.col("bound") / F.col("w") == F.col("first")["col1"]
    level = F.col("first")["num"].cast("double") / F.col("first")["den"].cast("double")
    target = F.when(F.col("first").isNotNull() & (after | same), F.least(level * F.col("w"), F.col("bound").cast("double")))
    return filled.select("source", "source_size", F.coalesce(target, F.col("bound").cast("double")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, copies, upto``: how often a source is taken whole, and the hash value up to which
    its documents are taken once more (-1: none)."""
    edge = targets.withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).select(
        F.col("source").alias("of"), "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("inside"),
    ).filter(F.col("budget") > 0)  # with nothing left over, not even a document without words is taken once more
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        at_edge = sized.join(edge, F.col("source").eqNullSafe(F.col("of"))).filter(
            F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")
        )
        histogram = at_edge.groupBy("of", "copies", "budget", "below", F.shiftright("hash", shift).alias("prefix")).agg(
            F.sum("size").alias("inside")
        )
        upto = Window.partitionBy("of").orderBy("prefix")
        running = histogram.withColumn("end", F.col("below") + F.sum("inside").over(upto))
        passed = running.filter(F.col("end") > F.col("budget"))
        edge = passed.groupBy("of").agg(
            F.min_by(F.struct("copies", "budget", "prefix", (F.col("end") - F.col("inside")).alias("below"), "inside"), "prefix").alias("e")
        ).select("of", "e.*")
    # the documents at the edge share one hash: in, if that comes nearer to the budget
    nearer = F.col("below") + F.col("inside") - F.col("budget") < F.col("budget") - F.col("below")
    edge = edge.select("of", F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("upto"))
    whole = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("copies"),
    )
    return whole.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _sized(docs: DataFrame) -> DataFrame:
    return hand_over(
        docs.select("doc_id", "source", words(F.col("text")).alias("size"), unit_hash(F.col("doc_id")).alias("hash")),
        "mix-sizes",
    )


def _limits(sized: DataFrame, weights: Sequence[int], share: tuple[int, int]) -> DataFrame:
    """One written row per source, small enough for Spark to send to all tasks unless sources are many."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = hand_over(source_targets(sizes, weights, share), "mix-targets")
    limits = thresholds(sized, targets).withColumnsRenamed({"source": "of", "copies": "whole"})
    return hand_over(limits, "mix-thresholds")


def _copies(hash_: Column) -> Column:
    once_more = hash_ <= F.coalesce(F.col("upto"), F.lit(-1))
    return (F.col("whole") + F.when(once_more, 1).otherwise(0)).cast("long")


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2)
) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` of every row of ``docs``.

    ``copies`` says how often the mix takes the row (0, 1 or 2), ``taken`` the words this gives.
    Rows with one id stand or fall together; a null source is a source of its own, a null text has
    size 0, a null id is an id. Documents are taken whole, so a source misses its target by less
    than its document at the threshold has words. Only ids, sources and sizes are shuffled.
    """
    sized = _sized(docs)
    joined = sized.join(_limits(sized, weights, share), F.col("source").eqNullSafe(F.col("of")))
    joined = joined.withColumn("copies", _copies(F.col("hash")))
    return joined.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2)
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it."""
    limits = _limits(_sized(docs), weights, share).select("of", "whole", "upto")
    joined = packed(docs).join(limits, F.col("doc.source").eqNullSafe(F.col("of")))
    taken = joined.withColumn("copies", _copies(unit_hash(F.col("doc.doc_id")))).filter(F.col("copies") > 0)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substring(md5(coalesce(doc_id::VARCHAR, '')), 1, 14))::BIGINT AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT]::BIGINT AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS bound, (2 * source_size)::DOUBLE / w AS ratio,
    coalesce(sum(2 * source_size) OVER (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS filled,
    (sum(w) OVER (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w_rest,
    (sum(source_size) OVER ())::BIGINT AS total
  FROM sources),
opened AS (
  SELECT *, 3 * total - 2 * filled AS num, 2 * w_rest AS den FROM filled),
pick AS (
  SELECT ratio, num, den FROM opened WHERE num::DOUBLE / den::DOUBLE <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
targets AS (
  SELECT o.source, o.source_size,
    CASE WHEN o.ratio >= p.ratio THEN least(p.num::DOUBLE / p.den::DOUBLE * o.w, o.bound::DOUBLE)
      ELSE o.bound::DOUBLE END AS target
  FROM opened o LEFT JOIN pick p ON true),
ranked AS (
  SELECT s.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS whole,
    (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash))::BIGINT AS upto,
    (sum(s.size) OVER (PARTITION BY s.source, s.hash))::BIGINT AS inside
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
edges AS (
  SELECT *, target - whole * source_size AS budget FROM ranked)
SELECT doc_id, size, source_size, target,
  (whole + CASE WHEN upto <= budget THEN 1
    WHEN upto - inside <= budget AND upto - budget < budget - (upto - inside) THEN 1 ELSE 0 END) * size AS taken
FROM edges
"""
