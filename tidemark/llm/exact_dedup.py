"""Exact deduplication: a tree of merges over sorted runs of digests, in DataFrame functions only.

1. Every row's normalised text becomes a digest. The rows that one scan task has read are a *run*:
   one entry per digest, with the identifier that stays and the number of rows.
2. Runs meet in binomial rounds. In each round a run and its siblings (the runs whose numbers differ
   in the lowest bits only) go to the task of their common parent, are sorted by digest and merged.
   Every merge keeps one identifier per digest: the winner of the winners. A run is cut into ranges
   of digests, so no task ever holds a whole run, and the last round has as many tasks as ranges.
3. Verdicts go down the same tree, for digests of two rows or more: from a parent's run to its
   children's, and from the first runs to their rows.

Entries are only merged if SHA-256 and length of the normalised text both agree. A text that a third
of all rows have is one entry per run, so neither a merge nor a join meets more than a run's share of
it. Texts never move; what moves are 32-byte digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_over, packed

#: Bits of a run's number (the scan task's, folded), and bits that one round takes off.
RUN_BITS, FAN_BITS = 9, 3
#: Hexadecimal digits of a digest that number its range.
RANGE_DIGITS = 3
ENTRY = ["range", "run", "digest", "size"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _digests(docs: DataFrame, doc_id: str, text: str, *others: str) -> DataFrame:
    """Written rows with number, run and digest. A row's number holds from here on."""
    normal = normalised(F.col(text))
    rows = docs.select(
        *others, F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().bitwiseAND((1 << RUN_BITS) - 1).alias("run"),
        F.sha2(normal, 256).alias("hex"), F.octet_length(normal).alias("size"),
    )
    rows = rows.withColumn("range", F.conv(F.substring("hex", 1, RANGE_DIGITS), 16, 10).cast("int"))
    return hand_over(rows.withColumn("digest", F.unhex("hex")).drop("hex"), "copies-digests")


def _runs(rows: DataFrame, keep: str) -> list[DataFrame]:
    """The runs of every round, from the scan's own to the merged one: an entry has ``best`` and ``n``."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    winner = F.max if keep == "largest" else F.min
    # a null id stays only if no other is there
    known = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    rank = F.struct(known.alias("known"), F.col("doc_id"), F.col("row"))
    first = rows.groupBy(*ENTRY).agg(winner(rank).alias("best"), F.count("*").alias("n"))
    rounds = [hand_over(first.sortWithinPartitions(*ENTRY), "copies-runs")]
    for _ in range(0, RUN_BITS, FAN_BITS):
        siblings = rounds[-1].withColumn("run", F.shiftright("run", FAN_BITS)).repartition("range", "run")
        merged = siblings.sortWithinPartitions(*ENTRY).groupBy(*ENTRY).agg(winner("best").alias("best"), F.sum("n").alias("n"))
        rounds.append(hand_over(merged, "copies-runs"))
    return rounds


def _verdicts(rows: DataFrame, keep: str) -> DataFrame:
    """``rows`` with ``best`` and ``n`` of their group, null where nothing equals the row."""
    *rounds, merged = _runs(rows, keep)
    verdict = merged.filter(F.col("n") > 1)
    for runs in reversed(rounds):
        parents = verdict.withColumnRenamed("run", "parent")
        children = runs.drop("best", "n").withColumn("parent", F.shiftright("run", FAN_BITS))
        verdict = children.join(parents, ["range", "parent", "digest", "size"]).drop("parent")
    return rows.join(verdict, ENTRY, "left")


def copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal if they are identical after lower-casing A-Z; a null text equals an empty one. Of
    equal texts the row with the largest (or smallest) id stays, whose id is ``keep_id``. Exactly one
    row of a group is ``kept``: of rows that share that id it is one of them, and a null id stays only
    where the group has no other. Other columns are not looked at. No rows give no rows.
    """
    rows = _digests(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")), "doc_id", "text")
    return _verdicts(rows, keep).select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these are called.

    Rules as in ``copies``. The rows are written once beside their digests, so that the row which was
    judged is the row that stays.
    """
    rows = _digests(packed(docs), "doc.doc_id", "doc.text", "doc")
    lost = _verdicts(rows.drop("doc"), keep).filter(F.col("best.row") != F.col("row")).select("row")
    return rows.join(lost, "row", "left_anti").select("doc.*")


ORACLE = f"""
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
kept AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM normal GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM normal JOIN kept USING (t)
"""
