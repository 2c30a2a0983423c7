"""Language-model scores by stupid backoff, worked out relationally.

Counts of words and word pairs come from all documents, and a document is scored with its own
occurrences taken off them: what it alone has does not speak for it. A pair that other documents have
scores its count over its first word's count; any other pair scores ``BACKOFF`` times its second
word's share of all words, and a word that no other document has ``BACKOFF`` squared times that of one
word. A document's score is the sum of the logarithms.

1. Each task counts the n-grams of its texts, and marks those that several of them have. Spark adds the
   counts up by hash. N-grams of a single text leave the table: without that text's own they are not
   there. The rows are dealt by their place in the bitmap of step 2, so that it is made of few rows.
2. The most frequent n-grams, a fixed number of them, are sent to all tasks: a task settles their
   occurrences where they are, and takes for the others that the pair is not found. A bitmap of the
   table, of fixed size, tells most n-grams that are not in it, for which this is the end.
3. The other occurrences become rows (document, n-gram, times, what finding it adds), are joined with the
   rest of the table by hash, and are summed per document. Where a word is neither among the frequent ones
   nor ruled out by the bitmap, it is a row of its own in the same join, and its pair is valued after it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bitmap_of, hand_over, in_bitmap, mix, signed, texts, word_hashes

BACKOFF = 0.4
#: Words and pairs that are sent to all tasks, at most, 16 bytes each; bits of the bitmap of n-grams.
FREQUENT, GRAM_BITS = 1 << 20, 1 << 26
#: N-grams that a task adds up before it sends counts on; the quarter with the largest counts stays.
HELD = 1_500_000

_U = np.uint64
_PRIME = _U(0x9E3779B97F4A7C15)
#: Words and pairs share the tables; a pair's hash is odd, a word's even.
_ONE = _U(1)
#: Stand for the start of a text, and for any word.
_START, _ANY = mix(np.array([1, 2], np.uint64)) & ~_ONE


def words_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words, first = word_hashes(raw, lower=True)
    return words & ~_ONE, first


def before_of(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each word; the start mark before a text's first."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    starts = first[:-1][np.diff(first) > 0]
    before[starts] = _START
    return before


def pairs_of(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(before + _U(2)) + words) | _ONE


def _own(owner: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the n-grams of each text: a place of each, how often the text has it, and that by occurrence."""
    code = mix(grams + owner.astype(_U) * _PRIME)
    _, first, which, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    return first, n, n[which]


def _counted(owner: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram once, and twice its number, plus 1 if several texts have it."""
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    end = np.append(start[1:], len(grams))
    return grams[start], 2 * (end - start) + (owner[start] != owner[end - 1])


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of different texts in one: what is there more than once, several texts have."""
    grams, marked = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(grams, kind="stable")
    grams, marked = grams[order], marked[order]
    start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    met = np.diff(np.append(start, len(grams))) > 1
    return grams[start], 2 * np.add.reduceat(marked >> 1, start) + (met | (marked[start] & 1 == 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, marked): no two rows of an n-gram count the same text."""
    held = np.zeros(0, _U), np.zeros(0, np.int64)

    def rows(grams: np.ndarray, marked: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signed(grams)), pa.array(marked)], ["gram", "marked"])

    for _, raw in texts(batches):
        words, first = words_of(raw)
        if not len(words):
            continue
        owner = np.repeat(np.arange(len(raw)), np.diff(first))
        filled = int((np.diff(first) > 0).sum())
        marks = np.array([_START, _ANY], _U), np.array([2 * filled + (filled > 1), 2 * len(words) + 1])
        held = _summed([held, _counted(owner, pairs_of(before_of(words, first), words)), _counted(owner, words), marks])
        if len(held[0]) > HELD:
            grams, marked = held
            stays = marked > np.partition(marked, len(marked) - HELD // 4)[len(marked) - HELD // 4]
            yield rows(grams[~stays], marked[~stays])
            held = grams[stays], marked[stays]
    if len(held[0]):
        yield rows(*held)


def _look(keys: np.ndarray, logs: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(grams), bool), np.zeros(len(grams))
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    return keys[at] == grams, logs[at].astype(np.float64)


_ROWS = "row bigint, place bigint, gram bigint, own bigint, adds double, known bigint, others bigint"
#: What a row is: ``place`` is four times the pair's number within its text, plus one of the first four,
#: or one of the last two.
_PAIR, _SECOND, _FIRST, _MET = 0, 1, 2, 3
_TEXT, _ASK = -4, -3


def _score(packed):
    """Rows for the texts, and for the n-grams that are to be looked up.

    - ``_TEXT``: in ``adds`` what is settled, in ``known`` the document's id, in ``others`` its words.
    - ``_ASK``: a pair that adds, for each of ``own`` times if it is found, ``adds`` beside the logarithm of its count.
    - ``_PAIR``: a pair of which nothing is settled. ``adds`` and ``known`` are the counts of its first and
      second word, null where they are to be looked up; ``others`` are the words of all other texts.
    - ``_SECOND``, ``_FIRST``: those look-ups, with ``own`` times in the text itself.
    - ``_MET``: nothing to look up; the others have the pair, a frequent one, minus ``own`` times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_keys, pair_counts, word_keys, word_counts, bitmap, total = packed.value
        for batch, raw in texts(batches):
            words, first = words_of(raw)
            sizes = np.diff(first)
            owner = np.repeat(np.arange(len(raw)), sizes)
            before = before_of(words, first)
            all_pairs = pairs_of(before, words)
            own_word = _own(owner, words)[2]
            own_before = np.ones(len(words), np.int64)
            own_before[1:] = own_word[:-1]
            own_before[first[:-1][sizes > 0]] = 1  # the start mark
            at, own, _ = _own(owner, all_pairs)
            pairs, owner_, before, words = all_pairs[at], owner[at], before[at], words[at]
            own_before, own_word = own_before[at], own_word[at]
            others = total - sizes[owner_]
            known, n_pair = _look(pair_keys, pair_counts, pairs)
            has_first, n_first = _look(word_keys, word_counts, before)
            has_second, n_second = _look(word_keys, word_counts, words)
            n_pair, n_first, n_second = (np.where(has, n - of_text, 0) for has, n, of_text in (
                (known, n_pair, own), (has_first, n_first, own_before), (has_second, n_second, own_word)))
            seek_first = ~has_first & in_bitmap(bitmap, before)
            seek_second = ~has_second & in_bitmap(bitmap, words)
            # a pair is in the table only if both words are
            seek_pair = ~known & (has_first | seek_first) & (has_second | seek_second) & in_bitmap(bitmap, pairs)
            seek_first &= known | seek_pair
            ready = ~(seek_first | seek_second)
            with np.errstate(divide="ignore", invalid="ignore"):
                missed = np.where(
                    n_second > 0, np.log(BACKOFF) + np.log(n_second) - np.log(others), 2 * np.log(BACKOFF) - np.log(others + 1)
                )
                value = np.where(n_pair > 0, np.log(n_pair) - np.log(n_first), missed)
                adds = -np.log(n_first) - missed
            settled = np.bincount(owner_[ready], (value * own)[ready], len(raw))
            ask = np.flatnonzero(ready & seek_pair & (n_first > 0))
            late = np.flatnonzero(~ready)
            second, first_ = late[seek_second[late]], late[seek_first[late]]
            lines = np.arange(len(raw))
            ids = batch.column("row").to_numpy().astype(np.int64)
            long, real = pa.int64(), pa.float64()

            def filled(*parts):
                return np.concatenate(parts)

            def some(kind, here, n, mask=None):
                return pa.concat_arrays([pa.array(here, kind, mask=mask), pa.nulls(n, kind)])

            met = late[n_pair[late] > 0]
            looked = len(second) + len(first_) + len(met)
            # what is to meet nothing has its place, spread, for an n-gram, so frequent pairs do not gather
            free = mix(ids.view(_U))
            sought = np.where(known, mix(pairs + free[owner_]), pairs)
            columns = {
                "row": pa.array(ids[filled(lines, owner_[ask], owner_[late], owner_[second], owner_[first_], owner_[met])]),
                "place": pa.array(filled(
                    np.full(len(raw), _TEXT), np.full(len(ask), _ASK),
                    4 * late + _PAIR, 4 * second + _SECOND, 4 * first_ + _FIRST, 4 * met + _MET)),
                "gram": pa.array(signed(filled(free, pairs[ask], sought[late], words[second], before[first_], sought[met]))),
                "own": pa.array(filled(
                    np.zeros(len(raw), np.int64), own[ask], own[late], own_word[second], own_before[first_],
                    -n_pair[met].astype(np.int64))),
                "adds": some(real, filled(settled, adds[ask], n_first[late]), looked,
                             filled(np.zeros(len(raw) + len(ask), bool), seek_first[late])),
                "known": pa.concat_arrays([
                    batch.column("doc_id"), pa.nulls(len(ask), long),
                    some(long, n_second[late].astype(np.int64), looked, seek_second[late])]),
                "others": pa.concat_arrays([
                    pa.array(sizes, long), pa.nulls(len(ask), long), some(long, others[late], looked)]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _frequent(table: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """The n-grams above the least count that leaves no more than ``FREQUENT``, their counts, and the rest.

    The count comes from a histogram, so nothing is sorted and no task sees the table.
    """
    level = F.when(F.col("n") < 1000, F.col("n")).otherwise(1000 + F.floor(F.log("n") * 50)).cast("long")
    cut, held = 1 << 40, 0
    for row in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        held += row["count"]
        if held > FREQUENT:
            break
        cut = row["level"]
    rows = table.filter(level >= cut).toArrow()
    keys, counts = rows.column("gram").to_numpy().view(_U), rows.column("n").to_numpy().astype(float)
    order = np.argsort(keys)
    return keys[order], counts[order], table.filter(level < cut)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``gram, n`` of the words and pairs that several texts have, and of the mark of any word."""
    counted = docs.select("text").mapInArrow(_count, "gram bigint, marked bigint")
    # as ``bitmap_of`` has it: all n-grams of one of its words lie in one task, and so in one file
    slot = F.shiftright(F.pmod(F.col("gram"), F.lit(GRAM_BITS)), 5)
    several = (F.count("*") > 1) | (F.max(F.col("marked").bitwiseAND(F.lit(1))) == 1)
    counts = counted.repartition(slot).groupBy(slot.alias("slot"), "gram").agg(
        F.sum(F.shiftright("marked", 1)).alias("n"), several.alias("several")
    )
    return counts.filter("several").select("gram", "n")


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, score, mean_score`` of every row of ``docs``.

    Words are lower-cased (A-Z) runs between white space; a text's first word follows a start mark. A
    text without words has score 0 and no mean. Repeated rows are documents of their own: each is scored
    with the others' counts. Other columns are not looked at. Rows are known by their place in the scan,
    so ``docs`` is to come from files: hand over what comes out of a shuffle first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    spark = docs.sparkSession
    counts = hand_over(gram_counts(docs), "lm-counts")
    is_any, is_pair = F.col("gram") == F.lit(int(_ANY.astype(np.int64))), F.col("gram").bitwiseAND(F.lit(1)) == 1
    total = counts.filter(is_any).first()
    *pairs, rare_pairs = _frequent(counts.filter(is_pair))
    *words, rare_words = _frequent(counts.filter(~is_pair & ~is_any))
    tables = (*pairs, *words, bitmap_of(counts, "gram", GRAM_BITS), total["n"] if total else 0)
    scored = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_score(spark.sparkContext.broadcast(tables)), _ROWS)

    met = scored.join(rare_pairs.union(rare_words), "gram", "left")
    left = F.coalesce("n", F.lit(0)) - F.col("own")
    place, kind = F.col("place"), F.when(F.col("place") >= 0, F.col("place").bitwiseAND(F.lit(3)))
    is_text, pair = place == _TEXT, kind == _PAIR
    part = F.when(is_text, F.col("adds")).when((place == _ASK) & (left > 0), F.col("own") * (F.log(left) + F.col("adds")))
    valued = met.groupBy("row", F.shiftright("place", 2).alias("pair")).agg(
        F.sum(part).alias("part"),
        F.max(F.when(is_text, F.col("known"))).alias("doc_id"),
        F.max(F.when(is_text, F.col("others"))).alias("n_words"),
        F.max(F.when(pair, F.col("own"))).alias("own"),
        F.max(F.when(pair | (kind == _MET), left)).alias("n_pair"),
        F.max(F.when(pair, F.col("adds")).when(kind == _FIRST, left.cast("double"))).alias("n_first"),
        F.max(F.when(pair, F.col("known")).when(kind == _SECOND, left)).alias("n_second"),
        F.max(F.when(pair, F.col("others"))).alias("others"),
    )
    step, n_pair, n_second = float(np.log(BACKOFF)), F.col("n_pair"), F.col("n_second")
    missed = F.when(n_second > 0, F.lit(step) + F.log(n_second) - F.log("others")).otherwise(
        F.lit(2 * step) - F.log(F.col("others") + 1))
    value = F.when(n_pair > 0, F.log(n_pair) - F.log("n_first")).otherwise(missed) * F.col("own")
    done = valued.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("pair") < 0, F.col("part")).otherwise(value)).alias("score"),
    )
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return done.select("doc_id", "n_words", "score", mean.alias("mean_score"))


def score_report(docs: DataFrame) -> DataFrame:
    """``lm_scores`` rounded, so that the order in which parts are summed does not show."""
    done = lm_scores(docs)
    return done.withColumns({"score": F.round("score", 4), "mean_score": F.round("mean_score", 6)})


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, unnest(w) AS b, unnest(list_prepend(' ', w[1:len(w) - 1])) AS a FROM words WHERE len(w) > 0),
own AS (SELECT doc_id, a, b, count(*) AS n FROM places GROUP BY ALL),
own_word AS (
  SELECT doc_id, b AS w, count(*) AS n FROM places GROUP BY ALL
  UNION ALL SELECT DISTINCT doc_id, ' ', 1 FROM places),
pair AS (SELECT a, b, sum(n) AS n FROM own GROUP BY ALL),
word AS (SELECT w, sum(n) AS n FROM own_word GROUP BY ALL),
total AS (SELECT count(*) AS n FROM places),
scored AS (
  SELECT o.doc_id, o.n * CASE
    WHEN p.n > o.n THEN ln((p.n - o.n)::DOUBLE / (f.n - g.n))
    WHEN x.n > y.n THEN ln(0.4) + ln((x.n - y.n)::DOUBLE / (total.n - len(d.w)))
    ELSE 2 * ln(0.4) - ln((total.n - len(d.w) + 1)::DOUBLE) END AS s
  FROM own o JOIN pair p ON p.a = o.a AND p.b = o.b JOIN word f ON f.w = o.a JOIN word x ON x.w = o.b
  JOIN own_word g ON g.doc_id = o.doc_id AND g.w = o.a JOIN own_word y ON y.doc_id = o.doc_id AND y.w = o.b
  JOIN words d ON d.doc_id = o.doc_id CROSS JOIN total)
SELECT d.doc_id, len(any_value(d.w))::BIGINT AS n_words, round(coalesce(sum(s.s), 0), 4) AS score,
  round(sum(s.s) / len(any_value(d.w)), 6) AS mean_score
FROM words d LEFT JOIN scored s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
