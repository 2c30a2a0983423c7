"""Spelling variants: words that differ by one code point, found by a bit-sliced position index.

1. The words of all texts are counted. Those that are long and frequent enough are the vocabulary.
2. Two words at distance one agree before the difference and after it, so they share the first half
   of the shorter one's letters, or the last half. The vocabulary is dealt out by both halves into
   groups of words of two neighbouring lengths; a group of more than ``GROUP`` words is divided by
   the halves of what its words do not share yet, until it is small. What cannot be divided any
   further differs in one or two letters, so its size is bounded by the alphabet.
3. Within a group there is a bitset over its words for every (position, letter). A word runs through
   all others at once: sets of those that agree with it so far (no error), and of those with one
   error, as a replaced letter, or with positions shifted by one for a missing or an additional one.
   Words are numbered by falling count, so the lowest bit of the result is the form.
4. Each (word, group) gives one row: how many words are near and the best of them. Never a pair.

Two words that share both halves would meet twice: a group by last halves leaves out words that share
the first half too, which is the no-error set at that position (``bar``).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hand_over, texts

#: Words are at least this long and frequent; a form is at least this many times as frequent.
MIN_CHARS, MIN_COUNT, TIMES = 6, 5, 5
#: One run of letters of this many loses a letter.
ONE_IN = 199
#: Words in one index.
GROUP = 2048
#: Distinct words that a task counts before it hands them on.
COUNTED = 100_000

_RUN = re.compile("[a-zÀ-ÿ]+")


# -- vocabulary -------------------------------------------------------------------------------


def _count(min_chars: int):
    """Rows (word, n) of the runs of letters, with the letters that some lose taken out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch, raw in texts(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                    if len(word) < min_chars:
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_chars:
                            continue
                    found[word] += n
                if len(found) > COUNTED:
                    yield _counted(found)
                    found.clear()
        yield _counted(found)

    return run


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: words of at least ``min_chars`` code points that occur ``min_count`` times or more."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    counted = rows.mapInArrow(_count(min_chars), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# -- index ------------------------------------------------------------------------------------


def near_sets(words: list[str], size: int, bar: int = 0) -> list[int]:
    """For each of the words the bitset of those at distance one.

    The words are ``size`` or ``size + 1`` long; two of the longer ones are not compared. Words that
    share their first ``bar`` letters do not count (0: all do).
    """
    index: dict[tuple[int, str], int] = {}
    lengths = {size: 0, size + 1: 0}
    for k, word in enumerate(words):
        bit = 1 << k
        lengths[len(word)] |= bit
        for slot in enumerate(word):
            index[slot] = index.get(slot, 0) | bit
    everything, at = (1 << len(words)) - 1, index.get
    out = []
    for word in words:
        none, replaced, missing, added, barred = everything, 0, 0, 0, 0
        for i, letter in enumerate(word):
            here = at((i, letter), 0)
            added = (added | none) & at((i + 1, letter), 0)
            missing = missing & at((i - 1, letter), 0) | none
            replaced = replaced & here | none & ~here
            none &= here
            if i + 1 == bar:
                barred = none
        if len(word) == size:
            near = replaced & lengths[size] | (added | none) & lengths[size + 1]
        else:
            near = missing & lengths[size]
        out.append(near & ~barred)
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, size, bar, n, word) to rows (word, n_near, form, form_n)."""
    now, group = None, []

    def done() -> tuple[list, ...]:
        out = [], [], [], []
        if len(group) > 1:
            sets = near_sets([w for w, _ in group], now[1], now[2])
            for (word, _), near in zip(group, sets):
                if near:
                    best = group[(near & -near).bit_length() - 1]
                    for column, value in zip(out, (word, near.bit_count(), *best)):
                        column.append(value)
        return out

    def rows(columns) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "form", "form_n"])

    for batch in batches:
        made: tuple[list, ...] = ([], [], [], [])
        keys, sizes, bars, counts, words = (batch.column(c).to_pylist() for c in ("key", "size", "bar", "n", "word"))
        for key, size, bar, n, word in zip(keys, sizes, bars, counts, words):
            if now is None or now[0] != key:
                for column, more in zip(made, done()):
                    column += more
                now, group = (key, size, bar), []
            group.append((word, n))
        yield rows(made)
    yield rows(done())


# -- groups -----------------------------------------------------------------------------------


def _divided(entries: DataFrame) -> DataFrame:
    """Entries of smaller groups: by the first half, and by the last half, of what is not shared."""
    half = F.floor((F.col("size") - F.col("head") - F.col("foot")) / 2).cast("int")
    front = F.struct((F.col("head") + half).alias("head"), F.col("foot").alias("foot"), F.col("bar").alias("bar"))
    bar = F.col("head") + half
    back = F.struct(
        F.col("head").alias("head"), (F.col("foot") + half).alias("foot"),
        F.when(F.col("bar") > 0, F.least(F.col("bar"), bar)).otherwise(bar).alias("bar"),
    )
    parts = entries.select("word", "n", "size", F.explode(F.array(front, back)).alias("part")).select("word", "n", "size", "part.*")
    shared = (F.expr("left(word, head)"), F.expr("right(word, foot)"))
    return parts.withColumn("key", F.concat_ws(":", "size", "head", "foot", "bar", *shared))


def groups(words: DataFrame, least: int) -> DataFrame:
    """Rows (key, size, bar, n, word, ...): every word in all its groups, none of which is large."""
    sizes = F.array(F.char_length("word"), F.char_length("word") - 1)
    start = words.select("word", "n", F.explode(sizes).alias("size")).filter(F.col("size") >= least)
    entries = start.select("*", *[F.lit(0).alias(c) for c in ("head", "foot", "bar")])
    small = None
    while True:
        entries = hand_over(_divided(entries), "spelling-groups")
        can_divide = F.col("size") - F.col("head") - F.col("foot") > 1
        large = entries.filter(can_divide).groupBy("key").agg(F.count("*").alias("words")).filter(F.col("words") > GROUP)
        large = hand_over(large.select("key"), "spelling-large")
        fit = entries.join(large, "key", "left_anti")
        small = fit if small is None else small.union(fit)
        if large.isEmpty():
            return small
        entries = entries.join(large, "key", "left_semi").drop("key")


def near_words(words: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``word, n_near, form, form_n`` for the words of ``words`` (``word, n``) that have a near word.

    ``form`` is the near word of largest ``n``, and of those the first in code-point order.
    """
    dealt = groups(words, least).select("key", "size", "bar", "n", "word")
    ordered = dealt.repartition("key").sortWithinPartitions("key", F.desc("n"), "word")
    found = ordered.mapInArrow(_compare, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", "best.form", (-F.col("best.less")).alias("form_n")
    )


def _roots(forms: DataFrame, times: int) -> DataFrame:
    """``word, root`` of the words with a form. A form is ``times`` as frequent as its word, which bounds the steps."""
    most = forms.agg(F.max("form_n")).first()[0] or 1
    steps = int(math.log(max(most, 1), times)) + 1
    roots = forms.select("word", F.col("form").alias("root"))
    for k in range(math.ceil(math.log2(steps + 1))):
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = hand_over(further, "spelling-roots")
    return roots


def spelling_variants(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = TIMES
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary of ``docs``.

    Words are runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased; one run of 199 (by a checksum of
    document id and run) loses a letter first. Near words differ by one inserted, deleted or replaced
    code point. ``form`` and ``form_n`` are null if no near word is ``times`` as frequent; ``root`` is
    where the forms end, the word itself without one. A null text has no words; a null id counts as
    an empty one in the checksum; repeated rows count again; other columns are not looked at. No rows
    give no words.
    """
    if times < 2:
        raise ValueError("times is 2 at least: else forms could lead in a circle")
    words = hand_over(vocabulary(docs, min_chars, min_count), "spelling-words")
    near = words.join(near_words(words, min_chars), "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    near = hand_over(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "spelling-near",
    )
    roots = _roots(near.filter(F.col("form").isNotNull()), times)
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
