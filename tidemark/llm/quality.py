"""Quality rules: statistics of whole texts and a learned decision list over them.

Sequential covering learns when a text is *bad*: a rule is a conjunction of thresholds, grown on two
thirds of the labelled rows by information gain and pruned on the rest; rows it covers leave, and the
next rule is learned. The list is emitted as one ordered Spark conditional, so applying it is plain
column arithmetic over the statistics.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, hand_over, ngram_hashes, texts, word_hashes

#: Labelled rows to learn from, at most (those whose ids have the smallest hashes).
SAMPLE = 30_000
MOST_RULES, MOST_TERMS, CUTS = 12, 4, 64
#: A rule stays if this share of what it covers among the rows kept for pruning is bad.
LEAST_PRECISION = 0.8
#: Extra rows that a rule must cover to be worth having.
LEAST_COVER = 5

MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
_SCHEMA = "doc_id bigint, " + ", ".join(f"{s} bigint" for s in STATS)

#: What rules test: statistics by hundred words, characters or lines, and the lengths themselves.
FEATURES = {
    "words": ("n_words", None), "chars_per_100_words": ("word_chars", "n_words"),
    "symbols_per_100_words": ("n_symbols", "n_words"), "repeated_per_100_words": ("n_repeat_words", "n_words"),
    "dup_per_100_lines": ("n_dup_lines", "n_lines"), "upper_per_100_chars": ("n_upper", "word_chars"),
    "marks_per_100_words": ("n_marks", "n_words"), "words_per_100_lines": ("n_words", "n_lines"),
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _MARK = _table(b"#*$%&|<>"), _table(b"!?")
_UPPER = _table(bytes(range(65, 91)))
_BLANKS = b" \t\n\x0b\x0c\r"


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    again = 0
    for line in lines:
        if line.strip(_BLANKS):
            again += line in seen
            seen.add(line)
    return again, len(lines)


def _repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three which the text has at least twice."""
    windows = ngram_hashes(words, 3)
    if len(windows) < 2:
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in texts(batches):
        words, first = word_hashes(raw)
        rows = []
        for text, a, b in zip(raw, first.tolist(), first[1:].tolist()):
            chars = np.frombuffer(text, np.uint8)
            again, lines = _duplicate_lines(text)
            rows.append((
                b - a, np.count_nonzero(((chars & 0xC0) != 0x80) & ~SPACE[chars]), np.count_nonzero(_SYMBOL[chars]), again,
                _repeated_words(words[a:b]), lines, np.count_nonzero(_UPPER[chars]), np.count_nonzero(_MARK[chars]),
            ))
        columns = np.array(rows, np.int64).T
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in columns)], ["doc_id", *STATS])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``STATS`` of every row's whole text; a null text has one empty line and no words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, _SCHEMA)


def feature(name: str) -> Column:
    top, bottom = FEATURES[name]
    value = F.col(top).cast("double")
    if bottom is None:
        return value
    return F.when(F.col(bottom) > 0, F.lit(100.0) * value / F.col(bottom)).otherwise(F.lit(0.0))


# -- learning ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    cut: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.feature] > self.cut if self.above else rows[self.feature] <= self.cut

    def column(self) -> Column:
        return feature(self.feature) > self.cut if self.above else feature(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Term, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    return functools.reduce(operator.and_, (t.holds(rows) for t in rule))


def _best_term(rows: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Term | None:
    """The threshold with the largest information gain among the rows a rule covers so far."""
    y = bad[inside]
    if not y.any() or y.all():
        return None
    before, best, chosen = np.log2(y.mean()), 0.0, None
    for name, values in rows.items():
        v = values[inside]
        order = np.argsort(v, kind="stable")
        sorted_v, hits = v[order], np.cumsum(y[order])
        ends = np.flatnonzero(sorted_v[1:] > sorted_v[:-1])
        if not len(ends):
            continue
        ends = ends[np.unique(np.linspace(0, len(ends) - 1, min(len(ends), CUTS)).astype(int))]
        for above in (False, True):
            p = hits[-1] - hits[ends] if above else hits[ends]
            n = (len(v) - ends - 1) if above else ends + 1
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), 0.0)
            k = int(gain.argmax())
            if gain[k] > best + 1e-9:
                best, at = float(gain[k]), ends[k]
                chosen = Term(name, above, float((sorted_v[at] + sorted_v[at + 1]) / 2))
    return chosen


def grow(rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_TERMS:
        term = _best_term(rows, bad, inside)
        if term is None:
            break
        rule += (term,)
        inside &= term.holds(rows)
    return rule


def prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The rule without its last terms, as far back as is best for (bad - good) / (bad + good)."""
    best, chosen = -2.0, rule
    for length in range(1, len(rule) + 1):
        inside = covers(rule[:length], rows)
        hit, miss = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth = (hit - miss) / (hit + miss) if hit + miss else -1.0
        if worth > best:
            best, chosen = worth, rule[:length]
    return chosen


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, for_pruning: np.ndarray) -> list[Rule]:
    """Rules for bad rows, in the order they are tried."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MOST_RULES:
        growing, pruning = left & ~for_pruning, left & for_pruning
        if (growing & bad).sum() < LEAST_COVER:
            break
        rule = grow({k: v[growing] for k, v in rows.items()}, bad[growing])
        if not rule:
            break
        held = {k: v[pruning] for k, v in rows.items()}
        rule = prune(rule, held, bad[pruning])
        inside = covers(rule, rows) & left
        tried = inside & pruning
        if (inside & bad).sum() < LEAST_COVER or not tried.any() or bad[tried].mean() < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from at most ``sample`` labelled rows; only their few numbers reach the driver.

    Rows that fail the fixed limits teach nothing. Labels other than 0 and 1 are left out; of an id's
    labels the smallest counts.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.min("quality").alias("quality"))
    )
    chosen = hand_over(known.orderBy(F.xxhash64("id"), "id").limit(sample), "quality-sample")
    rows = stats.filter(~_base_failed()).join(chosen, F.col("doc_id") == F.col("id"))
    picked = rows.select("id", "quality", *[feature(f).alias(f) for f in FEATURES], (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("held"))
    table = picked.orderBy("id", *FEATURES).limit(2 * sample).toArrow()
    values = {f: table.column(f).to_numpy() for f in FEATURES}
    return learn(values, table.column("quality").to_numpy() == 0, table.column("held").to_numpy(zero_copy_only=False))


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1 on; 0 if none does."""
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(functools.reduce(operator.and_, (t.column() for t in rule)), F.lit(i))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def _base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``rule`` (the first that holds, 0: none) and ``kept``
    of every row of ``docs``. Without usable labels the list is empty and the fixed limits decide."""
    stats = hand_over(statistics(docs), "quality-stats")
    judged = stats.withColumn("base_failed", _base_failed()).withColumn("rule", verdict(fit(stats, labels)).cast("int"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
