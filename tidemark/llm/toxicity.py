"""Toxicity scores from FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and skip-grams (one word between), each counted once per
text. Training walks a bounded sample of labelled texts in a fixed order with a learning rate per
coordinate; L1 keeps all but a few thousand weights at zero, and only those are sent to the tasks
that score. Scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import hand_over, mix, texts, word_hashes

BITS = 20
#: Labelled texts to learn from, at most (the smallest hashes of their ids).
SAMPLE = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 10.0, 0.0
CUT = 0.3

_U = np.uint64
#: Bytes between words: all ASCII that is no letter or digit.
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distinct feature slots of a text, given its word hashes."""
    shift = _U(64 - bits)
    one = [mix(words + _U(1))]
    if len(words) > 1:
        one.append(mix(mix(words[:-1]) + words[1:] * _U(3)))
    if len(words) > 2:
        one.append(mix(mix(words[:-2]) + words[2:] * _U(5)))
    return np.unique((np.concatenate(one) >> shift).astype(np.int64))


def train(rows: Iterator[tuple[np.ndarray, int]], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass of FTRL-proximal per ``EPOCHS`` over rows of (slots, label); gives the slots with a
    weight, the weights, and the bias (which is learned without L1)."""
    rows = list(rows)
    size = (1 << bits) + 1  # the last slot is the bias
    z, n = np.zeros(size), np.zeros(size)
    l1 = np.full(size, L1)
    l1[-1] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for slots, label in rows:
            at = np.append(slots, size - 1)
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0)))
            g = p - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(size))
    held = np.flatnonzero(every[:-1])
    return held, every[held], float(every[-1])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (place, toxic, slots) of one task, to rows of (slot, weight); slot -1 is the bias."""
    rows = []
    for batch in batches:
        for place, label, slots in zip(*(batch.column(c).to_pylist() for c in ("place", "toxic", "slots"))):
            rows.append((place, np.frombuffer(slots, np.int32).astype(np.int64), label))
    rows.sort(key=lambda r: r[0])
    slots, weights, bias = train((r[1], r[2]) for r in rows) if rows else (np.zeros(0), np.zeros(0), 0.0)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *slots.astype(int).tolist()], pa.int64()), pa.array([bias, *weights.tolist()], pa.float64())],
        ["slot", "weight"],
    )


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in texts(batches):
        words, first = word_hashes(raw, _GAPS, lower=True)
        made = [features(words[a:b]).astype(np.int32).tobytes() for a, b in zip(first, first[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("toxic"), pa.array(made, pa.binary())], ["place", "toxic", "slots"]
        )


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights learned from at most ``sample`` labelled rows that are not held out.

    The sample is bounded, so one task can learn from it; which rows are in it depends on their ids
    only. Labels that are null or neither 0 nor 1 are left out; of an id's labels the largest counts.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = known.withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(sample)
    joined = docs.select(F.col("doc_id").alias("id"), "text").join(hand_over(chosen, "toxic-sample"), "id")
    # rows that repeat an id with another text: the smallest text
    place = F.struct("place", F.xxhash64("text")).alias("p")
    rows = joined.select("toxic", "text", place).select(F.col("p.place").alias("place"), "toxic", "text")
    slots = rows.mapInArrow(_slots, "place bigint, toxic int, slots binary")
    slots = slots.groupBy("place", "toxic").agg(F.min("slots").alias("slots"))
    model = hand_over(slots, "toxic-features").coalesce(1).mapInArrow(_fit, "slot bigint, weight double").toArrow()
    slot, weight = model.column("slot").to_numpy(), model.column("weight").to_numpy()
    return slot[slot >= 0], weight[slot >= 0], float(weight[slot < 0].sum())


def scorer(spark: SparkSession, model: tuple[np.ndarray, np.ndarray, float]) -> Callable[[Column], Column]:
    """A function of a text column to its score, 0 to 1; a null text scores as an empty one.

    What is sent to the tasks is the list of weights that are not zero.
    """
    slots, weights, bias = model
    held = spark.sparkContext.broadcast((slots.astype(np.int32), weights.astype(np.float64), bias))

    @F.pandas_udf("double")
    def toxicity(column: pd.Series) -> pd.Series:
        used, value, start = held.value
        dense = np.zeros(1 << BITS)
        dense[used] = value
        sums = []
        for _, raw in texts([pa.RecordBatch.from_arrays([pa.array(column, pa.string())], ["text"])]):
            words, first = word_hashes(raw, _GAPS, lower=True)
            sums += [dense[features(words[a:b])].sum() for a, b in zip(first, first[1:])]
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(start + np.array(sums), -35.0, 35.0))))

    return lambda text: toxicity(F.coalesce(text, F.lit("")))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; a null id is not held out.

    Without usable labels every score is one half. Other columns are not looked at.
    """
    score = scorer(docs.sparkSession, fit(docs, labels))
    scored = docs.select("doc_id", score(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
