"""Document fingerprints by Order MinHash.

A text's k-mers of code points carry their occurrence number, so repeated ones count. Each of
``SKETCHES`` random orders selects the ``TUPLE`` smallest, which are put back into text order and
hashed as a tuple. Two texts agree in a component when they share k-mers *in the same order*, so the
share of agreeing components follows edit distance, not only common content.

The edited text needs the next document's start. Documents are dealt to ranges of ids whose bounds
are ids that occur; the first document of each range goes to the range before it as well, so every
task has the neighbours it needs and texts move once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix

K, SKETCHES, TUPLE = 8, 32, 2
#: Code points whose orders are worked out at a time.
BLOCK = 1 << 14
#: Documents per range of ids, at the least.
RANGE_DOCS = 1000
MOST_RANGES = 4096

_U = np.uint64
_XOR = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_MUL = mix(np.arange(1001, 1257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def occurrences(kmers: np.ndarray) -> np.ndarray:
    """How often each k-mer was seen before its position. k-mers are told apart by the bits that are
    left beside a position (44 for a million positions)."""
    n = len(kmers)
    bits = _U(max(1, int(n).bit_length()))
    low = (_U(1) << bits) - _U(1)
    packed = np.sort((kmers & ~low) | np.arange(n, dtype=_U))
    key = packed >> bits
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    out = np.zeros(n, _U)
    if len(starts) < n:
        lengths = np.diff(np.append(starts, n))
        number = np.arange(n) - np.repeat(starts, lengths)
        out[(packed & low).astype(np.int64)] = number.astype(_U)
    return out


def fingerprint(points: np.ndarray, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """``sketches`` 32-bit components of a text given by its code points.

    A text shorter than ``k`` is one k-mer; a text with fewer k-mers than ``size`` uses all. The empty
    text has the fingerprint of zeros, as a value of its own.
    """
    n = len(points)
    if not n:
        return np.zeros(sketches, np.uint32)
    k = min(k, n)
    kmers = np.zeros(n - k + 1, _U)
    for i in range(k):
        kmers = kmers * _U(0x100000001B3) + points[i : n - k + 1 + i] + _U(1)
    kmers = mix(kmers + _U(k))
    items = mix(kmers + occurrences(kmers) * _U(0xD6E8FEB86659FD93))
    m = len(items)
    take = min(size, m)
    blocks = range(0, m, BLOCK)
    worst = _U(0xFFFFFFFFFFFFFFFF)
    value = np.full((sketches, len(blocks) * take), worst, _U)
    place = np.full((sketches, len(blocks) * take), m, np.int64)
    for b, a in enumerate(blocks):
        block = items[a : a + BLOCK]
        for j in range(sketches):
            order = (block ^ _XOR[j]) * _MUL[j]
            for c in range(b * take, b * take + min(take, len(order))):
                at = order.argmin()
                value[j, c], place[j, c] = order[at], a + at
                order[at] = worst
    if len(blocks) > 1:
        best = np.argsort(value, axis=1, kind="stable")[:, :take]
        place = np.take_along_axis(place, best, 1)
    place.sort(axis=1)
    h = np.arange(1, sketches + 1, dtype=_U)
    for c in range(take):
        h = mix(h * _U(0x9E3779B97F4A7C15) + kmers[place[:, c]])
    return (h & _U(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)


def _hex(components: np.ndarray) -> str:
    return components.astype(">u4").tobytes().hex()


def _ranges(bounds: list[int]):
    """Range of an id; for the first id of a range also the range before it, marked as a peek."""
    starts = np.array(bounds, np.int64)

    @F.pandas_udf("array<int>")
    def targets(ids: pd.Series, known: pd.Series) -> pd.Series:
        known, value = known.to_numpy(), ids.to_numpy()
        at = np.where(known, np.maximum(np.searchsorted(starts, value, "right") - 1, 0), len(starts) - 1)
        first = known & (starts[at] == value)
        return pd.Series([[int(a), int((a - 1) % len(starts))] if f else [int(a)] for a, f in zip(at, first)])

    return targets


def _range_bounds(docs: DataFrame) -> list[int]:
    """Ids at which ranges start: the smallest of each approximate range, so they occur. None: no ids.

    Quantiles are worked out in doubles, which are no ids that occur above 2**53: they only part the ids.
    """
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    rows = ids.count()
    ranges = int(min(MOST_RANGES, max(1, rows // RANGE_DOCS)))
    inner = ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    cuts = np.array(sorted({min(int(x), 2**63 - 1) for x in inner}), np.int64)

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, values.to_numpy(), "right"))

    return sorted(r.low for r in ids.groupBy(part("doc_id").alias("part")).agg(F.min("doc_id").alias("low")).collect())


_OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _sketch(batches: Iterator[pa.RecordBatch], round_: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of one task, range by range in order of id, each range followed by its peek row.

    ``round_``: there is one range without a peek row, and its first row follows its last.
    """
    state: dict = {"range": None, "first": None, "last": None, "peeked": False}
    out: list[tuple] = []

    def close(row, follower) -> None:
        doc_id, points, own = row
        n = len(points)
        head = follower[1][: n // 2]
        edited = np.concatenate([points[: n - n // 2], head])
        sketch = fingerprint(edited)
        raw = edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        out.append((
            doc_id, n, hashlib.sha256(raw).hexdigest(), _hex(own), _hex(sketch),
            float((own == sketch).mean()), float((own == follower[2]).mean()),
        ))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in _OUT.split(", ")]
        )
        out.clear()
        return made

    for rows in batches:
        for i in range(rows.num_rows):
            doc_id, text = rows.column("doc_id")[i].as_py(), rows.column("text")[i].as_py() or ""
            target, peek = rows.column("range")[i].as_py(), rows.column("peek")[i].as_py()
            if target != state["range"]:
                state.update(range=target, first=None, last=None, peeked=False)
            if state["peeked"]:
                continue  # a repeated first id of the next range
            points = _points(text)
            row = (doc_id, points, fingerprint(points))
            if state["last"] is not None:
                close(state["last"], row)
            else:
                state["first"] = row
            state["last"] = row
            state["peeked"] = peek
            if len(out) >= 500:
                yield batch()
    if round_ and state["last"] is not None:
        close(state["last"], state["first"])
    if out:
        yield batch()


def order_minhash(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of
    every row of ``docs``.

    The next document is the next by id; rows with one id follow each other by text, null ids come
    last, and the first document follows the last. A single document is followed by itself. A null
    text counts as empty; two empty texts are alike (1.0). Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _range_bounds(docs)
    no_ids = not bounds
    bounds = bounds or [0]
    dealt = docs.select("doc_id", "text", F.posexplode(_ranges(bounds)(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNotNull())).alias("pos", "range"))
    return _neighbours(dealt, len(bounds)).mapInArrow(lambda batches: _sketch(batches, no_ids), _OUT)


def _neighbours(dealt: DataFrame, ranges: int) -> DataFrame:
    order: list[Column | str] = ["range", "peek", F.col("doc_id").asc_nulls_last(), "text"]
    return (
        dealt.withColumn("peek", F.col("pos") == 1).drop("pos").repartition(ranges, "range").sortWithinPartitions(*order)
    )
