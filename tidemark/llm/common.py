"""What several corpus operators share: reading, hand-over tables, hashing of words and shingles.

Text work that built-in expressions cannot do runs as ``mapInArrow`` over the scan. The helpers
below keep such a task's memory bounded: rows are walked in slices of a few MB of text, and word
hashing runs over blocks that end at white space, however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import workspace

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
#: Bytes per block of vectorised word hashing (each byte takes some 40 bytes of arrays).
BLOCK_BYTES = 1 << 20
#: Bits of the bitmaps that mark keys. The size is fixed, so what is broadcast is 4 MB at most.
BITMAP_BITS = 1 << 25
#: Spark's setting by which a query's shuffle files go when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``doc``, so whatever columns they have cannot clash with an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


@contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is made and run once in here go when it ends: else they stay until the
    driver happens to collect its garbage."""
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def hand_over(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Later jobs start from the written rows, so a lost executor repeats its own tasks only.
    """
    spark = df.sparkSession
    path = workspace(spark, label)
    with _released(spark):
        df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.handed_over = path
    return written


def let_go(*tables: DataFrame) -> None:
    """Delete tables of ``hand_over`` from which nothing will be read any more; other tables stay."""
    for table in tables:
        if path := vars(table).get("handed_over"):
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def texts(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8 (null: empty), a few MB at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            piece = batch.slice(a, b - a)
            raw = piece.column(column).cast(pa.binary()).to_pylist()
            yield piece, [t or b"" for t in raw]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser)."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_inverse = pow(_PRIME, -1, 1 << 64)


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:
    have = cache.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        steps = np.full(size, base, _U)
        steps[0] = 1
        have = cache[base] = np.multiply.accumulate(steps)
    return have[:n]


def _block_words(raw: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each maximal run of bytes outside ``gap``."""
    inside = ~gap
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, np.zeros(0, _U)
    n = len(raw)
    sums = np.zeros(n + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * _powers(_PRIME, n), out=sums[1:])
    h = (sums[end] - sums[start]) * _powers(_inverse, n)[start]
    return start, mix(h + (end - start).astype(_U))


def word_hashes(
    docs: list[bytes], gaps: np.ndarray = SPACE, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (n + 1 values).

    ``gaps`` marks the bytes between words; it must hold the line feed, which joins the texts.
    """
    joined = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
    ends = np.cumsum([len(d) + 1 for d in docs], dtype=np.int64)
    if lower:
        joined = _LOWER[joined]
    starts, hashes, at, n = [], [], 0, len(joined)
    while at < n:
        to = min(n, at + BLOCK_BYTES)
        if to < n:  # end at the last gap, or at the next one if a word is longer than the block
            back = np.flatnonzero(gaps[joined[at:to]])
            while not len(back):
                ahead = np.flatnonzero(gaps[joined[to : to + BLOCK_BYTES]])
                if len(ahead):
                    back = ahead[:1] + (to - at)
                to = min(n, to + BLOCK_BYTES)
            to = at + int(back[-1]) + 1
        start, h = _block_words(joined[at:to], gaps[joined[at:to]])
        starts.append(start + at)
        hashes.append(h)
        at = to
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    first = np.searchsorted(start, np.concatenate([[0], ends[:-1], [n]]))
    return (np.concatenate(hashes) if hashes else np.zeros(0, _U)), first


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    if len(words) < n:
        return np.zeros(0, _U)
    out = words[: len(words) - n + 1] + _U(n)
    for k in range(1, n):
        out = mix(out * _U(_PRIME)) + words[k : len(words) - n + 1 + k]
    return mix(out)


def bitmap_of(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap of the long keys in a column: bit ``key mod bits``. 4 MB whatever the input is."""
    slot = F.pmod(F.col(column), F.lit(bits))
    word = F.shiftright(slot, 5).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(pmod({column}, 32) as int))").alias("bit")
    with _released(df.sparkSession):
        rows = df.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits >> 5, np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bit").to_numpy().astype(np.uint32)
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the bitmap; a key that was put in is always found."""
    slot = keys.astype(_U) % _U(len(bitmap) << 5)
    return (bitmap[(slot >> _U(5)).astype(np.int64)] >> (slot & _U(31)).astype(np.uint32)) & np.uint32(1) == 1


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
