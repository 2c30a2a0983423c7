"""Phrases that stand out, from suffix trees that are built group by group.

The tree of all suffixes, cut off at ``DEPTH`` words, would give the count of every phrase, but fits
no task. So it is divided from the top:

1. Words are counted, and pairs of frequent words by their hashes. No phrase with a rarer word or pair
   can be frequent, so a suffix ends where one would come, and one without a frequent pair is left out.
   (Frequent pairs are marked in a bitmap of fixed size: a pair that shares a bit only lets a few more
   suffixes through.)
2. Pairs are the prefixes that are grouped: each group has suffixes for one memory budget. A prefix
   over the budget is extended to the full depth: its suffixes are spread over all groups.
3. Each group's suffixes are sorted, and its subtree is read off them: a node's count is the total of
   the leaves below it. Nodes above the place where a prefix was extended get a total from every group
   that has a part of them, which are added up.
4. Frequent nodes are the candidates; joins with the nodes of their parts give the score of every cut,
   and joins with longer candidates tell which ones only stand for a longer one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bitmap_of, hand_over, in_bitmap, mix, signed, texts

#: Words of a phrase at most, and how often a candidate is there at least.
DEPTH, LEAST = 4, 30
#: Rows of the report for each language.
TOP = 2000
#: Shares of a language that are ranked before the language is.
SHARES = 32
#: A longer candidate stands for its parts from this percentage of their count.
STANDS_FOR = 80
#: Suffixes in a group. Of all prefixes, fewer than 2**SPREAD_BITS can be over the budget.
BUDGET, SPREAD_BITS = 1 << 18, 14
#: Pairs that a task adds up before it hands them on, and words that it counts or remembers.
PAIRS, WORDS = 1 << 21, 200_000

_U = np.uint64
_PRIME = _U(0x9E3779B97F4A7C15)
#: Piece marks become a byte that no UTF-8 text has.
_BREAK = b"\xff"
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


def tokens(docs: list[bytes]) -> list[bytes]:
    """Lower-case words of the texts, with a break between pieces and texts."""
    joined = b"\n".join(docs).lower().translate(_PIECES).replace(b"\n", b" \xff ")
    return joined.split()


def _by_language(batch: pa.RecordBatch, raw: list[bytes]) -> dict[str, list[bytes]]:
    out = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(), raw):
        out[lang].append(text)
    return out


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode("utf-8", "replace")))


# -- words ------------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word, hash, n)."""
    found: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        flat = [(lang, w.decode("utf-8", "replace"), _word_hash(lang, w), n) for lang, own in found.items() for w, n in own.items() if w != _BREAK]
        columns = list(zip(*flat)) or [[], [], [], []]
        hashes = signed(np.array(columns[2], _U))
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(hashes, pa.int64()), pa.array(columns[3], pa.int64())],
            ["lang", "word", "hash", "n"],
        )

    for batch, raw in texts(batches):
        for lang, docs in _by_language(batch, raw).items():
            found[lang].update(tokens(docs))
        if sum(map(len, found.values())) > WORDS:
            yield rows()
    yield rows()


class _Numbers:
    """Words of a task as small numbers, with hash and whether they may be frequent. 0 is the break."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent
        self.of: dict[str, dict[bytes, int]] = {}
        self.hashes: dict[str, np.ndarray] = {}
        self.known: dict[str, np.ndarray] = {}

    def __call__(self, lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words; hashes and marks by number."""
        own = self.of.get(lang)
        if own is None or len(own) > WORDS:
            own = self.of[lang] = defaultdict(count().__next__)
            own[_BREAK]
            self.hashes[lang], self.known[lang] = np.zeros(1, _U), np.zeros(1, bool)
        numbers = np.fromiter(map(own.__getitem__, words), np.int64, len(words))
        have = len(self.hashes[lang])
        if len(own) > have:
            new = np.array([_word_hash(lang, w) for w in list(own)[have:]], _U)
            self.hashes[lang] = np.concatenate([self.hashes[lang], new])
            self.known[lang] = np.concatenate([self.known[lang], in_bitmap(self.frequent, new)])
        return numbers, self.hashes[lang], self.known[lang]


def _pairs(numbers: np.ndarray, hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of words that may be frequent, and the pairs' hashes."""
    ok = known[numbers]
    at = np.flatnonzero(ok[:-1] & ok[1:])
    return at, mix(hashes[numbers[at]] * _PRIME + hashes[numbers[at + 1]])


def _count_pairs(frequent):
    """Rows (pair, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, many = _Numbers(frequent.value), [], 0

        def rows() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held) if held else np.zeros(0, _U), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(signed(pair)), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch, raw in texts(batches):
            for lang, docs in _by_language(batch, raw).items():
                held.append(_pairs(*number(lang, tokens(docs)))[1])
                many += len(held[-1])
            if many > PAIRS:
                yield rows()
                held, many = [], 0
        yield rows()

    return run


# -- suffixes ---------------------------------------------------------------------------------


def _suffixes(words: list[bytes], numbers: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct suffixes that start with the pairs at ``at``, each word followed by a space; how many; a place of each."""
    follows = np.zeros(len(numbers) + DEPTH, bool)
    follows[at] = True
    length, more = np.full(len(at), 2), np.ones(len(at), bool)
    for k in range(1, DEPTH - 1):
        more &= follows[at + k]
        length += more
    # the words of a suffix as one number, two words at a time
    padded = np.concatenate([numbers, np.zeros(DEPTH, np.int64)])
    width = int(numbers.max(initial=0)) + 1
    code = np.zeros(len(at), np.int64)
    for k in range(0, DEPTH, 2):
        a, b = (np.where(length > k + j, padded[at + k + j], 0) for j in (0, 1))
        pair = np.unique(a * width + b, return_inverse=True)[1]
        code = code * (int(pair.max(initial=0)) + 1) + pair
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    place = at[first]
    keys = [b" ".join(words[i : i + size]) + b" " for i, size in zip(place.tolist(), length[first].tolist())]
    return keys, n, first


def _emit_suffixes(frequent, marked, over, n_groups: int):
    """Rows (part, spread, lang, key, n): the suffixes, with the group that they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, large = _Numbers(frequent.value), over.value
        for batch, raw in texts(batches):
            for lang, docs in _by_language(batch, raw).items():
                words = tokens(docs)
                numbers, hashes, known = number(lang, words)
                at, pair = _pairs(numbers, hashes, known)
                may = in_bitmap(marked.value, pair)
                at, pair = at[may], pair[may]
                if not len(at):
                    continue
                keys, n, first = _suffixes(words, numbers, at)
                pair = pair[first]
                spread = np.isin(pair, large)
                part = pair.copy()
                part[spread] = [xxhash.xxh64_intdigest(keys[i], int(pair[i] & _U(0xFFFF))) for i in np.flatnonzero(spread).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((part % _U(n_groups)).astype(np.int64)), pa.array(spread),
                        pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64)),
                    ],
                    ["part", "spread", "lang", "key", "n"],
                )

    return run


def _subtrees(least: int):
    """Sorted rows (spread, lang, key, n) to rows (lang, phrase, words, n), one for each frequent node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_nodes: dict[int, tuple] = {}  # by depth: (spread, lang, phrase), total so far
        found: list[tuple] = []

        def close(depth: int, node: tuple, total: int) -> None:
            if total >= least or node[0] and depth < DEPTH:
                found.append((node[1], node[2], depth, total))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*found)) or [[], [], [], []]
            found.clear()
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "phrase", "words", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            split = pc.split_pattern(batch.column("key"), " ")
            starts = split.offsets.to_numpy().astype(np.int64)
            words = split.flatten()
            codes = words.dictionary_encode().indices.to_numpy()
            starts -= starts[0]
            length = np.diff(starts) - 1  # behind the last space there is nothing
            spread = batch.column("spread").to_numpy(zero_copy_only=False)
            lang = batch.column("lang").dictionary_encode().indices.to_numpy()
            n = batch.column("n").to_numpy()
            new = np.ones(batch.num_rows, bool)
            new[1:] = (spread[1:] != spread[:-1]) | (lang[1:] != lang[:-1])
            for depth in range(1, DEPTH + 1):
                has = length >= depth
                word = np.where(has, codes[np.minimum(starts[:-1] + depth - 1, len(codes) - 1)], -1)
                new[1:] |= word[1:] != word[:-1]
                if depth == 1:
                    continue
                first = np.flatnonzero(new)
                total = np.add.reduceat(n, first)
                keep = has[first] & ((total >= least) | spread[first] & (depth < DEPTH))
                keep[[0, -1]] = has[first[[0, -1]]]  # may go on in the batch before or behind

                def node(k: int) -> tuple:
                    i = int(first[k])
                    phrase = " ".join(words[starts[i] + j].as_py() for j in range(depth))
                    return bool(spread[i]), batch.column("lang")[i].as_py(), phrase

                if not keep[0] and depth in open_nodes:
                    close(depth, *open_nodes.pop(depth))
                for k in np.flatnonzero(keep).tolist():
                    here, sum_here = node(k), int(total[k])
                    if k == 0 and depth in open_nodes:
                        before, so_far = open_nodes.pop(depth)
                        if before == here:
                            sum_here += so_far
                        else:
                            close(depth, before, so_far)
                    if k == len(first) - 1:
                        open_nodes[depth] = here, sum_here
                    else:
                        close(depth, here, sum_here)
            yield rows()
        for depth, (node_, total_) in open_nodes.items():
            close(depth, node_, total_)
        yield rows()

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``DEPTH`` words with at least ``least`` occurrences, and the words of each language.

    The first table has ``lang, phrase, words, n`` (words: how many), the second ``lang, n``.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").alias("text"))
    sc = docs.sparkSession.sparkContext
    counted = docs.mapInArrow(_count_words, "lang string, word string, hash bigint, n bigint")
    words = hand_over(counted.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "phrase-words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    common = words.filter(F.col("n") >= least)
    frequent = sc.broadcast(bitmap_of(common, "hash"))
    pairs = docs.mapInArrow(_count_pairs(frequent), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = hand_over(pairs.filter(F.col("n") >= least), "phrase-pairs")
    marked = sc.broadcast(bitmap_of(pairs, "pair"))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    budget = max(BUDGET, total >> SPREAD_BITS)
    large = pairs.filter(F.col("n") > budget).select("pair").toArrow().column("pair").to_numpy()
    over = sc.broadcast(np.ascontiguousarray(large).view(_U))
    n_groups = max(1, -(-total // BUDGET))
    suffixes = docs.mapInArrow(
        _emit_suffixes(frequent, marked, over, n_groups), "part bigint, spread boolean, lang string, key string, n bigint"
    )
    ordered = suffixes.repartition("part").drop("part").sortWithinPartitions("spread", "lang", "key")
    nodes = ordered.mapInArrow(_subtrees(least), "lang string, phrase string, words int, n bigint")
    nodes = nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    single = common.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return hand_over(nodes.unionByName(single), "phrase-nodes"), sizes


# -- report -----------------------------------------------------------------------------------


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first phrases by score.

    A-Z is lower-cased, pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are what space and tab leave. A
    candidate has 2 to 4 words and ``a`` occurrences, ``least`` at least. A cut gives
    ``floor(2000000 a / (l + r))`` with the counts of its two parts; the lowest cut counts, and of
    those the first. Candidates inside a longer one with 80 % of their count go. Order: score, then
    ``a``, both falling, then the phrase. A null language is ``und``, a null text has no words,
    repeated rows count again, other columns are not looked at. No rows give no phrases.
    """
    nodes, sizes = frequent_phrases(docs, least)
    candidates = nodes.filter(F.col("words") > 1).select("lang", "phrase", F.split("phrase", " ").alias("w"), F.col("n").alias("a"))
    cut = candidates.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    first = nodes.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = nodes.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cut = cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + r) as bigint)")
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # contiguous parts of two words or more
    spans = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.transform(
            F.sequence(F.lit(2), F.size("w") - i + 1), lambda k: F.struct(i.alias("i"), k.alias("k"))))),
        lambda s: s["k"] < F.size("w"),
    )
    longer = candidates.filter(F.size("w") > 2).select("lang", "w", "a", F.explode(spans).alias("s"))
    longer = longer.select("lang", F.expr("array_join(slice(w, s.i, s.k), ' ')").alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c, by: F.col(c).cast("decimal(19,0)") * F.lit(by).cast("decimal(3,0)")
    stands = F.coalesce(wide("longer", 100) >= wide("a", STANDS_FOR), F.lit(False))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(~stands).select("lang", "phrase", "a", "cut.*")
    # the first of each share of a language, then the first of those: no task meets all shares of all tasks
    shares = left.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    by_score = "ORDER BY score DESC, a DESC, phrase"
    ahead = shares.selectExpr("*", f"row_number() OVER (PARTITION BY lang, share {by_score}) AS within").filter(F.col("within") <= top)
    ranked = ahead.selectExpr("*", f"row_number() OVER (PARTITION BY lang {by_score}) AS rank").filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM starts) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE c >= {LEAST}),
cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM often WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.cut_at, x.c AS l, y.c AS r, ((2000000::HUGEINT * c.a) // (x.c::HUGEINT + y.c))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut_at FROM cand) c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.cut_at], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut_at + 1 : c.k], ' ')),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
spans AS (
  SELECT lang, a, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM cand), (VALUES (2), (3)) AS sizes_(m) WHERE m < k AND i + m - 1 <= k),
longer AS (SELECT lang, phrase, max(a) AS a FROM spans GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE g.a IS NULL OR 100::HUGEINT * g.a < {STANDS_FOR}::HUGEINT * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
