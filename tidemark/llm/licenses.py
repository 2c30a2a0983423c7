"""License scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a block of lines between blank lines; line breaks inside it count as blanks, so a
wrapped notice is read like any other. Paragraphs are read in windows of ``WINDOW`` words that overlap by
half: a notice of up to ``STEP + 1`` words lies whole in one of them, however long the paragraph is,
and what is scored is never diluted by more than a window of other words.

Sparse logistic regression over hashed word 1- to 3-grams gives each window a probability for every
licence family and for the unknown class (no licence at all). Families do not exclude each other, so
a window that names two has both. It is trained here, on templates (whole, shortened, with words lost, among
other words, two at a time) against windows from whole texts of the corpus; scale and offset fitted on windows left out of
training calibrate each class. A family that is predicted counts only if the comparison with its
templates confirms it: enough of a template's word pairs are in the window, and enough of those pairs
that no other family's templates have.

Only windows that the comparison can confirm are classified: each word pair of a template is worth at
most one part of the shortest template it is in, and a window where these do not add up to the least
share is unknown whatever its probabilities are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ngram_hashes, texts, word_hashes

BITS, ORDERS = 18, (1, 2, 3)
#: Words of a window, and from one window to the next.
WINDOW, STEP = 32, 16
#: Windows of the corpus to learn the unknown class from, at most, and the longest of them in characters.
SAMPLE, WINDOW_CHARS = 6000, 1000
#: Training windows of each template, and of each two families in one window.
VARIANTS, DUAL = 40, 30
EPOCHS, RATE, L1 = 15, 2.0, 1e-4
#: Least probability of a family, and least share of a template's word pairs that a window must have.
LEAST_PROBABILITY, LEAST_TEMPLATE = 0.5, 0.7

#: Families and the notices that name them. A notice that names two is there under both.
TEMPLATES: dict[str, list[str]] = {
    "agpl": ["licensed under the GNU Affero General Public License, version 3", "GNU Affero General Public License",
             "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "apache": ["Licensed under the Apache License, Version 2.0", "licensed under the Apache License",
               "you may not use this file except in compliance with the License",
               "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT OR Apache-2.0",
               "SPDX-License-Identifier: Apache-2.0 OR MIT"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Released under the BSD License", "BSD 3-Clause License", "BSD 2-Clause License",
            "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"],
    "cc-by": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
                 "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "gpl": ["licensed under the GNU General Public License, version 3", "licensed under the GNU General Public License, version 2",
            "licensed under the GNU General Public License",
            "it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later",
            "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl": ["licensed under the GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License",
             "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later",
             "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "mit": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: MIT OR Apache-2.0",
            "SPDX-License-Identifier: Apache-2.0 OR MIT"],
    "mpl": ["subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0",
            "licensed under the Mozilla Public License", "SPDX-License-Identifier: MPL-2.0"],
    "public-domain": ["CC0 1.0 Universal Public Domain Dedication", "This work is released into the public domain",
                      "SPDX-License-Identifier: CC0-1.0", "SPDX-License-Identifier: Unlicense"],
}
FAMILIES = sorted(TEMPLATES)
#: The families that each notice names.
OWNERS = {t: frozenset(k for k, f in enumerate(FAMILIES) if t in TEMPLATES[f]) for notices in TEMPLATES.values() for t in notices}

_U = np.uint64
#: Bytes between words: ASCII that is no letter or digit; a line feed ends a line as well.
_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: What parts two paragraphs: a line feed, and lines of nothing but ASCII white space.
_BLANK = re.compile(rb"\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*")


def paragraphs(text: bytes) -> list[tuple[int, bytes]]:
    """Paragraphs with the byte each begins at; a text without words is one."""
    out, at = [], 0
    for gap in _BLANK.finditer(text):
        out.append((at, text[at : gap.start()]))
        at = gap.end()
    return [*out, (at, text[at:])]


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paragraph, first word and end of every window; ``first`` bounds the paragraphs' words."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - WINDOW + STEP) // STEP)), 0)
    of = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = first[of] + STEP * place
    return of, start, np.minimum(start + WINDOW, first[of + 1])


def features(words: np.ndarray) -> np.ndarray:
    """Slots of the 1- to 3-grams of a window, each once."""
    if not len(words):
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate([ngram_hashes(words, n) >> _U(64 - BITS) for n in ORDERS]).astype(np.int64))


def _hashes(text: bytes) -> np.ndarray:
    return word_hashes([text], _GAPS, lower=True)[0]


def _pairs(text: str) -> np.ndarray:
    return np.unique(ngram_hashes(_hashes(text.encode()), 2))


class Templates:
    """Word pairs of the templates, and what each pair is worth.

    A template's own pairs are those that no template of another family has, unless it names this
    template's families too.
    """

    def __init__(self) -> None:
        pairs = {t: _pairs(t) for t in OWNERS}
        self.values = np.unique(np.concatenate(list(pairs.values())))
        self.worth = np.zeros(len(self.values))
        for p in pairs.values():
            at = np.searchsorted(self.values, p)
            self.worth[at] = np.maximum(self.worth[at], 1 / len(p))
        #: Per family, its templates as (pairs, own pairs).
        self.of: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in FAMILIES]
        for t, families in OWNERS.items():
            others = [pairs[x] for x in OWNERS if not OWNERS[x] >= families]
            for k in families:
                self.of[k].append((pairs[t], np.setdiff1d(pairs[t], np.concatenate(others))))

    def worths(self, words: np.ndarray) -> np.ndarray:
        """What the pair that begins at each word is worth; the last word begins none."""
        grams = ngram_hashes(words, 2)
        at = np.minimum(np.searchsorted(self.values, grams), len(self.values) - 1)
        return np.where(self.values[at] == grams, self.worth[at], 0.0)

    def confirmed(self, words: np.ndarray, family: int) -> tuple[float, np.ndarray | None]:
        """Largest share of a template of the family that the window confirms, and its pairs (0: none)."""
        own = np.unique(ngram_hashes(words, 2))
        best: tuple[float, np.ndarray | None] = (0.0, None)
        for pairs, alone in self.of[family]:
            share = len(np.intersect1d(own, pairs)) / len(pairs)
            sure = len(np.intersect1d(own, alone)) >= LEAST_TEMPLATE * len(alone) and len(alone)
            if sure and share >= LEAST_TEMPLATE and share > best[0]:
                best = (share, pairs)
        return best


def span(words: np.ndarray, pairs: np.ndarray) -> tuple[int, int]:
    """First word and end of the shortest, then earliest, stretch with all of the pairs that are there."""
    grams = ngram_hashes(words, 2)
    at = np.flatnonzero(np.isin(grams, pairs)).tolist()
    need = len({int(grams[k]) for k in at})
    best = (0, len(words))
    held: dict[int, int] = {}
    left = 0
    for k in at:
        held[int(grams[k])] = held.get(int(grams[k]), 0) + 1
        while len(held) == need:
            if k + 2 - at[left] < best[1] - best[0]:
                best = (at[left], k + 2)
            out = int(grams[at[left]])
            held[out] -= 1
            if not held[out]:
                del held[out]
            left += 1
    return best


class Classifier:
    """Sparse logistic regression per family; the last class is unknown."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, scale: np.ndarray | None = None, offset: np.ndarray | None = None):
        self.weights, self.bias = weights, bias
        self.scale = np.ones(len(bias)) if scale is None else scale
        self.offset = np.zeros(len(bias)) if offset is None else offset

    def scores(self, slots: np.ndarray) -> np.ndarray:
        return self.weights[slots].sum(axis=0) + self.bias

    def probabilities(self, slots: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scores(slots) * self.scale + self.offset)

    def families(self, slots: np.ndarray) -> list[tuple[int, float]]:
        """Families that are at least as likely as not, in a window that is not taken for unknown."""
        p = self.probabilities(slots)
        if p[-1] > 1 - LEAST_PROBABILITY:
            return []
        return [(k, float(p[k])) for k in np.flatnonzero(p[:-1] >= LEAST_PROBABILITY).tolist()]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _notice(template: str, rng: np.random.Generator) -> list[bytes]:
    """A notice as it may be met: shortened at the front, with words lost."""
    own = _WORD.findall(template.encode())
    words = own[int(rng.integers(0, 2)) :] if rng.random() < 0.3 else list(own)
    return [w for w in words if len(own) < 5 or rng.random() > 0.05]


def _examples(unknown: list[bytes], rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training windows as (slots, classes)."""
    known, rows, clean = Templates(), [], []
    none = np.zeros(len(FAMILIES) + 1)
    none[-1] = 1.0
    for window in unknown:
        words = _hashes(window)
        # a window that may hold a notice is no example of the unknown class
        if len(words) and known.worths(words).sum() < LEAST_TEMPLATE / 2:
            rows.append((features(words), none))
            clean.append(_WORD.findall(window))

    def filler(n: int) -> list[bytes]:
        return clean[int(rng.integers(0, len(clean)))][:n] if clean and n else []

    def example(*templates: str) -> None:
        notices = [_notice(t, rng) for t in templates]
        room = max(0, WINDOW - sum(map(len, notices)))
        before = filler(int(rng.integers(0, room + 1)) if rng.random() < 0.8 else 0)
        out = list(before)
        for k, notice in enumerate(notices):
            out += [[b"or"], [b"and"], filler(3), []][int(rng.integers(0, 4))] if k else []
            out += notice
        out += filler(max(0, WINDOW - len(out)) if rng.random() < 0.8 else 0)
        label = np.zeros(len(FAMILIES) + 1)
        label[list(frozenset().union(*(OWNERS[t] for t in templates)))] = 1.0
        rows.append((features(_hashes(b" ".join(out))), label))

    for template in OWNERS:
        for _ in range(VARIANTS):
            example(template)
    for two in combinations(FAMILIES, 2):
        for _ in range(DUAL):
            chosen = [TEMPLATES[family][int(rng.integers(0, len(TEMPLATES[family])))] for family in two]
            example(*(chosen if rng.random() < 0.5 else chosen[::-1]))
    return rows


def train(unknown: list[bytes], seed: int = 7) -> Classifier:
    """The classifier, from the templates and windows that are taken for no licence."""
    rng = np.random.default_rng(seed)
    rows = _examples(unknown, rng)
    order = rng.permutation(len(rows))
    held, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    classes = len(FAMILIES) + 1
    w, b = np.zeros((1 << BITS, classes)), np.zeros(classes)
    squares = np.ones((1 << BITS, classes))
    for _ in range(EPOCHS):
        for i in used:
            slots, label = rows[i]
            own = w[slots]
            p = _sigmoid(own.sum(axis=0) + b) - label
            near = squares[slots] + p * p
            squares[slots] = near
            own -= RATE * p / np.sqrt(near * len(slots))
            w[slots] = np.sign(own) * np.maximum(np.abs(own) - L1, 0.0)
            b -= 0.01 * p
    model = Classifier(w, b)
    s = np.array([model.scores(rows[i][0]) for i in held])
    y = np.array([rows[i][1] for i in held])
    for k in range(classes):
        model.scale[k], model.offset[k] = _calibrated(s[:, k], y[:, k])
    return model


def _calibrated(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the scores by Newton steps on the log loss, with targets short of 0 and 1."""
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([s, np.ones(len(s))], axis=1)
    loss = np.inf
    for _ in range(50):
        p = _sigmoid(x @ at)
        now = -float(np.mean(target * np.log(p) + (1 - target) * np.log(1 - p)))
        if now > loss - 1e-9:
            break
        loss, best = now, at
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(bend, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
    return (float(best[0]), float(best[1])) if best[0] > 0 else (1.0, 0.0)


def candidates(known: Templates, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows that the comparison with templates may confirm."""
    total = np.zeros(len(words) + 1)
    worths = known.worths(words)
    np.cumsum(worths, out=total[1 : len(worths) + 1])
    last = np.maximum(end - 1, start)
    return np.flatnonzero(total[last] - total[start] > LEAST_TEMPLATE - 1e-6)


_HIT = [("line", pa.int32()), ("begin", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("template", pa.float64())]
_HITS = (
    "doc_id bigint, n_lines bigint, n_windows bigint, n_candidates bigint, "
    "hits array<struct<line: int, begin: int, end: int, family: string, probability: double, template: double>>"
)


def _hit(text: bytes, begin: int, paragraph: bytes, words: tuple[int, int], family: int, p: float, share: float) -> dict:
    """A found notice with its place: words (first, end) of a paragraph that begins at a byte of the text."""
    at = [m.span() for m in _WORD.finditer(paragraph)]
    a, b = begin + at[words[0]][0], begin + at[words[1] - 1][1]
    return {"line": text.count(b"\n", 0, a), "begin": len(text[:a].decode("utf-8", "replace")),
            "end": len(text[:b].decode("utf-8", "replace")), "family": FAMILIES[family], "probability": p, "template": share}


def find(raw: list[bytes], model: Classifier, known: Templates) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Windows, candidates and hits of each text."""
    parts = [(i, at, p) for i, text in enumerate(raw) for at, p in paragraphs(text)]
    words, first = word_hashes([p for _, _, p in parts], _GAPS, lower=True)
    of, start, end = windows(first)
    owner = np.array([i for i, _, _ in parts], np.int64)
    n_windows = np.bincount(owner[of], minlength=len(raw)) if len(of) else np.zeros(len(raw), np.int64)
    tried = np.zeros(len(raw), np.int64)
    hits: list[list[dict]] = [[] for _ in raw]
    met: dict[tuple[int, int], tuple] = {}  # (paragraph, family): window, best (share, probability), words

    def close(key: tuple[int, int]) -> None:
        _, (share, p), place = met.pop(key)
        i, at, paragraph = parts[key[0]]
        hits[i].append(_hit(raw[i], at, paragraph, place, key[1], p, share))

    for k in candidates(known, words, start, end).tolist():
        own = words[start[k] : end[k]]
        tried[owner[of[k]]] += 1
        for family, p in model.families(features(own)):
            share, pairs = known.confirmed(own, family)
            if pairs is None:
                continue
            key = (int(of[k]), family)
            a, b = span(own, pairs)
            place = (int(start[k] - first[of[k]]) + a, int(start[k] - first[of[k]]) + b)
            if key in met and met[key][0] < k - 1:
                close(key)
            if key not in met or (share, p) > met[key][1]:
                met[key] = (k, (share, p), place)
            else:
                met[key] = (k, *met[key][1:])
    for key in list(met):
        close(key)
    for found in hits:
        found.sort(key=lambda h: (h["begin"], h["end"], h["family"]))
    return n_windows, tried, hits


def _scan(packed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, values, bias, scale, offset = packed.value
        weights = np.zeros((1 << BITS, len(FAMILIES) + 1))
        weights[slots] = values
        model, known = Classifier(weights, bias, scale, offset), Templates()
        for batch, raw in texts(batches):
            n_windows, tried, hits = find(raw, model, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.count(b"\n") + 1 for t in raw], pa.int64()),
                 pa.array(n_windows.astype(np.int64)), pa.array(tried), pa.array(hits, pa.list_(pa.struct(_HIT)))],
                ["doc_id", "n_lines", "n_windows", "n_candidates", "hits"],
            )

    return run


def _one_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window of each text, at a place that the words choose, as words with blanks between."""
    for _, raw in texts(batches):
        out = []
        for text in raw:
            parts = [p for _, p in paragraphs(text)]
            words, first = word_hashes(parts, _GAPS, lower=True)
            of, start, end = windows(first)
            if len(of):
                k = int((np.bitwise_xor.reduce(words) >> _U(20)) % _U(len(of)))
                own = _WORD.findall(parts[of[k]])[start[k] - first[of[k]] : end[k] - first[of[k]]]
                out.append(b" ".join(own).lower().decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["window"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Learns the unknown class from one window of each of at most ``sample`` documents, picked by hash
    of the id; the window may lie anywhere in the text."""
    picked = docs.filter(F.col("text").isNotNull()).select(F.xxhash64("doc_id").alias("h"), "doc_id").orderBy("h", "doc_id").limit(sample)
    ids = picked.select(F.col("doc_id").alias("id")).distinct()
    own = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text").mapInArrow(_one_window, "window string")
    rows = own.filter(F.length("window") <= WINDOW_CHARS).distinct().orderBy(F.xxhash64("window"), "window").limit(sample).toArrow()
    return train([x.encode() for x in rows.column("window").to_pylist()])


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """``doc_id, n_lines, n_windows, n_candidates, hits`` of every row of ``docs``. ``hits`` has, in order
    of place, each notice that was found: the line it begins on (from 0), its first character and its end, the
    family, its probability, and the share of the template.

    Windows of one paragraph that follow each other and name one family are one hit: the one with the
    largest share, then probability, then the first. A null or empty text has one empty line and no
    window. Rows with one id, and rows that repeat, are looked at each. Only the n-grams with a weight
    are sent to the tasks. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = model or fit(docs)
    used = np.flatnonzero(np.abs(model.weights).max(axis=1))
    packed = docs.sparkSession.sparkContext.broadcast((used.astype(np.int32), model.weights[used], model.bias, model.scale, model.offset))
    return docs.mapInArrow(_scan(packed), _HITS)


def license_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_hits, families, probability``: the families found, sorted and joined by
    commas (empty: none), and the largest probability (null: none)."""
    found = scan(docs)
    return found.select(
        "doc_id", "n_lines", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct(F.col("hits.family"))), ",").alias("families"),
        F.array_max(F.col("hits.probability")).alias("probability"),
    )
