"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def shingles(text: str | None) -> set[tuple]:
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(sets: list[set]) -> list[int]:
    """For each set the index of the first one that links lead to."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(sets))]


def dedup_lines(docs: list[tuple[int | None, str | None]]) -> list[tuple]:
    blanks = " \t\n\x0b\f\r"
    split = [(i, (t or "").split("\n")) for i, t in docs]
    holders = collections.defaultdict(set)
    for i, lines in split:
        for line in lines:
            key = lower(line.strip(blanks))
            if len(key) >= 10 and i is not None:
                holders[key].add(i)
    out = []
    for i, lines in split:
        stay = []
        for line in lines:
            h = holders.get(lower(line.strip(blanks)), set())
            if i is None or len(h) < 2 or min(h) == i:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def statistics(text: str | None) -> tuple:
    text = text or ""
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside)


def backoff(texts: list[str | None]) -> list[float]:
    """Each text by the counts of all the others."""
    tokens = [["\0", *words(lower(t))] if words(t) else [] for t in texts]
    one = collections.Counter(x for t in tokens for x in t)
    two = collections.Counter(p for t in tokens for p in zip(t, t[1:]))
    total = sum(one.values()) - one["\0"]
    out = []
    for t in tokens:
        n, m, rest = one - collections.Counter(t), two - collections.Counter(zip(t, t[1:])), total - len(t) + 1
        out.append(sum(
            math.log(m[p] / n[p[0]]) if m[p] else math.log(0.4 * n[p[1]] / rest) if n[p[1]] else math.log(0.16 / (rest + 1))
            for p in zip(t, t[1:])
        ))
    return out


def edited(docs: list[tuple[int, str]]) -> list[tuple[int, str]]:
    out = []
    for k, (i, t) in enumerate(docs):
        follower = docs[(k + 1) % len(docs)][1]
        out.append((i, t[: len(t) - len(t) // 2] + follower[: len(t) // 2]))
    return out


def copies(docs: list[tuple[int | None, str | None]], keep: str = "largest") -> collections.Counter:
    """(doc_id, keep_id, group size, kept, digest); of rows that share the id that stays, one is kept."""
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[lower(t)].append(i)
    out = collections.Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stays = (max if keep == "largest" else min)(known) if known else None
        for i in ids:
            out[(i, stays, len(ids), False, sha(t))] += 1
        out[(stays, stays, len(ids), False, sha(t))] -= 1
        out[(stays, stays, len(ids), True, sha(t))] += 1
    return +out


def distance_one(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def spelling(docs: list[tuple[int | None, str | None]], min_chars: int = 6, min_count: int = 5, times: int = 5) -> set[tuple]:
    n = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    forms, near = {}, {}
    for w in n:
        others = [x for x in n if distance_one(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w: str) -> str:
        while forms[w] is not None:
            w = forms[w]
        return w

    return {(w, forms[w], root(w), n[w], near[w], n[forms[w]] if forms[w] else None) for w in n}


def collocations(docs: list[tuple[str | None, str | None]], least: int, top: int) -> list[tuple]:
    """Of (language, text)."""
    f = collections.defaultdict(collections.Counter)
    for lang, t in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(t)):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                f[lang or "und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        size = sum(c for g, c in counts.items() if len(g) == 1)
        candidates = {g: c for g, c in counts.items() if len(g) > 1 and c >= least}
        rows = []
        for g, a in candidates.items():
            inside = [
                c for x, c in candidates.items()
                if len(x) > len(g) and any(x[i : i + len(g)] == g for i in range(len(x) - len(g) + 1))
            ]
            if any(100 * c >= 80 * a for c in inside):
                continue
            cuts = [(2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g))]
            score, _, l, r = min(cuts)
            rows.append((" ".join(g), a, l, r, size, score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode("utf-8", "surrogatepass")))
        out += [(lang, k, *row) for k, row in enumerate(rows[:top], 1)]
    return out


_MASK = (1 << 64) - 1


def _mix(h: int) -> int:
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & _MASK
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & _MASK
    return h ^ h >> 31


def order_minhash(text: str, k: int = 8, sketches: int = 32, size: int = 2) -> list[int]:
    """Each component: the k-mers that are first in one order, numbered by occurrence, put in text order and hashed."""
    if not text:
        return [0] * sketches
    k = min(k, len(text))
    kmers, seen, items = [], collections.Counter(), []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i : i + k]:
            h = (h * 0x100000001B3 + ord(c) + 1) & _MASK
        kmers.append(_mix(h + k & _MASK))
        items.append(_mix(kmers[-1] + seen[kmers[-1]] * 0xD6E8FEB86659FD93 & _MASK))
        seen[kmers[-1]] += 1
    out = []
    for j in range(sketches):
        xor, times = (_mix((1 + j + base) * 0x9E3779B97F4A7C15 & _MASK) for base in (0, 1000))
        first = sorted(range(len(items)), key=lambda i: ((items[i] ^ xor) * (times | 1) & _MASK, i))[:size]
        h = j + 1
        for i in sorted(first):
            h = _mix(h * 0x9E3779B97F4A7C15 + kmers[i] & _MASK)
        out.append(h & 0xFFFFFFFF | 1)
    return out


def ftrl(rows: list[tuple[list[int], int]], bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[dict, float]:
    """FTRL-proximal, one coordinate after the other; the bias is learned without ``l1``."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i: int) -> float:
        bound = 0.0 if i < 0 else l1
        if abs(z[i]) <= bound:
            return 0.0
        return -(z[i] - math.copysign(bound, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for slots, label in rows:
            own = [*slots, -1]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - label
            for i in own:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if i >= 0 and weight(i)}, weight(-1)
