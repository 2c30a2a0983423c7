"""License scans beside a plain version, and notices as files have them: inline, wrapped, tagged, two at a time."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import lower
from tidemark.llm import licenses

WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
VOCABULARY = ("work", "the", "of", "under", "and", "terms", "license", "public", "general", "copy", "version", "use", "permitted", "größe")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + (str(rng.randrange(300)) if rng.random() < 0.8 else "") for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    return licenses.train([prose(rng, rng.randrange(5, 33)).encode() for _ in range(1500)])


def found(model, *texts):
    known = licenses.Templates()
    return [[(h["family"], t[h["begin"] : h["end"]]) for h in hits]
            for t, hits in zip(texts, licenses.find([t.encode() for t in texts], model, known)[2])]


def pairs(words):
    return set(zip(words, words[1:]))


def plain(text: str, model) -> list[tuple]:
    """Hits (line, family, probability, template) of a text, every window classified and compared."""
    templates = {t: pairs(WORD.findall(lower(t))) for t in licenses.OWNERS}
    out = []
    for block in re.split(r"\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*", text):
        words = WORD.findall(lower(block))
        runs: dict[str, list] = {}
        for number, at in enumerate(range(0, max(1, len(words)), licenses.STEP)):
            if at and at + licenses.STEP >= len(words):
                break
            own = words[at : at + licenses.WINDOW]
            if not own:
                break
            p = model.probabilities(licenses.features(licenses._hashes(" ".join(own).encode())))
            if p[-1] > 1 - licenses.LEAST_PROBABILITY:
                continue
            for k, family in enumerate(licenses.FAMILIES):
                shares = []
                for t, owners in licenses.OWNERS.items():
                    alone = set(templates[t])
                    for x, other in licenses.OWNERS.items():
                        alone -= templates[x] if not other >= owners else set()
                    share = len(templates[t] & pairs(own)) / len(templates[t])
                    if k in owners and alone and share >= 0.7 and len(alone & pairs(own)) >= 0.7 * len(alone):
                        shares.append(share)
                if shares and p[k] >= licenses.LEAST_PROBABILITY:
                    runs.setdefault(family, []).append((number, max(shares), float(p[k])))
        for family, windows in runs.items():
            run = [windows[0]]
            for w in [*windows[1:], (10**9, 0, 0)]:
                if w[0] > run[-1][0] + 1:
                    out.append((family, max((s, q) for _, s, q in run)))
                    run = []
                run.append(w)
    return sorted((f, round(s, 9), round(q, 9)) for f, (s, q) in out)


def test_beside_plain(model):
    rng = random.Random(11)
    every = list(licenses.OWNERS)
    texts = ["", "\n", " \n\t\n ", "one", "license " * 500, prose(rng, 3000)]
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(every).split()
            if rng.random() < 0.4:
                del words[rng.randrange(len(words))]
            parts += [prose(rng, rng.randrange(40)), rng.choice((" ", "\n", "\r\n", "\n\n", "\n \t\n\n")).join((" ".join(words), ""))]
        texts.append(rng.choice((" ", "\n", "\n\n")).join(parts))
    known = licenses.Templates()
    n_windows, tried, hits = licenses.find([t.encode() for t in texts], model, known)
    for text, own in zip(texts, hits):
        assert sorted((h["family"], round(h["template"], 9), round(h["probability"], 9)) for h in own) == plain(text, model)
        for h in own:
            assert h["line"] == text[: h["begin"]].count("\n")
    assert sum(map(len, hits)) > 200 and (tried <= n_windows).all() and n_windows[0] == 0


def test_every_window_of_a_notice(model):
    """However many words are before it, a notice is whole in one window."""
    longest = "it under the terms of the GNU General Public License as published by the Free Software Foundation"
    assert len(longest.split()) <= licenses.STEP + 1
    for n in range(70):
        text = " ".join(f"w{i}" for i in range(n)) + " " + longest + " " + " ".join(f"v{i}" for i in range(60))
        assert found(model, text) == [[("gpl", longest)]]


@pytest.mark.parametrize("template", sorted(licenses.OWNERS))
def test_inside_a_long_paragraph(model, template):
    rng = random.Random(template)
    hits = found(model, f"{prose(rng, 900)} {template} {prose(rng, 900)}")[0]
    assert {f for f, _ in hits} == {licenses.FAMILIES[k] for k in licenses.OWNERS[template]}
    assert len(hits) == len(licenses.OWNERS[template]) and all(len(t) <= len(template) for _, t in hits)


@pytest.mark.parametrize("template", sorted(licenses.OWNERS))
def test_wrapped_over_lines(model, template):
    words = template.split()
    for cut in range(1, len(words)):
        text = "x y\n\n# " + " ".join(words[:cut]) + "\n# " + " ".join(words[cut:]) + ".\n\nz"
        (hits,) = found(model, text)
        assert {f for f, _ in hits} == {licenses.FAMILIES[k] for k in licenses.OWNERS[template]}


def test_two_families(model):
    got = found(
        model, "Released under the MIT License or licensed under the Apache License",
        "licensed under the GNU General Public License, version 2 and the Mozilla Public License Version 2.0",
        "BSD 3-Clause License\n\nReleased under the MIT License\n\nBSD 3-Clause License",
    )
    assert [[f for f, _ in hits] for hits in got] == [["mit", "apache"], ["gpl", "mpl"], ["bsd", "mit", "bsd"]]


def test_tags(model):
    tags = {"MIT": "mit", "Apache-2.0": "apache", "BSD-3-Clause": "bsd", "GPL-2.0": "gpl", "LGPL-2.1-only": "lgpl", "CC-BY-4.0": "cc-by",
            "CC-BY-SA-4.0": "cc-by-sa", "MPL-2.0": "mpl", "AGPL-3.0-only": "agpl", "Apache-2.0 OR MIT": "apache mit", "Nothing": ""}
    got = found(model, *(f"// SPDX-License-Identifier: {tag}\nint main() {{}}" for tag in tags))
    assert [" ".join(f for f, _ in hits) for hits in got] == list(tags.values())


def test_other_texts_hold_none(model):
    rng = random.Random(5)
    texts = ["no licence at all, the general public", "Permission is hereby granted to the public to copy the work", "license " * 2000,
             "the terms of the general license of the public software version 2.0", *(prose(rng, 400) for _ in range(100))]
    assert found(model, *texts) == [[] for _ in texts]


def test_unknown_class_is_calibrated(model):
    """Of windows that were not trained on, the unknown class takes those without a notice."""
    rng = random.Random(77)
    every = list(licenses.OWNERS)
    right = []
    for k in range(600):
        text = prose(rng, 20) if k % 2 else f"{prose(rng, 6)} {rng.choice(every)} {prose(rng, 6)}"
        right.append((k % 2, model.probabilities(licenses.features(licenses._hashes(text.encode())))[-1]))
    assert sum(abs(y - p) for y, p in right) / len(right) < 0.05


def test_odd_rows(odd, odd_rows, none, model):
    got = licenses.scan(odd, model)
    assert got.count() == len(odd_rows)
    empty = got.filter("doc_id in (1, 2)").select("n_lines", "n_windows", "n_candidates", F.size("hits")).collect()
    assert [tuple(r) for r in empty] == [(1, 0, 0, 0)] * 2
    assert licenses.scan(none, model).count() == 0
    assert licenses.license_report(odd.filter("text is null")).count() == 2


def test_repeated_rows_are_looked_at_each(spark, model):
    text = "Released under the MIT License"
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (None, text, None)], "doc_id long, text string, family string")
    hits = licenses.scan(docs, model).select("doc_id", F.explode("hits.family")).collect()
    assert sorted(map(tuple, hits), key=str) == [(1, "mit"), (1, "mit"), (None, "mit")]
