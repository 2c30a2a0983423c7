"""Exact deduplication, spelling variants and phrases against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm import brute
from tests.llm.test_operators import SMALL, rows
from tidemark.llm import exact_dedup, phrases, spelling

# 11 exact deduplication

COPIES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_copies(odd, odd_rows, none, keep):
    assert rows(exact_dedup.copies(odd, keep), *COPIES) == brute.copies(odd_rows, keep)
    assert exact_dedup.copies(none, keep).count() == 0


def test_copies_of_a_third(spark):
    """One text in a third of all rows, over many partitions: every run has one entry of it."""
    docs = [(i, "Same TEXT" if i % 3 else f"text {i % 500}") for i in range(4000)]
    got = exact_dedup.copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(40))
    assert rows(got, *COPIES) == brute.copies(docs)


def test_drop_copies(odd, odd_rows):
    kept = exact_dedup.drop_copies(odd.withColumn("run", F.lit(1)).withColumn("best", F.lit("x")))
    assert kept.columns == [*odd.columns, "run", "best"]
    stay = Counter((r.doc_id, brute.sha(brute.lower(r.text))) for r in kept.collect())
    assert stay == Counter({(i, h): n for (i, _, _, kept, h), n in brute.copies(odd_rows).items() if kept})
    given = Counter(tuple(r) for r in odd.collect())
    assert not Counter(tuple(r)[: len(odd.columns)] for r in kept.collect()) - given


def test_copies_run_no_python(odd):
    plan = exact_dedup.copies(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_keep_is_checked(odd):
    with pytest.raises(ValueError):
        exact_dedup.copies(odd, "first")


# 12 spelling variants

SPELLING = ("word", "form", "root", "n", "n_near", "form_n")


def _misspelt(rng):
    """Words of few letters, so that many are near, with counts in steps, chains and ties; some are very long."""
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(5, 9))) for _ in range(12)] + ["ab" * 40, "Straße" * 3]
    text = []
    for start in base:
        text += [start] * rng.choice((190, 200))
        word = start
        for n in (36, 6, 36, 6, 36, 6):
            word = start if n == 36 else word
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcÀ") + word[at:], word[:at] + rng.choice("abc") + word[at + 1 :]])
            text += [word if rng.random() < 0.9 else word.upper()] * n
    rng.shuffle(text)
    return text


@pytest.mark.parametrize("group", [2048, 3])
def test_spelling(spark, monkeypatch, group):
    """Also with groups that are divided again and again."""
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = random.Random(8)
    words = _misspelt(rng)
    docs = [(i, " ".join(words[i::60]) + ", x9y") for i in range(60)] + [(None, "abcabc abcabd " * 5), (7, None), (8, "")]
    got = spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    expected = brute.spelling(docs)
    assert {tuple(r) for r in got.select(*SPELLING).collect()} == expected and got.count() == len(expected)
    assert sum(r[1] is not None for r in expected) > 10 and any(r[1] != r[2] and r[1] for r in expected)


def test_spelling_odd(odd, odd_rows, none):
    assert {tuple(r) for r in spelling.spelling_variants(odd).select(*SPELLING).collect()} == brute.spelling(odd_rows)
    assert spelling.spelling_variants(none).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(odd, times=1)


def test_spelling_small(spark, small):
    got = entry.queries()["op12_spelling"](spark, SMALL).select(*SPELLING).collect()
    assert {tuple(r) for r in got} == brute.spelling(small) and len(got) > 100


def test_near_sets():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((6, 7)))) for _ in range(150)})
    for bar in (0, 2, 5):
        for w, near in zip(words, spelling.near_sets(words, 6, bar)):
            expected = {
                x for x in words
                if brute.distance_one(w, x) and min(len(w), len(x)) == 6 and not (bar and w[:bar] == x[:bar])
            }
            assert {words[k] for k in range(len(words)) if near >> k & 1} == expected


# 13 phrases

PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _prose(rng, n):
    common = ["the", "of", "New", "york", "city", "hall", "a\x01", "é", "in", "over"]
    out = []
    while len(out) < n:
        if rng.random() < 0.3:
            out += ["New", "York", "City", "Hall"][: rng.randrange(2, 5)]
        out.append(rng.choice(common) + rng.choice(["", "", "", ".", ";\t", "\r\n", " ", "!"]))
    return " ".join(out)


@pytest.mark.parametrize("budget", [1 << 18, 20])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_phrases(spark, monkeypatch, budget, batch):
    """Also with prefixes over the budget, and subtrees that go over many batches."""
    monkeypatch.setattr(phrases, "BUDGET", budget)
    rng = random.Random(9)
    docs = [(rng.choice(["en", "de", "de", None, ""]), _prose(rng, rng.randrange(120))) for _ in range(200)] + [("en", None), ("fr", "")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(6), 5, 60)
        assert sorted(tuple(r) for r in got.select(*PHRASES).collect()) == sorted(brute.collocations(docs, 5, 60))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_phrases_odd(odd, odd_rows, none):
    docs = odd.withColumn("lang", F.lit("x")).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x"))
    got = phrases.collocations(docs)
    assert sorted(tuple(r) for r in got.select(*PHRASES).collect()) == sorted(brute.collocations([("x", t) for _, t in odd_rows], 30, 2000))
    assert phrases.collocations(none.withColumn("lang", F.lit("x"))).count() == 0


def test_phrase_scores_pass_64_bits(spark):
    """The products of the score are decimals."""
    big = 9 * 10**17
    row = spark.range(1).selectExpr(
        f"cast(cast(2000000 as decimal(7,0)) * cast({big}L as decimal(19,0)) div (cast({big}L as decimal(19,0)) + {big}L) as bigint) AS s"
    ).first()
    assert row.s == 1000000
