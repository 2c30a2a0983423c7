"""Every operator against a plain version, on odd rows, on no rows, and on the smallest tables."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
from tests.llm import brute
from tidemark.llm import (
    bpe, jaccard_join, licenses, line_dedup, lm_scores, mixing, order_minhash, quality, token_counts, toxicity,
)
from tidemark.llm.queries import ORACLE, PIECES, WORDS, tokenizer

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert check.compare(spark, SMALL, name)[0] == "ok"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


# 1 token counts


def _pieces(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    return Counter(
        (i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in docs
    )


def test_token_counts(odd, odd_rows, none):
    path = tokenizer(PIECES)
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert rows(token_counts.token_counts(odd, path), *columns) == _pieces(odd_rows)
    assert token_counts.token_counts(none, path).count() == 0


def test_token_counts_small(spark, small):
    assert rows(entry.queries()["op1_token_counts"](spark, SMALL), "doc_id", "n_bytes", "n_tokens", "over_limit") == _pieces(small)


@pytest.mark.parametrize("text", ["a b " * 50, "a  b\tc\n d " * 40, "▁a ▁b a▁ b " * 30, "é 中 文 　 x " * 30, " x" * 99 + " "])
def test_safe_pieces(text):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    for size in (1, 7, 40):
        cut = list(token_counts.safe_pieces(text.encode(), size))
        assert sum(len(model.encode(p.decode())) for p in cut) == len(model.encode(text))


# 2 mixing


def test_mixing_odd(odd, odd_rows, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    total = sum(r["size"] for r in got)
    assert total == sum(len(brute.words(t)) for _, t in odd_rows)
    largest = max(r["size"] for r in got)
    for target in {r.target for r in got}:
        own = [r for r in got if r.target == target]
        assert abs(sum(r.taken for r in own) - target) <= largest
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in own)
    assert rows(mixing.mix(odd.repartition(3)), "doc_id", "size", "taken") == rows(mixing.mix(odd), "doc_id", "size", "taken")
    assert mixing.mix(none).count() == 0


def test_mixing_shares(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 + i % 5), s) for i, s in enumerate(["a"] * 300 + ["b"] * 200 + ["c"] * 40 + [None] * 60)],
        "doc_id long, text string, source string",
    )
    got = mixing.mix(docs).groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    sizes = [r.source_size for r in got]
    assert sum(r.target for r in got) == pytest.approx(1.5 * sum(sizes))
    assert all(r.target <= 2 * r.source_size + 1e-6 and abs(r.taken - r.target) <= 5 for r in got)
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    expected = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()} == expected


def test_mixing_takes_nothing_three_times(spark):
    """A source at its bound, with documents without words: copies are counted, not compared with ``mix``."""
    rows_ = [(i, "w " * 3 if i < 3 else "", "a") for i in range(33)] + [(100 + i, "w " * 50, "b") for i in range(40)]
    rows_ += [(200 + i, None, "c") for i in range(20)]
    taken = mixing.mixed(spark.createDataFrame(rows_, "doc_id long, text string, source string"))
    counts = Counter(r.doc_id for r in taken.select("doc_id").collect())
    assert max(counts.values()) <= 2
    assert all(counts[i] == 2 for i in range(3))
    words = {i: len(brute.words(t)) for i, t, _ in rows_}
    assert sum(words[i] * n for i, n in counts.items() if i < 100) == 18


def test_mixing_smaller_budget_is_subset(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9), "s") for i in range(400)], "doc_id long, text string, source string")
    few, more = (
        {r.doc_id for r in mixing.mix(docs, (1,), share).filter("taken > 0").collect()} for share in ((1, 4), (1, 2))
    )
    assert few < more


# 3 line deduplication


def test_lines(odd, odd_rows, none):
    got = rows(line_dedup.line_report(odd), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == Counter(brute.dedup_lines(odd_rows))
    assert line_dedup.line_report(none).count() == 0


def test_lines_keep_columns(odd):
    done = line_dedup.dedup_lines(odd.withColumn("n_lines", F.lit("x")).withColumn("pos", F.lit(1)))
    assert done.columns == [*odd.columns, "pos", "n_lines", "n_dropped", "kept_text"]
    assert rows(done, "doc_id", "text", "key", "row", "n") == rows(odd, "doc_id", "text", "key", "row", "n")


def test_lines_run_no_python(odd):
    assert "Python" not in line_dedup.line_report(odd)._jdf.queryExecution().toString()


# 4 BPE


def _encoded(docs):
    model = Tokenizer.from_file(public_tokenizers.path(WORDS))
    out = Counter()
    for i, t in docs:
        ids = model.encode(t or "", add_special_tokens=False).ids
        out[(i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(model.decode(ids, skip_special_tokens=False)))] += 1
    return out


def test_bpe(odd, odd_rows, none):
    path = tokenizer(WORDS)
    assert rows(bpe.encode(odd, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _encoded(odd_rows)
    assert bpe.encode(none, path).count() == 0


def test_bpe_gives_ids_and_text(odd, odd_rows):
    model = Tokenizer.from_file(public_tokenizers.path(WORDS))
    expected = Counter()
    for i, t in odd_rows:
        ids = model.encode(t or "", add_special_tokens=False).ids
        expected[(i, tuple(ids), model.decode(ids, skip_special_tokens=False))] += 1
    got = bpe.encode(odd, tokenizer(WORDS)).select("doc_id", "ids", "decoded").collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == expected


def test_bpe_small(spark, small):
    got = entry.queries()["op4_bpe"](spark, SMALL)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _encoded(small)


def test_chunks_are_content_defined():
    a, b = (bytes(brute.sha(str(i)), "ascii") for i in (1, 2))
    body = b" ".join(bytes(brute.sha(str(i)), "ascii") for i in range(400))
    cut = bpe.chunks([a + body, body, b"", "é".encode() * 4000])
    assert [b"".join(c) for c in cut] == [a + body, body, b"", "é".encode() * 4000]
    assert cut[0][-20:] == cut[1][-20:] and len(cut[0]) > 20
    for part in cut[3]:
        part.decode()


def test_joins_are_repaired():
    encoder = bpe.Encoder(tokenizer(WORDS))
    model = Tokenizer.from_file(public_tokenizers.path(WORDS))
    text = "unbelievable  tokenization's\nof reassembled<|endoftext|>words, and whitespacelessness" * 3
    raw = text.encode()
    for step in (1, 2, 3, 7, 20, 64):
        parts = [raw[i : i + step] for i in range(0, len(raw), step)]
        encoded = [encoder.encode(p) for p in parts]
        assert bpe.assemble(parts, encoded, encoder) == model.encode(text, add_special_tokens=False).ids


# 5 quality rules


def test_quality(odd, odd_rows, labels, none, no_labels):
    got = quality.quality_report(odd, labels)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert rows(got, *names) == Counter((i, *brute.statistics(t)) for i, t in odd_rows)
    for r in got.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    plain = quality.quality_report(odd, no_labels)
    assert plain.filter("kept = base_failed").count() == 0
    assert quality.quality_report(none, no_labels).count() == 0


def test_quality_learns(spark, small):
    documents, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_report(documents, marks).join(marks, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1 and not r.base_failed) for r in got) / len(got) > 0.97


def test_rules_are_grown_and_pruned():
    import numpy as np

    rng = np.random.default_rng(1)
    values = {"words": rng.uniform(0, 100, 4000), "marks_per_100_words": rng.uniform(0, 10, 4000)}
    bad = (values["words"] > 70) & (values["marks_per_100_words"] > 6) | (values["words"] < 10)
    noisy = bad ^ (rng.random(4000) < 0.02)
    rules = quality.learn(values, noisy, rng.random(4000) < 1 / 3)
    found = np.zeros(4000, bool)
    for rule in rules:
        found |= quality.covers(rule, values)
    assert (found == bad).mean() > 0.97 and len(rules) <= 6


# 6 licenses


def test_licenses(spark, none):
    texts = [
        "Some words of prose here.\nReleased under the MIT License.\nMore prose.", None, "", "no licence at all, the general public",
        "x\nLicensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "license " * 2000,
    ]
    filler = [(100 + i, f"plain text number {i} the of and under work version {i % 7}") for i in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), *filler], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_report(docs).collect()}
    assert [got[i].families for i in range(len(texts))] == ["mit", "", "", "", "cc-by-nc", "gpl", "apache,mit", ""]
    assert got[1].n_lines == 1 and got[0].n_lines == 3 and got[1].probability is None
    assert all(got[i].families == "" for i, _ in filler)
    assert licenses.license_report(none).count() == 0


# 7 language-model scores


@pytest.mark.parametrize("frequent", [3, 1 << 18])
def test_lm(odd, odd_rows, none, monkeypatch, frequent):
    monkeypatch.setattr(lm_scores, "FREQUENT", frequent)
    expected = Counter(
        (i, len(brute.words(t)), round(s, 6)) for (i, t), s in zip(odd_rows, brute.backoff([t for _, t in odd_rows]))
    )
    got = lm_scores.lm_scores(odd).collect()
    assert Counter((r.doc_id, r.n_words, round(r.score, 6) + 0.0) for r in got) == expected
    assert all((r.mean_score is None) == (r.n_words == 0) for r in got)
    assert lm_scores.lm_scores(none).count() == 0


def test_lm_takes_a_text_off_its_own_counts(spark):
    """What a text alone has backs off, however often it has it; what another has too does not."""
    docs = [(1, "a b a b a b"), (2, "c d"), (3, "c d"), (4, "d c")]
    got = {r.doc_id: r.score for r in lm_scores.lm_scores(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == pytest.approx(dict(zip((1, 2, 3, 4), brute.backoff([t for _, t in docs]))))
    assert got[2] == got[3] > got[4] > got[1]


# 8 Jaccard join


def _components(docs):
    sets = [brute.shingles(t) for _, t in docs]
    roots = brute.components(sets)
    least = {}
    for (i, _), r in zip(docs, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return Counter((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(docs, sets, roots))


@pytest.mark.parametrize("region_docs,large,block", [(2000, 48, 256), (3, 4, 5), (2000, 1000, 256)])
def test_jaccard(odd, odd_rows, none, monkeypatch, region_docs, large, block):
    for name, value in (("REGION_DOCS", region_docs), ("LARGE", large), ("BLOCK", block)):
        monkeypatch.setattr(jaccard_join, name, value)
    expected = _components(odd_rows)
    assert rows(jaccard_join.jaccard_join(odd), "doc_id", "n_shingles", "component_id") == expected
    if large == 48:
        assert jaccard_join.jaccard_join(none).count() == 0


def test_jaccard_small(spark, small):
    assert rows(entry.queries()["op8_jaccard_join"](spark, SMALL), "doc_id", "n_shingles", "component_id") == _components(small)


@pytest.mark.parametrize("large,block", [(48, 256), (4, 5), (2, 256)])
def test_jaccard_gives_every_link(odd, odd_rows, none, monkeypatch, large, block):
    """All pairs of different sets that link, once, and each document's number of links."""
    for name, value in (("LARGE", large), ("BLOCK", block)):
        monkeypatch.setattr(jaccard_join, name, value)
    sets = [brute.shingles(t) for _, t in odd_rows]
    linked = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    n_links = [sum(bool(linked(a, b)) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    different = list({frozenset(s) for s in sets})
    pairs = sum(bool(linked(a, b)) for i, a in enumerate(different) for b in different[:i])
    members, edges = jaccard_join.join_links(odd)
    assert rows(members, "doc_id", "n_shingles", "n_links") == Counter((i, len(s), n) for (i, _), s, n in zip(odd_rows, sets, n_links))
    found = [(bytes(r.a), bytes(r.b)) for r in edges.collect()]
    assert len(found) == len(set(found)) == pairs > 0 and all(a < b for a, b in found)
    if large == 48:
        members, edges = jaccard_join.join_links(none)
        assert members.count() == edges.count() == 0


def test_three_variants_have_three_links(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(["x" if i == at else w for i, w in enumerate(words)]) for at in (3, 90, 180)]
    members, edges = jaccard_join.join_links(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"))
    assert edges.count() == 3 and {r.n_links for r in members.collect()} == {2}


def test_regions_lose_no_link():
    """Two sets that link always meet in a region in which one of them lives."""
    import numpy as np

    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = []
    for _ in range(150):
        keep = base[rng.random(200) > rng.uniform(0, 0.9)]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 60, rng.integers(1, 60)).astype(np.uint64)])))
    regions = jaccard_join.Regions()
    regions.divide(0, sets[:6])
    regions.divide(2, sets[6:9])
    regions.ready()
    homes = [regions.of(s) for s in sets]
    for i, a in enumerate(sets):
        assert sum(lives for _, lives in homes[i]) == 1
        for j in range(i):
            assert jaccard_join.may_link(*[x for s in (a, sets[j]) for x in (jaccard_join.signature(s), len(s))]) or not jaccard_join.links(a, sets[j])
            if jaccard_join.links(a, sets[j]):
                home = next(r for r, lives in homes[i] if lives)
                assert home in {r for r, _ in homes[j]}


def test_keep_one(odd, odd_rows):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    sets = [brute.shingles(t) for _, t in odd_rows]
    roots = brute.components(sets)
    groups = {r for r, s in zip(roots, sets) if s}
    blank = {(i, t) for (i, t), s in zip(odd_rows, sets) if not s}
    got = kept.collect()
    assert len(got) == len(groups) + len(blank)
    by_row = {(i, t): r for (i, t), r, s in zip(odd_rows, roots, sets) if s}
    assert {by_row[(r.doc_id, r.text)] for r in got if (r.doc_id, r.text) in by_row} == groups


def test_keep_one_does_not_depend_on_the_order(spark):
    docs = [(1, "a b c d e f", n) for n in range(20)] + [(2, "x y z u v w", 3)]
    kind = "doc_id long, text string, other int"
    kept = [
        sorted(map(tuple, jaccard_join.keep_one(spark.createDataFrame(d, kind).repartition(n)).collect()))
        for d, n in ((docs, 3), (docs[::-1], 5), (docs[::2] + docs[1::2], 1))
    ]
    assert len(kept[0]) == 2 and kept[0] == kept[1] == kept[2]


# 9 toxicity


def test_toxicity(spark, odd, labels, none, no_labels):
    import zlib

    got = toxicity.toxicity_report(odd, labels).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert {r.score for r in toxicity.toxicity_report(odd, no_labels).collect()} == {0.5}
    assert toxicity.toxicity_report(none, no_labels).count() == 0


def test_training_equals_a_plain_one(monkeypatch):
    """Per-coordinate rates and L1: weights as one coordinate after the other gives them."""
    import random

    import numpy as np

    rng = random.Random(2)
    monkeypatch.setattr(toxicity, "L1", 0.7)
    data = []
    for _ in range(300):
        slots = sorted(rng.sample(range(64), rng.randrange(9)))
        data.append((slots, int(bool({3, 9} & set(slots)) != (rng.random() < 0.1))))
    slots, weights, bias = toxicity.train(((np.array(s, np.int64), y) for s, y in data), bits=6)
    expected, plain_bias = brute.ftrl(data, 6, toxicity.EPOCHS, toxicity.ALPHA, toxicity.BETA, 0.7, toxicity.L2)
    assert bias == pytest.approx(plain_bias) and 0 < len(expected) < 64
    assert dict(zip(slots.tolist(), weights.tolist())) == pytest.approx(expected)


def test_toxicity_learns(spark):
    documents, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_report(documents, marks).filter("held_out").join(marks, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in got)
    assert hits / sum(r.predicted for r in got) > 0.9
    assert hits / sum(r.toxic for r in got) > 0.75


def test_weights_are_sparse(spark):
    documents, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    slots, weights, _ = toxicity.fit(documents, marks)
    assert 0 < len(slots) < 20_000 and len(slots) == len(weights)


# 10 Order MinHash


def _prints(docs):
    texts = [(i, t or "") for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))]
    sketch = lambda t: order_minhash.fingerprint(order_minhash._points(t))
    out = Counter()
    own = [sketch(t) for _, t in texts]
    for k, ((i, t), (_, e)) in enumerate(zip(texts, brute.edited(texts))):
        other = sketch(e)
        out[(i, len(t), brute.sha(e), order_minhash._hex(own[k]), order_minhash._hex(other),
             float((own[k] == other).mean()), float((own[k] == own[(k + 1) % len(own)]).mean()))] += 1
    return out


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.parametrize("per_range", [5, 1000])
def test_order_minhash(odd, odd_rows, none, monkeypatch, per_range):
    monkeypatch.setattr(order_minhash, "RANGE_DOCS", per_range)
    assert rows(order_minhash.order_minhash(odd), *COLUMNS) == _prints(odd_rows)
    assert order_minhash.order_minhash(none).count() == 0


def test_order_minhash_of_wide_ids(spark, monkeypatch):
    """Ids that no double holds: no range loses its last document."""
    monkeypatch.setattr(order_minhash, "RANGE_DOCS", 5)
    ids = [2**62 + 3 * i + 1 for i in range(60)] + [-(2**61) - 5 * i - 1 for i in range(60)] + [2**63 - 1, -(2**63)]
    docs = [(i, f"text number {n} of these") for n, i in enumerate(ids)] + [(None, "b"), (None, "a")]
    got = order_minhash.order_minhash(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert rows(got, *COLUMNS) == _prints(docs)


@pytest.mark.parametrize("texts", [["only"], [None], ["b", "a", None, "a", "longer text"]])
def test_order_minhash_without_ids(spark, texts):
    docs = [(None, t) for t in texts]
    got = order_minhash.order_minhash(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got, *COLUMNS) == _prints(docs)


def test_order_minhash_small(spark, small):
    assert rows(entry.queries()["op10_order_minhash"](spark, SMALL), *COLUMNS) == _prints(small)


def test_fingerprint_follows_order():
    import random

    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(40)]
    text, near = "".join(parts), "".join(parts[:38] + parts[:2])
    shuffled = "".join(rng.sample(parts, 40))
    sketch = lambda t: order_minhash.fingerprint(order_minhash._points(t), sketches=256)
    like = lambda a, b: (sketch(a) == sketch(b)).mean()
    assert like(text, text) == 1 and like(text, near) > 0.7 > 0.6 > like(text, shuffled)
    assert like("", "") == 1 and like("abc", "abc") == 1 and like("abc", "abd") == 0


def test_fingerprint_equals_a_plain_one():
    import random

    rng = random.Random(5)
    texts = ["", "a", "abcdefg", "abcdefgh", "aaaaaaaaaaaaaaaa", "ab" * 40, "é中文\U0001f600" * 9]
    texts += ["".join(rng.choice("abc ") for _ in range(rng.randrange(200))) for _ in range(40)]
    texts.append("".join(rng.choice("abcdefgh ") for _ in range(order_minhash.BLOCK + 500)))  # more than one block
    for text in texts:
        assert order_minhash.fingerprint(order_minhash._points(text)).tolist() == brute.order_minhash(text)


def test_occurrences():
    import numpy as np

    kmers = np.array([5 << 40, 7 << 40, 5 << 40, 5 << 40, 9 << 40, 7 << 40], np.uint64)
    assert order_minhash.occurrences(kmers).tolist() == [0, 0, 1, 2, 0, 1]


def test_line_keys_lower_a_to_z_alone(spark):
    lines = [" \tPlain LINE \r", "ÉTÉ Straße İI \u212a\xa0", "", "\x0b\x0c", "\xa0X\xa0", "A\tB"]
    df = spark.createDataFrame([(lines,)], "lines array<string>").select(line_dedup.line_keys(F.col("lines")))
    upper = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
    assert df.collect()[0][0] == [line.strip(" \t\n\x0b\x0c\r").translate(upper) for line in lines]
