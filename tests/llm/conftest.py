import random

import pytest

SMALL = "/root/testdata/sf0.001"
VOCABULARY = ["alpha", "Beta", "gamma,", "delta", "über", "ñandú", "zeta!", "eta", "theta", "Iota", "中文", "kappa", "λ"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, blanks, repeats, ties, shared passages, hot copies and a long text."""
    rng = random.Random(5)
    passage = "\n".join(prose(rng, 12) for _ in range(6))
    base = prose(rng, 120).split()
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two three"), (6, "one  TWO\tthree"),
        (7, passage), (8, passage.upper()), (9, prose(rng, 30) + "\n" + passage), (10, "x" * 3000),
        (11, "same line again here\nsame line again here\nother"), (12, "same line again here"),
        (13, prose(rng, 20_000)), (14, "<|endoftext|> a<|startoftext|>b  c <s>d</s>"),
        (15, " \x85  café \U0001f600"), (None, passage), (None, None),
    ]
    for k in range(16, 60):  # near copies of one text, at different distances
        copy = list(base)
        for _ in range(rng.randrange(12)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(1000)}"
        rows.append((k, " ".join(copy)))
    rows += [(60 + k, " ".join(base)) for k in range(25)]
    rows += [(90, prose(rng, 60)), (90, prose(rng, 60)), (91, rows[6][1]), (91, rows[6][1])]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows as documents with columns that operators might use themselves."""
    rows = [(i, t, "s" if n % 3 else None, n, "x", 1.5, t) for n, (i, t) in enumerate(odd_rows)]
    kind = "doc_id long, text string, source string, n long, row string, score double, key string"
    return spark.createDataFrame(rows, kind).repartition(7)


@pytest.fixture(scope="session")
def labels(spark, odd_rows):
    rows = [(i, n % 2, int(n % 7 == 0)) for n, (i, _) in enumerate(odd_rows)] + [(1, None, None), (1, 5, 5)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, n long")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows]
