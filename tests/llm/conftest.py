import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rnd, n, words=WORDS):
    out = []
    for i in range(n):
        w = rnd.choice(words)
        out.append(w.capitalize() + "." if rnd.random() < 0.1 else w)
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names operators use inside."""
    rnd = random.Random(5)
    base = prose(rnd, 120)
    rows = [(1, base, "en", "src0", 1), (2, base, "en", "src0", 1), (3, base.replace("alpha", "alpha ", 1), "de", "src1", 1), (4, base + " omega", "en", None, None)]
    rows += [(5, None, None, None, None), (6, "", "en", "src0", 0), (7, " \t\n", "en", "src0", 3), (8, prose(rnd, 30_000), "fr", "src2", 1), (9, "x" * 50_000, "es", "src2", 1)]
    rows += [(10, prose(rnd, 60), "de", "src3", 1)] * 2 + [(None, "One text without an id. It has two sentences.", "en", "src0", 1), (None, None, None, None, None)]
    rows += [(20 + i, prose(rnd, 40 + i), ["en", "de", "fr", None][i % 4], f"src{i % 5}", i) for i in range(20)]
    rows += [(50, "!!! 123 ...", "en", "src0", 1), (51, "Ünïcödé “quotes” and 日本語 text", None, "src1", 1), (52, "word", "en", "src1", 4)]
    return rows


@pytest.fixture
def docs(spark, odd_docs):
    return spark.createDataFrame(odd_docs, SCHEMA)


@pytest.fixture
def clashing(docs):
    """The same with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    for name in ("digest", "place", "tokens", "rank", "score", "kept", "uid", "key", "id", "domain", "n_removed", "starts", "_h", "hash", "row", "words", "of"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
