import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence as D

from .conftest import SCHEMA, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, add=5, scale=10**9, ranks=50):
    """Term by term, over every term of a language for every two of its sources."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = Counter()
        for s in own:
            total.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)  # noqa: B023
            return {t: 1 + scale * (c[t] + add) // (n + add * len(kept)) for t in kept}  # noqa: B023

        q, p = shares(total), {s: shares(counts[lang, s]) for s in own}
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[x][t]) for t in kept), x.encode()) for x in own if x != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:ranks]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def told(df):
    assert df.dtypes == [(c, "string") for c in ("lang", "source", "part", "item")] + [("value", "bigint"), ("rank", "int")]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("least,shards,add,ranks", [(2, 1, 5, 50), (2, 7, 5, 3), (1, 3, 2, 50), (4, 8, 1, 1)])
def test_against_brute_force(docs, odd_docs, least, shards, add, ranks):
    assert told(D.divergence(docs, least=least, shards=shards, add=add, ranks=ranks)) == brute(odd_docs, least, add, ranks=ranks)


def test_uneven_sources(spark):
    """A source with a third of all rows, one without terms, sources that share no term, languages without frequent terms."""
    rnd = random.Random(4)
    rows = [(i, prose(rnd, 12), "en", "hot", 1) for i in range(60)] + [(100 + i, prose(rnd, 9, ["one", "two", "\u00dcber", "\u65e5\u672c"]), "en", f"s{i % 5}", 1) for i in range(50)]
    rows += [(200, "123 ... 45", "en", "digits", 1), (201, None, "xx", None, 1), (202, "rare words", "xx", "a", 1), (203, "", None, "only", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for least in (30, 5):
        got = told(D.divergence(df, least=least, shards=4))
        assert got == brute(rows, least) and ("xx", "", "pair", "a", 0, 1) in got
    assert told(D.divergence(df.repartition(13), least=5, shards=2)) == brute(rows, 5)


def test_large_counts(spark):
    """Where a count times the scale needs more than 64 bits."""
    rows = [(i, "a " * 200_000 + "b " * i, "en", f"s{i % 2}", 1) for i in range(4)]
    assert told(D.divergence(spark.createDataFrame(rows, SCHEMA), least=2, scale=10**15)) == brute(rows, 2, scale=10**15)


def test_long_texts_in_parts():
    text = ("Word and\u00e9 " * 500 + "x" * 5000 + " end").encode()
    for most in (1, 7, 100, 4096, 10**6):
        parts = list(D.pieces(text, most))
        assert b"".join(parts) == text
        assert sum((Counter(p.translate(D.TERM_BYTES).split()) for p in parts), Counter()) == Counter(text.translate(D.TERM_BYTES).split())


def test_windows_of_any_size(odd_docs):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in odd_docs], pa.string()) for i in (2, 3, 1)], ["lang", "source", "text"])
    sums = []
    for most in (1, 50, 10**6):
        found = Counter()
        for b in D.occurrences(iter([batch]), most):
            for r in b.to_pylist():
                found[r["lang"], r["source"], r["term"], "n"] += r["n"]
                found[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        sums.append(found)
    assert sums[0] == sums[1] == sums[2]


def test_empty_and_clashing(clashing, empty, odd_docs):
    assert told(D.divergence(empty)) == []
    more = clashing.withColumn("term", F.lit("x")).withColumn("n", F.lit(1)).withColumn("shard", F.lit(2)).withColumn("part", F.lit("p")).withColumn("value", F.lit(0))
    assert told(D.divergence(more, least=2)) == brute(odd_docs, 2)
