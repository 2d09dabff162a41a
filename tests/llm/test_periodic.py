import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic, queries

from .conftest import SCHEMA, prose


def suffix_is_smaller(w, i, j, ascending):
    """(whether the suffix from i on is smaller than the one from j on, i != j; how many words both share)."""
    a = 0
    while max(i, j) + a < len(w) and w[i + a] == w[j + a]:
        a += 1
    return (i > j if max(i, j) + a == len(w) else (w[i + a] < w[j + a]) == ascending), a


def brute_lyndon(w, ascending):
    after, match = [], []
    for i in range(len(w)):
        found = next(((j, suffix_is_smaller(w, j, i, ascending)[1]) for j in range(i + 1, len(w)) if suffix_is_smaller(w, j, i, ascending)[0]), (len(w), 0))
        after.append(found[0])
        match.append(found[1])
    return after, match


def brute_runs(w, least, exponent):
    """Every maximal stretch for every period, those with a smaller period left out."""
    out = []
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            x = w[start : i + p]
            if len(x) >= max(least, exponent * p) and not any(all(x[k] == x[k + q] for k in range(len(x) - q)) for q in range(1, p)):
                out.append((start, len(x), p))
    return sorted(out)


def odd_texts(rnd):
    w = [rnd.randrange(rnd.choice([1, 2, 2, 3, 10])) for _ in range(rnd.randrange(1, 60))]
    kind = rnd.random()
    if kind < 0.3:
        a = rnd.randrange(len(w))
        p = rnd.randrange(1, max(2, (len(w) - a) // 3 + 1))
        return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    if kind < 0.6:
        u = w[: rnd.randrange(1, 8)]
        while len(u) < 60:
            u = u * rnd.randrange(1, 5) + w[: rnd.randrange(1, 4)]
        return u[:100]
    return w


def test_against_brute_force():
    rnd = random.Random(3)
    for _ in range(2500):
        w = odd_texts(rnd)
        for ascending in (True, False):
            after, match, matched = periodic.lyndon_array(w, ascending)
            assert (after, match) == brute_lyndon(w, ascending)
            assert sorted(matched) == [i for i, m in enumerate(match) if m]
        for least, exponent in ((2, 3), (24, 3), (5, 4)):
            assert periodic.find_runs(w, least, exponent) == brute_runs(w, least, exponent)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def nested(n):
    u, k = [0], 1
    while len(u) < n:
        u, k = u * 3 + [k], k + 1
    return u[:n]


@pytest.mark.parametrize("kind", ["one word", "fibonacci", "nested", "two words"])
def test_time_in_proportion_to_the_words(kind):
    rnd = random.Random(1)
    make = {"one word": lambda n: [b"a"] * n, "fibonacci": fibonacci, "nested": nested, "two words": lambda n: [rnd.randrange(2) for _ in range(n)]}[kind]
    took = []
    for n in (50_000, 200_000):
        w = make(n)
        began = time.process_time()
        found = periodic.find_runs(w)
        took.append(time.process_time() - began)
    assert took[1] < 8 * max(took[0], 0.05)
    if kind == "one word":
        assert found == [(0, 200_000, 1)]


def plain(rows):
    """The contract, word by word."""
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute_runs(w, 24, 3)
        dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        kept = b" ".join(x for i, x in enumerate(w) if i not in dropped)
        out.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, odd_docs, tmp_path):
    rnd = random.Random(9)
    rows = [r[:2] for r in odd_docs if len(r[1] or "") < 5000]
    rows += [(100 + i, prose(rnd, rnd.randrange(1, 300))) for i in range(300)]
    rows += [(500, "again " * 40), (501, "a b " * 12 + "c " + "a b " * 11), (502, "one\u00a0two " * 24), (503, "x y z " * 8), (504, "x y z " * 7 + "x y")]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"file://{path}")
    got = queries.op12_periodic_runs(spark, f"file://{tmp_path}")
    assert got.dtypes[1:] == [(c, "bigint") for c in ("n_runs", "start", "length", "period", "exponent_milli")] + [("runs_sha256", "string"), ("collapsed_sha256", "string")]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == plain(rows)
    assert sum(r[1] > 0 for r in got) >= 15


def test_odd_rows(clashing, empty, odd_docs):
    got = clashing.select("*", periodic.periodic_runs(F.col("text")).alias("found")).collect()
    assert len(got) == len(odd_docs)
    for r in got:
        words = (r.text or "").encode().split()
        assert r.found.n_words == len(words) and r.found.collapsed == b" ".join(words).decode() and r.found.runs == [] and r.found.best is None
    assert empty.select(periodic.periodic_runs(F.col("text"))).count() == 0


def test_long_texts(spark):
    rows = spark.createDataFrame([(1, "word " * 300_000), (2, "x" * 3_000_000), (3, " ".join(f"w{i}" for i in range(200_000)) + " end" * 30)], "doc_id long, text string")
    got = {r.doc_id: r.of for r in rows.select("doc_id", periodic.periodic_runs(F.col("text")).alias("of")).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "word"
    assert got[2].runs == [] and len(got[2].collapsed) == 3_000_000
    assert [tuple(x) for x in got[3].runs] == [(200_000, 30, 1)] and got[3].collapsed.endswith("w199999 end")


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert queries.op12_periodic_runs(spark, f"file://{tmp_path}").count() == 0
