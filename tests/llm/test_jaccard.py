import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard
from tidemark.llm.common import Scratch
from tidemark.llm.components import components

from .conftest import WORDS, prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=80):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted([(r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)], key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=repr)


def varied(rnd, base, edits):
    words = base.split(" ")
    for _ in range(edits):
        i = rnd.randrange(len(words))
        words[i : i + 1] = rnd.choice([[], [rnd.choice(WORDS)], [words[i], rnd.choice(WORDS)]])
    return " ".join(words)


@pytest.mark.parametrize("percent", [34, 50, 60, 67, 75, 81, 95, 100])
def test_any_percentage(spark, percent):
    """Sets of one to a few shingles, whose partners differ from percentage to percentage, and larger ones."""
    rnd = random.Random(percent)
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "a b c d e"), (4, "a b c d e f"), (5, "b c d e f"), (6, "x a b c d e"), (7, "a b"), (8, "A  b"), (9, "a b c")]
    for base in range(12):
        text = prose(rnd, rnd.choice([5, 6, 7, 8, 10, 30]), [f"w{i}" for i in range(60)])
        words = text.split(" ")
        rows += [(100 + 10 * base + i, " ".join(words[: len(words) - i] + [f"t{i}"] * (i % 3))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.JaccardJoin(docs, percent=percent).result()) == brute(rows, percent)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, odd_docs, seed):
    rnd = random.Random(seed)
    rows = [(r[0], r[1]) for r in odd_docs]
    many = [f"w{i}" for i in range(400)]
    for size in (3, 5, 8, 9, 12, 15, 20, 40, 90, 200):
        for _ in range(4):
            base = prose(rnd, size, many)
            rows += [(100 + len(rows) + i, varied(rnd, base, rnd.randrange(1 + size // 25))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.JaccardJoin(df).result()) == brute(rows)


def test_chains_and_common_passages(spark):
    """Neighbours are similar, ends are not; and a passage that all texts share links nothing."""
    rnd = random.Random(3)
    many = [f"w{i}" for i in range(2000)]
    words = [rnd.choice(many) for _ in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(60)]
    passage = prose(rnd, 80, many)
    rows += [(1000 + i, passage + " " + prose(rnd, 60, many)) for i in range(40)]
    out = got(jaccard.JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string")).result())
    assert out == brute(rows) and {r[2] for r in out if r[0] < 60} == {0}


@pytest.mark.parametrize("block", [512, 40])
def test_texts_of_one_template_make_few_candidates(spark, monkeypatch, block):
    """Two words changed in each row: most rows share a key with all others and are similar to none of them."""
    monkeypatch.setattr(jaccard.JaccardJoin, "BLOCK", block)
    rnd = random.Random(5)
    many = [f"w{i}" for i in range(5000)]
    base = [rnd.choice(many) for _ in range(100)]
    pairs = {}
    for n in (200, 800):
        rows = []
        for i in range(n):
            words = list(base)
            for j in rnd.sample(range(100), 2):
                words[j] = rnd.choice(many)
            rows.append((i, " ".join(words)))
        join = jaccard.JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"))
        assert got(join.result(counted=False)) == brute(rows)
        made = lambda name: spark.read.parquet(f"{join.scratch.path}/{name}").count()
        pairs[n] = made("star_pairs") + made("across_pairs")
        assert made("star_pairs") < 2 * n and made("across_pairs") < n + 2 * made("across_links")  # of n * n / 2 that meet


def test_sketches_never_hide_a_pair():
    rnd = np.random.default_rng(3)
    sets = []
    for n in (4, 31, 32, 33, 60, 200, 1000):
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        sets += [a, a[: max(4, n * 4 // 5)], np.unique(np.concatenate([a[: n * 9 // 10], rnd.integers(0, 2**63, n // 10, dtype=np.uint64)])), np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))]
    n = np.array([len(s) for s in sets])
    x, y = np.triu_indices(len(sets), 1)
    fit = 100 * np.minimum(n[x], n[y]) >= 80 * np.maximum(n[x], n[y])
    x, y = x[fit], y[fit]
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y)])
    alike = 100 * both >= 80 * (n[x] + n[y] - both)
    for rows in (pa.array([jaccard.sketch(s) for s in sets]), pa.array([b"skipped!", *(jaccard.sketch(s) for s in sets)]).slice(1)):
        passed = jaccard.may_be_similar(rows, n, x, y, 80, step=500)
        assert (passed | ~alike).all() and alike.any() and (~passed).any()
    one_counter = np.arange(300, dtype=np.uint64) << np.uint64(20)  # more than a counter holds
    rows = pa.array([jaccard.sketch(one_counter), jaccard.sketch(one_counter[:290])])
    assert jaccard.may_be_similar(rows, np.array([300, 290]), np.array([0]), np.array([1]), 80).all()


def test_light_and_heavy_keys_meet():
    rnd = np.random.default_rng(0)
    counts = np.zeros(jaccard.COUNTERS, dtype=np.uint32)
    for n in (4, 9, 10, 12, 13, 30, 80):
        for light in (4, 10, 12, 40, 1000):
            a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[: jaccard.least_overlap(n, 80)], rnd.integers(0, 2**63, max(0, n // 10), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            (ka, fa, _), (kb, fb, _) = (jaccard.signature_keys(s, counts, 80, light) for s in (a, b))
            met = any(fa[list(ka).index(k)] or fb[list(kb).index(k)] for k in set(ka.tolist()) & set(kb.tolist()))
            assert met or np.array_equal(a, b), (n, light)


def test_one_of_each_keeps_the_smallest_id(clashing, odd_docs):
    out = jaccard.one_of_each(clashing)
    assert out.columns == clashing.columns
    ids = [r.doc_id for r in out.collect()]
    assert 1 in ids and not {2, 3, 4} & set(ids) and {5, 6, 7, 50, 52} <= set(ids) and ids.count(10) == 1


def test_one_of_each_of_rows_without_ids(spark):
    rnd = random.Random(2)
    base, other = (prose(rnd, 60, [f"w{i}" for i in range(400)]) for _ in range(2))
    texts = [base, base.replace(" ", "  "), base + " more", base + " less", other]
    out = jaccard.one_of_each(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert len(out) == 2 and other in {r.text for r in out}


def test_empty(empty):
    assert jaccard.JaccardJoin(empty).result().count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_components(spark):
    rnd = random.Random(0)
    links = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)] + [(500, 500 + i) for i in range(1, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


@pytest.mark.parametrize("block", [512, 7])
def test_links_against_brute_force(spark, odd_docs, monkeypatch, block):
    """Groups of one-word edits, of which each is similar to most others, and chains; in one block and in several."""
    monkeypatch.setattr(jaccard.JaccardJoin, "BLOCK", block)
    rnd = random.Random(8)
    many = [f"w{i}" for i in range(500)]
    rows = [(r[0], r[1]) for r in odd_docs if len(r[1] or "") < 20_000]
    for size, copies in ((60, 30), (100, 20), (40, 2), (80, 3)):
        base = prose(rnd, size, many)
        rows += [(1000 + len(rows) + i, varied(rnd, base, 1)) for i in range(copies)]
    words = [rnd.choice(many) for _ in range(300)]
    rows += [(5000 + i, " ".join(words[3 * i : 3 * i + 100])) for i in range(40)]
    sets = [shingles(r[1]) for r in rows]
    different = set(filter(None, sets))
    links = {s: sum(100 * len(s & o) >= 80 * len(s | o) for o in different) - 1 for s in different}
    join = jaccard.JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"))
    told = sorted(((r.doc_id, r.n_links) for r in join.result().collect()), key=repr)
    assert told == sorted(((r[0], links.get(s, 0)) for r, s in zip(rows, sets)), key=repr)
    assert 2 * len({(r.a, r.b) for r in join.links()[1].collect()}) == sum(links.values()) == 2 * join.links()[1].count()
