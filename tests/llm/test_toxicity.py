import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, toxicity as T

from .conftest import SCHEMA, prose
from .test_divergence import LOWER, TERM

INSULTS = ["vilelump", "grimsot", "ñoñazo"]


def plain_terms(text):
    """Words, stems (the first five characters of longer words) and how many words there are."""
    words = TERM.findall((text or "").translate(LOWER))
    return Counter(words), Counter("^" + w[:5] for w in words if len(w) > 5), len(words)


def plain_vectors(texts, terms, df, total):
    """Dense TF-IDF vectors of length 1; the last place is that of all other words."""
    out = np.zeros((len(texts), len(terms) + 1))
    for i, text in enumerate(texts):
        words, stems, n = plain_terms(text)
        for j, t in enumerate(terms):
            c = (stems if t.startswith("^") else words)[t]
            if c:
                out[i, j] = (1 + math.log(c)) * (1 + math.log((1 + total) / (1 + df[t])))
        rest = n - sum(words[t] for t in terms if not t.startswith("^"))
        if rest:
            out[i, -1] = 1 + math.log(rest)
        size = math.sqrt((out[i] ** 2).sum())
        if size:
            out[i] /= size
    return out


def plain_vote(cosines, labels, weights, k, prior, but=None):
    cosines = np.round(cosines, 9)
    own = [(c, i) for i, c in enumerate(cosines) if i != but]
    last = sorted((c for c, _ in own), reverse=True)[: k][-1]
    near = [i for c, i in own if c >= last]
    w = cosines[near] ** 2 * weights[near]
    return float(np.clip(((w * labels[near]).sum() + 0.5 * prior) / (w.sum() + 0.5), 1e-9, 1 - 1e-9)), near


@pytest.fixture(scope="module")
def corpus():
    """(documents, labels): toxic ones hold insults, whole or as the start of longer words; some labels are wrong."""
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        text, toxic = prose(rnd, rnd.randrange(20, 120)), int(rnd.random() < 0.2)
        if toxic:
            words = text.split()
            for _ in range(rnd.randrange(1, 6)):
                words[rnd.randrange(len(words))] = rnd.choice(INSULTS) + rnd.choice(["", "", "s", "mente"])
            text = " ".join(words)
        rows.append((i, text, "en", "src0", 1))
        if i % 4:
            labels.append((i, 1 - toxic if rnd.random() < 0.03 else toxic))
    return rows, labels


def tables(spark, corpus):
    return spark.createDataFrame(corpus[0], SCHEMA), spark.createDataFrame(corpus[1], "doc_id long, toxic int")


def test_index_against_all_cosines():
    rnd = np.random.default_rng(2)
    vectors = []
    for _ in range(500):
        at = np.sort(rnd.choice(40, rnd.integers(0, 6), replace=False))
        w = rnd.integers(1, 4, len(at)).astype(float)  # many are equal
        vectors.append((at, w / np.sqrt((w * w).sum()) if len(w) else w))
    dense = np.zeros((500, 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for block in (1, 7, 64, 1000):
        index = T.BlockMaxIndex(vectors, 40, block)
        for q in range(0, 500, 9):
            for k, but in ((1, None), (10, q), (600, None)):
                at, w = vectors[q]
                cosines = np.round(dense @ dense[q], 9)
                if but is not None:
                    cosines[but] = -1
                last = max(np.sort(cosines)[::-1][: min(k, 500)][-1], 0)
                want = {i: c for i, c in enumerate(cosines) if c >= last}
                examples, got = index.nearest(at, w, k, but)
                got = dict(zip(examples.tolist(), got.tolist()))
                assert set(got) == set(want)  # ties with the last one are all there
                assert all(got[i] == pytest.approx(want[i], abs=2e-9) for i in want)


def test_blocks_are_passed_over():
    """Of groups of similar vectors only some blocks have to be looked at."""
    rnd = np.random.default_rng(5)
    vectors = []
    for _ in range(4000):
        at = np.array([rnd.integers(0, 50), 50 + rnd.integers(0, 50)])
        w = rnd.random(2) + 0.5
        vectors.append((at, w / np.sqrt((w * w).sum())))
    index = T.BlockMaxIndex(vectors, 100)
    for q in range(100):
        index.nearest(*vectors[q], 15)
    assert index.looked_at < 100 * index.blocks / 3


def test_query_against_brute_force(spark, corpus):
    """Vectors, all cosines, votes and the curve by plain code over the judge's terms, and the terms by plain counts."""
    docs, labels = tables(spark, corpus)
    judge = T.train(docs, labels, k=7)
    text_of, label_of = {r[0]: r[1] for r in corpus[0]}, dict(corpus[1])
    assert sorted(judge.ids) == sorted(label_of)
    n1 = sum(label_of.values())
    n, share = len(label_of), n1 / len(label_of)
    held, with_one, df = Counter(), Counter(), Counter()
    for i, text in text_of.items():
        words, stems, _ = plain_terms(text)
        for t in {*words, *stems}:
            df[t] += 1
            held[t] += i in label_of
            with_one[t] += label_of.get(i, 0)
    z = {t: (with_one[t] - c * share) / math.sqrt(c * share * (1 - share) * (1 - c / n) + 1e-9) for t, c in held.items() if c >= 5}
    want = sorted((t for t in z if z[t] >= 4 and with_one[t] / n1 >= 2 * (held[t] - with_one[t]) / (n - n1)), key=str.encode)
    got = {**{w.decode(): i for w, i in judge.vocabulary.words.items()}, **{"^" + s.decode(): i for s, i in judge.vocabulary.stems.items()}}
    assert sorted(got, key=str.encode) == want and {*INSULTS, "^ñoñaz"} <= set(want)

    ids = judge.ids
    y, prior = np.array([label_of[i] for i in ids]), share
    examples = plain_vectors([text_of[i] for i in ids], want, df, len(text_of))
    weights = np.ones(len(ids))  # the sample is all there is
    votes = np.array([plain_vote(examples @ examples[j], y, weights, 7, prior, but=j)[0] for j in range(len(ids))])
    a, b = T.calibrate(votes, y, weights)
    queries_ = plain_vectors([r[1] for r in corpus[0]], want, df, len(text_of))
    rows = docs.select("doc_id", T.score(docs, judge, F.col("text")).alias("of")).collect()
    for r in rows:
        cosines = examples @ queries_[r.doc_id]
        vote, near = plain_vote(cosines, y, weights, 7, prior)
        assert r.of.score == pytest.approx(1 / (1 + math.exp(-(a * math.log(vote / (1 - vote)) + b))), rel=1e-6)
        told = sorted((-round(cosines[j], 9), ids[j]) for j in near)[:7]
        assert [x.id for x in r.of.evidence] == [i for _, i in told] and [x.label for x in r.of.evidence] == [label_of[i] for _, i in told]
        assert [x.cosine for x in r.of.evidence] == pytest.approx([-c for c, _ in told], abs=2e-9)


def test_the_curve_fits():
    """The likelihood's slope is 0 at the curve that comes back; certain votes don't make it run away."""
    rnd = np.random.default_rng(3)
    votes, weights = rnd.random(500) * 0.98 + 0.01, rnd.random(500) + 0.5
    labels = (rnd.random(500) < votes**2).astype(int)
    a, b = T.calibrate(votes, labels, weights)
    x = np.log(votes / (1 - votes))
    n1, n0 = weights[labels == 1].sum(), weights[labels == 0].sum()
    gap = weights * (1 / (1 + np.exp(-(a * x + b))) - np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)))
    assert abs((gap * x).sum() + 1e-3 * (a - 1)) < 1e-6 and abs(gap.sum() + 1e-3 * b) < 1e-6
    a, b = T.calibrate(np.array([1e-9] * 50 + [1 - 1e-9] * 50), np.array([0] * 50 + [1] * 50), np.ones(100))
    assert np.isfinite([a, b]).all() and a > 0


def test_held_out_documents_are_told_apart(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest has twelve toxic documents
    out = queries.op11_toxicity(spark, sf_dir)
    assert dict(out.dtypes) | {"evidence": 0} == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int", "evidence": 0}
    label_of = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert all(zlib.crc32(str(e.id).encode()) % 5 and label_of[e.id] == e.label for e in r.evidence)
    known = [(r.predicted, label_of[r.doc_id]) for r in rows if r.doc_id in label_of and r.held_out]
    assert np.mean([a == b for a, b in known]) > 0.95
    flagged = [y for p, y in known if p]
    assert flagged and np.mean(flagged) > 0.9


def test_learns_on_one_part_of_many_examples(spark, corpus):
    """A bounded sample of each label: few are left out where they are few, and votes stand for as many as there are."""
    docs, labels = tables(spark, corpus)
    judge = T.train(docs, labels, per_label=40)
    assert sorted(Counter(judge.labels.tolist()).items()) == [(0, 40), (1, 40)]
    toxic = sum(t for _, t in corpus[1])
    assert judge.prior == pytest.approx(toxic / len(corpus[1]))
    assert (judge.stands_for * judge.labels).sum() / judge.stands_for.sum() == pytest.approx(judge.prior)
    again = T.train(docs.repartition(7), labels.repartition(3), per_label=40)
    assert again.ids == judge.ids and again.curve == judge.curve
    rows = docs.select("doc_id", T.score(docs, judge, F.col("text")).alias("of")).collect()
    right = [(r.of.score >= 0.5) == any(x in corpus[0][r.doc_id][1] for x in INSULTS) for r in rows]
    assert np.mean(right) > 0.93  # forty examples of a label, some with wrong ones


def test_only_the_text_counts(spark, corpus):
    docs, labels = tables(spark, corpus)
    judge = T.train(docs, labels)
    of = lambda df: sorted((r.text, r.of) for r in df.select("text", T.score(df, judge, F.col("text")).alias("of")).collect())
    assert of(docs) == of(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1).repartition(5))


def test_odd_rows(spark, clashing, docs, empty, odd_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (2, 1), (None, 1), (7, 9), (8, None), (999, 1)], "doc_id long, toxic int")
    judge = T.train(clashing.withColumn("label", F.lit("x")).withColumn("term", F.lit("y")), labels)
    rows = clashing.select("*", T.score(clashing, judge, F.col("text")).alias("found")).collect()
    assert len(rows) == len(odd_docs) and all(0 <= r.found.score <= 1 for r in rows)
    scores = {}
    for r in rows:
        assert scores.setdefault(r.text, r.found.score) == r.found.score  # equal texts
        if not TERM.findall(r.text or ""):
            assert r.found.evidence == []
    assert empty.select(T.score(empty, judge, F.col("text"))).count() == 0


@pytest.mark.parametrize("label,share", [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_without_both_labels(spark, docs, label, share):
    rows = [(i, label) for i in range(60)] if label is not None else []
    judge = T.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert {(r.of.score, len(r.of.evidence)) for r in docs.select(T.score(docs, judge, F.col("text")).alias("of")).collect()} == {(share, 0)}


def test_no_term_tells(spark):
    """Equal texts with both labels: every score is about the share of label 1."""
    docs = spark.createDataFrame([(i, "the same words", "en", "s", 1) for i in range(60)], SCHEMA)
    judge = T.train(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int"))
    scores = {r.of.score for r in docs.select(T.score(docs, judge, F.col("text")).alias("of")).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(1 / 3, abs=0.1)


def test_one_id_on_many_rows(spark, corpus):
    """A third of all rows share a labelled id: one of them is an example."""
    docs, labels = tables(spark, corpus)
    many = docs.unionByName(spark.range(200).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")))
    judge = T.train(many, labels)
    assert len(judge.ids) == len(set(judge.ids)) == len(corpus[1])


def test_texts_without_end(spark, corpus):
    docs, labels = tables(spark, corpus)
    judge = T.train(docs, labels)
    long = "alpha beta " * 400_000 + "vilelump " * 20_000
    rows = spark.createDataFrame([(1, long), (2, "x" * 6_000_000)], "doc_id long, text string")
    got = {r.doc_id: r.of.score for r in rows.select("doc_id", T.score(rows, judge, F.col("text")).alias("of")).collect()}
    assert got[1] > 0.5 > got[2]
