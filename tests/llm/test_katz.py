import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import katz
from tidemark.llm.katz import K, discounts


def is_train(k):
    return k is None or zlib.crc32(str(k).encode()) % 5 != 1


def train():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))


class Plain:
    """The model, token by token."""

    def __init__(self, rows, order):
        self.order = order
        self.texts = [(r[0], (r[1] or "").encode().lower().split() + [2]) for r in rows]
        self.counts = {m: Counter() for m in range(1, order + 1)}
        for k, t in self.texts:
            if is_train(k):
                for m in self.counts:
                    self.counts[m].update(self.grams(t, m))
        self.d = {m: discounts([0] + [sum(v == i for v in c.values()) for i in range(1, K + 2)]) for m, c in self.counts.items()}
        self.N = sum(self.counts[1].values())
        self.unknown = max(1e-12, 1 - sum(self.kept(c, 1) for c in self.counts[1].values()) / self.N)
        self.followers = defaultdict(dict)
        for m in range(2, order + 1):
            for g, c in self.counts[m].items():
                self.followers[g[:-1]][g[-1]] = c
        self.alpha = {}
        for h in sorted(self.followers, key=len):
            f = self.followers[h]
            self.alpha[h] = (1 - sum(self.p(h, w) for w in f)) / (1 - sum(self.p(h[1:], w) for w in f))

    @staticmethod
    def grams(t, m):
        padded = [1] * (m - 1) + t
        return [tuple(padded[i : i + m]) for i in range(len(t))]

    def kept(self, c, m):
        return c * self.d[m][c] if c <= K else c

    def p(self, h, w):
        if not h:
            c = self.counts[1][(w,)]
            return self.kept(c, 1) / self.N if c else self.unknown
        f = self.followers.get(h, {})
        if w in f:
            return self.kept(f[w], len(h) + 1) / (sum(f.values()) + all(c > K for c in f.values()))
        return (self.alpha[h] if f else 1) * self.p(h[1:], w)

    def rows(self):
        V = len(self.counts[1])
        for k, t in self.texts:
            score = sum(math.log10(self.p(g[:-1], g[-1])) for g in self.grams(t, self.order))
            one = [self.counts[1][(w,)] for w in t]
            yield k, not is_train(k), len(t), sum(c > 0 for c in one), self.N, sum(math.log10((c + 0.5) / (self.N + 0.5 * (V + 1))) for c in one), score


def told(model):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in model.scores().collect()), key=repr)


def same(got, want, rel):
    got, want = (sorted(x, key=lambda r: (repr(r[0]), r[2], r[3], round(r[6], 4))) for x in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=rel)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("options", [{}, {"bucket_tokens": 100, "window_tokens": 500}])
def test_against_a_plain_model(docs, odd_docs, order, options):
    plain = Plain(odd_docs, order)
    same(told(katz.Katz(docs, train(), order=order, **options)), list(plain.rows()), 1e-8)
    for h in list(plain.followers)[:: max(1, len(plain.followers) // 50)]:  # exactly normalised, unknown words being one class
        whole = sum(plain.p(h, w) for (w,) in plain.counts[1]) + plain.p(h, b"never seen")
        assert whole == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_the_model_is_a_function_of_the_data(spark, sf_dir, order):
    """Partitions, windows and buckets, and so which contexts are spread, change nothing."""
    docs, was, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions, window in (("4", 1_000_000), ("64", 5000), ("200", 20_000)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append(told(katz.Katz(docs.repartition(3), train(), order=order, window_tokens=window)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    same(found[1], found[0], 1e-9)
    same(found[2], found[0], 1e-9)


@pytest.mark.parametrize("bucket_tokens", [1_000_000, 50])
def test_the_stored_tables(docs, odd_docs, bucket_tokens):
    model, plain = katz.Katz(docs, train(), order=3, bucket_tokens=bucket_tokens), Plain(odd_docs, 3)
    model.fit()
    for m in (1, 2, 3):
        assert Counter(r["count"] for r in model.ngrams(m).collect()) == Counter(plain.counts[m].values())
        per_bucket = model.ngrams(m).groupBy("context", "word").agg(F.count_distinct("bucket").alias("n")).agg(F.max("n")).first()[0]
        assert per_bucket == 1
    for m in (2, 3):
        got = sorted((r["count"], round(r.log_alpha, 6)) for r in model.contexts(m).collect())
        want = sorted((sum(f.values()), round(math.log10(plain.alpha[h]), 6)) for h, f in plain.followers.items() if len(h) == m - 1)
        assert len(got) == len(want) and all(g[0] == w[0] and abs(g[1] - w[1]) < 1e-5 for g, w in zip(got, want))


def test_clashing_columns(clashing, docs):
    same(told(katz.Katz(clashing, train())), told(katz.Katz(docs, train())), 1e-12)


def test_discounts():
    d = discounts([0, 1000, 300, 150, 90, 60, 40])
    assert d[0] == 1 and all(0 < x <= 1 for x in d) and d[1] < d[2] < d[3]
    assert discounts([0, 10, 0, 0, 0, 0, 0]) == [1.0, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]


def test_held_out_text_is_more_likely_than_by_single_tokens(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    r = katz.Katz(docs, train()).scores().where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_without_training_rows_and_empty(docs, empty, odd_docs):
    out = katz.Katz(docs, F.lit(False)).scores().collect()
    assert len(out) == len(odd_docs) and all(r.train_tokens == 0 and r.n_known == 0 for r in out)
    assert katz.Katz(empty, train()).scores().count() == 0
