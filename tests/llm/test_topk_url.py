import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk, url_filter
from tidemark.llm.common import BlockedBloom


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))


def brute(rows, k):
    whole = [(i, [min(max(math.floor(64 * float(np.float32(x))), topk.LOWEST), topk.HIGHEST) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in {i for i, _ in whole if i % 5 == 0}:
        own = min((v, n) for n, (j, v) in enumerate(whole) if j == i)[1]
        q = whole[own][1]
        scores = sorted((-min(max(sum(a * b for a, b in zip(q, v)), topk.LOWEST), topk.HIGHEST), j) for n, (j, v) in enumerate(whole) if n != own and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"dims_per_block": 3, "rows_per_block": 7, "cell": (20, 5)}, {"cell_bytes": 24 * 8 * 30}])
def test_top_k_against_brute_force(spark, options):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(24)], 0) for i in range(120)]
    rows += [(200 + i, rows[0][1], 0) for i in range(30)]  # ties
    rows += [(300, None, 0), (305, [1.0, None] * 12, 0), (310, [float("nan")] * 24, 0), (315, [float("inf")] * 24, 0), (None, rows[1][1], 0), (320, [1.0, 2.0], 0), (321, [3.0, 4.0], 0), (325, [], 0)]
    rows += [(0, rows[0][1], 0), (0, rows[3][1], 0), (7, rows[8][1], 0), (7, rows[8][1], 0), (330, rows[5][1], 0), (330, rows[5][1], 0)]  # ids that come again
    df = vectors(spark, rows)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=20, **options)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


@pytest.mark.parametrize("size", [1e6, 1e12, 1e30])
def test_large_components(spark, size):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, size if i % 3 else 1) for _ in range(8)], 0) for i in range(60)] + [(100 + i, [size * (1 if i % 2 else -1), *[0.0] * 6, float(i)], 0) for i in range(10)]
    df = vectors(spark, rows)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=7, dims_per_block=2, rows_per_block=9)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7)


def test_top_k_of_few_and_none(spark):
    df = vectors(spark, [(0, [1.0], 0), (5, [2.0], 0)])
    assert sorted(map(tuple, topk.top_k(df, F.lit(True), k=20).collect())) == [(0, 1, 5, 64 * 128), (5, 1, 0, 64 * 128)]
    assert topk.top_k(df, F.lit(False)).count() == 0 and topk.top_k(df.where("1 = 0"), F.lit(True)).count() == 0
    twice = vectors(spark, [(0, [1.0], 0), (0, [1.0], 0), (2, [3.0], 0), (3, [2.0], 0)])
    assert [tuple(r) for r in topk.top_k(twice, F.col("vec_id") == 0, k=3).orderBy("rank").collect()] == [(0, 1, 2, 64 * 192), (0, 2, 3, 64 * 128), (0, 3, 0, 64 * 64)]


def test_branch_and_bound_prunes():
    rnd = np.random.default_rng(0)
    rows = np.floor(rnd.normal(size=(500, 32)) * 8).astype(np.int64)
    queries = rows[:3] * 4  # near their own rows
    blocks = [slice(i, i + 8) for i in range(0, 32, 8)]
    best, own, uids = topk.Best(3, 5), np.arange(3) + 1000, np.arange(500)
    topk.search(best, queries, own, rows[:100], uids[:100], uids[:100], blocks)
    reached = topk.search(best, queries, own, rows[100:], uids[100:], uids[100:], blocks)
    exact = queries @ rows.T
    assert np.array_equal(best.scores, -np.sort(-exact, axis=1)[:, :5]) and reached < 400 * 3 / 2


URLS = [
    ("http://a.example.net/en/1", "example.net/en/", "allow"), ("https://EXAMPLE.net/de/x", "net/", "block"), ("http://example.com/de/1?x#y", "example.com/de/", "block"),
    ("http://notexample.com/de/1", None, "allow"), ("http://x.org/fr/a", "org/fr/", "allow"), ("http://x.org/fr", None, "allow"), ("http://x.net", None, "allow"), (None, None, "allow"),
    ("no scheme", None, "allow"), ("http://h.com/p?utm_source=a&b=1", None, "allow"), ("https://www.h.com/p/?b=1&ref=x#top", None, "block"), ("http://h.com/p", None, "allow"),
]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, None) for i, (u, _, _) in enumerate(URLS)], "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    out = {r.page_id: r for r in url_filter.filter_urls(pages, url_filter.repeated(pages)).collect()}
    assert [(out[i].rule, out[i].verdict) for i in range(len(URLS))] == [(r, v) for _, r, v in URLS]
    assert (out[1].host, out[1].path) == ("example.net", "/de/x") and (out[6].host, out[6].path) == ("x.net", "") and (out[7].host, out[8].path) == ("", "")
    none = pages.where("1 = 0")
    assert url_filter.filter_urls(none, url_filter.repeated(none)).count() == 0
    assert url_filter.filter_urls(pages, url_filter.repeated(none)).where("listed").count() == 0


def test_an_overfull_bloom_filter_changes_nothing(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.de/"), (F.col("id") % 1700).cast("string")).alias("url"))
    listed = url_filter.repeated(pages)
    small, large = (sorted(map(tuple, url_filter.filter_urls(pages, listed, bloom_blocks=b).collect())) for b in (1, 1 << 14))
    assert small == large and sum(r[-1] == "block" for r in small) == 1300


def test_bloom_passes_every_key_and_few_others(spark):
    bloom = BlockedBloom(1 << 12)
    keys = spark.range(10_000).select(F.col("id").alias("k"))
    rows = spark.range(20_000).select(F.col("id").alias("k"))
    held = bloom.may_hold(rows, bloom.build(keys, "k"), "k")
    assert held.where("k < 10000").count() == 10_000 and held.where("k >= 10000").count() < 500
    assert bloom.may_hold(rows, bloom.build(keys, "k"), "k", keep=False).count() + held.count() == 20_000


def test_the_filter_grows_with_its_keys(spark):
    """At four million keys under 2 % of others pass, in 8 MB; the bound is 64 MB."""
    bloom = BlockedBloom()
    filled = bloom.build(spark.range(4_000_000).select(F.concat(F.lit("key"), "id").alias("k")), "k")
    assert bloom.blocks == 1 << 20 and filled.select(F.size("bloom")).first()[0] == bloom.blocks
    held = lambda first, n: bloom.may_hold(spark.range(first, first + n).select(F.concat(F.lit("key"), "id").alias("k")), filled, "k").count()
    assert held(3_900_000, 100_000) == 100_000 and held(5_000_000, 100_000) < 2000
    assert [BlockedBloom().sized(n) for n in (0, 1, 1 << 14, (1 << 14) + 1, 1 << 40)] == [1 << 12, 1 << 12, 1 << 12, 1 << 13, 1 << 23]


def test_most_pairs_fall_away_before_the_last_block(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", topk.quantised(F.col("embedding")).alias("v")).where("v IS NOT NULL").collect()
    ids, c = np.array([r.vec_id for r in rows]), np.array([r.v for r in rows])
    asking = ids % 20 == 0
    blocks = [slice(b, b + 16) for b in range(0, c.shape[1], 16)]
    best, reached = topk.best_of(c[asking], ids[asking], c, ids, ids, blocks, 20, 1024)
    assert reached < 0.5 * asking.sum() * len(c)
    scores = c[asking] @ c.T
    scores[ids[asking][:, None] == ids[None, :]] = -(10**12)
    assert (best.scores == -np.sort(-scores, axis=1)[:, :20]).all()
