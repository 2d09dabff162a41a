import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M


def tokens(text):
    return len((text or "").encode().split())


def share(children, budget):
    """{name: (supply, weight)} -> {name: tokens}, one child after the other."""
    out, left, open_ = {}, budget, dict(children)
    for name in sorted(children, key=lambda n: (children[n][0] / children[n][1], n)):
        supply, w = children[name]
        if supply * sum(x[1] for x in open_.values()) <= w * left:
            out[name] = supply
            left -= supply
            del open_[name]
        else:
            break
    total = sum(x[1] for x in open_.values())
    return out | {n: left * w // total for n, (_, w) in open_.items()}


def brute(rows, weights, fraction, epochs, seed):
    leaves, of = defaultdict(list), {}
    for i, r in enumerate(rows):
        source, lang = r[3] or "", r[2] or ""
        of[i] = (f"domain{zlib.crc32(source.encode()) % 4}", lang, source)
        leaves[of[i]].append(i)
    n = {leaf: sum(tokens(rows[i][1]) for i in members) for leaf, members in leaves.items()}
    w = lambda level, name: weights[level].get(name, 1)
    supply = lambda prefix: sum(n[x] for x in n if x[: len(prefix)] == prefix) * epochs
    out = {}
    top = share({d: (supply((d,)), w("domain", d)) for d in {x[0] for x in n}}, sum(n.values()) * fraction[0] // fraction[1])
    for d, b in top.items():
        for lang, c in share({x: (supply((d, x)), w("lang", x)) for x in {y[1] for y in n if y[0] == d}}, b).items():
            for s, a in share({x: (supply((d, lang, x)), w("source", x)) for x in {y[2] for y in n if y[:2] == (d, lang)}}, c).items():
                leaf = (d, lang, s)
                whole, part = divmod(a, n[leaf]) if n[leaf] else (0, 0)
                total = 0
                key = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()  # noqa: B023, E731
                for i in sorted(leaves[leaf], key=key):
                    total += tokens(rows[i][1])
                    out[i] = whole + (total <= part)
    return sorted([(rows[i][0], *of[i], tokens(rows[i][1]), c) for i, c in out.items()], key=repr)


@pytest.mark.parametrize("fraction,epochs,digits", [((3, 4), 2, 3), ((1, 3), 1, 1), ((1, 1), 1, 3), ((3, 1), 2, 1)])
def test_against_plain_budgets(docs, odd_docs, fraction, epochs, digits):
    got = M.mix(docs, share=fraction, epochs=epochs, digits=digits).collect()
    got = sorted([(r.doc_id, r.domain, r.lang, r.source, r.tokens, r.copies) for r in got], key=repr)
    assert got == brute(odd_docs, M.WEIGHTS, fraction, epochs, 17)


def test_a_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("a", "x", "s1", 10, 1), ("a", "x", "s2", 100, 1), ("a", "y", "s3", 100, 1), ("b", "x", "s4", 1000, 1)]
    leaves = spark.createDataFrame([r[:4] for r in rows], "domain string, lang string, source string, tokens long")
    given = {r.source: r.given for r in M.budgets(leaves, {"domain": {}, "lang": {}, "source": {}}, (200, 1210), 1).collect()}
    # 100 for each domain; 50 for each language of a; s1 lacks 15, which s2 gets
    assert given == {"s1": 10, "s2": 40, "s3": 50, "s4": 100}
    given = {r.source: r.given for r in M.budgets(leaves, {"domain": {}, "lang": {}, "source": {}}, (600, 1210), 1).collect()}
    assert given == {"s1": 10, "s2": 100, "s3": 100, "s4": 390}  # what all of a lacks goes to b


def test_rows_stand_as_often_as_told(clashing, odd_docs):
    want = defaultdict(int)
    for r in brute(odd_docs, M.WEIGHTS, (3, 1), 2, 17):
        want[r[0]] += r[-1]
    out = M.mixed_rows(clashing, share=(3, 1))
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert out.columns == clashing.columns and dict(got) == {k: v for k, v in want.items() if v}


def test_empty(empty):
    assert M.mix(empty).count() == 0 and M.mixed_rows(empty).count() == 0


def test_weights_hold_where_supply_allows(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("five words are in here").alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"), F.lit("src0").alias("source"))
    got = {r.lang: r.n for r in M.mix(df, share=(1, 4)).groupBy("lang").agg(F.sum(F.col("copies") * F.col("tokens")).alias("n")).collect()}
    assert got["en"] == pytest.approx(20000 / 4 * 8 / 12, abs=5) and got["de"] == pytest.approx(20000 / 4 * 4 / 12, abs=5)
