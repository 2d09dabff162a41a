import functools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid


@pytest.fixture(scope="module")
def pieces():
    return langid.Pieces.of_file(langid.vocabulary("piece_bpe_32k.model"))


def brute_forward(names, p, word):
    """Sum over all segmentations, piece by piece."""
    index = {n: i for i, n in enumerate(names) if i > 1}

    @functools.cache
    def ways(i):
        if i == len(word):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(word) + 1):
            k = index.get(word[i:j], 1 if j == i + 1 else 0)
            total += (p[k] if k else 0) * (ways(j) if k else 0)
        return total

    return math.log(ways(0))


def test_forward_sums_all_segmentations(pieces):
    rnd = np.random.default_rng(0)
    p = rnd.random((len(pieces.names), 2)) * 1e-3 + 1e-6
    p[0] = 0
    words = ["▁the", "▁internationalisation", "▁日本", "▁a", "▁ünïcödé", "▁" + "and" * 18, "▁x" * 31, "▁" + "a" * 150, "日本語中文" * 13]
    got = langid.log_forward(pieces, p, words)
    for w, row in zip(words, got):
        for lang in range(2):
            assert row[lang] == pytest.approx(brute_forward(pieces.names, p[:, lang], w), rel=1e-9)
    for word in ("longword" * 500, "日本語中文字符" * 500):  # in parts, too, it is the same
        whole = langid.log_forward(pieces, p, [word])[0]
        in_parts = sum(langid.log_forward(pieces, p, [x])[0] for x in langid.parts(pieces, word, 100))
        assert in_parts == pytest.approx(whole, rel=1e-9) and np.isfinite(whole).all()


def test_long_texts_without_spaces(pieces):
    p = np.full((len(pieces.names), 4), 1e-5)
    p[0] = 0
    began = time.time()
    assert np.isfinite(langid.log_forward(pieces, p, ["日本語中文字符測試" * 120_000])).all()
    assert time.time() - began < 30  # over a million characters


SMALL = ["a", "b", "ab", "ba", "aba", "bb"]


def segmentations(word):
    if not word:
        yield ()
    for m in range(1, len(word) + 1):
        k = SMALL.index(word[:m]) + 2 if word[:m] in SMALL else 1 if m == 1 else 0
        if k:
            yield from ((k, *rest) for rest in segmentations(word[m:]))


@pytest.mark.parametrize("short", [60, 2])
def test_fit_against_brute_force(short, monkeypatch):
    """EM by listing every segmentation; with short = 2 most segments take the path for long ones."""
    monkeypatch.setattr(langid, "SHORT", short)
    pieces = langid.Pieces(SMALL)
    words, counts = ["ab", "abab", "xab", "bba", "bax", "ababbab"], np.array([[3.0, 0], [1, 2], [0, 1], [2, 2], [5, 1], [1, 1]])
    got = langid.fit(pieces, words, counts, 3, 0.1)
    p = np.full((8, 2), 1 / 8)
    p[0], p[1] = 0, 0.1 / 8
    for _ in range(3):
        expected = np.zeros((8, 2))
        for w, n in zip(words, counts):
            ways = [(s, np.prod(p[list(s)], axis=0)) for s in segmentations(w)]
            total = sum(x for _, x in ways)
            for s, x in ways:
                for k in s:
                    expected[k] += n * x / total
        expected[0] = 0
        expected[2:] += 0.1
        expected[1] += 0.01
        p = expected / expected.sum(axis=0)
    assert got == pytest.approx(p, rel=1e-9)


def test_posterior_against_brute_force():
    rnd = np.random.default_rng(1)
    p = rnd.random((len(SMALL) + 3, 3))
    names = [*SMALL, langid.MARK]
    p[0] = 0
    model = langid.LanguageModel(names, ["x", "y", "z"], p / p.sum(axis=0))
    texts = ["ab ba", "ABAB, (bb)", "aba aba x", "bab"] * 3
    langs, scores = langid.Scorer(model, most=3)(texts)
    for text, lang, score in zip(texts, langs, scores):
        like = [math.exp(sum(brute_forward(["", "", *names], model.p[:, c], langid.MARK + w.strip(langid.EDGES)) for w in text.lower().split())) for c in range(3)]
        assert lang == "xyz"[int(np.argmax(like))] and score == pytest.approx(max(like) / sum(like), rel=1e-9)


def test_null_and_repeated_ids_lose_no_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    langs = sorted(r.lang for r in docs.select("lang").distinct().collect())
    many = docs.crossJoin(spark.range(25)).select(F.lit(None).cast("long").alias("doc_id"), F.concat("text", F.lit(" "), "id").alias("text"), "lang")
    assert many.count() > 4000
    for some in (many, many.withColumn("doc_id", F.lit(7)), many.withColumn("text", F.concat(F.lit("the same text in "), "lang"))):
        taken = {r.lang: r["count"] for r in langid.sample(some, "doc_id", "text", "lang", 30).groupBy("lang").count().collect()}
        assert taken == dict.fromkeys(langs, 30)
        assert langid.train(some, docs_per_lang=30, rounds=1).langs == langs


def test_em_raises_the_likelihood(pieces):
    words = ["▁the", "▁then", "▁other", "▁mother"]
    counts = np.array([[5.0, 1], [3, 2], [2, 4], [1, 9]])
    like = [(langid.log_forward(pieces, langid.fit(pieces, words, counts, n, 1e-6), words) * counts).sum() for n in (1, 2, 4)]
    assert like[0] < like[1] < like[2]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out("doc_id")), docs_per_lang=20, rounds=2)
    assert model.langs == sorted(r.lang for r in docs.select("lang").distinct().collect())
    rows = docs.where(langid.held_out("doc_id")).select("lang", langid.predict(docs, model, F.col("text")).alias("of")).collect()
    assert np.mean([r.lang == r.of.lang for r in rows]) > 0.95 and all(0 <= r.of.score <= 1 for r in rows)


def test_odd_texts(docs, clashing, odd_docs):
    model = langid.train(docs, rounds=1)
    got = {(r.doc_id, r.text): r.of for r in docs.select("doc_id", "text", langid.predict(docs, model, F.col("text")).alias("of")).collect()}
    for r in odd_docs:
        of = got[(r[0], r[1])]
        has_letter = bool(r[1]) and any(c.isalpha() for c in r[1])
        assert (of.lang == langid.UNDETERMINED and of.score == 0) if not has_letter else (of.lang in model.langs and 0 < of.score <= 1)
    out = langid.identified(clashing, model)
    assert out.columns == clashing.columns
    assert {5, 6, 7, 50}.isdisjoint({r.doc_id for r in out.collect()})


def test_signs_for_numbers_are_no_letters(spark, docs):
    model = langid.train(docs, rounds=1)
    texts = ["²", "½ ¾", "Ⅷ", "① 12", "٣", "_", "ª", "ʰ", "日"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", langid.predict(docs, model, F.col("text")).alias("of")).collect()
    letters = {r.text for r in rows if r.of.lang != langid.UNDETERMINED}
    assert letters == {"ª", "ʰ", "日"} and all(r.of.score == 0 for r in rows if r.text not in letters)


def test_nothing_to_learn_from(docs, empty):
    model = langid.train(empty, rounds=1)
    assert model.langs == [] and {r.of.lang for r in docs.select(langid.predict(docs, model, F.col("text")).alias("of")).collect()} == {langid.UNDETERMINED}
    assert langid.identified(empty, model).count() == 0


def test_only_the_text_counts(docs):
    model = langid.train(docs, rounds=1)
    of = lambda df: sorted((r.text or "", r.of) for r in df.select("text", langid.predict(df, model, F.col("text")).alias("of")).collect())
    assert of(docs) == of(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(0)))
