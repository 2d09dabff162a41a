import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing

from .conftest import prose


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))


TEXTS = [
    "", " ", "a", "Hello world.  Two spaces\n\nand lines \n x", " leading", "trailing ", "tab\tand\x0bothers\x1c\x85\xa0x", "don't we'll I'm", "日本語 text é è", "<|endoftext|> inside <|endoftext|>",
    "\n\n", "a \n b", "x  y", "12 345 6.7!?", "  a　b", "it's 'quoted' and\nnew 's", "😀 👍🏽 emoji", "a" * 3000,
]


def test_ids_are_the_librarys(plain):
    encode = packing.encoder(packing.vocabulary("byte_bpe_50k.json"), packing.vocabulary("byte_bpe_50k.tiktoken"))
    rnd = random.Random(0)
    alphabet = ["a", "B", " ", " ", " ", "\n", "'s", "é", "1", ".", "\t", " ", "日", "<|endoftext|>"]
    for text in TEXTS + ["".join(rnd.choice(alphabet) for _ in range(30)) for _ in range(500)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("window", [300, 2_000_000])
def test_round_trip(docs, odd_docs, plain, window):
    rows = packing.pack(docs.select("doc_id", "text"), window_tokens=window).collect()
    want = sorted(np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes() for r in odd_docs)
    sequences = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)  # no padding at all
    docs_of, whole = {}, []
    for r in sorted(rows, key=lambda r: r.start):
        docs_of.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (_, n), pieces in docs_of.items():
        if sum(p.length for p in pieces) == n:
            at = 0
            for p in pieces:
                assert p.start == at
                at += p.length
            whole.append(b"".join(p.ids for p in pieces))
        else:  # repeated rows: each piece comes as often
            assert sum(p.length for p in pieces) % n == 0
            k = sum(p.length for p in pieces) // n
            starts = {}
            for p in pieces:
                starts.setdefault((p.start, p.length), p.ids)
            whole += [None] * k
    assert len(whole) == len(odd_docs) and not {w for w in whole if w is not None} - set(want)
    assert sum(r.length for r in rows) == sum(len(w) // 4 for w in want)


@pytest.mark.parametrize("spread", [1.0, 1.2, 1.5])
def test_costs_are_balanced(spread):
    """Far better than the same documents in order, cut where a sequence ends."""
    lengths = np.maximum(1, np.random.default_rng(0).lognormal(6, spread, 3000).astype(int))
    pieces = packing.place(lengths, 1024, 1.0, 1 / 1024, 512)
    full = int(lengths.sum()) // 1024
    cost, one_by_one, tokens = np.zeros(full + 10), [0.0], 0
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
    for n in lengths.tolist():
        while n:
            take = min(n, 1024 - tokens)
            one_by_one[-1] += take + take * take / 1024
            tokens, n = tokens + take, n - take
            if tokens == 1024:
                one_by_one.append(0.0)
                tokens = 0
    relative = lambda x: np.std(x) / np.mean(x)
    assert relative(cost[:full]) < 0.4 * relative(one_by_one[:-1]) and cost.max() <= 1.1 * cost[:full].mean() < max(one_by_one)
    by_doc = {}
    for d, start, n, _, _ in pieces:
        by_doc.setdefault(d, []).append((start, n))
    for d, n in enumerate(lengths.tolist()):
        at = 0
        for start, k in sorted(by_doc[d]):
            assert start == at and 0 < k <= 512
            at += k
        assert at == n


def test_empty_and_clashing(empty, clashing, odd_docs):
    assert packing.pack(empty).count() == 0
    assert packing.pack(clashing).agg(F.sum("length")).first()[0] > len(odd_docs)


def test_common_prose(spark, plain):
    rnd = random.Random(1)
    df = spark.createDataFrame([(i, prose(rnd, 200)) for i in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.n for r in packing.pack(df).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == {r.doc_id: len(plain.encode(r.text, add_special_tokens=False).ids) + 1 for r in df.collect()}
