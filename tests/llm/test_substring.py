import random
import time

import numpy as np
import pytest

from tidemark.llm import substring as S

from .conftest import prose

WS = " \t\n\x0b\x0c\r"


def split(text):
    """The sentences with what separates them from the next."""
    out, start, i = [], 0, 0
    while i < len(text):
        if text[i] in ".!?" and i + 1 < len(text) and text[i + 1] in WS:
            j = i + 1
            while j < len(text) and text[j] in WS:
                j += 1
            if j < len(text):  # up to the next word; lines that end in between are blank sentences
                out.append(text[start:j])
                start = i = j
                continue
        if text[i] == "\n" and i + 1 < len(text):
            out.append(text[start : i + 1])
            start = i + 1
        i += 1
    return [*out, text[start:]]


def brute(rows, k):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        told = [w for s in split(r[1] or "") if (w := s.lower().split())]
        gone = set()
        for j in range(len(told) - k + 1):
            run = tuple(map(tuple, told[j : j + k]))
            if run in seen:
                gone |= set(range(j, j + k))
            seen.add(run)
        whole = [s.split() for s in split(r[1] or "") if s.split()]
        text = None if r[1] is None else [w for i, s in enumerate(whole) if i not in gone for w in s]
        out.append((r[0], text, len(told), len(gone)))
    return sorted(out, key=repr)


def sentence(rnd):
    return prose(rnd, rnd.randrange(5, 15)).replace(".", "").capitalize() + rnd.choice([". ", "! ", "?  ", ".\n", "\n\n", ".       ", ".  \n \t"])


@pytest.mark.parametrize("k", [2, 4])
def test_against_brute_force(spark, odd_docs, k):
    rnd = random.Random(k)
    passages = ["".join(sentence(rnd) for _ in range(6)) for _ in range(4)]
    rows = [(r[0], r[1]) for r in odd_docs if r[0] is None or r[0] != 10]
    for i in range(60):
        parts = [sentence(rnd) for _ in range(rnd.randrange(1, 12))]
        if i % 2:
            parts.insert(rnd.randrange(len(parts)), rnd.choice(passages))
        rows.append((100 + i, "".join(parts)))
    rows.append((300, passages[0] + passages[0]))  # repeated in itself
    got = S.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string"), k=k)
    got = [(r.doc_id, None if r.text is None else r.text.split(), r.n_sentences, r.n_removed) for r in got.collect()]
    assert sorted(got, key=repr) == brute(rows, k)


def test_long_passages_go_and_other_text_stays(spark):
    rnd = random.Random(9)
    passage = "".join(sentence(rnd) for _ in range(8))
    rows = [(i, f"Own start of text {i} is here. " + passage + f"\nOwn end of text {i} is here too.") for i in range(30)]
    out = {r.doc_id: r for r in S.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].text == rows[0][1] and out[0].n_removed == 0
    for i in range(1, 30):
        assert f"Own start of text {i} is here." in out[i].text and f"Own end of text {i} is here too." in out[i].text and out[i].n_removed == 8


def test_of_repeated_rows_one_stays_whole(spark, clashing):
    text = "A first sentence. A second one. A third one. A last one."
    rows = spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")
    assert sorted(r.text for r in S.dedup_spans(rows).collect()) == ["", "", text]
    out = S.dedup_spans(clashing)
    assert set(out.columns) == set(clashing.columns) | {"n_sentences", "n_removed"} and out.count() == clashing.count()


def test_empty(empty):
    assert S.dedup_spans(empty).count() == 0


def test_runs_of_short_sentences(spark):
    """A list or a verse of short lines is found, whatever its lines' length; fewer sentences than k are no evidence."""
    rnd = random.Random(4)
    verse = "".join(prose(rnd, 2).replace(".", "").upper() + rnd.choice(["!\n", ".\n", "\n"]) for _ in range(60))
    rows = [(1, "First text of its own kind.\n" + verse), (2, "Second text that differs here.\n" + verse + "It ends another way too."), (3, "Yes. No."), (4, "Yes. No.")]
    out = {r.doc_id: r for r in S.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].text == rows[0][1] and out[3].text == out[4].text == "Yes. No."
    left = out[2].text.removeprefix("Second text that differs here.\n")
    assert left == "It ends another way too." and out[2].n_removed == 60


def test_every_repeated_stretch_of_50_words_is_cut(spark):
    """Stretches without a whole sentence, glued to their hosts at both ends: none is left."""
    rnd = random.Random(6)
    many = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(40):
        words = [rnd.choice(many) for _ in range(50)]
        for j in rnd.sample(range(50), i % 3):
            words[j] += rnd.choice([".", "!\n"])
        for _ in range(2):
            rows.append((len(rows), f"{prose(rnd, rnd.randrange(30), many)} own{len(rows)} {' '.join(words)} end{len(rows)} {prose(rnd, rnd.randrange(30), many)}"))
    out = {r.doc_id: r for r in S.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        if i % 2 == 0:
            assert out[i].text == text and out[i].n_removed == 0
        else:
            left = out[i].text.split()
            assert out[i].n_removed > 0 and f"own{i}" in left and f"end{i}" in left
            assert len(text.split()) - len(left) >= 34 and left[: left.index(f"own{i}")] == text.split()[: left.index(f"own{i}")]


def test_long_texts_take_time_in_proportion(spark):
    times = []
    for n in (4000, 32_000):
        text = " ".join(f"Word{i % 977} and word{i}." for i in range(n))
        starts = S.spans(text, 4)[0].tolist()
        began = time.perf_counter()
        S.spans(text, 4)
        assert S.without(text, starts)["gone"] == n
        times.append(time.perf_counter() - began)
    assert times[1] < 30 * times[0]


def test_equal_hashes_of_other_words_are_no_repeat():
    runs = {"hash": [5, 5, 5, 5], "second": [1, 2, 1, 2], "no_id": [0, 0, 0, 1], "id": [7, 8, 6, 0], "uid": [1, 2, 3, 4], "at": [0, 0, 0, 0]}
    runs, first = S._firsts({c: np.array(runs[c], dtype=t) for c, t in S.RUN_COLUMNS.items()})
    assert runs["uid"].tolist() == [3, 1, 2, 4] and first.tolist() == [True, False, True, False]


@pytest.mark.parametrize("words", [1, 300])
def test_windows_and_buckets_change_nothing(spark, words):
    rnd = random.Random(7)
    passages = ["".join(sentence(rnd) for _ in range(6)) for _ in range(4)]
    rows = [(rnd.choice([None, i]), "".join(sentence(rnd) for _ in range(3)) + rnd.choice(passages)) for i in range(60)]
    docs = S.placed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = [sorted((r.place, sorted(r.starts)) for r in S.repeated_spans(docs, "doc_id", "text", 4, S.Scratch(spark, "t"), *options).collect()) for options in ((), (words, 50))]
    assert found[0] == found[1] and len(found[0]) > 40


def test_cut_words_are_those_of_the_spans():
    text = "  One two.\n\n  Three four five. Six\n"
    assert S.without(text, [1 << 32 | 3], 1) == {"kept": "  One \n  four five. Six\n", "gone": 2}
    assert S.without(text, [1 << 32 | 3], 3) == {"kept": text, "gone": 0}
    assert S.without(text, [0 << 32 | 2, 5 << 32 | 6], 1) == {"kept": "\n  Three four five. ", "gone": 2}
