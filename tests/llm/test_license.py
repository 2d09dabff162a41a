import re
import time

import pytest

from tidemark.llm import license_scan as L

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def spans(text, k=3, near=2, least=0.6):
    """Diagonal voting, word by word: {label: best coverage}."""
    w, out = words(text), {}
    for label, notice in L.NOTICES:
        t = words(notice)
        grams = len(t) - k + 1
        votes = {}
        for i in range(len(w) - k + 1):
            for j in range(grams):
                if w[i : i + k] == t[j : j + k]:
                    votes.setdefault(i - j, []).append((i, j))
        runs, last = [], None
        for d in sorted(votes):
            if last is None or d - last > near:
                runs.append([])
            runs[-1] += votes[d]
            last = d
        for run in runs:
            ats = [j for _, j in sorted(run)]
            coverage = min(len(set(ats)), sum(b > a for a, b in zip([-1, *ats], ats))) / grams
            length = max(i for i, _ in run) + k - min(i for i, _ in run)
            if coverage >= least and length <= 2 * len(t):
                out[label] = max(out.get(label, 0), coverage)
    return out


def plain(text):
    w, places, labels = words(text), [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split(" ")
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    own = spans(text)
    score = 1.0 if places else max(own.values(), default=0.0)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(own))), round(score, 9)


MIT = L.NOTICES[1][1]
TEXTS = [
    f"Foreword here. {MIT}. More text.", MIT.replace("obtaining a copy", "who is obtaining one copy"), "Released under the MIT License and the mit  LICENSE", "the apache-license, general public license",
    "Licensed under CC BY-NC 4.0.", "licensed under", "redistribution and use in source", f"{L.NOTICES[6][1]} and again {L.NOTICES[6][1]}", "Mıt license İ K license mit", "x", None, "", "mit", "license mit license",
    f"Before. {L.NOTICES[10][1]} After.", L.NOTICES[11][1].upper(), L.NOTICES[12][1][:300], " ".join(t for _, t in L.NOTICES), L.NOTICES[16][1].replace("software", "package"),
    L.NOTICES[3][1][:60], "All rights reserved by nobody " * 50, "é license. apache\nlicense",
]


@pytest.mark.parametrize("from_files", [False, True])
def test_against_plain_scan(spark, docs, odd_docs, tmp_path, from_files):
    rows = [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(r[0], r[1]) for r in odd_docs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if from_files:
        df.write.parquet(f"file://{tmp_path}/d")
        df = spark.read.parquet(f"file://{tmp_path}/d")
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in L.judged(df).collect()]
    assert sorted(got, key=repr) == sorted([(i, *plain(t)) for i, t in rows], key=repr)


def test_whole_licenses_are_found(spark):
    """Each whole text gives its label with a span over all of it, and half of one doesn't."""
    whole = L.NOTICES[10:]
    rows = [(i, f"some words before {t} and after") for i, (_, t) in enumerate(whole)] + [(100 + i, " ".join(t.split()[: len(t.split()) // 2])) for i, (_, t) in enumerate(whole)]
    documents, found = L.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    whole_ones = found.where("template >= 10 AND coverage = 1").join(documents.select("place", "row"), "place")
    got = {(r.row.doc_id, r.label, r.last - r.first + 1) for r in whole_ones.collect()}
    assert got == {(i, label, len(words(t))) for i, (label, t) in enumerate(whole)}


def test_time_in_proportion_to_the_length(spark):
    took = []
    for n in (1000, 100_000, 400_000):  # the first run compiles
        df = spark.createDataFrame([(1, "alpha beta gamma without restriction " * (n // 5) + MIT)], "doc_id long, text string")
        began = time.time()
        (r,) = L.judged(df).collect()
        took.append(time.time() - began)
        assert r.labels == "mit" and r.n_words == n // 5 * 5 + len(words(MIT))
    assert took[2] < 5 * max(took[1], 1)


def test_spans_say_where(spark):
    _, found = L.scan(spark.createDataFrame([(1, "one two " + L.NOTICES[5][1] + " three")], "doc_id long, text string"))
    (r,) = found.where("label = 'gpl' AND coverage = 1").collect()
    assert (r.first, r.last) == (2, 2 + len(words(L.NOTICES[5][1])) - 1)


def test_a_notice_in_another_order_is_none(spark):
    w = L.NOTICES[5][1].split(" ")
    turned = " ".join(" ".join(w[i : i + 3]) for i in reversed(range(0, len(w), 3)))
    one, two = (r.labels for r in L.judged(spark.createDataFrame([(1, L.NOTICES[6][1]), (2, turned.replace("General Public", "x"))], "doc_id long, text string")).orderBy("doc_id").collect())
    assert one == "bsd" and two == ""


def test_empty_and_clashing(empty, clashing, odd_docs):
    assert L.judged(empty).count() == 0
    told = lambda df: sorted(map(repr, df.collect()))
    assert told(L.judged(clashing)) == told(L.judged(clashing.select("doc_id", "text"))) and L.judged(clashing).count() == len(odd_docs)


def test_no_python_in_the_plan(docs):
    plan = L.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
