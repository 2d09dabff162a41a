"""Toxicity by the nearest labelled examples: exact TF-IDF cosines from a block-max inverted index, votes by closeness."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.divergence import TERM_BYTES, pieces

#: Stands before a stem, the first STEM characters of a longer word; no word has it.
MARK, STEM = b"^", 5
#: Cosines are rounded to so many digits, so that equal ones are ties whatever the order of a sum.
DIGITS = 9
#: Arrow's names of the types that ids may have.
ID_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def words_of(text: bytes) -> Counter:
    """How often each word stands: letters of ASCII, lower-cased, and all that isn't ASCII; anything else parts words."""
    found: Counter = Counter()
    for part in pieces(text):
        found.update(part.translate(TERM_BYTES).split())
    return found


def stem_of(word: bytes) -> bytes | None:
    stem = word[:STEM] if word.isascii() else word.decode("utf-8", "replace")[:STEM].encode()
    return MARK + stem if len(stem) < len(word) else None


class Vocabulary:
    """The terms, words and stems, that vectors are made of, with their weights; all other words are one term together."""

    def __init__(self, terms: list[bytes], documents: list[int], total: int):
        """``documents``: how many of ``total`` documents hold each term."""
        self.words = {t: i for i, t in enumerate(terms) if not t.startswith(MARK)}
        self.stems = {t[1:]: i for i, t in enumerate(terms) if t.startswith(MARK)}
        self.sizes = sorted({len(s) for s in self.stems})
        self.rest = len(terms)
        self.idf = [1 + math.log((1 + total) / (1 + n)) for n in documents] + [1.0]

    def counts(self, words: Counter) -> dict[int, int]:
        """How often each term stands, among them the other words, in the order of terms."""
        found = {self.words[w]: words[w] for w in self.words.keys() & words.keys()}
        rest = words.total() - sum(found.values())
        for size in self.sizes:
            for word, n in words.items():
                if (at := self.stems.get(word[:size])) is not None and len(word) > size:
                    found[at] = found.get(at, 0) + n
        if rest:
            found[self.rest] = rest
        return dict(sorted(found.items()))

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights (1 + ln n) * idf, of length 1."""
        at = np.array(list(counts), dtype=np.int64)
        weights = np.array([(1 + math.log(n)) * self.idf[i] for i, n in counts.items()])
        return at, weights / np.sqrt((weights * weights).sum()) if len(weights) else weights


class BlockMaxIndex:
    """An inverted index in blocks of examples, with the greatest weight of each term in each block.

    What a query's weights and a block's greatest ones add up to is a bound on the cosines in it. Blocks are looked at
    from the highest bound on, until none can hold one of the k best; those are exact. Similar examples stand together.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = 64):
        by_weight = [tuple(at[np.lexsort((at, -w))].tolist()) for at, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=by_weight.__getitem__), dtype=np.int64)
        self.place = np.argsort(self.order)
        self.size, self.block, self.blocks = len(vectors), block, -(-len(vectors) // block)
        self.bounds = np.zeros((terms, self.blocks))
        rows = [(i // block, t, i % block, w) for i, v in enumerate(self.order) for t, w in zip(*(x.tolist() for x in vectors[v]))]
        rows.sort()
        self.example, self.weight = np.array([r[2] for r in rows], dtype=np.int64), np.array([r[3] for r in rows])
        key = np.array([r[0] * terms + r[1] for r in rows], dtype=np.int64)
        self.starts = np.searchsorted(key, np.arange(self.blocks * terms + 1)).reshape(-1)
        self.terms, self.looked_at = terms, 0
        for b, t, _, w in rows:
            self.bounds[t, b] = max(self.bounds[t, b], w)

    def cosines(self, at: np.ndarray, weights: np.ndarray, b: int) -> np.ndarray:
        """With all examples of a block."""
        out = np.zeros(min(self.block, self.size - b * self.block))
        for t, w in zip((at + b * self.terms).tolist(), weights.tolist()):
            some = slice(self.starts[t], self.starts[t + 1])
            out[self.example[some]] += w * self.weight[some]
        return np.round(out, DIGITS)

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k greatest cosines, ties with the last of them included; without the example ``but``."""
        bound = weights @ self.bounds[at]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        best, last = np.zeros(0), -1.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if len(best) == k and bound[b] + 2 * 10.0**-DIGITS < last:
                break
            self.looked_at += 1
            own = self.cosines(at, weights, b)
            if but is not None and self.place[but] // self.block == b:
                own[self.place[but] % self.block] = -1
            near = np.flatnonzero(own >= max(last, 0))
            found.append((near + b * self.block, own[near]))
            best = np.sort(np.concatenate([best, own[near]]))[-k:]
            last = best[0] if len(best) == k else -1.0
        examples, cosines = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64), np.zeros(0))
        near = cosines >= last
        return self.order[examples[near]], cosines[near]


def calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, least: float = 0.5) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the votes' log odds that fits the labels best (Platt's targets).

    An example's own label is missing from its vote, so where all are alike those with label 1 get the lower ones; a curve
    less steep than ``least`` is taken for that, and only the offset is fitted, for a slope of 1.
    """
    x = np.log(votes / (1 - votes))
    n1, n0 = weights[labels == 1].sum(), weights[labels == 0].sum()
    y = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for free in (np.array([1.0, 1.0]), np.array([0.0, 1.0])):
        at = np.array([1.0, 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -500, 500)))
            d, h = weights * (p - y), weights * p * (1 - p)
            slope = np.array([(d * x).sum(), d.sum()]) + 1e-3 * (at - [1, 0])
            bend = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 1e-3 * np.eye(2)
            step = np.linalg.solve(bend * np.outer(free, free) + np.diag(1 - free), slope * free)
            step /= max(1.0, np.abs(step).max())
            at = at - step
            if np.abs(step).max() < 1e-10:
                break
        if at[0] >= least:
            break
    return float(at[0]), float(at[1])


class Judge:
    """Scores texts by the votes of the nearest examples."""

    def __init__(self, vocabulary: Vocabulary, ids: list, labels: list[int], counts: list[dict[int, int]], standing: tuple[int, int], k: int, doubt: float = 0.5):
        """``standing``: how many labelled documents there are with label 0 and 1, of which the examples are some."""
        self.vocabulary, self.ids, self.labels, self.k, self.doubt = vocabulary, ids, np.array(labels, dtype=np.int64), k, doubt
        self.prior = standing[1] / sum(standing) if sum(standing) else 0.0
        self.curve: tuple[float, float] | None = None
        self.seen: dict[Any, tuple] = {}
        if len(set(labels)) < 2:
            return
        share = np.array([standing[0], standing[1]]) / sum(standing)
        self.stands_for = (share / (np.bincount(self.labels, minlength=2) / len(labels)))[self.labels]
        vectors = [vocabulary.vector(c) for c in counts]
        self.index = BlockMaxIndex(vectors, vocabulary.rest + 1)
        known: dict[Any, float] = {}
        votes = []
        for i, (c, label) in enumerate(zip(counts, labels)):  # what the others would say of each example
            key = self.key(c), label
            if key not in known:
                known[key] = self.vote(*self.index.nearest(*vectors[i], k, but=i))
            votes.append(known[key])
        self.curve = calibrate(np.array(votes), self.labels, self.stands_for)

    def key(self, counts: dict[int, int]):
        """Equal for equal vectors: of a single term it doesn't matter how often it stands."""
        return tuple(counts) if len(counts) == 1 else tuple(counts.items())

    def vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        """The share of label 1 among the examples, each counting as cosine squared times how many documents it stands for;
        some weight is left to the share among all labelled documents."""
        weights = cosines * cosines * self.stands_for[examples]
        value = ((weights * self.labels[examples]).sum() + self.doubt * self.prior) / (weights.sum() + self.doubt)
        return float(np.clip(value, 1e-9, 1 - 1e-9))

    def __call__(self, text: bytes | None) -> tuple[float, list[tuple[Any, float, int]]]:
        """(score, the k nearest examples as id, cosine and label): equal cosines by id."""
        if self.curve is None:
            return self.prior, []
        counts = self.vocabulary.counts(words_of(text or b""))
        key = self.key(counts)
        if key not in self.seen:
            examples, cosines = self.index.nearest(*self.vocabulary.vector(counts), self.k) if counts else (np.zeros(0, dtype=np.int64), np.zeros(0))
            vote = self.vote(examples, cosines)
            score = 1 / (1 + math.exp(-(self.curve[0] * math.log(vote / (1 - vote)) + self.curve[1])))
            near = sorted(((-c, self.ids[e], int(self.labels[e])) for e, c in zip(examples.tolist(), cosines.tolist())))[: self.k]
            if len(self.seen) >= 20_000:
                self.seen.clear()
            self.seen[key] = score, [(i, -c, label) for c, i, label in near]
        return self.seen[key]


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_label: int = 2000, terms: int = 4096, surprise: float = 4.0, lift: float = 2.0, least: int = 5, k: int = 15,
) -> Judge:
    """Learns from a bounded sample of the labelled documents: the ``per_label`` ids of each label whose hashes are lowest,
    with their whole texts.

    Vectors are made of the ``terms`` terms at most, words and stems, that label 1 brings along: at least ``least`` examples
    hold the term, ``lift`` times as large a share of those with label 1 as of the others, and ``surprise`` standard deviations more
    than chance would have it. How often documents hold them is counted over all documents, how common the labels are over all labels.

    Labels other than 0 and 1, labels of documents that aren't there and null ids are not used; an id with both labels has label 1;
    of rows that share an id the greatest text is the example. Without both labels there is nothing to compare, and every score is
    the share of label 1 (0 if there are none).
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    told = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = scratch.write(rows.select("id").where("id IS NOT NULL").distinct().join(told, "id"), "known")
    standing = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    first = [known.where(F.col("label") == c).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(per_label) for c in (0, 1)]
    chosen = scratch.write(first[0].unionByName(first[1]), "chosen")

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                words = words_of(text or b"")
                found = Counter({w: n for w, n in words.items() if len(w) <= 64})
                for w, n in words.items():
                    if (s := stem_of(w)) is not None:
                        found[s] += n
                found[b""] = words.total()
                at = pa.array([i] * len(found))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["id", "label", "term", "n"])

    id_type = docs.schema[id_col].dataType.simpleString()
    examples = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.max("text").alias("text"))  # of 2 * per_label ids at most
    held = scratch.write(examples.select("id", "label", "text").mapInArrow(terms_of, f"id {id_type}, label int, term binary, n long"), "terms")
    sizes = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Judge(Vocabulary([], [], 0), [], [], [], (standing.get(0, 0), standing.get(1, 0)), k)
    share = n1 / (n0 + n1)
    by_term = held.where("octet_length(term) > 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("a"))
    chance = F.sqrt(F.col("n") * share * (1 - share) * (1 - F.col("n") / (n0 + n1)) + 1e-9)
    by_term = by_term.withColumn("z", (F.col("a") - F.col("n") * share) / chance)
    telling = by_term.where((F.col("n") >= least) & (F.col("z") >= surprise) & (F.col("a") / n1 >= lift * (F.col("n") - F.col("a")) / n0))
    names = sorted(bytes(r["term"]) for r in telling.orderBy(F.desc("z"), "term").limit(terms).select("term").collect())
    plain = Vocabulary(names, [0] * len(names), 0)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            found[-1] += batch.num_rows
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found.update(plain.counts(words_of(text or b"")).keys())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    documents = {r["term"]: r["n"] for r in rows.select("text").mapInArrow(holding, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    vocabulary = Vocabulary(names, [documents.get(i, 0) for i in range(len(names))], documents.get(-1, 0))
    listed = spark.createDataFrame([(bytearray(t),) for t in [b"", *names]], "term binary")
    mine = held.join(F.broadcast(listed), "term").toArrow()  # at most 2 * per_label rows for each of the terms
    at = {t: i for i, t in enumerate(names)}
    counts: dict[Any, dict[int, int]] = {}
    label_of = {}
    for id_, label, term, n in zip(*(mine.column(c).to_pylist() for c in ("id", "label", "term", "n"))):
        own = counts.setdefault(id_, {})
        label_of[id_] = label
        place = at.get(bytes(term), vocabulary.rest)
        own[place] = own.get(place, 0) + n
        if place < vocabulary.rest and not term.startswith(MARK):  # all words are counted under "", what is a term isn't among the others
            own[vocabulary.rest] = own.get(vocabulary.rest, 0) - n
    ids = sorted(counts)
    clean = [{t: n for t, n in sorted(counts[i].items()) if n} for i in ids]
    return Judge(vocabulary, ids, [label_of[i] for i in ids], clean, (standing[0], standing[1]), k)


def score(docs: DataFrame, judge: Judge, text: Column, id_type: str = "bigint") -> Column:
    """A struct column (score, evidence) for the texts of ``docs``: how likely label 1 is, and the nearest examples (id, cosine,
    label), the closest first, equal ones by id.

    Only the text is looked at, and all of it, where it is read: no shuffle. Null counts as empty; texts without words are like no
    example and get the share of label 1, calibrated like all votes, without evidence. Equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(judge)  # as large as the sample's vectors, whose size is bounded

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("id", ID_TYPES[id_type]), ("cosine", pa.float64()), ("label", pa.int32())]))
        for batch in batches:
            scores, evidence = [], []
            for i in range(0, len(batch), 500):
                for text in batch.slice(i, 500).cast(pa.binary()).to_pylist():
                    value, near = shared.value(text)
                    scores.append(value)
                    evidence.append([{"id": x, "cosine": c, "label": y} for x, c, y in near])
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["score", "evidence"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, f"score double, evidence array<struct<id:{id_type},cosine:double,label:int>>")(text)



def held_out(id_col: str, of: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % of == fold, F.lit(False))
