"""Language ID by unigram piece models whose score sums over all segmentations of a text."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, let_go, own_worker, whole_row
from tidemark.llm.packing import vocabulary

UNDETERMINED = "und"
MARK = "▁"  # stands before each word in the vocabulary
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(44)
#: Forward values are multiplied by this for each character, so that segments of up to SHORT characters stay within a double.
_SCALE, SHORT = 1e4, 60
#: Characters of the words that are looked at together, and segments of one size.
CHUNK, GROUP = 100_000, 10_000
EDGES = ".,;:!?()[]{}\"'|"


class Pieces:
    """Finds the pieces of a fixed vocabulary in code points, by polynomial hashes."""

    def __init__(self, own: list[str]):
        #: Row 0 of the probabilities is "no piece", row 1 a character that is no piece.
        self.names = ["", "", *own]
        self.longest = max(map(len, own), default=1)
        self.keys = np.zeros(len(self.names), dtype=np.uint64)
        by_size: dict[int, list[int]] = {}
        for i, name in enumerate(own, 2):
            by_size.setdefault(len(name), []).append(i)
        with np.errstate(over="ignore"):
            for size, rows in by_size.items():
                points = self.mixed(code_points([self.names[i] for i in rows])).reshape(len(rows), size)
                h = np.zeros(len(rows), dtype=np.uint64)
                for c in range(size):
                    h = h * _BASE + points[:, c]
                self.keys[rows] = h
            one, two = self._one(self.keys).tolist(), self._two(self.keys).tolist()
        first, second = [0] * (1 << 20), [0] * (1 << 20)
        for i in range(2, len(self.names)):
            if not first[one[i]]:
                first[one[i]] = i
            elif not second[two[i]]:
                second[two[i]] = i
            else:
                raise ValueError("the vocabulary needs a larger table")
        self.first, self.second = np.array(first, dtype=np.int32), np.array(second, dtype=np.int32)

    @classmethod
    def of_file(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls([sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))])

    @staticmethod
    def _one(h):
        return h >> _SHIFT

    @staticmethod
    def _two(h):
        return (h * _SECOND) >> _SHIFT

    @staticmethod
    def mixed(points: np.ndarray) -> np.ndarray:
        out = (points + np.uint64(1)) * _SECOND
        return out ^ (out >> np.uint64(29))

    def find(self, h: np.ndarray, m: int) -> np.ndarray:
        """The pieces of m characters with these hashes; 0 (or 1, for a single character) if none."""
        at = self.first[self._one(h)]
        missed = np.flatnonzero(self.keys[at] != h)
        if len(missed):
            other = self.second[self._two(h[missed])]
            at[missed] = np.where(self.keys[other] == h[missed], other, 1 if m == 1 else 0)
        return at


def code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


class Lattice:
    """The pieces that stand in some words, cut into segments where none of them crosses.

    What all segmentations of a word sum up to is the product of what those of
    its segments do, so words of any length fall into short parts. Texts without
    spaces do too: few pieces of their scripts have more than a character or two.
    """

    def __init__(self, pieces: Pieces, words: list[str]):
        sizes = np.array([len(w) for w in words])
        points = pieces.mixed(code_points(words))
        n, word = len(points), np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        self.longest = min(pieces.longest, int(sizes.max()))
        #: At [m - 1, s] the piece of m characters from s on.
        self.found = np.zeros((self.longest, n), dtype=np.int32)
        turns = np.zeros(n + 1, dtype=np.int32)
        h = np.zeros(n + 1, dtype=np.uint64)
        for m in range(1, self.longest + 1):
            h = h[: n - m + 1] * _BASE + points[m - 1 :]
            at = np.flatnonzero(word[: n - m + 1] == word[m - 1 :])
            k = pieces.find(h[at], m)
            self.found[m - 1, at] = k
            if m > 1:
                at = at[k > 0]
                turns[at + 1] += 1
                turns[at + m] -= 1
        self.starts = np.flatnonzero(np.cumsum(turns[:n]) == 0)
        self.sizes = np.diff([*self.starts, n])
        self.word = word[self.starts]
        self.words = len(words)

    def groups(self) -> Iterator[tuple[int, np.ndarray]]:
        """(size, segments of it), GROUP at most at a time."""
        order = np.argsort(self.sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(self.sizes[order])) + 1
        for rows in np.split(order, cuts):
            for i in range(0, len(rows), GROUP):
                yield int(self.sizes[rows[0]]), rows[i : i + GROUP]

    def spans(self, size: int, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, m, which, pieces): of these segments, those with a piece of m characters that ends there."""
        at = self.starts[rows]
        for i in range(1, size + 1):
            for m in range(1, min(self.longest, i) + 1):
                k = self.found[m - 1, at + (i - m)]
                hit = np.flatnonzero(k)
                if len(hit):
                    yield i, m, hit, k[hit]

    def log_sums(self, p: np.ndarray) -> np.ndarray:
        """Per word and language the log of the sum over all segmentations."""
        total = np.zeros((self.words, p.shape[1]))
        for size, rows in self.groups():
            if size == 1:
                value = np.log(p[self.found[0, self.starts[rows]]])
            elif size <= SHORT:
                alpha = np.zeros((size + 1, len(rows), p.shape[1]))
                alpha[0] = 1
                for i, m, hit, k in self.spans(size, rows):
                    alpha[i, hit] += alpha[i - m, hit] * (p[k] * _SCALE**m)
                value = np.log(alpha[size]) - size * np.log(_SCALE)
            else:
                value = np.array([self._long(int(r), p) for r in rows])
            np.add.at(total, self.word[rows], value)
        return total

    def _long(self, row: int, p: np.ndarray) -> np.ndarray:
        """The same for one segment of any length: a window of the last values, rescaled at every character."""
        own = self.found[:, self.starts[row] : self.starts[row] + self.sizes[row]]
        most = np.arange(1, self.longest + 1)
        window, scale = np.zeros((self.longest, p.shape[1])), np.zeros(p.shape[1])  # window[m - 1]: the value m characters back
        window[0] = 1
        for i in range(1, own.shape[1] + 1):
            m = most[: min(self.longest, i)]
            new = (window[: len(m)] * p[own[m - 1, i - m]]).sum(axis=0)
            window[1:] = window[:-1] / new
            window[0] = 1
            scale += np.log(new)
        return scale

    def expect(self, p: np.ndarray, counts: np.ndarray, expected: np.ndarray) -> None:
        """Adds how often each piece is expected in these words, which stand ``counts`` times in each language."""
        langs = p.shape[1]
        for size, rows in self.groups():
            weight = counts[self.word[rows]]
            if size == 1:
                k = self.found[0, self.starts[rows]]
                for c in range(langs):
                    expected[:, c] += np.bincount(k, weight[:, c], len(p))
            elif size <= SHORT:
                alpha, beta = np.zeros((size + 1, len(rows), langs)), np.zeros((size + 1, len(rows), langs))
                alpha[0] = beta[size] = 1
                spans = list(self.spans(size, rows))
                for i, m, hit, k in spans:
                    alpha[i, hit] += alpha[i - m, hit] * (p[k] * _SCALE**m)
                for i, m, hit, k in reversed(spans):
                    beta[i - m, hit] += beta[i, hit] * (p[k] * _SCALE**m)
                share = weight / alpha[size]
                for i, m, hit, k in spans:
                    part = alpha[i - m, hit] * beta[i, hit] * (p[k] * _SCALE**m) * share[hit]
                    for c in range(langs):
                        expected[:, c] += np.bincount(k, part[:, c], len(p))
            else:
                for r, w in zip(rows, weight):
                    self._expect_long(int(r), p, w, expected)

    def _expect_long(self, row: int, p: np.ndarray, weight: np.ndarray, expected: np.ndarray) -> None:
        """The same for one segment of any length, in logarithms."""
        spans = [(i, m, int(k[0])) for i, m, _, k in self.spans(int(self.sizes[row]), np.array([row]))]
        size = int(self.sizes[row])
        with np.errstate(divide="ignore"):
            log_p = np.log(p)
        alpha, beta = np.full((size + 1, p.shape[1]), -np.inf), np.full((size + 1, p.shape[1]), -np.inf)
        alpha[0] = beta[size] = 0
        for i, m, k in spans:
            alpha[i] = np.logaddexp(alpha[i], alpha[i - m] + log_p[k])
        for i, m, k in reversed(spans):
            beta[i - m] = np.logaddexp(beta[i - m], beta[i] + log_p[k])
        for i, m, k in spans:
            expected[k] += weight * np.exp(alpha[i - m] + beta[i] + log_p[k] - alpha[size])


def parts(pieces: Pieces, word: str, most: int) -> Iterator[str]:
    """A word of any length in parts that no piece crosses, of about ``most`` characters unless there is no such place."""
    while len(word) > most:
        size, open_ = most, np.zeros(0, dtype=np.int64)
        while not len(open_) and size < len(word):
            starts = Lattice(pieces, [word[: size + pieces.longest]]).starts
            open_, size = starts[(starts > 0) & (starts <= size)], 2 * size
        if not len(open_):
            break
        yield word[: open_[-1]]
        word = word[open_[-1] :]
    yield word


def lattices(pieces: Pieces, words: list[str], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, Lattice]]:
    """(which words, lattice of them or of parts of them), about CHUNK characters at a time."""
    own: list[str] = []
    which: list[int] = []
    held = 0
    with np.errstate(over="ignore"):
        for i, word in enumerate(words):
            for part in (word,) if len(word) <= most else parts(pieces, word, most):
                own.append(part)
                which.append(i)
                held += len(part)
                if held >= CHUNK:
                    yield np.array(which), Lattice(pieces, own)
                    own, which, held = [], [], 0
        if own:
            yield np.array(which), Lattice(pieces, own)


def log_forward(pieces: Pieces, p: np.ndarray, words: list[str]) -> np.ndarray:
    """log of the sum, over all segmentations of each word, of the product of piece probabilities; a column per language."""
    out = np.zeros((len(words), p.shape[1]))
    for which, lattice in lattices(pieces, words):
        np.add.at(out, which, lattice.log_sums(p))
    return out


def fit(pieces: Pieces, words: list[str], counts: np.ndarray, rounds: int, smooth: float) -> np.ndarray:
    """EM over all segmentations: piece probabilities for each column of word counts."""
    p = np.full((len(pieces.names), counts.shape[1]), 1.0 / len(pieces.names))
    p[0], p[1] = 0, smooth / len(pieces.names)
    for _ in range(rounds):
        expected = np.zeros_like(p)
        for which, lattice in lattices(pieces, words):
            lattice.expect(p, counts[which], expected)
        expected[0] = 0
        expected[2:] += smooth
        expected[1] += smooth / 10
        p = expected / expected.sum(axis=0)
    return p


class LanguageModel:
    """Per-language piece probabilities; picklable, small (pieces x languages doubles)."""

    def __init__(self, names: list[str], langs: list[str], p: np.ndarray):
        self.names, self.langs, self.p = names, langs, p
        self.key = uuid.uuid4().hex


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode's category L is in the text; signs for numbers (², ½, Ⅷ, ①) are none."""
    return any(map(str.isalpha, text or ""))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int) -> DataFrame:
    """(lang, text): of each language the ``docs_per_lang`` rows whose id and text hash lowest, or all if it has fewer.

    The hashes alone are ranked first, in parts so that what the tasks pass on
    doesn't meet at once; texts are read only of rows up to the last one that is
    taken, and ranked once more, as repeated rows share a hash.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    keyed = known.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    lowest = lambda df, order, *part: df.withColumn("rank", F.row_number().over(W.partitionBy("lang", *part).orderBy(*order))).where(F.col("rank") <= docs_per_lang)
    scratch = Scratch(docs.sparkSession, "langid")
    some = lowest(keyed.select("lang", "h", (F.spark_partition_id() % 64).alias("part")), ["h"], "part")
    last = scratch.write(lowest(some, ["h"]).groupBy("lang").agg(F.max("h").alias("last")), "last")
    chosen = keyed.join(scratch.sent(last, "last"), "lang").where(F.col("h") <= F.col("last"))
    return lowest(chosen, ["h", "text"]).select("lang", "text")


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None,
    docs_per_lang: int = 300, rounds: int = 3, smooth: float = 0.05,
) -> LanguageModel:
    """Learns from a bounded sample of labelled rows: ``docs_per_lang`` rows of each language (see ``sample``), all their
    words. Rows without text or language are not used; null and repeated ids are rows like others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                found.update((lang, w) for word in words_of(text) if (w := word.strip(EDGES)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found]), pa.array([k[1] for k in found]), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    taken = sample(docs, id_col, text_col, lang_col, docs_per_lang)
    counts = taken.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    pieces = Pieces.of_file(path or vocabulary("piece_bpe_32k.model"))
    lang, word = counts.column("lang").combine_chunks().dictionary_encode(), counts.column("word").combine_chunks().dictionary_encode()
    langs, words = lang.dictionary.to_pylist(), word.dictionary.to_pylist()
    by_name, by_word = sorted(range(len(langs)), key=langs.__getitem__), sorted(range(len(words)), key=words.__getitem__)
    table = np.zeros((len(words), len(langs)))
    table[word.indices.to_numpy(), lang.indices.to_numpy()] = counts.column("n").to_numpy()
    table = table[by_word][:, by_name]
    p = fit(pieces, [MARK + words[i] for i in by_word], table, rounds, smooth) if langs else np.zeros((len(pieces.names), 0))
    return LanguageModel(pieces.names[2:], [langs[i] for i in by_name], p)


class Scorer:
    """Scores texts, remembering the words it has seen: a generation of about ``most`` of them or ``most_chars``, and the one before."""

    def __init__(self, model: LanguageModel, most: int = 80_000, most_chars: int = 2_500_000):
        self.model, self.most, self.most_chars, self.chars = model, most, most_chars, 0
        self.pieces = Pieces(model.names)
        self.index: dict[str, int] = {}
        self.before: dict[str, int] = {}
        self.scores = self.scores_before = np.zeros((0, len(model.langs)))

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
        """Per word its row of scores; how many words each text has."""
        if len(self.index) > self.most or self.chars > self.most_chars:
            self.before, self.scores_before = self.index, self.scores
            self.index, self.scores, self.chars = {}, self.scores[:0], 0
        known, at, sizes = self.index, [], []
        fresh: dict[str, int] = {}
        for text in texts:
            words = words_of(text)
            rows = [known.get(w, -1) for w in words]
            if -1 in rows:
                for i, r in enumerate(rows):
                    if r < 0:
                        rows[i] = fresh.setdefault(words[i], len(known) + len(fresh))
            at += rows
            sizes.append(len(rows))
        if fresh:
            old = np.array([self.before.get(w, -1) for w in fresh])
            scores = np.empty((len(fresh), len(self.model.langs)))
            scores[old >= 0] = self.scores_before[old[old >= 0]]
            scores[old < 0] = log_forward(self.pieces, self.model.p, [MARK + w.strip(EDGES) for w, k in zip(fresh, old) if k < 0])
            self.scores = np.concatenate([self.scores, scores])
            known.update(fresh)
            self.chars += sum(map(len, fresh))
        return np.array(at, dtype=np.int64), sizes

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and its posterior (equal priors) of each text; UNDETERMINED and 0 without letters."""
        if not self.model.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        at, sizes = self._words(texts)
        total = np.zeros((len(texts), len(self.model.langs)))
        filled = np.flatnonzero(sizes)
        if len(filled):
            total[filled] = np.add.reduceat(self.scores[at], np.concatenate([[0], np.cumsum(np.array(sizes)[filled])[:-1]]))
        undetermined = np.array([not has_letter(t) for t in texts])
        posterior = np.exp(total - total.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        best = posterior.argmax(axis=1)
        names = [UNDETERMINED if u else self.model.langs[b] for u, b in zip(undetermined, best)]
        return names, np.where(undetermined, 0.0, posterior[np.arange(len(texts)), best])


def predict(docs: DataFrame, model: LanguageModel, text: Column, step: int = 500) -> Column:
    """A struct column (lang, score) for the texts of ``docs``; only the text is looked at, and all of it.

    Null texts and texts without letters are UNDETERMINED with score 0, as all
    texts are where nothing could be learned. Of equally likely languages the
    first by name is taken. Where the text is read there the words are scored: no shuffle.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(model), model.key

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = own_worker(f"langid {key}", lambda: Scorer(shared.value))
        for batch in batches:
            langs: list[str] = []
            scores: list[np.ndarray] = []
            for start in range(0, len(batch), step):
                a, b = scorer(batch.slice(start, step).to_pylist())
                langs += a
                scores.append(b)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang", "score"])
        del scorer
        let_go()  # the next stage needs the memory more than the next task needs these words

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "lang string, score double")(text)


def held_out(id_col: str, of: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % of == fold, F.lit(False))


def identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose language is determined with a posterior of at least ``least``; their columns as they are.

    Null texts and texts without letters go. Null and repeated ids are judged row by row; an empty table stays empty."""
    judged = docs.select(whole_row(docs).alias("row"), predict(docs, model, F.col(text_col)).alias("of"))
    return judged.where((F.col("of.lang") != UNDETERMINED) & (F.col("of.score") >= least)).select("row.*")
