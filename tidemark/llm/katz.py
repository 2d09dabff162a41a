"""A Katz back-off model with Good-Turing discounts: counted, normalised and evaluated order by order, in packed buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ODD, Scratch, give_back, let_go, mix, release_shuffles, spread_join, words_of_worker

#: Words are 64-bit hashes; this one stands for a text's end (a token, never a context). Contexts before a text's start are START.
END, START = 2, 1
#: Counts up to this are discounted.
K = 5
#: What is left to the unseen, and room for them, never falls below this.
LEAST = 1e-12


def discounts(n: list[int], k: int = K) -> list[float]:
    """Katz's Good-Turing discount of each count 0..k (0: unused), from n[r], how many types occur r times.

    The largest k whose discounts all lie in (0, 1] is taken and counts above it
    stay whole; if there is none, half a count is taken from each type of up to K.
    """
    for most in range(k, 0, -1):
        if min(n[1 : most + 2]) <= 0:
            continue
        common = (most + 1) * n[most + 1] / n[1]
        if common >= 1:
            continue
        d = [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, most + 1)]
        if all(0 < x <= 1 for x in d) and min(d) < 1:
            return [1.0, *d, *[1.0] * (k - most)]
    return [1.0, *((r - 0.5) / r for r in range(1, k + 1))]


def kept(r, d: list[float]):
    """The discounted count of r > 0."""
    return r * np.take(np.array([*d, 1.0]), np.minimum(r, K + 1).astype(np.int64))


class Model:
    """What every task knows: numbers of training texts and tokens, and the discounts of each order so far."""

    def __init__(self, train_docs: int, buckets: int, hot: int):
        #: Contexts of ``hot`` counts or more are spread over the buckets.
        self.train_docs, self.buckets, self.hot = train_docs, buckets, hot
        self.d: dict[int, list[float]] = {}
        self.types = self.tokens = 0
        self.unknown = self.scale = 1.0

    def learn(self, order: int, n: list[int], types: int, tokens: int) -> None:
        self.d[order] = discounts([0, *n])
        if order == 1:
            self.types, self.tokens = types, tokens
            spent = tokens - sum((r - kept(np.array([r]), self.d[1])[0]) * n[r - 1] for r in range(1, K + 1))
            #: The probability of any token that training has not seen.
            self.unknown = max(LEAST, 1 - spent / tokens) if tokens else 1.0
            self.scale = (1 - self.unknown) / (spent / tokens) if tokens and spent else 1.0

    def single(self, c: np.ndarray) -> np.ndarray:
        """The probability of tokens with these training counts."""
        return np.where(c > 0, kept(np.maximum(c, 1), self.d[1]) / max(self.tokens, 1) * self.scale, self.unknown)

    def seen(self, order: int, c: np.ndarray, den: np.ndarray) -> np.ndarray:
        """The probability of seen n-grams of an order."""
        return self.single(c) if order == 1 else kept(c, self.d[order]) / np.maximum(den, 1)

    def log_alpha(self, order: int, c: np.ndarray, m: np.ndarray, room: np.ndarray) -> np.ndarray:
        """The back-off weights of contexts: counts, how many continuations occur 1..K times, and the lower order's share of all seen ones."""
        den = c + (m.sum(axis=1) == 0)
        r = np.arange(1, K + 1)
        spent = m @ kept(r, self.d[order]) + (c - m @ r)
        return np.log10(np.maximum(LEAST, 1 - spent / den)) - np.log10(np.maximum(LEAST, 1 - room))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte, since the upper bytes repeat."""
    import zstandard

    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    planes = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, n: int) -> np.ndarray:
    import zstandard

    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:], max_output_size=max(1, n * width)), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where new values begin in sorted columns."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


TYPES = {"kind": pa.int32(), "window": pa.int64(), "bucket": pa.int64(), "level": pa.int32(), "ids": pa.list_(pa.string()), "held": pa.list_(pa.bool_()), "x": pa.int64(), "y": pa.int64(), "m": pa.list_(pa.int64()), "room": pa.float64()} | {c: pa.binary() for c in "abcdefg"}
SCHEMA = ", ".join(f"{c} {'array<string>' if c == 'ids' else 'array<boolean>' if c == 'held' else 'array<long>' if c == 'm' else {'int32': 'int', 'int64': 'long', 'double': 'double', 'binary': 'binary'}[str(t)]}" for c, t in TYPES.items())
#: Kinds of rows: windows of documents; what windows ask; what buckets answer; counts of counts (m) with types (x) and tokens (y);
#: the table: y contexts (a) with runs (b) of the x last words (c) seen after them, these counts (d), what the order below gives each
#: context's (e), and which are spread (g); a spread context's part in a bucket (x, its count y, m, room); who asks for it; a window's words.
WINDOW, ASK, ANSWER, STATS, GRAMS, PART, WANT, WORDS = range(8)


def rows(kind: int, n: int = 1, **columns) -> pa.RecordBatch:
    given = {"kind": pa.array(np.full(n, kind, dtype=np.int32))} | columns
    return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in TYPES.items()], list(TYPES))


def windows(batches: Iterator[pa.RecordBatch], most_tokens: int) -> Iterator[pa.RecordBatch]:
    """Documents (id, held out, text) to windows of them, x tokens: a (lengths), c (tokens as places among the window's y words); and these words: a (hashes, in order), d (training counts)."""
    from pyspark import TaskContext

    words, number = words_of_worker(), TaskContext.get().partitionId() << 24
    ids: list = []
    held: list[bool] = []
    texts: list[np.ndarray] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal number, size
        lengths = np.array([len(t) + 1 for t in texts])
        hashes, at = np.unique(np.concatenate([part for t in texts for part in (t, end)]), return_inverse=True)
        trained = np.bincount(at[np.repeat(~np.array(held), lengths)], minlength=len(hashes))
        yield rows(WINDOW, window=[number], level=[0], ids=[list(ids)], held=[list(held)], x=[len(at)], y=[len(hashes)], a=[pack(lengths)], c=[pack(at)])
        yield rows(WORDS, window=[number], level=[0], y=[len(hashes)], a=[hashes.tobytes()], d=[pack(trained)])
        number, size = number + 1, 0
        for v in (ids, held, texts):
            v.clear()

    end = np.array([END], dtype=np.uint64)
    for batch in batches:
        for name, is_held, text in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(name)
            held.append(is_held)
            texts.append(words(text) if text else np.zeros(0, dtype=np.uint64))
            size += len(texts[-1]) + 1
            if size >= most_tokens:
                yield from out()
    if ids:
        yield from out()
    del words
    let_go()


class Window:
    """The n-grams of a window of documents, and what the buckets have answered of them.

    The n-grams of an order, and its contexts, are numbers that each window gives
    itself; a context is the n-gram of the order below that ends before a token,
    or, as the last number, what stands before a text.
    """

    def __init__(self, row: dict, model: Model, order: int):
        self.model, self.ids, self.held = model, row["ids"], np.array(row["held"])
        self.lengths = unpack(row["a"], len(self.ids))
        self.words = size = row["y"]
        t = unpack(row["c"], int(self.lengths.sum()))
        self.starts = np.cumsum(self.lengths) - self.lengths
        trained = np.repeat(~self.held, self.lengths)
        self.token = t
        self.n = {1: np.bincount(t[trained], minlength=size)}
        self.gram, self.context, self.context_of, self.word_of, self.lower, self.lower_context = {1: t}, {}, {1: None}, {1: np.arange(size)}, {}, {}
        for m in range(2, order + 1):
            context = np.empty_like(t)
            context[1:] = self.gram[m - 1][:-1]
            context[self.starts] = size
            keys, gram = np.unique(context * self.words + t, return_inverse=True)
            self.gram[m], self.context[m], self.context_of[m], self.word_of[m] = gram, context, keys // self.words, keys % self.words
            self.lower[m] = np.empty(len(keys), dtype=np.int64)
            self.lower[m][gram] = self.gram[m - 1]
            if m > 2:
                self.lower_context[m] = np.zeros(size + 1, dtype=np.int64)
                self.lower_context[m][context] = self.context[m - 1]
            self.n[m] = np.bincount(gram[trained], minlength=len(keys))
            size = len(keys)
        #: Answers: training counts of n-grams; of contexts their counts, what they are divided by, and the logarithms of their back-off weights.
        self.r: dict[int, np.ndarray] = {}
        self.c: dict[int, np.ndarray] = {}
        self.den: dict[int, np.ndarray] = {}
        self.alpha: dict[int, np.ndarray] = {}

    def context_keys(self, m: int) -> np.ndarray:
        """What contexts are called everywhere: for order 2 the words' numbers, above it hashes of these."""
        number = (self.number + 3).astype(np.uint64)
        keys = np.append(number, np.uint64(START))
        with np.errstate(over="ignore"):
            for k in range(3, m + 1):
                keys = np.append(mix(keys[self.context_of[k - 1]] * ODD[3] + number[self.word_of[k - 1]] * ODD[4]), mix(np.array([START * k], dtype=np.uint64)))
        return keys

    def dealt(self, m: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, n-grams, their contexts, where these begin among the n-grams)."""
        keys, context = self.context_keys(m), self.context_of[m]
        with np.errstate(over="ignore"):
            spread = np.where(self.is_hot(m)[context], mix(keys[context] * ODD[5] + self.number[self.word_of[m]].astype(np.uint64) * ODD[6]), mix(keys[context]))
        bucket = spread % np.uint64(self.model.buckets)
        order = np.argsort(bucket, kind="stable")  # n-grams of one context stay together
        bucket = bucket[order]
        cuts = group_starts(bucket)
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            grams = order[a:b]
            begins = group_starts(context[grams])
            yield int(bucket[a]), grams, context[grams[begins]], begins

    def is_hot(self, m: int) -> np.ndarray:
        return np.append(self.r[m - 1], self.model.train_docs) >= self.model.hot

    def asks(self, m: int, window: int) -> Iterator[pa.RecordBatch]:
        """A row for each bucket: a contexts, b how many n-grams each has here, c last words, d training counts here, e counts one
        order below, f what these are divided by, g which contexts are spread."""
        keys, hot = self.context_keys(m), self.is_hot(m)
        found: dict[str, list] = {c: [] for c in ("bucket", *"abcdefg")}
        for bucket, grams, contexts, begins in self.dealt(m):
            own = self.n[m][grams]
            below = np.where(own > 0, self.r[m - 1][self.lower[m][grams]], 0)
            den = self.den[m - 1][self.lower_context[m][contexts]] if m > 2 else np.zeros(len(contexts), dtype=np.int64)
            values = (bucket, keys[contexts].tobytes(), pack(np.diff(np.append(begins, len(grams)))), pack(self.number[self.word_of[m][grams]]), pack(own), pack(below), pack(den), np.packbits(hot[contexts]).tobytes())
            for name, value in zip(found, values):
                found[name].append(value)
        yield from sliced(rows(ASK, len(found["bucket"]), window=np.full(len(found["bucket"]), window), **found))

    def hear(self, m: int, answers: dict[int, dict], hot_rows: list[dict]) -> None:
        """Takes the buckets' answers of an order."""
        if m == 1:  # buckets are ranges of the words' hashes, so that their answers follow one another
            self.r[1], self.number = (np.concatenate([unpack(row[c], row["x"]) for _, row in sorted(answers.items())]) for c in "ab")
            return
        self.r[m] = np.zeros(len(self.n[m]), dtype=np.int64)
        contexts_here = len(self.n[m - 1]) + 1
        c, free = np.zeros(contexts_here, dtype=np.int64), np.zeros(contexts_here, dtype=bool)
        alpha = np.zeros(contexts_here)
        hot = self.is_hot(m)
        for bucket, grams, contexts, begins in self.dealt(m):
            row = answers[bucket]
            r = self.r[m][grams] = unpack(row["a"], len(grams))
            cold = ~hot[contexts]
            c[contexts[cold]] = unpack(row["b"], len(contexts))[cold]
            free[contexts[cold]] = np.unpackbits(np.frombuffer(row["c"], np.uint8), count=len(contexts)).astype(bool)[cold]
            needed = contexts[asked_weights(r, begins, c[contexts]) & cold]
            if len(needed):
                alpha[needed] = self.model.log_alpha(m, c[needed], unpack(row["d"], K * len(needed)).reshape(-1, K), np.frombuffer(row["e"], "<f8"))
        if hot_rows:
            keys = self.context_keys(m)
            order = np.argsort(keys)
            for row in hot_rows:
                at = order[np.searchsorted(keys, np.uint64(row["x"] % 2**64), sorter=order)]
                counts = np.array([row["m"]])
                c[at], free[at] = row["y"], counts.sum() == 0
                if row["y"]:
                    alpha[at] = self.model.log_alpha(m, c[[at]], counts, np.array([row["room"]]))[0]
        self.c[m], self.den[m], self.alpha[m] = c, c + (free & (c > 0)), alpha

    def log_probabilities(self, m: int) -> np.ndarray:
        """Of the n-grams of an order, each by its own count if it is seen, else by its context's weight and the order below."""
        if m == 1:
            return np.log10(self.model.single(self.r[1]))
        r, context = self.r[m], self.context_of[m]
        seen = r > 0
        below = self.alpha[m][context] + self.log_probabilities(m - 1)[self.lower[m]]
        return np.where(seen, np.log10(self.model.seen(m, np.maximum(r, 1), self.den[m][context])), below)

    def scored(self, order: int) -> pa.Table:
        total = lambda values: np.add.reduceat(values, self.starts)
        known = self.r[1][self.token]
        base = np.log10((known + 0.5) / (self.model.tokens + 0.5 * (self.model.types + 1)))
        return pa.table({
            "id": pa.array(self.ids, pa.string()), "held_out": pa.array(self.held), "n_tokens": pa.array(self.lengths), "n_known": pa.array(total((known > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(self.ids), self.model.tokens, dtype=np.int64)), "base_score": pa.array(total(base)), "score": pa.array(total(self.log_probabilities(order)[self.gram[order]])),
        })


def sliced(batch: pa.RecordBatch, step: int = 500) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(batch), step):
        yield batch.slice(i, step)


def asked_words(row: dict, buckets: int) -> Iterator[pa.RecordBatch]:
    """A window's words by bucket: a hashes, d training counts here."""
    hashes, own = np.frombuffer(row["a"], "<u8"), unpack(row["d"], row["y"])
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = group_starts(bucket)
    ends = np.append(cuts[1:], len(bucket))
    yield from sliced(rows(ASK, len(cuts), window=np.full(len(cuts), row["window"]), bucket=bucket[cuts], a=[hashes[a:b].tobytes() for a, b in zip(cuts, ends)], d=[pack(own[a:b]) for a, b in zip(cuts, ends)]))


def asked_weights(r: np.ndarray, begins: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which contexts' back-off weights a window needs: those seen, with an n-gram that isn't."""
    return np.logical_or.reduceat(r == 0, begins) & (c > 0)


def solve_words(parts: list[dict], model: Model) -> Iterator[pa.RecordBatch]:
    """A bucket of words: their counts and numbers."""
    hashes = [np.frombuffer(p["a"], "<u8") for p in parts]
    whole, at = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.bincount(at, np.concatenate([unpack(p["d"], len(h)) for p, h in zip(parts, hashes)]), len(whole)).astype(np.int64)
    number = np.arange(len(whole)) * model.buckets + parts[0]["bucket"]
    ends = np.cumsum([len(h) for h in hashes])[:-1]
    yield rows(ANSWER, len(parts), window=[p["window"] for p in parts], bucket=[p["bucket"] for p in parts], level=np.full(len(parts), 1), x=[len(h) for h in hashes], a=[pack(count[i]) for i in np.split(at, ends)], b=[pack(number[i]) for i in np.split(at, ends)])
    seen = count > 0
    yield rows(STATS, m=[[int((count == r).sum()) for r in range(1, K + 2)]], x=[int(seen.sum())], y=[int(count.sum())])
    yield rows(GRAMS, bucket=[parts[0]["bucket"]], level=[1], x=[int(seen.sum())], y=[int(seen.sum())], a=[pack(whole[seen])], c=[pack(number[seen])], d=[pack(count[seen])])


def solve(parts: list[dict], model: Model, m: int) -> Iterator[pa.RecordBatch]:
    """A bucket of n-grams: every one of its contexts is whole here, but for spread ones, of which every n-gram is."""
    bucket = parts[0]["bucket"]
    keys = [np.frombuffer(p["a"], "<u8") for p in parts]
    runs = [unpack(p["b"], len(k)) for p, k in zip(parts, keys)]
    sizes = [int(r.sum()) for r in runs]
    word, own, below = (np.concatenate([unpack(p[c], n) for p, n in zip(parts, sizes)]) for c in "cde")
    whole, entry = np.unique(np.concatenate(keys), return_inverse=True)
    den_below, hot = np.zeros(len(whole), dtype=np.int64), np.zeros(len(whole), dtype=bool)
    np.maximum.at(den_below, entry, np.concatenate([unpack(p["f"], len(k)) for p, k in zip(parts, keys)]))
    np.logical_or.at(hot, entry, np.concatenate([np.unpackbits(np.frombuffer(p["g"], np.uint8), count=len(k)) for p, k in zip(parts, keys)]).astype(bool))
    context = np.repeat(entry, np.concatenate(runs))
    order = np.lexsort((word, context))
    first = group_starts(context[order], word[order])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    r, below = np.add.reduceat(own[order], first), np.maximum.reduceat(below[order], first)
    gram_context, gram_word = context[order][first], word[order][first]
    del order, own, context
    seen = r > 0
    c = np.bincount(gram_context, r, len(whole)).astype(np.int64)
    counts = np.stack([np.bincount(gram_context[r == k], minlength=len(whole)) for k in range(1, K + 1)], axis=1)
    share = model.seen(m - 1, below[seen], den_below[gram_context[seen]])
    room = np.bincount(gram_context[seen], share, len(whole))
    free = counts.sum(axis=1) == 0
    # answers
    answers: dict[str, list] = {x: [] for x in "abcde"}
    at = at_entry = 0
    for run, n in zip(runs, sizes):
        mine, contexts = r[group[at : at + n]], entry[at_entry : at_entry + len(run)]
        needed = contexts[asked_weights(mine, np.cumsum(run) - run, c[contexts]) & ~hot[contexts]]
        for x, value in zip("abcde", (pack(mine), pack(c[contexts]), np.packbits(free[contexts]).tobytes(), pack(counts[needed].ravel()), room[needed].tobytes())):
            answers[x].append(value)
        at, at_entry = at + n, at_entry + len(run)
    n = len(parts)
    yield from sliced(rows(ANSWER, n, window=[p["window"] for p in parts], bucket=np.full(n, bucket), level=np.full(n, m), **answers))
    yield rows(STATS, m=[[int((r == k).sum()) for k in range(1, K + 2)]], x=[int(seen.sum())], y=[int(r.sum())])
    # tables
    kept_contexts = np.flatnonzero(c > 0)
    if len(kept_contexts):
        runs = np.bincount(gram_context[seen], minlength=len(whole))[kept_contexts]
        yield rows(GRAMS, bucket=[bucket], level=[m], x=[int(seen.sum())], y=[len(kept_contexts)], a=[pack(whole[kept_contexts])], b=[pack(runs)], c=[pack(gram_word[seen])], d=[pack(r[seen])], e=[room[kept_contexts].tobytes()], g=[np.packbits(hot[kept_contexts]).tobytes()])
    spread = np.flatnonzero(hot)
    if len(spread):
        yield rows(PART, len(spread), x=whole[spread].view(np.int64), y=c[spread], m=counts[spread].tolist(), room=room[spread])
        asked = np.concatenate([np.full(len(k), p["window"]) for p, k in zip(parts, keys)])
        some = np.flatnonzero(hot[entry])
        yield rows(WANT, len(some), window=asked[some], x=whole[entry[some]].view(np.int64))


class Katz:
    """Learns from the rows where ``train`` holds and scores all rows.

    Tokens: the text's words (A-Z lower-cased, between ASCII white space), then
    one end. An n-gram seen r > 0 times after a context h has the probability
    d(r) * r / c(h), any other one alpha(h) times its probability without the
    first word of h, and so on down to single tokens, whose rest belongs to the one class of unknown
    words. d are Good-Turing discounts of each order; alpha(h) is (1 - sum of the
    seen) / (1 - sum of what the order below gives them), so that the
    probabilities after each context add up to one exactly; a context that training lacks
    has alpha 1. A context whose counts are all above K counts once more than it
    occurs, which leaves the unseen some mass. Before a text stand as many marks as there are words in a context.

    Order by order, windows of documents (at least ``window_tokens`` tokens each)
    send their distinct n-grams, packed, to buckets of contexts (about
    ``bucket_tokens`` tokens each), with their counts there and what the order below
    said; buckets add up, write the tables of n-grams and contexts, and
    answer each window what it asked for. So a probability is put together where
    the text is, from the top order down. What a window sends of an n-gram
    doesn't grow with its repeats. Contexts with a large share of the tokens are spread
    over the buckets, n-gram by n-gram; their sums are joined. Neither that nor the
    numbers of windows and buckets changes a probability.

    ``ngrams`` and ``contexts`` give the stored tables, which are partitioned by
    order and, inside, by bucket of the context's hash.

    Null and empty texts have one token, the end. Null ids and repeated rows are
    rows like others. Without training rows everything is unknown with
    probability 1; an empty table gives no rows. Other columns are not read.
    """

    def __init__(self, docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, window_tokens: int = 1_000_000, bucket_tokens: int = 1_000_000):
        self.docs, self.train, self.id_col, self.text_col, self.order = docs, F.coalesce(train, F.lit(False)), id_col, text_col, order
        self.window_tokens, self.bucket_tokens = window_tokens, bucket_tokens
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "katz")

    def _found(self, m: int, kind: int) -> DataFrame:
        return self.found[m].where(F.col("kind") == kind)

    def _states(self, m: int) -> DataFrame:
        """The windows with all answers of the orders below m."""
        out = self.windows
        for k in range(1, m):
            out = out.unionByName(self._found(k, ANSWER)).unionByName(self.hot[k]) if k > 1 else out.unionByName(self._found(1, ANSWER))
        return out

    def _grouped(self, m: int, work, schema: str) -> DataFrame:
        """work(window, number) for each window once it has heard of the orders below m."""
        model, order = self.model, self.order

        def one(table: pa.Table) -> pa.Table:
            told: dict[int, dict[int, dict]] = {}
            hot: dict[int, list[dict]] = {}
            window = None
            for row in table.to_pylist():
                if row["kind"] == WINDOW:
                    window, number = Window(row, model, min(order, m)), row["window"]
                elif row["kind"] == ANSWER:
                    told.setdefault(row["level"], {})[row["bucket"]] = row
                else:
                    hot.setdefault(row["level"], []).append(row)
            for k in range(1, m):
                window.hear(k, told[k], hot.get(k, []))
            out = work(window, number)
            del window, told
            give_back()
            return out

        return self._states(m).groupBy("window").applyInArrow(one, schema)

    def fit(self) -> Model:
        """Counts all orders, one after the other."""
        told, most = self.docs.select(F.col(self.id_col).cast("string"), ~self.train, F.col(self.text_col).cast("binary")), self.window_tokens
        made = self.scratch.write(told.mapInArrow(lambda batches: windows(batches, most), SCHEMA), "windows", ["kind"]).select(*TYPES)
        self.windows, words = made.where(F.col("kind") == WINDOW), made.where(F.col("kind") == WORDS)
        everything = self.windows.agg(F.sum("x")).first()[0] or 0
        trained = self.windows.select(F.explode("held").alias("held")).where("not held").count()
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(everything / self.bucket_tokens))
        self.model, self.found, self.hot = Model(trained, buckets, max(2, everything // (2 * buckets))), {}, {}
        for m in range(1, self.order + 1):
            model = self.model
            if m == 1:

                def ask(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
                    for batch in batches:
                        for row in batch.to_pylist():
                            yield from asked_words(row, model.buckets)

                asked = words.mapInArrow(ask, SCHEMA)
            else:
                asked = self._grouped(m, lambda w, number, m=m: pa.Table.from_batches(list(w.asks(m, number))), SCHEMA)

            def answer(batches: Iterator[pa.RecordBatch], model=model, m=m) -> Iterator[pa.RecordBatch]:
                parts: list[dict] = []
                solved = lambda: solve_words(parts, model) if m == 1 else solve(parts, model, m)
                for batch in batches:
                    for row in batch.to_pylist():
                        if parts and parts[0]["bucket"] != row["bucket"]:
                            yield from solved()
                            parts = []
                        parts.append(row)
                if parts:
                    yield from solved()
                give_back()

            needed = [f.name for f in self.windows.schema if f.name in ("window", "bucket", *"abcdefg")]
            answered = asked.select(*needed).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, SCHEMA)
            self.found[m] = self.scratch.write(answered, f"order{m}", ["kind"]).select(*TYPES)
            del asked, answered
            release_shuffles(self.spark)
            if m == 1:  # from now on words have numbers
                self.scratch.drop(f"windows/kind={WORDS}")
            sums = self._found(m, STATS).agg(*(F.sum(F.col("m")[i]) for i in range(K + 1)), F.sum("x"), F.sum("y")).first()
            *n, types, tokens = (int(v or 0) for v in sums)
            self.model.learn(m, n, types, tokens)
            if m > 1:
                self._spread(m)
        return self.model

    def _spread(self, m: int) -> None:
        """Adds up the contexts that were spread, for the windows that want them."""
        parts = self._found(m, PART).groupBy("x").agg(F.sum("y").alias("y"), F.array(*(F.sum(F.col("m")[i]) for i in range(K))).alias("m"), F.sum("room").alias("room"))
        wanted = self.scratch.write(self._found(m, WANT).select("window", "x").distinct(), f"wanted{m}")
        sized = self.scratch.write(parts.join(wanted.groupBy("x").agg(F.count(F.lit(1)).alias("askers")), "x"), f"spread{m}")
        told = spread_join(wanted, sized, "x", "askers").select("window", "x", "y", "m", "room")
        given = {"kind": F.lit(PART), "level": F.lit(m)} | {c: F.col(c) for c in ("window", "x", "y", "m", "room")}
        types = {f.name: f.dataType for f in self.windows.schema}
        self.hot[m] = self.scratch.write(told.select(*(given.get(c, F.lit(None)).cast(types[c]).alias(c) for c in TYPES)), f"hot{m}")

    def scores(self) -> DataFrame:
        """A row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
        self.fit()
        order = self.order
        out = self._grouped(order + 1, lambda w, number: w.scored(order), "id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        return out.withColumn("id", F.col("id").cast(self.docs.schema[self.id_col].dataType)).withColumnRenamed("id", self.id_col)

    def ngrams(self, m: int) -> DataFrame:
        """The stored n-grams of an order: bucket, context (of order 1: the word's hash), word (its number), count."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    context, word, count = unpack(row["a"], row["y"]), unpack(row["c"], row["x"]), unpack(row["d"], row["x"])
                    if m > 1:
                        context = np.repeat(context, unpack(row["b"], row["y"]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), row["bucket"])), pa.array(context), pa.array(word), pa.array(count)], ["bucket", "context", "word", "count"])

        return self._found(m, GRAMS).select("bucket", "x", "y", "a", "b", "c", "d").mapInArrow(run, "bucket long, context long, word long, count long")

    def contexts(self, m: int) -> DataFrame:
        """The stored contexts of an order: context, count, log_alpha (base 10). Spread ones are added up from their buckets."""
        model = self.model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["kind"] == GRAMS:
                        whole = ~np.unpackbits(np.frombuffer(row["g"], np.uint8), count=row["y"]).astype(bool)
                        runs, seen = unpack(row["b"], row["y"]), unpack(row["d"], row["x"])
                        begins = np.cumsum(runs) - runs
                        context, count, room = unpack(row["a"], row["y"])[whole], np.add.reduceat(seen, begins)[whole], np.frombuffer(row["e"], "<f8")[whole]
                        counts = np.stack([np.add.reduceat((seen == k).astype(np.int64), begins) for k in range(1, K + 1)], axis=1)[whole]
                    else:
                        context, count, counts, room = np.array([row["x"]]), np.array([row["y"]]), np.array([row["m"]]), np.array([row["room"]])
                    yield pa.RecordBatch.from_arrays([pa.array(context), pa.array(count), pa.array(model.log_alpha(m, count, counts, room))], ["context", "count", "log_alpha"])

        spread = self._found(m, PART).groupBy("kind", "x").agg(F.sum("y").alias("y"), F.array(*(F.sum(F.col("m")[i]) for i in range(K))).alias("m"), F.sum("room").alias("room")).where("y > 0")
        columns = ("kind", "x", "y", "m", "room", "a", "b", "d", "e", "g")
        rows_of = self._found(m, GRAMS).select(*columns).unionByName(spread, allowMissingColumns=True)
        return rows_of.mapInArrow(run, "context long, count long, log_alpha double")
