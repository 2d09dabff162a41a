"""Substring dedup by sliding spans of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ODD, BlockedBloom, Scratch, give_back, mix, placed, words_of_worker

#: A sentence ends with a line, or where . ! or ? stand before white space. A word, for Python.
_CLOSES = np.isin(np.arange(256), list(b".!?"))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: A sentence's first character, with what stands before it.
_BEGIN = r"(?:\A[\x20\x09-\x0D]*|\n[\x20\x09-\x0D]*|(?<=[.!?])[\x20\x09-\x0D]+)[^\x20\x09-\x0D]"

#: Of RUN consecutive words there is a run where their hash is the least of WINDOW neighbouring ones: of a repeated stretch
#: the same runs are taken wherever it stands, and one of RUN + WINDOW - 1 = 50 words holds at least one.
RUN, WINDOW = 34, 17


def sentence_count(text: Column) -> Column:
    """How many sentences that aren't blank the text has."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_BEGIN)).cast("long")


def word_runs(words: np.ndarray) -> np.ndarray:
    """The runs of RUN words (first word << 32 | end) that are taken from these words; of fewer than 50, the one of least hash."""
    first = np.arange(len(words) - RUN + 1, dtype=np.int64)
    if not len(first):
        return first
    hashes = span_hashes(words, first << 32 | first + RUN, ODD[3]).view(np.uint64)
    taken = np.lib.stride_tricks.sliding_window_view(hashes, min(WINDOW, len(hashes))).argmin(axis=1)
    first = np.unique(taken + np.arange(len(taken)))
    return first << 32 | first + RUN


def spans(text: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(span, hash, second hash) of each run of sentences or words: its first word << 32 | the word behind it, and two hashes of its words."""
    hasher, data = words_of_worker(), np.frombuffer(text.encode(), dtype=np.uint8)
    begin, end = hasher.bounds(data)
    words = hasher.hashes(data, begin, end)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(words) + 1, dtype=bool)
    opens[1:-1] = (lines[begin[1:]] > lines[end[:-1]]) | _CLOSES[data[end[:-1] - 1]]
    starts = np.flatnonzero(opens)
    at = np.union1d(starts[:-k] << 32 | starts[k:], word_runs(words))
    return at, span_hashes(words, at, ODD[0]), span_hashes(words, at, ODD[7]).view(np.uint64).astype(np.uint32)


def span_hashes(words: np.ndarray, at: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of the spans of a text's words, by sums of powers of an odd number modulo 2^64, taken back to the span's start."""
    first, end = at >> 32, at & 0xFFFFFFFF
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(words) + 1, base, dtype=np.uint64))
        back = np.cumprod(np.full(len(words) + 1, pow(int(base), -1, 1 << 64), dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(words ^ base) * power[:-1], dtype=np.uint64)])
        return mix((sums[end] - sums[first]) * back[first] + ODD[9] * (end - first).astype(np.uint64)).view(np.int64)


def without(text: str | None, gone: list[int] | None, least: int = RUN) -> dict | None:
    """The text without the spans ``gone``, each word with the white space after it; and how many sentences lost words.

    Spans of whole sentences go first; of the other spans' words, then, stretches of ``least`` or more.
    """
    if text is None or gone is None:
        return None
    at = [m.span() for m in _WORD.finditer(text)]
    opens = np.ones(len(at) + 1, dtype=bool)
    for i in range(1, len(at)):
        before = text[at[i - 1][1] : at[i][0]]
        opens[i] = "\n" in before or text[at[i - 1][1] - 1] in ".!?"
    cut, part = np.zeros(len(at), dtype=bool), np.zeros(len(at) + 2, dtype=np.int8)
    for s in gone:
        first, end = s >> 32, s & 0xFFFFFFFF
        if opens[first] and opens[end]:
            cut[first:end] = True
        else:
            part[first + 1 : end + 1] = 1
    part[1:-1] &= ~cut
    turns = np.flatnonzero(np.diff(part))
    for first, end in zip(turns[::2], turns[1::2]):
        cut[first:end] |= end - first >= least
    kept, done, sentence, lost = [], 0, 0, set()
    for i, (low, high) in enumerate(at):
        sentence += bool(opens[i])
        if cut[i]:
            lost.add(sentence)
            before = text[at[i - 1][1] if i else 0 : low]
            ended = i > 0 and text[at[i - 1][1] - 1] in ".!?"
            if not ended and (i == 0 or "\n" in before):  # a line's indent is the sentence's, blank lines are nobody's
                low -= len(before) - before.rfind("\n") - 1
            kept.append(text[done:low])
            after = at[i + 1][0] if i + 1 < len(at) else len(text)
            line = text.find("\n", high, after)
            done = after if line < 0 else line + 1
    return {"kept": "".join([*kept, text[done:]]), "gone": len(lost)}


def cut_texts(text: Column, starts: Column, step: int = 500) -> Column:
    """``without`` as a column (kept, gone), some hundred texts at a time."""
    kind = pa.struct([("kept", pa.string()), ("gone", pa.int64())])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans_of in batches:
            parts = [pa.array([without(t, g) for t, g in zip(texts.slice(i, step).to_pylist(), spans_of.slice(i, step).to_pylist())], kind) for i in range(0, len(texts), step)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)
        give_back()

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "kept string, gone long")(text, starts)


#: What is known of a run: two hashes, its row's id (and whether it is null) and number, and where it stands.
RUN_COLUMNS = {"hash": "<u8", "second": "<u4", "no_id": "u1", "id": "<i8", "uid": "<i8", "at": "<i8"}


def _firsts(runs: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The runs in order, and which of them are the first of their words."""
    order = np.lexsort([runs[c] for c in reversed(RUN_COLUMNS)])
    runs = {c: v[order] for c, v in runs.items()}
    return runs, np.concatenate([[True], (runs["hash"][1:] != runs["hash"][:-1]) | (runs["second"][1:] != runs["second"][:-1])])[: len(order)]


def _batch(values: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[c], types[c]) for c in types], list(types))


def _later(runs: dict[str, np.ndarray]) -> pa.RecordBatch:
    """(window, uid, at): a row for each window of these runs."""
    order = np.argsort(runs["uid"], kind="stable")
    uid, at = runs["uid"][order], runs["at"][order]
    window = uid >> 20
    cuts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])[: len(uid)])
    ends = np.append(cuts[1:], len(uid))
    values = {"window": window[cuts], "uid": [uid[a:b].tobytes() for a, b in zip(cuts, ends)], "at": [at[a:b].tobytes() for a, b in zip(cuts, ends)]}
    return _batch(values, {"window": pa.int64(), "uid": pa.binary(), "at": pa.binary()})


def _windows(k: int, most_words: int, numbered: bool):
    """Rows of documents to windows of them: their places, the runs that are the first of their words in the window, and the others."""
    types = {"window": pa.int64(), "places": pa.list_(pa.string()), "runs": pa.int64()} | {c: pa.binary() for c in (*RUN_COLUMNS, "later_uid", "later_at")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        window, places, held = TaskContext.get().partitionId() << 20, [], 0
        found: dict[str, list[np.ndarray]] = {c: [] for c in RUN_COLUMNS}

        def out() -> pa.RecordBatch:
            nonlocal window, places, held
            runs, first = _firsts({c: np.concatenate(v).astype(RUN_COLUMNS[c]) for c, v in found.items()})
            values = {"window": [window], "places": [places], "runs": [int(first.sum())], "later_uid": [runs["uid"][~first].tobytes()], "later_at": [runs["at"][~first].tobytes()]}
            whole = _batch(values | {c: [v[first].tobytes()] for c, v in runs.items()}, types)
            window, places, held = window + 1, [], 0
            for v in found.values():
                v.clear()
            return whole

        for batch in batches:
            for place, number, text in zip(*(c.to_pylist() for c in batch.columns)):
                at, first, second = spans(text or "", k)
                values = (first.view(np.uint64), second, number is None, number if numbered and number is not None else 0, window << 20 | len(places), at)
                for c, v in zip(RUN_COLUMNS, values):
                    found[c].append(v if isinstance(v, np.ndarray) else np.full(len(at), v))
                places.append(place)
                held += len(text or "") // 6 + 1
                if held >= most_words or len(places) == 1 << 20:
                    yield out()
        if places:
            yield out()
        give_back()

    return run, "window long, places array<string>, runs long, " + ", ".join(f"{c} binary" for c in (*RUN_COLUMNS, "later_uid", "later_at"))


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, k: int, scratch: Scratch, window_words: int = 1_000_000, bucket_runs: int = 1_000_000) -> DataFrame:
    """(place, starts): per row of ``docs`` (with _place) its runs (as in ``spans``) that stand earlier too, in another row or its own.

    Windows of documents tell apart the first of equal runs and the others, which
    need not be asked about; the firsts, a row for each window and bucket of hashes,
    meet by bucket, where all but one of each are found to be later ones."""
    types = {"bucket": pa.int64()} | {c: pa.binary() for c in RUN_COLUMNS}
    numbered = docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    make, schema = _windows(k, window_words, numbered)
    told = scratch.write(docs.select("_place", F.col(id_col), F.col(text_col)).mapInArrow(make, schema), "windows")
    total = told.agg(F.sum("runs")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_runs))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                runs = {c: np.frombuffer(row[c], t) for c, t in RUN_COLUMNS.items()}
                bucket = (runs["hash"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                runs, bucket = {c: v[order] for c, v in runs.items()}, bucket[order]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
                values: dict[str, list] = {c: [v[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(bucket)))] for c, v in runs.items()}
                yield _batch(values | {"bucket": bucket[cuts]}, types)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict] = []

        def solve() -> pa.RecordBatch:
            runs, first = _firsts({c: np.concatenate([np.frombuffer(p[c], t) for p in parts]) for c, t in RUN_COLUMNS.items()})
            parts.clear()
            return _later({c: v[~first] for c, v in runs.items()})

        for batch in batches:
            for row in batch.to_pylist():
                if parts and row["bucket"] != parts[0]["bucket"]:
                    yield solve()
                parts.append(row)
        if parts:
            yield solve()
        give_back()

    def gather(rows: pa.Table) -> pa.Table:
        """All later runs of a window, by the places of its documents."""
        uid, at = (np.concatenate([np.frombuffer(v.as_buffer(), "<i8") for v in rows[c] if v.is_valid]) for c in ("uid", "at"))
        places = next(v.values for v in rows["places"] if v.is_valid)
        order = np.argsort(uid, kind="stable")
        number, at = uid[order] & (1 << 20) - 1, at[order]
        cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])[: len(number)])
        ends = pa.array(np.append(cuts, len(number)).astype(np.int32))
        return pa.table({"place": places.take(pa.array(number[cuts])), "starts": pa.ListArray.from_arrays(ends, pa.array(at))})

    dealt = told.select(*RUN_COLUMNS).mapInArrow(deal, "bucket long, " + ", ".join(f"{c} binary" for c in RUN_COLUMNS))
    across = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "window long, uid binary, at binary")
    inside = told.select("window", "places", F.col("later_uid").alias("uid"), F.col("later_at").alias("at"))
    both = inside.unionByName(across, allowMissingColumns=True)
    return scratch.write(both.groupBy("window").applyInArrow(gather, "place string, starts array<long>"), "later")


def dedup_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, bloom_blocks: int | None = None,
) -> DataFrame:
    """docs with ``text_col`` freed of repeated sentences, and n_sentences and n_removed (long) added (or replaced).

    Every k consecutive sentences (blank ones not counted) are a run. So are some
    stretches of RUN words, whatever sentences they stand in (see ``RUN``): every
    stretch of 50 words that recurs holds such a run. Runs are equal if their words
    have the same 64-bit and the same second 32-bit hash. The first place of a run stays (of
    the smallest id where ids are whole numbers, null ids last, then of the row
    read first, then in its text); what a run covers at any other
    place goes, with the white space after it: whole sentences, and parts of
    others where ``RUN`` or more words together are left to cut. A sentence that
    loses some of its words counts as removed too. A run that a third of all rows hold
    moves once for each window of documents; rows without repeats are not shuffled.

    Null text stays null and has no sentences; texts with fewer than k sentences
    have no run of sentences; of repeated rows one stays whole; a text may become
    empty; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "spans")
    keep = [c for c in docs.columns if c not in (text_col, "n_sentences", "n_removed")]
    # own names for what is used here; the other columns pass through in one struct, whatever they are called
    docs = placed(docs.select(F.struct(*keep).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    later = repeated_spans(docs, "_id", "_text", k, scratch)
    bloom = BlockedBloom(bloom_blocks)
    filled = bloom.build(later, "place")
    count = F.when(F.col("_text").isNull(), F.lit(0).cast("long")).otherwise(sentence_count(F.col("_text"))).alias("n_sentences")
    rest = bloom.may_hold(docs, filled, "_place", keep=False)
    rest = rest.select("_row.*", F.col("_text").alias(text_col), count, F.lit(0).cast("long").alias("n_removed"))
    touched = bloom.may_hold(docs, filled, "_place").join(later.withColumnRenamed("place", "_later"), F.col("_place") == F.col("_later"), "left")
    touched = touched.withColumn("_cut", cut_texts(F.col("_text"), F.col("starts")))
    text = F.when(F.col("_cut").isNotNull(), F.col("_cut.kept")).otherwise(F.col("_text")).alias(text_col)
    touched = touched.select("_row.*", text, count, F.coalesce(F.col("_cut.gone"), F.lit(0)).cast("long").alias("n_removed"))
    return touched.unionByName(rest)
