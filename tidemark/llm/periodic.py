"""Periodic runs of words: maximal stretches that repeat a period, by Lyndon arrays whose extensions are matched once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ``periodic_runs`` returns for each text.
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, collapsed string"


def lyndon_array(words: list, ascending: bool = True) -> tuple[list[int], list[int], list[int]]:
    """(after, match, matched): for each position the next one where a smaller suffix starts (words[i:after[i]] is the
    longest Lyndon word from i on), how many words the two suffixes share, and the positions that share any.

    Words are only compared with each other, by < if ascending, else the other way round; the end is smaller than all.
    Suffixes whose successor isn't known yet form a chain, each with the next smaller suffix to its left (``before``) and
    what it shares with that (``shared``). A new suffix r is compared along the chain, by first words as far as these
    differ, then:

    * If r shares a words with the last one, y, and y shares b != a with its own next one, then what r shares with that
      is the lesser of the two, and the order follows: no word is looked at.
    * Else, if the match goes on inside a stretch that equalled an earlier one (from ``right`` up to ``reach`` the words
      are those ``shift`` earlier), the same two suffixes, or their earlier copies, have been compared there, and what
      was found holds unless it comes up to the end of the stretch.
    * Only then words are compared, from ``reach`` on. Each that is equal moves ``reach``, so all of it takes time in
      proportion to the number of words, whatever the text.

    The second rule's comparison always exists: (left, right) were compared, so all between them are smaller suffixes'
    predecessors that have left the chain; what is left of the chain below ``right`` was below ``left`` as well, and one
    that only r leaves out would have to lie between r and its earlier copy, which agree up to ``reach``.
    """
    n = len(words)
    after, match, matched = [n] * n, [0] * n, []
    before, shared = list(range(-1, n - 1)), [0] * n
    reach = right = shift = 0
    pairs = zip(words, words[1:])
    for r in [i for i, (a, b) in enumerate(pairs, 1) if a >= b] if ascending else [i for i, (a, b) in enumerate(pairs, 1) if a <= b]:
        y, word = r - 1, words[r]  # where the word before is smaller, it is the next smaller one already
        if ascending:
            while y >= 0 and words[y] > word:
                after[y] = r
                y = before[y]
        else:
            while y >= 0 and words[y] < word:
                after[y] = r
                y = before[y]
        if y < 0 or words[y] != word:
            before[r] = y
            continue
        a = b = 0
        while y >= 0:
            if a > b:
                a = b
                break
            if a == b:
                smaller = None
                if r + a < reach:
                    other, copy = y - shift if y >= right else y, r - shift
                    smaller = after[other] == copy
                    a = match[other] if smaller else shared[copy]
                    if r + a >= reach:
                        a, smaller = reach - r, None
                if smaller is None:
                    while r + a < n and words[y + a] == words[r + a]:
                        a += 1
                    if r + a > reach:
                        reach, right, shift = r + a, r, r - y
                    smaller = r + a == n or (words[r + a] < words[y + a]) == ascending
                if not smaller:
                    break
            after[y] = r
            if a:
                match[y] = a
                matched.append(y)
            b = shared[y]
            y = before[y]
        before[r] = y
        shared[r] = a if y >= 0 else 0
    return after, match, matched


def find_runs(words: list, least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period), in this order, of every maximal stretch whose smallest period stands ``exponent`` (at
    least 3) times or more in it and that has ``least`` words or more.

    A run whose next word, or the end, breaks the period downwards in one of the two orders holds Lyndon words of the
    period's length in that order, which are longest ones at their places: all runs are among the places where the match
    with the next smaller suffix covers the period. Of a run's places the first is less than a period from its start.
    """
    found = set()
    if len(words) >= least:
        for ascending in (True, False):
            after, match, matched = lyndon_array(words, ascending)
            for i in matched:
                p = after[i] - i
                if match[i] < p or i >= p and after[i - p] == i and match[i - p] >= p:
                    continue
                start = i
                while start and words[start - 1] == words[start + p - 1]:
                    start -= 1
                length = after[i] + match[i] - start
                if length >= max(least, exponent * p):
                    found.add((start, length, p))
    return sorted(found)


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run has after its first period."""
    if not runs:
        return words
    open_ = [0] * (len(words) + 1)
    for start, length, period in runs:
        open_[start + period] += 1
        open_[start + length] -= 1
    kept, depth = [], 0
    for word, step in zip(words, open_):
        depth += step
        if not depth:
            kept.append(word)
    return kept


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; of equal ones the first, then the one of the shortest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(text: Column, least: int = 24, exponent: int = 3, step: int = 500) -> Column:
    """A struct column for texts: n_words, runs (by start, then period), best (the strongest run, null if there is none) and
    collapsed, the text without what repeats: its words joined by one space.

    Texts are judged whole, where they are read: no shuffle, and time in proportion to their words. Words are parted by ASCII
    white space and compared byte by byte. Null counts as empty: no words, no runs, an empty text. Rows are judged one by one, so
    repeated rows, ties, null ids, empty tables and other columns make no difference.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            sizes: list[int] = []
            runs: list[list[dict]] = []
            best: list[dict | None] = []
            texts: list[bytes] = []
            as_row = lambda r: dict(zip(("start", "length", "period"), r))
            for at in range(0, len(batch), step):
                for value in batch.slice(at, step).cast(pa.binary()).to_pylist():
                    words = (value or b"").split()
                    found = find_runs(words, least, exponent)
                    sizes.append(len(words))
                    runs.append([as_row(r) for r in found])
                    best.append(as_row(strongest(found)) if found else None)
                    texts.append(b" ".join(collapse(words, found)))
            columns = [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_words", "runs", "best", "collapsed"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT)(text)
