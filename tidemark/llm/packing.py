"""Cost-balanced packing of tokenised documents into training sequences."""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dealt_out, let_go, own_worker

END_ID = 0
#: id 50256 of the vocabulary; its string in a text is that id, as in the library's own reading.
SPECIAL = "<|endoftext|>"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Whole texts to ids (little-endian unsigned 32-bit): by the ranks, which is faster, or, where the special string is in a text, by the library that knows it."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = functools.cache(lambda: Tokenizer.from_file(json_path))

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return array("I", self.slow().encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.plain.encode_ordinary(text)).tobytes()


def encoder(json_path: str, ranks_path: str) -> Encoder:
    """One for each Python worker."""
    return own_worker(f"encoder {json_path} {ranks_path}", lambda: Encoder(json_path, ranks_path))


def place(lengths: np.ndarray, size: int, linear: float, quadratic: float, longest: int) -> list[tuple[int, int, int, int, int]]:
    """Assigns documents of these lengths to sequences: (document, start, length, sequence, offset).

    A document's cost is linear * n + quadratic * n^2 for each of its pieces, as
    attention stays inside a document. Documents are cut into pieces of ``longest``
    tokens and a rest: a piece that fills a sequence alone has a cost that no
    other sequence can be brought to. Pieces go, longest first, to the lowest-cost
    sequence with room for them; if there is none a piece is cut at the room of the
    lowest-cost open one. The sequences' capacities add up to the tokens: ``size``
    each, and the remainder as powers of two, which need no padding.
    """
    out: list[tuple[int, int, int, int, int]] = []
    pieces = [(min(longest, n - start), d, start) for d, n in enumerate(lengths.tolist()) for start in range(0, n, longest)]
    total = int(lengths.sum())
    room = [size] * (total // size) + [1 << b for b in reversed(range(size.bit_length())) if (total % size) >> b & 1]
    capacity = np.array(room, dtype=np.int64)
    left, cost = capacity.copy(), np.zeros(len(room))
    for n, d, start in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        while n:
            fits = left >= n
            if not fits.any():
                fits = left > 0
            s = int(np.where(fits, cost, np.inf).argmin())
            take = min(n, int(left[s]))
            out.append((d, start, take, s, int(capacity[s] - left[s])))
            left[s] -= take
            cost[s] += linear * take + quadratic * take * take
            n, start = n - take, start + take
    return out


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, linear: float = 1.0, quadratic: float = 1 / 1024,
    longest: int = 512, window_tokens: int = 2_000_000, json_path: str | None = None, ranks_path: str | None = None,
) -> DataFrame:
    """Packs every document's tokens, then one end id, into sequences of at most ``size`` tokens.

    Returns a row per piece: id, start and length in the document's ids, ``ids``
    (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (in
    the sequence) and cost. No piece has more than ``longest`` tokens, for the sake of equal costs. Documents are packed where they are read, window by
    window of at least ``window_tokens`` tokens: there is no shuffle, a task
    holds one window, and a task run again gives the same sequences. Sequences
    are full or, at most ten a window, powers of two.

    Null text counts as empty (only the end id); null and repeated ids pass
    through, each row packed for itself; an empty table gives no rows; other
    columns are not read. Both paths are those of the vocabulary's files on each machine.
    """
    json_path = json_path or vocabulary("byte_bpe_50k.json")
    ranks_path = ranks_path or vocabulary("byte_bpe_50k.tiktoken")
    id_type = docs.schema[id_col].dataType
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, first = encoder(json_path, ranks_path), TaskContext.get().partitionId() << 40
        ids: list = []
        tokens: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal first, ids, tokens
            lengths = np.array([len(t) // 4 for t in tokens], dtype=np.int64)
            pieces = place(lengths, size, linear, quadratic, longest)
            d, start, length, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces))
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids).take(pa.array(d)), pa.array(start), pa.array(length),
                    pa.array([tokens[a][4 * b : 4 * (b + c)] for a, b, c, _, _ in pieces], pa.binary()), pa.array(lengths[d]),
                    pa.array(sequence + first), pa.array(offset), pa.array(linear * length + quadratic * length * length),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "cost"],
            )
            first, ids, tokens = first + int(sequence.max()) + 1, [], []
            return batch

        held = 0
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            for i, text in enumerate(texts):
                tokens.append((encode(text) if text else b"") + end)
                held += len(tokens[-1]) // 4
                if held >= window_tokens:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    yield flush()
                    held, at = 0, i + 1
            if at < len(texts):
                ids.append(batch.column(0).slice(at))
        if tokens:
            yield flush()
        del encode
        let_go()

    kind = id_type.simpleString()
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"
    return dealt_out(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema).withColumnRenamed("id", id_col)
