"""Exact top-k inner products by columnar branch and bound over dimension blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch

#: Integers below this are exact in a double.
EXACT = 2.0**53
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; null for vectors that are null or hold null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of 64-bit integers."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


def suffix_norms(rows: np.ndarray, blocks: list[slice]) -> np.ndarray:
    """For each number of blocks done, the norm of what is left of each row."""
    squares = np.stack([np.square(rows[:, b]).sum(axis=1) for b in blocks] + [np.zeros(len(rows))])
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])


class Best:
    """The k highest scores of each query so far, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), LOWEST, dtype=np.int64)
        self.ids = np.full((n, k), HIGHEST, dtype=np.int64)
        self.held = np.zeros(n, dtype=np.int64)
        self.k = k

    def least(self) -> np.ndarray:
        """What a candidate must reach."""
        return np.where(self.held == self.k, self.scores[:, -1].astype(np.float64), -np.inf)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        rows = np.unique(q)
        old = np.arange(self.k) < self.held[rows, None]
        q_all = np.concatenate([q, np.repeat(rows, self.held[rows])])
        s_all = np.concatenate([scores, self.scores[rows][old]])
        i_all = np.concatenate([ids, self.ids[rows][old]])
        order = np.lexsort((i_all, ~s_all, q_all))  # ~: highest first, without leaving the integers
        q_all, s_all, i_all = q_all[order], s_all[order], i_all[order]
        place = np.arange(len(q_all)) - np.searchsorted(q_all, q_all)
        top = place < self.k
        self.scores[q_all[top], place[top]] = s_all[top]
        self.ids[q_all[top], place[top]] = i_all[top]
        self.held[rows] = np.minimum(self.k, np.bincount(q_all)[rows])


def products(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, c: np.ndarray, step: int = 10_000) -> np.ndarray:
    """The inner products of pairs in integers of any size, kept within those of 64 bits."""
    out = np.empty(len(q), dtype=np.int64)
    for i in range(0, len(q), step):
        exact = (queries[q[i : i + step]].astype(object) * rows[c[i : i + step]].astype(object)).sum(axis=1)
        out[i : i + step] = [min(max(int(x), LOWEST), HIGHEST) for x in exact]
    return out


def search(best: Best, queries: np.ndarray, own: np.ndarray, rows: np.ndarray, uids: np.ndarray, ids: np.ndarray, blocks: list[slice]) -> int:
    """Adds a block of candidates to ``best``; returns the number of pairs that reached the last dimension block.

    Scores accumulate one dimension block at a time over the candidates' columns.
    After each, what is still possible is the sum so far plus the product of the
    remaining norms (Cauchy-Schwarz); pairs that can't reach the query's k-th
    score fall away and the survivors are compacted. A row (``uids``) is no
    candidate of the query that it is itself (``own``). Where sums may leave the
    integers that a double holds, bounds allow for that and survivors are summed
    again in whole numbers.
    """
    fine_q, fine_c = queries.astype(np.float64), rows.astype(np.float64)
    exact = float(np.abs(fine_q).max(initial=0)) * float(np.abs(fine_c).max(initial=0)) * max(1, rows.shape[1]) < EXACT
    q_left, c_left = suffix_norms(fine_q, blocks), suffix_norms(fine_c, blocks)
    columns = [np.ascontiguousarray(fine_c[:, b].T) for b in blocks]  # vertical layout
    need = best.least()
    if not exact:
        need = need - 1e-9 * np.abs(need)
    slack = lambda done, q, c: q_left[done][q] * c_left[done][c] * (1 + 1e-9) + 1 + (0 if exact else 1e-9 * q_left[0][q] * c_left[0][c])
    every_q, every_c = np.arange(len(queries))[:, None], np.arange(len(rows))[None, :]
    # the first block is a dense product; what is left of it is a list of pairs
    sums = fine_q[:, blocks[0]] @ columns[0]
    alive = sums + slack(1, every_q, every_c) >= need[:, None]
    alive &= own[:, None] != uids[None, :]
    kept = np.arange(len(rows))
    done = 1
    while done < len(blocks) and alive.mean() > 0.2:  # too many for a list: stay dense, on the candidates that any query still wants
        keep = np.flatnonzero(alive.any(axis=0))
        if len(keep) < len(kept):
            sums, alive, kept = sums[:, keep], alive[:, keep], kept[keep]
        sums = sums + fine_q[:, blocks[done]] @ columns[done][:, kept]
        done += 1
        alive &= sums + slack(done, every_q, kept[None, :]) >= need[:, None]
    q, c = np.nonzero(alive)
    part, c = sums[q, c], kept[c]
    for b in range(done, len(blocks)):
        part = part + np.einsum("ij,ji->i", fine_q[q][:, blocks[b]], columns[b][:, c])
        stay = part + slack(b + 1, q, c) >= need[q]
        q, c, part = q[stay], c[stay], part[stay]
    scores = part.astype(np.int64) if exact else products(queries, rows, q, c)
    best.add(q, scores, ids[c])
    return len(q)


def best_of(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, uids: np.ndarray, ids: np.ndarray, blocks: list[slice], k: int, most: int) -> tuple[Best, int]:
    """The best k of all candidates, and how many pairs reached the last dimension block.

    Large norms come first, and few rows first, so that there is a k-th score before most candidates come."""
    best = Best(len(queries), k)
    strong = np.argsort(-np.square(rows.astype(np.float64)).sum(axis=1), kind="stable")
    at, size, reached = 0, min(2 * k, most), 0
    while at < len(rows):
        some = strong[at : at + size]
        reached += search(best, queries, own, rows[some], uids[some], ids[some], blocks)
        at, size = at + size, min(2 * size, most)
    return best, reached


def top_k(
    vectors: DataFrame, asks: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "vector",
    dims_per_block: int = 16, rows_per_block: int = 1024, cell: tuple[int, int] = (8192, 4096), cell_bytes: int = 64 << 20,
) -> DataFrame:
    """(query_id, rank, id, score): the k highest integer inner products of each row for which ``asks`` holds, among all
    other rows, ties to the smaller id.

    ``vectors`` holds an id and an array of longs (see ``quantised``). Candidates
    and queries are dealt into groups of about ``cell`` rows (fewer where vectors
    are so long that a group would pass ``cell_bytes``); a task takes one group of
    each, the candidates by falling norm in blocks of 2 * k rows, then ever more up to ``rows_per_block``, and passes on k rows a query,
    which a second stage merges. Nothing is sent to the driver or to every task; a
    row is moved once for each group of the other side.

    Rows whose vector or id is null take no part. A row is told from its repeats
    by its place: only the query's own row is not its candidate, other rows of its
    id are. Of several rows with one id that ask, the one with the least vector
    (by its components in turn) does. Vectors of another length than the query's
    aren't compared; empty vectors score 0. Components are 64-bit integers, sums are
    exact, and scores beyond 64 bits are the nearest integers within. With fewer
    candidates than k there are fewer rows; empty tables give none.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    usable = vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
    rows = usable.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.size(vector_col).alias("dims"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = scratch.write(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
    first = rows.where("asks").groupBy("id").agg(F.min(F.struct("v", "uid"))["uid"].alias("uid"))
    queries = scratch.write(rows.join(first, "uid", "left_semi"), "queries")
    n, longest = rows.agg(F.count(F.lit(1)), F.max("dims")).first()
    most = max(1, cell_bytes // (8 * max(1, longest or 1)))
    groups, query_groups = (max(1, math.ceil(many / min(size, most))) for many, size in zip((n, queries.count()), cell))
    deal = lambda df, name, n, other, m: df.select("uid", "id", "v", "dims", F.pmod(F.xxhash64("uid"), F.lit(n).cast("long")).alias(name), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))
    key = ("dims", "g", "h")
    left, right = deal(rows, "g", groups, "h", query_groups).groupBy(*key), deal(queries, "h", query_groups, "g", groups).groupBy(*key)

    def compare(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
        if not len(candidates) or not len(asking):
            return schema.empty_table()
        own, query_ids, q = asking["uid"].to_numpy(), asking["id"].to_numpy(), matrix(asking["v"])
        uids, ids, c = candidates["uid"].to_numpy(), candidates["id"].to_numpy(), matrix(candidates["v"])
        blocks = [slice(b, min(b + dims_per_block, c.shape[1])) for b in range(0, c.shape[1], dims_per_block)] or [slice(0, 0)]
        top, _ = best_of(q, own, c, uids, ids, blocks, k, rows_per_block)
        held = np.arange(k) < top.held[:, None]
        return pa.table([np.repeat(query_ids, top.held), top.ids[held], top.scores[held]], schema=schema)

    out = left.cogroup(right).applyInArrow(compare, "query_id long, id long, score long")
    ranked = out.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
