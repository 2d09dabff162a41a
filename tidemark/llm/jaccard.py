"""N-gram Jaccard join: size-aware, light sets by fixed-size subsets, heavy sets by inverted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ODD, BlockedBloom, Scratch, from_files, give_back, mix, placed, spread_join, without, words_of_worker
from tidemark.llm.components import components

#: The subsets' size.
SUBSET = 2
COUNTERS, SLICES = 1 << 20, 64


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles; of fewer words, the whole sequence as one; of none, none."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        if len(words) < k:
            return mix((words * ODD[: len(words)]).sum(keepdims=True) + ODD[9] * np.uint64(len(words)))
        n = len(words) - k + 1
        h = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            h += words[j : j + n] * ODD[j]
        return np.unique(mix(h))


def least_overlap(n: int, percent: int) -> int:
    """What a set of n shares at least with a partner of that Jaccard similarity."""
    return -(-n * percent // 100)


def least_size(percent: int) -> int:
    """The size from which on a set can be similar to one that isn't equal: with one more shingle."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 31


def boundary(counts: np.ndarray, percent: int, k: int = SUBSET) -> int:
    """The largest size at which enumerating a light set's subsets costs no more than scanning its inverted lists.

    A set of n has p = n - overlap + k rare shingles to make p * (p - 1) / 2
    subsets of, each one row; or p - 1 lists, each one row and as many reads as a
    list of the rare shingles is long. The rare ones are the first 1 - percent of
    all occurrences; the counters tell how full the last counter among these is,
    against the mean filling, which is what falls into a counter by chance.
    """
    total = float(counts.sum())
    if not total:
        return 4
    ordered = np.sort(counts[counts > 0])
    rare = ordered[np.searchsorted(np.cumsum(ordered), total * (100 - percent) / 100)]
    mean_list = max(1.0, float(rare) / max(1.0, total / len(counts)))
    best = 4
    for n in range(4, 2000):
        p = n - least_overlap(n, percent) + k
        if p * (p - 1) / 2 <= (p - 1) * (1 + mean_list):
            best = n
    return best


def signature_keys(own: np.ndarray, counts: np.ndarray, percent: int, light: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, free, pos) of a set: where it meets its partners.

    The order is rare first: by counter, then by hash, the same for every set, so
    that partners share a shingle among the first n - overlap + 1, and two among
    one more. Light sets meet on pairs of those; heavy sets meet all others on
    single ones, where light sets large enough for a heavy partner wait too (not
    ``free``: two of them have met already). ``pos`` is the shingle's place in
    that order (of a pair, the second one's less one): two sets that have to share
    more than the least overlap meet on the first n - overlap places already. At
    low percentages some small sets need share but one shingle; they meet on single ones too.
    """
    n = len(own)
    if n < least_size(percent):  # a partner would be the same set
        return own[:0], np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int32)
    one = least_overlap(n, percent) < SUBSET
    p = n - least_overlap(n, percent) + SUBSET
    order = np.lexsort((own, counts[(own >> np.uint64(44)).astype(np.int64)]))
    rare = own[order[:p]]
    singles = rare[: p - 1]
    if n > light:
        return singles, np.ones(len(singles), dtype=bool), np.arange(len(singles), dtype=np.int32)
    i, j = np.triu_indices(len(rare), 1)
    with np.errstate(over="ignore"):
        low, high = np.minimum(rare[i], rare[j]), np.maximum(rare[i], rare[j])
        pairs = mix(low * ODD[5] + high * ODD[6])
    if 100 * n < percent * (light + 1) and not one:
        return pairs, np.ones(len(pairs), dtype=bool), (j - 1).astype(np.int32)
    return (
        np.concatenate([pairs, singles]), np.concatenate([np.ones(len(pairs), dtype=bool), np.full(len(singles), one)]),
        np.concatenate([j - 1, np.arange(len(singles))]).astype(np.int32),
    )


def _count(docs: DataFrame, text_col: str, k: int, scratch: Scratch) -> np.ndarray:
    """A fixed number of counters over all shingles of all texts; only they go to the driver and to every task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = words_of_worker(), np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            held: list[np.ndarray] = []
            for text in batch.column(0).to_pylist():
                if text:
                    held.append(shingles(words(text), k) >> np.uint64(44))
                    if len(held) == 1000:
                        np.add(counts, np.bincount(np.concatenate(held).astype(np.int64), minlength=COUNTERS).astype(np.uint32), out=counts)
                        held = []
            if held:
                np.add(counts, np.bincount(np.concatenate(held).astype(np.int64), minlength=COUNTERS).astype(np.uint32), out=counts)
        for i, part in enumerate(np.split(counts.astype("<u8"), SLICES)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.astype("<u4").tobytes()], pa.binary())], ["slice", "counts"])
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part, dtype="<u4" if len(part) == 4 * COUNTERS // SLICES else "<u8")
                sums[i] = sums[i] + part if i in sums else part.astype(np.uint64)
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.astype("<u8").tobytes()], pa.binary())], ["slice", "counts"])

    parts = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "slice int, counts binary")
    total = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint64)
    for row in parts.repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect():
        total[row["slice"]] = np.frombuffer(row["counts"], dtype="<u8")
    return total.ravel()


def sketch(own: np.ndarray) -> bytes:
    """How many shingles fall into each of some four times as many counters, by their last bits: two bits each, up to three.

    What two sets share is no more than their lesser counters add up to, and the
    lesser of what each has beyond its counters."""
    size = 1 << max(6, min(20, int(len(own)).bit_length() + 2))
    counts = np.minimum(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size), 3).astype(np.uint8)
    return (counts[0::4] | counts[1::4] << 2 | counts[2::4] << 4 | counts[3::4] << 6).tobytes()


def counters(sketches: list[np.ndarray], size: int) -> np.ndarray:
    """The counters of sketches of one size, folded onto ``size`` of them."""
    packed = np.stack(sketches)
    spread = np.stack([packed >> shift & 3 for shift in (0, 2, 4, 6)], axis=2).reshape(len(packed), -1)
    return spread.reshape(len(packed), -1, size).sum(axis=1, dtype=np.uint16)


def may_be_similar(sketches: pa.Array, n: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, step: int = 1 << 22) -> np.ndarray:
    """Whether the sketches of rows x and y leave it possible that their sets of n[x] and n[y] shingles are similar.

    Larger sketches fold onto the size of smaller ones; all are folded to an eighth first, which few pairs pass."""
    data = np.frombuffer(sketches.buffers()[2] or b"", dtype=np.uint8)
    ends = np.frombuffer(sketches.buffers()[1], dtype=np.int32)[sketches.offset : sketches.offset + len(sketches) + 1].astype(np.int64)
    sizes = 4 * np.diff(ends)
    out = np.ones(len(x), dtype=bool)
    small, large = np.where(sizes[x] <= sizes[y], x, y), np.where(sizes[x] <= sizes[y], y, x)
    kinds = sizes[small] << 32 | sizes[large]
    at, beyond = np.empty(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)

    def folded(rows: np.ndarray, size: int) -> np.ndarray:
        """The counters of these rows, whose sketches have one size; ``at`` then says where, ``beyond`` what they leave out."""
        found = counters([data[ends[r] : ends[r + 1]] for r in rows], size)
        at[rows] = np.arange(len(rows))
        beyond[rows] = n[rows] - found.sum(axis=1, dtype=np.int64)
        return found

    for kind in np.unique(kinds):
        whole = int(kind) >> 32
        for size in (whole // 8, whole):
            pairs = np.flatnonzero((kinds == kind) & out)
            if not len(pairs):
                break
            left, left_at = folded(np.unique(small[pairs]), size), at[small[pairs]]
            right, right_at = folded(np.unique(large[pairs]), size), at[large[pairs]]
            for i in range(0, len(pairs), max(1, step // size)):
                j = slice(i, i + max(1, step // size))
                some = pairs[j]
                most = np.minimum(left[left_at[j]], right[right_at[j]]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[x[some]], beyond[y[some]])
                out[some] = 100 * most >= percent * (n[x[some]] + n[y[some]] - most)
    return out


def fitting(n_x, n_y, pos_x, pos_y, percent: int):
    """Sizes and places allow the pair: of n shingles, n - overlap may stand before the first common one."""
    overlap = -(-percent * (n_x + n_y) // (100 + percent))
    return (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y)) & (pos_x <= n_x - overlap) & (pos_y <= n_y - overlap)


def similar_pairs(owns: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether each of the sets ``left`` is similar to each of ``right``: their overlaps are products of the sets' 0-1 matrix, 2048 shingles at a time."""
    sizes = np.array([len(o) for o in owns], dtype=np.int64)
    _, shingle, counts = np.unique(np.concatenate(owns), return_inverse=True, return_counts=True)
    often = counts > 1
    keep = often[shingle]
    column, owner = (np.cumsum(often) - 1)[shingle[keep]], np.repeat(np.arange(len(owns)), sizes)[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(left), len(right)), dtype=np.int64)
    for first in range(0, int(often.sum()), 2048):
        a, b = np.searchsorted(column, (first, first + 2048))
        some = np.zeros((len(owns), 2048), dtype=np.float32)
        some[owner[a:b], column[a:b] - first] = 1
        both += (some[left] @ some[right].T).astype(np.int64)
    return 100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both)


class JaccardJoin:
    """Documents whose sets of k-word shingles are similar: 100 * |a and b| >= percent * |a or b|.

    Equal sets form one class first (128-bit digest of the set), so copies are
    never paired. Classes meet on the keys of ``signature_keys``. On each key
    first all compare with the most typical class only, the one whose shingles
    are the most frequent on average (of near copies the least changed one). What these links did
    not connect compares across the components so far, so a link that joins two
    components is never missed, and groups of near copies make few pairs. All
    links lie inside the components that this gives: there all classes are then
    compared with each other, a block of them with a block at a time, so that no
    row is made for a pair.

    Null and empty texts have no shingles and no links. Repeated rows and null ids
    are rows like others; a component's id is its smallest id that isn't null.
    """

    #: A block of a component has about so many classes and shingles at most.
    BLOCK, BLOCK_SHINGLES = 512, 2_000_000
    FEW = 8

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80):
        self.id_col, self.text_col, self.k, self.percent = id_col, text_col, k, percent
        self.scratch = Scratch(docs.sparkSession, "jaccard")
        self.docs = placed(docs.select(id_col, text_col))

    def _members(self) -> DataFrame:
        """uid, place, id, n, digest of the set, the keys with their flags, the mean counter of the shingles and their sketch."""
        counts = _count(self.docs, self.text_col, self.k, self.scratch)
        light, percent, k = boundary(counts, self.percent), self.percent, self.k
        shared = self.docs.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**32 - 1).astype(np.uint32))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import hashlib

            words, order = words_of_worker(), shared.value
            for batch in batches:
                for at in range(0, len(batch), 1000):
                    some = batch.slice(at, 1000)
                    n, digests, keys, free, pos, typical, sketches = [], [], [], [], [], [], []
                    for text in some.column(2).to_pylist():
                        own = shingles(words(text), k) if text else np.zeros(0, dtype=np.uint64)
                        n.append(len(own))
                        digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                        a, b, c = signature_keys(own, order, percent, light)
                        keys.append(a)
                        free.append(b)
                        pos.append(c)
                        sketches.append(sketch(own))
                        typical.append(int(order[(own >> np.uint64(44)).astype(np.int64)].mean()) if len(own) else 0)
                    ends = pa.array(np.concatenate([[0], np.cumsum([len(a) for a in keys])]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0), some.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys).view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(free))),
                            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pos))), pa.array(typical, pa.int64()), pa.array(sketches, pa.binary()),
                        ],
                        ["place", "id", "n", "digest", "keys", "free", "pos", "typical", "sketch"],
                    )
            give_back()

        told = self.docs.select(F.col("_place").alias("place"), F.col(self.id_col).alias("id"), F.col(self.text_col).cast("binary").alias("text"))
        kind = self.docs.schema[self.id_col].dataType.simpleString()
        rows = told.mapInArrow(sets, f"place string, id {kind}, n long, digest binary, keys array<long>, free array<boolean>, pos array<int>, typical long, sketch binary")
        return self.scratch.write(rows.withColumn("uid", F.monotonically_increasing_id()), "sets")

    def _lists(self, sets: DataFrame) -> DataFrame:
        """(key, uid, n, free, pos) of the keys that more than one class has, and the same of each key's leader, its most typical class."""
        told = sets.where(F.col("n") >= least_size(self.percent)).select("digest", "uid")
        classes = told.groupBy("digest").agg(F.min("uid").alias("uid"))
        # what goes is written: if that is small, the rows with the keys are not shuffled for it
        copies = self.scratch.write(told.select("uid").join(classes.select("uid"), "uid", "left_anti"), "copies")
        single = sets.where(F.col("n") >= least_size(self.percent)).join(copies, "uid", "left_anti").select("uid", "n", "typical", F.explode(F.arrays_zip("keys", "free", "pos")).alias("k"))
        rows = single.select(F.col("k.keys").alias("key"), "typical", "uid", F.col("n").cast("int").alias("n"), F.col("k.free").alias("free"), F.col("k.pos").alias("pos"))
        names = ["key", "uid", "n", "free", "pos", "lead_uid", "lead_n", "lead_free", "lead_pos"]

        def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come by key, leaders first: a row without neighbours of its key goes, the others learn who leads."""
            first = None  # the one row of the key that is open, which may stay alone
            lead = None  # what leads that key
            for batch in batches:
                if not len(batch):
                    continue
                batch = batch.select([0, 2, 3, 4, 5])
                if first is not None and first.column(0)[0].as_py() == batch.column(0)[0].as_py():
                    batch = pa.Table.from_batches([first, batch]).combine_chunks().to_batches()[0]
                    lead = None
                first = None
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                key = columns[0]
                starts = np.concatenate([[True], key[1:] != key[:-1]])
                at = np.flatnonzero(starts)[np.cumsum(starts) - 1]
                leaders = [c[at] for c in columns]
                goes_on = lead is not None and lead[0] == key[0]
                if goes_on:
                    for c, v in zip(leaders, lead):
                        c[: np.argmax(~(key == key[0])) if key[-1] != key[0] else len(key)] = v
                keep = ~starts
                keep[:-1] |= ~starts[1:]
                if goes_on:
                    keep[0] = True
                if not keep[-1]:
                    first = batch.slice(len(batch) - 1)
                lead = [c[-1] for c in leaders]
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (*columns, *leaders[1:])], names)

        spread = rows.repartition("key").sortWithinPartitions("key", F.desc("typical"), "uid")
        return self.scratch.write(spread.mapInArrow(shared, "key long, uid long, n int, free boolean, pos int, lead_uid long, lead_n int, lead_free boolean, lead_pos int"), "lists")

    def _full(self, nodes: DataFrame, name: str) -> DataFrame:
        """(uid, own): the full sets of the rows ``nodes`` (uid, place), a written table ``name``."""
        bloom = BlockedBloom()
        texts = bloom.may_hold(self.docs, bloom.build(nodes, "place"), "_place")
        texts = texts.select(F.col("_place").alias("place"), F.col(self.text_col).cast("binary").alias("text")).join(self.scratch.sent(nodes, name), "place").select("uid", "text")
        k = self.k

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = words_of_worker()
            for batch in batches:
                own = [shingles(words(t), k).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["uid", "own"])

        return texts.mapInArrow(whole, "uid long, own binary")

    def _verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) whose full sets are similar."""
        pairs = self.scratch.write(pairs, f"{name}_pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
        nodes = self.scratch.write(nodes.join(sets.select("uid", "place"), "uid"), f"{name}_nodes")
        full = self.scratch.write(self._full(nodes, f"{name}_nodes"), f"{name}_full")
        percent = self.percent
        side = lambda c: full.select(F.col("uid").alias(c), F.col("own").alias(f"own_{c}"))

        def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                    if len(x) > len(y):
                        x, y = y, x
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "own_a", "own_b")
        links = self.scratch.write(met.mapInArrow(similar, "a long, b long"), f"{name}_links")
        self.scratch.drop(f"{name}_full", f"{name}_nodes")
        return links

    def _compared(self, sets: DataFrame, roots: DataFrame, counted: bool) -> DataFrame:
        """All links of the components of three classes or more: (a, b), or counted, (uid, n_links) by parts that add up."""
        sized = roots.groupBy("root").agg(F.count(F.lit(1)).alias("classes")).where("classes > 2").select("root")
        name = "counted" if counted else "paired"
        nodes = self.scratch.write(roots.join(sized, "root").withColumnRenamed("node", "uid").join(sets.select("uid", "place", "n"), "uid"), f"{name}_nodes")
        full = self.scratch.write(self._full(nodes.select("uid", "place"), f"{name}_nodes"), f"{name}_full")
        parts = nodes.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / self.BLOCK, F.sum("n") / self.BLOCK_SHINGLES)).cast("long").alias("parts"))
        dealt = nodes.join(parts, "root").select("uid", "root", F.pmod(F.xxhash64("uid"), F.col("parts")).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
        met = dealt.join(full, "uid").select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "uid", "part", "own")
        percent = self.percent

        def compare(rows: pa.Table) -> pa.Table:
            uid, part = rows["uid"].to_numpy(), rows["part"].to_numpy()
            owns = [np.frombuffer(o, dtype=np.uint64) for o in rows["own"].to_pylist()]
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            hit = similar_pairs(owns, left, right, percent)
            if i == j:
                hit = np.triu(hit, 1)
            if counted:
                found = np.zeros(len(uid), dtype=np.int64)
                found[left] += hit.sum(axis=1)
                found[right] += hit.sum(axis=0)
                return pa.table({"uid": uid, "n_links": found})
            x, y = np.nonzero(hit)
            x, y = uid[left[x]], uid[right[y]]
            return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})

        return met.groupBy("root", "i", "j").applyInArrow(compare, "uid long, n_links long" if counted else "a long, b long")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(sets, links): the rows with their sets' digests; all links between classes (a, b: uids)."""
        sets, links = self._connecting()
        roots = self.scratch.write(components(links, self.scratch, "all"), "roots")
        pair = roots.groupBy("root").agg(F.count(F.lit(1)).alias("classes"), F.min("node").alias("a"), F.max("node").alias("b")).where("classes = 2").select("a", "b")
        return sets, self._compared(sets, roots, False).unionByName(pair)

    def _connecting(self) -> tuple[DataFrame, DataFrame]:
        """(sets, links): the rows with their sets' digests; verified links between classes (a, b: uids) that connect what is connected."""
        sets = self._members()
        lists = self._lists(sets)
        sketches = sets.select("uid", "sketch")
        sets = sets.select("uid", "place", "id", "n", "digest")
        overlap = F.ceil(F.lit(self.percent) * (F.col("n") + F.col("lead_n")) / (100 + self.percent))
        fits = (100 * F.least("n", "lead_n") >= self.percent * F.greatest("n", "lead_n")) & (F.col("free") | F.col("lead_free"))
        fits = fits & (F.col("pos") <= F.col("n") - overlap) & (F.col("lead_pos") <= F.col("lead_n") - overlap)  # as ``fitting``
        stars = lists.where((F.col("uid") != F.col("lead_uid")) & fits).select(F.least("lead_uid", "uid").alias("a"), F.greatest("lead_uid", "uid").alias("b")).distinct()
        stars = self.scratch.write(stars, "stars")
        first = self._verified(stars, sets, "star")
        roots = self.scratch.write(components(first, self.scratch, "first"), "first_roots")
        marked = lists.select("key", "uid", "n", "free", "pos").join(self.scratch.sent(roots.withColumnRenamed("node", "uid"), "first_roots"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        met = self._met(marked)
        across = met.where("kind = 0").select("a", "b").unionByName(self._possible(met, sketches))
        second = self._verified(across.distinct().join(stars, ["a", "b"], "left_anti"), sets, "across")
        return sets, first.unionByName(second)

    def _block(self) -> int:
        """The classes of a key's block: half as many as a component's, since several keys' blocks may fall to one task."""
        return max(1, self.BLOCK // 2)

    def _met(self, marked: DataFrame) -> DataFrame:
        """What the keys say: kind 0, a pair (a, b) from different components that fits, of keys of up to FEW classes; 1, a
        class on a larger key, with its block there; 2, a larger key with its number of classes (a) and whether they are of different components (b)."""
        few, block, percent = self.FEW, self._block(), self.percent
        schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("part", pa.int64()), ("uid", pa.int64()), ("root", pa.int64()), ("n", pa.int32()), ("free", pa.bool_()), ("pos", pa.int32())])

        def rows_of(**columns) -> pa.RecordBatch:
            size = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

        def pairs(c: list[np.ndarray]) -> pa.RecordBatch:
            """Of rows of small groups."""
            key, uid, n, free, pos, root = c
            found, x = [], np.arange(len(key))
            for step in range(1, few):
                x = x[x + step < len(key)]
                x = x[key[x] == key[x + step]]
                y = x + step
                fits = (root[x] != root[y]) & (free[x] | free[y]) & fitting(n[x].astype(np.int64), n[y].astype(np.int64), pos[x], pos[y], percent)
                found.append(np.stack([uid[x[fits]], uid[y[fits]]]))
            both = np.concatenate(found, axis=1)
            return rows_of(kind=np.zeros(both.shape[1], np.int32), a=both.min(axis=0, initial=2**63 - 1), b=both.max(axis=0, initial=-(2**63)))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows come by key. ``held``: rows of the open key, up to FEW; ``large``: [key, rows so far, least root, greatest root] if it has more."""
            held: list[np.ndarray] | None = None
            large: list[int] | None = None

            def closed() -> pa.RecordBatch:
                return rows_of(kind=[2], a=[large[1]], b=[int(large[2] != large[3])], key=[large[0]])

            for batch in batches:
                if not len(batch):
                    continue
                c = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("key", "uid", "n", "free", "pos", "root")]
                if held is not None:
                    c, held = [np.concatenate(v) for v in zip(held, c)], None
                starts = np.flatnonzero(np.concatenate([[True], c[0][1:] != c[0][:-1]]))
                sizes = np.diff([*starts, len(c[0])])
                if large and large[0] != c[0][0]:
                    yield closed()
                    large = None
                is_large = sizes > few
                is_large[0] |= large is not None
                if not is_large[-1]:  # may go on
                    held = [v[starts[-1] :] for v in c]
                    c, starts, sizes, is_large = [v[: starts[-1]] for v in c], starts[:-1], sizes[:-1], is_large[:-1]
                small = np.repeat(~is_large, sizes)
                if small.any():
                    yield pairs([v[small] for v in c])
                for start, size in zip(starts[is_large], sizes[is_large]):
                    key, uid, n, free, pos, root = (v[start : start + size] for v in c)
                    if large and large[0] != key[0]:
                        yield closed()
                        large = None
                    large = large or [int(key[0]), 0, int(root[0]), int(root[0])]
                    yield rows_of(kind=np.ones(size, np.int32), key=key, part=(large[1] + np.arange(size)) // block, uid=uid, root=root, n=n, free=free, pos=pos)
                    large = [large[0], large[1] + int(size), min(large[2], int(root.min())), max(large[3], int(root.max()))]
            if held is not None:
                yield pairs(held)
            if large:
                yield closed()
            give_back()

        spread = marked.select("key", "uid", "n", "free", "pos", "root").repartition("key").sortWithinPartitions("key", "uid")
        return self.scratch.write(spread.mapInArrow(meet, "kind int, a long, b long, key long, part long, uid long, root long, n int, free boolean, pos int"), "met", ["kind"])

    def _possible(self, met: DataFrame, sketches: DataFrame) -> DataFrame:
        """(a, b): pairs of classes from different components that meet on a larger key and whose sketches may be those of similar sets.

        A key's classes stand in blocks; each block meets each other one in a task's memory, where the pairs are compared."""
        mixed = self.scratch.write(met.where("kind = 2 AND b = 1").select("key", F.col("a").alias("m")), "mixed")
        lists = spread_join(met.where("kind = 1").select("key", "part", "uid", "root", "n", "free", "pos"), mixed, "key", "m")
        parts = F.ceil(F.col("m") / self._block())
        dealt = lists.join(sketches, "uid").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        met = dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "uid", "root", "n", "free", "pos", "sketch")
        percent = self.percent

        def compare(rows: pa.Table) -> pa.RecordBatch:
            key, i, j, part, uid, root, n, free, pos = (rows.column(c).to_numpy() for c in range(9))
            group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))])
            n, pos, found = n.astype(np.int64), pos.astype(np.int64), []
            x = np.arange(len(group))
            for step in range(1, len(group)):
                x = x[x + step < len(group)]
                x = x[group[x] == group[x + step]]
                if not len(x):
                    break
                y = x + step
                fits = (root[x] != root[y]) & ((i[x] == j[x]) | (part[x] != part[y])) & (free[x] | free[y]) & fitting(n[x], n[y], pos[x], pos[y], percent)
                found.append(np.stack([x[fits], y[fits]]))
            x, y = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
            left = may_be_similar(rows.column(9).combine_chunks(), n, x, y, percent)
            x, y = uid[x[left]], uid[y[left]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []  # the last group, which may go on in the next batch
            for batch in batches:
                if not len(batch):
                    continue
                last = [c[len(batch) - 1].as_py() for c in batch.columns[:3]]
                same = np.logical_and.reduce([c.to_numpy() == v for c, v in zip(batch.columns[:3], last)])
                begin = int(np.argmax(same))
                if begin or (held and [c[0].as_py() for c in held[0].columns[:3]] != last):
                    whole = pa.Table.from_batches([*held, batch.slice(0, begin)])
                    held = []
                    if len(whole):
                        yield compare(whole)
                held.append(batch.slice(begin))
            if held:
                yield compare(pa.Table.from_batches(held))
            give_back()

        return met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")

    def _degrees(self, sets: DataFrame, roots: DataFrame) -> DataFrame:
        """(uid, n_links) of the classes in components; of two classes alone each has one link."""
        pair = roots.groupBy("root").agg(F.count(F.lit(1)).alias("classes"), F.min("node").alias("a"), F.max("node").alias("b")).where("classes = 2")
        pair = pair.select(F.explode(F.array("a", "b")).alias("uid"), F.lit(1).cast("long").alias("n_links"))
        return self._compared(sets, roots, True).unionByName(pair).groupBy("uid").agg(F.sum("n_links").alias("n_links"))

    def result(self, counted: bool = True) -> DataFrame:
        """A row per row of docs: place, id, n_shingles, component_id, n_links: to how many other classes the row's class is similar (null unless counted)."""
        return self._grouped(counted).drop("root")

    def _grouped(self, counted: bool) -> DataFrame:
        """The result with the root (a uid) of the row's component; null for rows without shingles."""
        sets, links = self._connecting()
        roots = self.scratch.write(components(links, self.scratch, "all"), "roots")
        degree = roots.select(F.col("node").alias("uid"), F.lit(None).cast("long").alias("n_links"))
        if counted:
            degree = self._degrees(sets, roots)
        filled = sets.where("n > 0")
        classes = filled.groupBy("digest").agg(F.min("uid").alias("class"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        rooted = classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        rooted = self.scratch.write(rooted.join(degree.withColumnRenamed("uid", "class"), "class", "left"), "rooted")
        whole = self.scratch.write(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes")), "whole")
        told = self.scratch.write(spread_join(rooted, whole, "root", "classes").select("digest", "root", "component_id", "n_links", "copies"), "told")
        some = spread_join(filled, told, "digest", "copies").select("place", "id", "n", "root", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        none = sets.where("n = 0").select("place", "id", "n", F.lit(None).cast("long").alias("root"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
        return some.unionByName(none).select("place", F.col("id").alias(self.id_col), F.col("n").alias("n_shingles"), "root", "component_id", "n_links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which each component keeps one: that of the smallest id (null ids last), then of the first place."""
    docs = from_files(docs)
    join = JaccardJoin(docs, id_col, text_col)
    rows = join.scratch.write(join._grouped(counted=False).where("n_shingles > 0"), "grouped")
    order = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col), F.col("place"))
    stays = rows.groupBy("root").agg(F.min(order).alias("best")).select("best.place")
    out = rows.select("place").join(stays, "place", "left_anti").withColumnRenamed("place", "_out")
    out = join.scratch.sent(join.scratch.write(out, "out"), "out")
    return without(docs, out)
