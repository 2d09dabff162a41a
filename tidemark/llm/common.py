"""Shared pieces of the corpus operators: scratch tables, blocked Bloom filters, word splitting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separator of words in the operators' contracts.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_own_dirs: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset (tests), a local one of this process."""
    where = spark.conf.get("spark.checkpoint.dir", "") or ""
    if where:
        return where.rstrip("/")
    if not _own_dirs:
        _own_dirs.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        atexit.register(shutil.rmtree, _own_dirs[0].removeprefix("file://"), ignore_errors=True)
    return _own_dirs[0]


class Scratch:
    """A folder of intermediate tables below the shared folder.

    Tables cut lineage: an executor lost later costs a re-read of parquet, not a
    recomputation. ``drop`` removes a table that no lazy result needs any more;
    the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._quietly_remove)

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _quietly_remove(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                self._remove(self.path)
        except Exception:  # the session has ended: a local folder goes with its own hook
            pass

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{name}")
        return self.read(df, name)

    def read(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def sent(self, df: DataFrame, name: str, most: int = 8 << 20) -> DataFrame:
        """A written table, marked for a broadcast if its values take no more than ``most`` bytes in memory; larger ones are left to the planner's shuffle."""
        taken = F.lit(16)
        for c, kind in df.dtypes:
            if kind in ("string", "binary"):
                taken = taken + 8 + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
            else:  # of other types by their text, which is no shorter
                taken = taken + (8 if "<" not in kind else 8 + 8 * F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))))
        return F.broadcast(df) if (df.agg(F.sum(taken.cast("long"))).first()[0] or 0) <= most else df

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.path}/{name}")


def whole_row(docs: DataFrame, but: str | None = None) -> Column:
    """All columns of docs, whatever they are called, in one struct."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns if c != but))


def place() -> Column:
    """A row's place: the hash of its file's path, and the row in it."""
    return F.concat_ws("#", F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index").cast("string"))


def from_files(docs: DataFrame) -> DataFrame:
    """docs, written first if its rows don't come from files."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return Scratch(docs.sparkSession, "rows").write(docs, "docs")
    return docs


def placed(docs: DataFrame, name: str = "_place") -> DataFrame:
    """docs with a column that names each row's place."""
    return from_files(docs).select("*", place().alias(name))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs (which are read from files) but for those at the places in ``gone``, a table of one column. No column
    of docs, whatever it is called, meets a name of this function's."""
    here, there = f"here_{uuid.uuid4().hex}", f"there_{uuid.uuid4().hex}"
    return placed(docs, here).join(gone.toDF(there), F.col(here) == F.col(there), "left_anti").drop(here)


def dealt_out(docs: DataFrame, most: int = 1 << 30) -> DataFrame:
    """docs, dealt out to all cores if they are read from fewer files than there are cores, of ``most`` bytes together: a small
    table's one file would be one task. Rows are unchanged; larger tables are read as they are, without a shuffle."""
    context = docs.sparkSession.sparkContext
    files = docs.inputFiles()
    if not 0 < len(files) < context.defaultParallelism:
        return docs
    paths = [context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(f)) for f in files]
    size = sum(p.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    return docs.repartition(context.defaultParallelism) if size <= most else docs


#: A key is hot if it has more than one in so many rows: so many keys are hot at most.
HOT_SHARE = 4096


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """rows joined to the one row that ``groups`` (a written table) has for each ``key``; ``size`` there says how many rows share the key.

    Hot keys, fewer than HOT_SHARE of them whatever the input, are broadcast, so their
    rows stay where they are; the rows of all others meet their group in a shuffle.
    """
    least = (groups.agg(F.sum(size)).first()[0] or 0) // HOT_SHARE
    hot = groups.where(F.col(size) > least)
    name = "_hot_" + key
    cold = rows.join(F.broadcast(hot.select(F.col(key).alias(name))), F.col(key) == F.col(name), "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold.join(groups.where(F.col(size) <= least).hint("merge"), key))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")).cast("long")


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished jobs now, not at the next collection of garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


#: Odd multipliers of the words of a shingle or a span, and of the finishing mix.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD[1]
    h = (h ^ (h >> np.uint64(29))) * ODD[2]
    return h ^ (h >> np.uint64(32))


class Words:
    """64-bit hashes of a text's words: A-Z are lower-cased, ASCII white space parts them.

    Each byte stands for two random numbers; a word's are summed, times powers of
    an odd number that count from the word's start, in two independent sums modulo
    2^64 that are mixed into one. All words of a text at once: sums run over the
    whole text, and what stands before a word is taken off.
    """

    def __init__(self, size: int = 1 << 16):
        random = np.random.default_rng(20240229)  # the same numbers everywhere
        codes = random.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + random.integers(0, 2, (2, 256), dtype=np.uint64)
        codes[:, 65:91] = codes[:, 97:123]
        self.codes, self.size = codes, size
        self.tables = self._tables(size + 1)
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    @staticmethod
    def _tables(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Powers of the two odd numbers, and of what undoes them."""
        powers = lambda base: np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, dtype=np.uint64)]))
        return [(powers(base), powers(np.uint64(pow(int(base), -1, 1 << 64)))) for base in (ODD[0], ODD[7])]

    def bounds(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a text (its bytes) begin and end."""
        edges = np.diff(self.space[text].view(np.int8), prepend=np.int8(1), append=np.int8(1))
        return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)

    def hashes(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, done = np.empty(len(begin), dtype=np.uint64), 0
        while done < len(begin):  # as many words as the tables hold, or one that is longer
            first = int(begin[done])
            upto = max(done + 1, int(np.searchsorted(end, first + self.size, side="right")))
            some = slice(done, upto)
            part = text[first : int(end[upto - 1])]
            tables = self.tables if len(part) <= self.size else self._tables(len(part) + 1)
            b, e = begin[some] - first, end[some] - first
            with np.errstate(over="ignore"):
                sums = []
                for codes, (power, back) in zip(self.codes, tables):
                    total = np.zeros(len(part) + 1, dtype=np.uint64)
                    np.cumsum(codes[part] * power[: len(part)], out=total[1:])
                    sums.append((total[e] - total[b]) * back[b])
                out[some] = mix(sums[0] + ODD[8] * (e - b).astype(np.uint64)) ^ (sums[1] * ODD[9])
            done = upto
        return out

    def __call__(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, dtype=np.uint8)
        return self.hashes(data, *self.bounds(data))


_held: dict[str, Any] = {}


def own_worker(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, one thing at a time: another name lets go of the one before."""
    if name not in _held:
        let_go()
        _held[name] = make()
    return _held[name]


def words_of_worker() -> Words:
    return own_worker("words", Words)


def let_go() -> None:
    _held.clear()
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: an idle Python worker would keep it while others need it."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


class BlockedBloom:
    """A register-blocked Bloom filter built and probed with SQL functions.

    Each key sets ``BITS`` bits of one 64-bit block; the filter is an array of
    ``blocks`` longs. Unless their number is given, it follows the keys': 16 bits
    a key and upwards, at which fewer than 1 % of other keys pass, from 32 KB up to 64 MB
    (32 million keys). With more keys, or too few blocks, more rows pass, never
    fewer, and the exact join behind the filter removes them.
    """

    BITS, KEYS, LEAST, MOST, SLICE = 5, 4, 1 << 12, 1 << 23, 1 << 10

    def __init__(self, blocks: int | None = None):
        self.blocks = blocks

    def sized(self, keys: int) -> int:
        """Blocks for so many keys: a power of two with up to KEYS of them in each."""
        return min(max(self.LEAST, 1 << max(0, -(-keys // self.KEYS) - 1).bit_length()), self.MOST)

    def _block(self, h: Column) -> Column:
        return F.pmod(h, F.lit(self.blocks)).cast("int")

    def _mask(self, h: Column) -> Column:
        """BITS bits of a long, by the upper bits of the key's hash (the block takes it modulo a power of two)."""
        mask = F.lit(0).cast("long")
        for i in range(self.BITS):
            pick = F.shiftrightunsigned(h, 63 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), pick))
        return mask

    def build(self, keys: DataFrame, key: str) -> DataFrame:
        """One row, one column ``bloom``: the blocks in order. Partial bit_or runs before the shuffle; slices of blocks are
        put together in many tasks and then, as arrays of longs, in one. ``keys`` is counted first, so it should be a written table."""
        spark = keys.sparkSession
        k = F.col(key)
        self.blocks = self.blocks or self.sized(keys.count())
        hashed = keys.where(k.isNotNull()).select(F.xxhash64(k).alias("h"))
        set_bits = hashed.select(self._block(F.col("h")).alias("block"), self._mask(F.col("h")).alias("mask"))
        empty = spark.range(self.blocks).select(F.col("id").cast("int").alias("block"), F.lit(0).cast("long").alias("mask"))
        merged = set_bits.unionByName(empty).groupBy("block").agg(F.bit_or("mask").alias("mask"))
        in_order = lambda of: F.array_sort(F.collect_list(of))
        slices = merged.groupBy(F.expr(f"block div {self.SLICE}").alias("slice")).agg(F.transform(in_order(F.struct("block", "mask")), lambda x: x["mask"]).alias("masks"))
        return slices.agg(F.flatten(F.transform(in_order(F.struct("slice", "masks")), lambda x: x["masks"])).alias("bloom"))

    def may_hold(self, rows: DataFrame, bloom: DataFrame, key: str, keep: bool = True) -> DataFrame:
        """The rows whose key may have been put in: every one that was, and few others; with keep=False, the rest.

        The hash passes through a generator, or the optimizer would put the
        expression behind ``key`` into every place where the filter uses it.
        """
        hashed = rows.select("*", F.explode(F.array(F.xxhash64(key))).alias("_h"))
        mask, h = self._mask(F.col("_h")), F.col("_h")
        held = F.coalesce(F.col(key).isNotNull() & (F.get(bloom.scalar(), self._block(h)).bitwiseAND(mask) == mask), F.lit(False))
        return hashed.where(held if keep else ~held).drop("_h")
