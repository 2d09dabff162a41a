"""Exact dedup as a stateful stream: keyed state on disk, without expiry, checked byte for byte on hits."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, BlockedBloom, Scratch, from_files, spread_join, without


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


class ExactDedup:
    """Streaming exact deduplication of texts.

    ``ingest`` turns a load of rows into *arrivals* (digest, identifier, code
    points, content locator: load, file and row) and runs them through a
    Structured Streaming aggregation whose state lives in RocksDB and never
    expires: per digest the number of rows and the best row so far, with its
    locator. Rows of one digest are combined before the shuffle, so a digest that
    holds a third of all rows costs one row per task.

    Hits (digests that the load brought and that are seen more than once) are
    checked on full bytes at once: the load's own texts, and the text of the row
    that the state held before, which its locator finds in the file it came from.
    Least and greatest normalised text of each hit must be the same; only rows that
    may belong to a hit are looked at (blocked Bloom filter, then an exact
    semi-join), and the two texts per digest combine before the shuffle too. A
    digest shared by different texts is split by the texts themselves.

    Everything stands in ``path``: an object made for the same path, in this
    session or a later one, goes on where the last load ended. The files that
    loads were read from have to stay, as locators point there; rows that don't
    come from parquet files are written below ``path`` first. Without a path the
    folder goes with the session. A load given by its number that was ingested
    already changes nothing, so a job that was cut off can be run again.

    Of equal texts the row with most code points stays, then the smallest id
    (null ids last), then the first locator, so of repeated rows one stays, in one
    load or over several. Null texts count as empty and are equal to texts of
    white space only. An empty table gives an empty result. Other columns are never
    looked at.
    """

    def __init__(self, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", digest=sha256, bloom_blocks: int | None = None, path: str | None = None):
        self.spark, self.id_col, self.text_col, self.digest = spark, id_col, text_col, digest
        self.scratch = Scratch(spark, "exact")
        self.path = path.rstrip("/") if path else self.scratch.path
        self.bloom_blocks = bloom_blocks

    def _listed(self, folder: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def loads(self) -> list[int]:
        """The numbers of the loads whose arrivals are whole."""
        numbers = [int(name.removeprefix("load=")) for name in self._listed("arrivals") if name.startswith("load=")]
        return sorted(n for n in numbers if "_SUCCESS" in self._listed(f"arrivals/load={n}"))

    def _digested(self, docs: DataFrame, *more: Column) -> DataFrame:
        return docs.select(self.digest(normalised(F.col(self.text_col))).alias("digest"), *more)

    @staticmethod
    def _best() -> Column:
        """Orders rows of a group: most code points, smallest id, null ids last, first locator."""
        return F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("locator"))

    def ingest(self, docs: DataFrame, load: int | None = None) -> int:
        """Takes a load; returns its number."""
        done = self.loads()
        number = load or max(done, default=0) + 1
        try:
            docs.select("_metadata.row_index")
        except AnalysisException:  # not read from files: the locators need some
            own = f"{self.path}/texts/load={number}"
            if number not in done:
                docs.select(self.id_col, self.text_col).write.mode("overwrite").option("compression", "zstd").parquet(own)
            docs = self.spark.read.schema(docs.select(self.id_col, self.text_col).schema).parquet(own)
        arrivals = f"{self.path}/arrivals/load={number}"
        if number not in done:
            text = F.col(self.text_col)
            locator = F.struct(F.lit(number).alias("load"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
            seen = self._digested(docs, F.col(self.id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("points"), locator.alias("locator"))
            seen.write.mode("overwrite").option("compression", "zstd").parquet(arrivals)
        before = self.state() if self._listed("state") else None
        ran = self._stream(self.spark.read.parquet(arrivals).schema)
        # what has come with this call alone has left its digests' newest state in the batches that ran; else all of them are looked through
        after = self.state(ran if number not in done else None)
        self._check(docs, self.spark.read.parquet(arrivals), before, after, number)
        return number

    def _stream(self, schema) -> list[int]:
        """Brings the state up to date with all arrivals; returns the numbers of the batches that ran."""
        ran: list[int] = []
        session = self.spark.newSession()  # the stream's settings stay out of the caller's session
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            session.conf.set(key, self.spark.conf.get(key))
        session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else each partition reserves megabytes on disk
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "96")
        source = session.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{self.path}/arrivals/load=*")
        state = source.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(self._best()).alias("best"))
        sink = f"{self.path}/state"

        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{sink}/batch={number}")
            ran.append(number)

        query = (
            state.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        return ran

    def state(self, batches: list[int] | None = None) -> DataFrame:
        """The newest state of every digest, or of those that some batches have: n, best."""
        folders = [f"{self.path}/state/batch={b}" for b in batches] if batches else [f"{self.path}/state"]
        rows = self.spark.read.option("basePath", f"{self.path}/state").parquet(*folders)
        newest = F.max_by(F.struct("n", "best"), "batch").alias("s")
        return rows.groupBy("digest").agg(newest).select("digest", "s.n", "s.best")

    def texts(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``norm``, the normalised texts that their locators find. Only the files that they name are read, and only their names are collected."""
        files = [unquote(r.file) for r in rows.select("locator.file").distinct().collect()]
        if not files:
            return rows.withColumn("norm", F.lit(""))
        there = self.spark.read.parquet(*files).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), normalised(F.col(self.text_col)).alias("norm"))
        return rows.join(there, (F.col("locator.file") == F.col("_file")) & (F.col("locator.row") == F.col("_row"))).drop("_file", "_row")

    def _check(self, docs: DataFrame, arrivals: DataFrame, before: DataFrame | None, state: DataFrame, number: int) -> None:
        """Writes the load's collisions: digests of more than one text."""
        if before is not None:  # what else the state holds was checked when it came
            state = state.join(arrivals.select("digest").distinct(), "digest", "left_semi")
        hits = self.scratch.write(state.where("n > 1").select("digest"), f"hits{number}")
        rows = self._digested(docs, normalised(F.col(self.text_col)).alias("norm"))
        bloom = BlockedBloom(self.bloom_blocks)
        rows = bloom.may_hold(rows, bloom.build(hits, "digest"), "digest")
        ends = rows.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("most"))
        if before is not None:
            held = self.scratch.write(before.join(hits, "digest", "left_semi").select("digest", "best.locator"), f"held{number}")
            held = self.texts(held).select("digest", F.col("norm").alias("least"), F.col("norm").alias("most"))
            ends = ends.unionByName(held).groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        bad = ends.where("least <> most").join(hits, "digest", "left_semi").select("digest")
        bad.write.mode("overwrite").parquet(f"{self.path}/collisions/load={number}")

    def result(self) -> DataFrame:
        """Every row that came in with any load, and the row that stays in its group."""
        seen = self.spark.read.parquet(f"{self.path}/arrivals").drop("load")
        state = self.scratch.write(self.state(), "groups")
        bad = self.spark.read.parquet(f"{self.path}/collisions").select("digest").distinct()
        if bad.isEmpty():
            rows = spread_join(seen, state, "digest", "n")
        else:
            clean = spread_join(seen.join(bad, "digest", "left_anti"), state, "digest", "n")
            full = self.texts(self.scratch.write(seen.join(bad, "digest", "left_semi"), "bad"))
            groups = full.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.min(self._best()).alias("best"))
            rows = clean.unionByName(full.join(groups, ["digest", "norm"]).select(clean.columns))
        return rows.select(
            F.col("id").alias(self.id_col), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
            (F.col("best") == self._best()).alias("kept"), F.col("digest").alias("text_sha256"), "locator",
        )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256, locator (load, file, row)."""
    run = ExactDedup(docs.sparkSession, id_col, text_col)
    run.ingest(docs)
    return run.result()


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. Decisions are joined back by the place of the row."""
    docs = from_files(docs)
    scratch = Scratch(docs.sparkSession, "kept")
    out = exact_dedup(docs, id_col, text_col).where("not kept")
    out = out.select(F.concat_ws("#", F.hex(F.xxhash64("locator.file")), F.col("locator.row").cast("string")).alias("_out"))
    out = scratch.sent(scratch.write(out, "out"), "out")
    return without(docs, out)
