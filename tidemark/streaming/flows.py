"""Append flows: one restartable stream per table, from a folder of files into an archive table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.config import EngineConfig
from tidemark.plans.registry import STREAM, TableSpec
from tidemark.sources.files import Files
from tidemark.sources.store import ArchiveStore, ArchiveTable


def flow_name(spec: TableSpec) -> str:
    """Names are the identity of a checkpoint: a renamed flow starts anew."""
    return f"{spec.schema}_{spec.table}_flow"


class Flow:
    """Appends what has come since the last run, then ends (availableNow).

    Only new files count: deletions in the source pass unnoticed, a file that the
    source has rewritten comes again (dedup removes its rows later). Each start
    infers the source's schema anew, so new columns arrive with the next run. A
    batch is committed once: its number is in the table's log under the flow's
    id, which stands beside the checkpoint; after ``refresh`` all files come again under a new id.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, source: str, table: ArchiveTable, state: str, files_per_batch: int | None = None):
        self.spark, self.spec, self.source, self.table = spark, spec, source, table
        self.state = f"{state.rstrip('/')}/{flow_name(spec)}"
        self.files_per_batch = files_per_batch

    def _id(self) -> str:
        files, path = Files(self.spark), f"{self.state}/flow.json"
        if not files.exists(path):
            files.make(self.state)
            files.create_once(path, json.dumps({"id": uuid.uuid4().hex}))
        return json.loads(files.read(path))["id"]

    def refresh(self) -> None:
        """Forgets what has been read. Nothing in the archive is deleted."""
        Files(self.spark).remove(self.state)

    def start(self) -> StreamingQuery:
        flow, table = self._id(), self.table
        schema = self.spark.read.options(**self.spec.read_options).option("mergeSchema", "true").parquet(self.source).schema
        reader = self.spark.readStream.schema(schema).options(**self.spec.read_options).option("maxFileAge", "36500d")
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", str(self.files_per_batch))

        def append(batch: DataFrame, number: int) -> None:
            table.append(batch, transaction=(flow, number))

        return (
            reader.parquet(self.source).writeStream.queryName(flow_name(self.spec)).foreachBatch(append)
            .option("checkpointLocation", f"{self.state}/checkpoint").trigger(availableNow=True).start()
        )

    def run(self) -> None:
        query = self.start()
        query.awaitTermination()


def start_flows(spark: SparkSession, specs: Iterable[TableSpec], config: EngineConfig, source: Callable[[TableSpec], str], store: ArchiveStore, state: str) -> list[StreamingQuery]:
    """Starts the flows of all streamed tables that aren't excluded; they run side by side."""
    out = []
    for spec in specs:
        if spec.strategy == STREAM and config.should_process(spec.source):
            store.create_schema(spec.schema)
            out.append(Flow(spark, spec, source(spec), store.table(spec.schema, spec.table), state).start())
    return out
