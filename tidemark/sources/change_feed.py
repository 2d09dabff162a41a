"""An archive table's change feed as a stream: the files of its log are the source, a commit is an event."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.store import ArchiveTable


def follow(table: ArchiveTable, deliver: Callable[[DataFrame, int], None], checkpoint: str, first: int = 0) -> StreamingQuery:
    """Calls deliver(changes, version) for each commit from ``first`` on that no earlier run has delivered, in order; then ends.

    Structured Streaming's checkpoint remembers the commits that were read. A
    commit may be delivered again after a failure, under the same version."""

    def hand_over(batch: DataFrame, number: int) -> None:
        names = batch.select(F.regexp_extract("name", r"(\d{20})\.json$", 1).cast("long").alias("v")).distinct().collect()
        for version in sorted(r.v for r in names if r.v >= first):
            deliver(table.changes(version, version), version)

    log = table.spark.readStream.option("pathGlobFilter", "*.json").option("maxFileAge", "36500d").text(f"{table.path}/_log", wholetext=True)
    names = log.select(F.col("_metadata.file_name").alias("name"))
    return names.writeStream.foreachBatch(hand_over).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
