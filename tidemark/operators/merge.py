"""Incremental batch ingest by a stored high-water mark, with an insert-only merge."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import Moment, bytes_taken, micros, quoted, same_key
from tidemark.functions.schema import field_of
from tidemark.sources.store import ArchiveTable, bounded, bounds


def high_water_mark(archive: DataFrame | ArchiveTable, column: str) -> Moment | None:
    """The latest time in the archive; null for an empty one. A table's log knows it, rows have to be read."""
    if isinstance(archive, ArchiveTable):
        return archive.latest(column)
    kind = field_of(archive.schema, column).dataType
    most = archive.agg(micros(F.max(quoted(column)), kind)).first()[0]
    return None if most is None else Moment(most, isinstance(kind, T.TimestampType))


def incremental_read(source: DataFrame, column: str, mark: Moment | dt.datetime | None, buffer_hours: int) -> DataFrame:
    """Source rows from ``buffer_hours`` before the mark on, the bound included; all of them without a mark.

    The bound is a literal of the column's type when the scan is planned, so the
    filter reaches the files. Rows without a time are never newer than a mark."""
    if mark is None:
        return source
    mark = mark if isinstance(mark, Moment) else Moment.of(mark)
    kind = field_of(source.schema, column).dataType.simpleString()
    c = F.col(quoted(column))
    return source.where((c.cast("timestamp_ntz") if kind == "date" else c) >= mark.plus(-buffer_hours).column(kind))


def missing_rows(source: DataFrame, archive: DataFrame, keys: list[str], most_sent: int = 32 << 20) -> DataFrame:
    """Source rows whose key the archive lacks; null keys are equal. The archived version of a key stays for ever, and
    duplicates within the source all come.

    The batch's distinct keys go to the archive, not the archive to them: if they
    take up to ``most_sent`` bytes they are broadcast, the archive's rows are
    looked at where they are read, and the few keys found there (no more than were
    sent) come back. Larger batches meet the archive's keys in a shuffle."""
    names = [quoted(k) for k in keys]
    wanted = source.select(*names).distinct()
    if bytes_taken(wanted) > most_sent:
        return source.alias("s").join(archive.select(*names).alias("a"), same_key("s", "a", keys), "left_anti")
    held = archive.select(*names).alias("a").join(F.broadcast(wanted.alias("w")), same_key("a", "w", keys), "left_semi").distinct()
    return source.alias("s").join(F.broadcast(held.alias("h")), same_key("s", "h", keys), "left_anti")


def counted_with_bounds(batch: DataFrame, keys: list[str]) -> tuple[int, dict[str, tuple]]:
    """The number of rows, and the least and greatest value of each key that has bounds in logs and no nulls here; in one job."""
    fields = [f for f in (field_of(batch.schema, k) for k in keys) if bounded(T.StructType([f]))]
    told = batch.agg(F.count(F.lit(1)).alias("n"), *(c.alias(f"{side}{i}") for i, f in enumerate(fields) for side, c in zip(("low", "high", "held"), (*bounds(f), F.count(quoted(f.name)))))).first()
    return told.n, {f.name: (told[f"low{i}"], told[f"high{i}"]) for i, f in enumerate(fields) if told.n and told[f"held{i}"] == told.n}


def process_watermark_table(source: DataFrame, table: ArchiveTable, name: str, keys: list[str], column: str, buffer_hours: int = 4) -> dict:
    """First run: a full copy, as it is. Later: what is missing of the rows since the mark, with new columns added.

    An empty archive is read in full but merged. Without source rows nothing is
    created. rows_read counts what was read, not what was inserted. Files of the archive whose keys are, by the log, away from the
    batch's aren't opened (files_compared: how many are)."""
    began = time.monotonic()
    report = {"table": name, "strategy": "watermark", "status": "success"}
    exists = table.exists()
    mark = high_water_mark(table, column) if exists else None
    batch = incremental_read(source, column, mark, buffer_hours)
    rows, within = counted_with_bounds(batch, keys)
    report |= {"rows_read": rows}
    if not rows:
        report |= {"note": "no source rows"}
    elif not exists:
        table.overwrite(batch)
        report |= {"note": "initial load"}
    else:
        before = table.snapshot().rows
        near = table.files_between(within)
        table.append(missing_rows(batch, table.rows_of(near), keys))
        report |= {"files_compared": len(near), "count_before": before, "count_after": table.snapshot().rows}
    return report | {"elapsed_s": time.monotonic() - began}


def process_overwrite_table(source: DataFrame, table: ArchiveTable, name: str) -> dict:
    """Replaces a small table outright, its schema too."""
    began = time.monotonic()
    table.overwrite(source)
    rows = table.snapshot().rows
    return {"table": name, "strategy": "overwrite", "status": "success", "rows_read": rows, "count_after": rows, "elapsed_s": time.monotonic() - began}
