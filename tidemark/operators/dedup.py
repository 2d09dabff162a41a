"""Removes duplicates by natural key and proves that none is left."""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.keys import bytes_taken, key_struct, quoted, same_key, survivor_order
from tidemark.operators.features import row_tracking_enabled
from tidemark.sources.store import FILE, MOST_SENT, PLACE, ROW_ID, ArchiveTable, Snapshot


class DuplicateKeys(RuntimeError):
    """A table has more rows than keys."""


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, with their number of rows ``copies``; nulls are equal. Reads only the key columns."""
    return df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def has_duplicates(df: DataFrame, keys: list[str]) -> bool:
    return not duplicate_groups(df, keys).isEmpty()


def dedup_frame(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. Spark keeps one row a key and task before the shuffle (WindowGroupLimit)."""
    place = f"place_{uuid.uuid4().hex}"  # no column of the caller's is called that
    first = F.row_number().over(W.partitionBy(*map(quoted, keys)).orderBy(*order))
    return df.withColumn(place, first).where(F.col(place) == 1).drop(place)


def count_keys(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows, distinct keys); keys with nulls count.

    A sum over groups instead of a distinct count over all rows: keys are counted
    in many tasks, and only one number a task meets in the last one."""
    row = df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return int(row[0]), int(row[1])


def count_keys_by_struct(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same as one row (total_rows, distinct_keys), by a distinct count of the key as one value."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key_struct(keys)).alias("distinct_keys"))


#: Duplicates are marked as deleted where they are, and no file is rewritten, if they are at most one row in so many.
FEW = 20


def dedup_table(table: ArchiveTable, name: str, keys: list[str], tiebreaker: str, newest_version_wins: bool = False) -> dict:
    """Dedups a table in place and returns its report.

    skipped: there is no table. clean: no duplicate key (an empty table too);
    nothing is written. deduped: in one commit, after the outcome
    has been verified; if that fails the table stays as it was and the error is raised.

    A version that was found or made unique is noted beside the log; the next check compares what has come since.
    Few duplicates (one row in FEW or fewer, and no more than scans can leave out without a shuffle) are ``marked``: only the
    rows of their keys are compared, and the commit names those that go. With more of them the table is ``rewritten``.
    """
    began = time.monotonic()
    if not table.exists():
        return {"table": name, "status": "skipped", "reason": "no table"}
    snapshot = table.snapshot()
    tracked = row_tracking_enabled(snapshot.properties)
    note = "unique-" + hashlib.sha256(json.dumps(keys).encode()).hexdigest()[:16]
    rows, checked = _to_check(table, snapshot, keys, (table.noted(note) or {}).get("version"))
    report = {"table": name, "ordering": "row_id" if tracked else "tiebreaker", "count_before": snapshot.rows, "files_checked": checked}
    groups = duplicate_groups(rows, keys)
    found = groups.agg(F.max("copies").alias("most"), F.sum(F.col("copies") - 1).alias("gone"), F.count(F.lit(1)).alias("keys")).first() if checked else None
    if found is None or found.most is None:
        table.note(note, {"keys": keys, "version": snapshot.version})
        return report | {"status": "clean", "count_after": snapshot.rows, "duplicates_removed": 0, "elapsed_s": time.monotonic() - began}
    order = survivor_order(tiebreaker, ROW_ID if tracked else None, newest_version_wins)
    few = found.gone * FEW <= snapshot.rows and sum(f.deleted for f in snapshot.files) + found.gone <= MOST_SENT
    if few:
        with table.working(groups) as held:  # as many rows as scans can leave out at most; found once, used three times
            _mark(table, snapshot, name, keys, order, tracked, held, found.gone, found["keys"])
        after = snapshot.rows - found.gone
    else:
        after = _rewritten(table, snapshot, name, keys, order, tracked, found.most)
    if table.version() == snapshot.version + 1:  # nobody else has committed meanwhile
        table.note(note, {"keys": keys, "version": snapshot.version + 1})
    done = {"status": "deduped", "method": "marked" if few else "rewritten", "count_after": after, "duplicates_removed": snapshot.rows - after}
    return report | done | {"elapsed_s": time.monotonic() - began}


def _to_check(table: ArchiveTable, snapshot: Snapshot, keys: list[str], unique: int | None) -> tuple[DataFrame, int]:
    """(rows among which all duplicates are, of how many files): all rows, or, where a version is known to be ``unique``, those of
    files that have come since, and of the others the rows whose key is among theirs.

    The new rows' keys (up to 32 MB, as a checked size) go to the others where these are, so nothing of the archive is shuffled,
    and files whose bounds are away from the new files' aren't opened."""
    before = {f.path for f in table.snapshot(unique).files} if unique is not None and unique <= snapshot.version else set()
    new = [f for f in snapshot.files if f.path not in before]
    if 4 * sum(f.rows for f in new) > snapshot.rows:
        return table.read(snapshot.version), len(snapshot.files)
    names = [quoted(k) for k in keys]
    rows = table.rows_of(new, snapshot.version).select(*names)
    wanted = rows.distinct()
    if bytes_taken(wanted) > 32 << 20:
        return table.read(snapshot.version), len(snapshot.files)
    old = table.files_near([f for f in snapshot.files if f.path in before], new, keys, snapshot.version) if new else []
    held = table.rows_of(old, snapshot.version).select(*names).alias("r").join(F.broadcast(wanted.alias("g")), same_key("r", "g", keys), "left_semi")
    return rows.unionAll(held), len(new) + len(old)


def _of_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of some keys, looked at where they are: the keys go to them if they take no more than 32 MB, as a checked size."""
    listed = groups.select(*map(quoted, keys))
    listed = F.broadcast(listed) if bytes_taken(listed) <= 32 << 20 else listed
    return rows.alias("r").join(listed.alias("g"), same_key("r", "g", keys), "left_semi")


def _mark(table: ArchiveTable, snapshot: Snapshot, name: str, keys: list[str], order: list[Column], tracked: bool, groups: DataFrame, gone: int, n: int) -> None:
    rows = table.scan(snapshot, row_id=tracked)
    rank = f"rank_{uuid.uuid4().hex}"
    ranked = _of_groups(rows, groups, keys).withColumn(rank, F.row_number().over(W.partitionBy(*map(quoted, keys)).orderBy(*order, FILE, PLACE)))

    def verify(left: DataFrame) -> None:
        rows, distinct = count_keys(_of_groups(left, groups, keys), keys)
        if not rows == distinct == n:
            raise DuplicateKeys(f"{name}: {rows} rows of {distinct} keys after dedup, of {n} that had copies")

    table.delete_rows(ranked.where(F.col(rank) > 1).select(FILE, PLACE), "dedup", snapshot, verify, gone)


def _rewritten(table: ArchiveTable, snapshot: Snapshot, name: str, keys: list[str], order: list[Column], tracked: bool, most: int) -> int:
    rows = table.read(snapshot.version, row_id=tracked)
    names = [quoted(k) for k in keys]
    # the table is dealt out by ranges of its key, so that later filters on the key skip files; the window needs no other shuffle.
    # Not if one key has more rows than a task should: those combine before the shuffle, which then goes by hash.
    if most * int(table.spark.conf.get("spark.sql.shuffle.partitions")) <= snapshot.rows:
        rows = rows.repartitionByRange(*names)
    unique = dedup_frame(rows, keys, order).drop(ROW_ID)
    after: list[int] = []

    def verify(written: DataFrame) -> None:
        rows, distinct = count_keys(written, keys)
        if rows != distinct:
            raise DuplicateKeys(f"{name}: {rows} rows but {distinct} distinct keys after dedup")
        after.append(rows)

    table.overwrite(unique.sortWithinPartitions(*names), schema_mode="merge", check=verify, operation="dedup")
    return after[0]
