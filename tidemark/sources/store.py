"""Versioned parquet tables: atomic commits, stable row ids, deleted rows, history, and a feed of changes.

A table is a folder. ``_log`` has a JSON file per commit, created exclusively, so
of two writers from one version one fails; ``data`` has immutable parquet files as
Spark has written them, ``deletes`` parquet files that name rows of these by file
and place. What a commit removes stays readable for history and changes.

A row's id is the first id of its file, which the log has, plus its place in the
file; or the value of a hidden column in files that an update or a compaction has
rewritten. So ids cost no column, no join and no rewrite, and telling them to
readers (row tracking) is a matter of a property.

The log has the least and greatest values of each file's leading columns, so a
read between bounds leaves out files that can't have such rows.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, fields, replace
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import TIMES, Moment, comparable, has_map, micros, quoted
from tidemark.functions.schema import by_name, checked, evolve, field_of, nullable
from tidemark.sources.files import Files

ROW_ID = "_row_id"
_STORED_ID = "__stored_row_id"
#: Names of a row's file and of its place in it, in scans that are asked for them.
FILE, PLACE = "__file", "__place"
_OF, _FIRST, _IN, _AT, _BIN = "__of", "__first", "__in", "__at", "__bin"
RESERVED = {ROW_ID, _STORED_ID, FILE, PLACE, _OF, _FIRST, _IN, _AT, _BIN}
#: Commits that put the same rows into other files.
SAME_ROWS = ("compact", "cluster")
#: Log versions between two summaries that spare readers the older log.
SUMMARY_EVERY = 20
#: So many columns have their bounds in the log, from the first on, and all with times besides; of texts so many characters.
BOUNDED, BOUND_CHARS = 8, 32
#: A line of a plan that says that rows have been dealt out, or put together.
_DEALT = re.compile(r"^[\s:+\-*()\d]*(\w*Exchange\b|Coalesce \d)", re.MULTILINE)
#: Deleted rows and files are sent to every task where a scan has no more of them than this; else they meet in a shuffle.
MOST_SENT = 250_000


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one read the table."""


class ReservedName(ValueError):
    """A column is named like one of the table's own."""


class TableMissing(LookupError):
    """There is no such table."""


@dataclass(frozen=True)
class DataFile:
    path: str  # below the table's folder
    rows: int  # with the deleted ones
    bytes: int
    first_id: int
    #: By column: the least and the greatest value (see ``bounds``), null if there is none, and the number of nulls.
    bounds: dict[str, list] = field(default_factory=dict)
    #: Folders that name deleted rows of this file, and how many they are.
    deletes: tuple[str, ...] = ()
    deleted: int = 0
    #: By which columns the file's rows are near each other, see ArchiveTable.cluster.
    clustered: str = ""

    @classmethod
    def of(cls, told: dict) -> DataFile:
        known = {f.name for f in fields(cls)}
        return cls(**{k: tuple(v) if k == "deletes" else v for k, v in told.items() if k in known})

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    files: tuple[DataFile, ...] = ()
    properties: dict[str, str] = field(default_factory=dict)
    next_id: int = 0
    transactions: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(f.rows - f.deleted for f in self.files)


def bounded(schema: T.StructType) -> list[T.StructField]:
    """The columns whose bounds the log has: of whole numbers, decimals, times and texts (compared byte by byte)."""
    plain = lambda k: isinstance(k, (T.IntegralType, T.DecimalType, *TIMES)) or k == T.StringType()
    return [f for i, f in enumerate(schema.fields) if plain(f.dataType) and (i < BOUNDED or isinstance(f.dataType, TIMES))]


def bounds(f: T.StructField) -> list[Column]:
    """The least and greatest value of a column, as JSON can have them: times in microseconds, decimals as texts, of texts the start."""
    ends = [F.min(F.col(quoted(f.name))), F.max(F.col(quoted(f.name)))]
    if isinstance(f.dataType, TIMES):
        return [micros(e, f.dataType) for e in ends]
    if isinstance(f.dataType, T.StringType):
        return [F.substring(e, 1, BOUND_CHARS) for e in ends]
    return [e.cast("string") for e in ends] if isinstance(f.dataType, T.DecimalType) else [e.cast("long") for e in ends]


def _comparable(value: Any, kind: T.DataType) -> Any:
    """A value, the caller's or the log's, as bounds are compared; None if it can't be."""
    if isinstance(kind, TIMES):
        if isinstance(value, Moment):
            return value.micros
        if isinstance(value, dt.datetime):
            if isinstance(kind, T.TimestampType):
                value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
            return Moment.of(value).micros
        return Moment.of(dt.datetime.combine(value, dt.time())).micros if isinstance(value, dt.date) else value
    if isinstance(kind, T.StringType):
        return value[:BOUND_CHARS] if isinstance(value, str) else None
    if isinstance(kind, T.DecimalType):
        return Decimal(value)
    return value


def may_hold(f: DataFile, kind: T.DataType, column: str, low: Any, high: Any) -> bool:
    """Whether a file can have rows with low <= column <= high (None: no bound)."""
    if column not in f.bounds:
        return True
    least, most, _ = f.bounds[column]
    if least is None:
        return False
    low, high = (None if v is None else _comparable(v, kind) for v in (low, high))
    return (low is None or _comparable(most, kind) >= low) and (high is None or _comparable(least, kind) <= high)


def _range_of(value: Column, ends: list[float]) -> Column:
    """How many of the ascending ``ends`` are at most the value, by halving; null for null."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value >= ends[mid], place(mid + 1, high)).otherwise(place(low, mid))

    return F.when(value.isNotNull(), place(0, len(ends)))


def _checked(schema: T.StructType) -> T.StructType:
    """The schema as a table has it: nullable, and with names that can be told apart."""
    checked(schema)
    if taken := RESERVED & set(by_name(schema)):
        raise ReservedName(f"a table has a column of its own called {', '.join(sorted(taken))}")
    return nullable(schema)


def _columns(schema: T.StructType) -> list[Column]:
    return [F.col(quoted(f.name)) for f in schema.fields]


class ArchiveTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.disk = spark, path.rstrip("/"), Files(spark)
        self._seen: Snapshot | None = None

    # -- log ---------------------------------------------------------------

    def _log(self, version: int, kind: str = "json") -> str:
        return f"{self.path}/_log/{version:020d}.{kind}"

    def _versions(self) -> list[int]:
        return sorted(int(n[:20]) for n in self.disk.names(f"{self.path}/_log") if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self._versions())

    def version(self) -> int:
        versions = self._versions()
        if not versions:
            raise TableMissing(self.path)
        return versions[-1]

    def commit_record(self, version: int) -> dict:
        return json.loads(self.disk.read(self._log(version)))

    def snapshot(self, version: int | None = None) -> Snapshot:
        last = self.version() if version is None else version
        state = self._seen if self._seen and self._seen.version <= last else None
        if state is None:
            summaries = [int(n[:20]) for n in self.disk.names(f"{self.path}/_log") if n.endswith(".summary")]
            if usable := [v for v in summaries if v <= last]:
                s = json.loads(self.disk.read(self._log(max(usable), "summary")))
                state = Snapshot(s["version"], T.StructType.fromJson(s["schema"]), tuple(DataFile.of(f) for f in s["files"]), s["properties"], s["next_id"], s["transactions"])
        for v in range(state.version + 1 if state else 0, last + 1):
            state = self._apply(state, self.commit_record(v))
        if version is None:
            self._seen = state
        return state

    @staticmethod
    def _apply(state: Snapshot | None, record: dict) -> Snapshot:
        gone = set(record["remove"])
        files = tuple(f for f in (state.files if state else ()) if f.path not in gone) + tuple(DataFile.of(f) for f in record["add"])
        if marked := {d["path"]: d for d in record.get("delete", ())}:
            files = tuple(replace(f, deletes=(*f.deletes, marked[f.path]["deletes"]), deleted=f.deleted + marked[f.path]["rows"]) if f.path in marked else f for f in files)
        transactions = dict(state.transactions if state else {})
        if record["transaction"]:
            transactions[record["transaction"][0]] = record["transaction"][1]
        return Snapshot(record["version"], T.StructType.fromJson(record["schema"]), files, record["properties"], record["next_id"], transactions)

    def _commit(
        self, base: Snapshot | None, operation: str, schema: T.StructType, add: Iterable[DataFile] = (), remove: Iterable[str] = (), properties: dict[str, str] | None = None,
        next_id: int = 0, transaction: tuple[str, int] | None = None, delete: Iterable[dict] = (),
    ) -> int:
        version = base.version + 1 if base else 0
        properties = properties if properties is not None else (base.properties if base else {})
        record = {
            "version": version, "timestamp": dt.datetime.now(dt.timezone.utc).isoformat(), "operation": operation, "schema": schema.jsonValue(), "add": [asdict(f) for f in add],
            "remove": list(remove), "delete": list(delete), "properties": properties, "next_id": next_id, "transaction": transaction,
        }
        self.disk.make(f"{self.path}/_log")
        if not self.disk.create_once(self._log(version), json.dumps(record)):
            raise ConcurrentCommit(f"{self.path}: version {version} is taken")
        self._seen = self._apply(base, json.loads(json.dumps(record)))
        if version and version % SUMMARY_EVERY == 0:
            s = self._seen
            whole = {"version": version, "schema": s.schema.jsonValue(), "files": [asdict(f) for f in s.files], "properties": s.properties, "next_id": s.next_id, "transactions": s.transactions}
            self.disk.write(self._log(version, "summary"), json.dumps(whole))
        return version

    # -- reading -----------------------------------------------------------

    def _sent(self, df: DataFrame, rows: int) -> DataFrame:
        """Marked for a broadcast if it has few enough rows; else left to the planner."""
        return F.broadcast(df) if rows <= MOST_SENT else df

    def _scan(self, files: Iterable[DataFile], schema: T.StructType, row_id: bool = False, places: bool = False) -> DataFrame:
        """The files' rows but for the deleted ones; with their ids, with their files' names and their places in them."""
        files = list(files)
        wanted = T.StructType([*schema.fields, T.StructField(_STORED_ID, T.LongType())]) if row_id else schema
        extra = [F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(PLACE)]
        tail = [F.col(ROW_ID)] * row_id + [F.col(FILE), F.col(PLACE)] * places
        if not files:
            more = [T.StructField(ROW_ID, T.LongType())] * row_id + [T.StructField(FILE, T.StringType()), T.StructField(PLACE, T.LongType())] * places
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *more]))

        def rows(some: list[DataFile], located: bool) -> DataFrame:
            df = self.spark.read.schema(wanted).parquet(*(f"{self.path}/{f.path}" for f in some))
            df = df.select(*_columns(wanted), *extra) if located or row_id else df
            if row_id:
                firsts = self.spark.createDataFrame([(f.name, f.first_id) for f in some], f"{_OF} string, {_FIRST} long")
                df = df.join(self._sent(firsts, len(some)), F.col(FILE) == F.col(_OF)).withColumn(ROW_ID, F.coalesce(F.col(_STORED_ID), F.col(_FIRST) + F.col(PLACE)))
            return df

        clean, dirty = [f for f in files if not f.deletes], [f for f in files if f.deletes]
        parts = [rows(clean, places)] if clean else []
        if dirty:
            gone = self._sent(self._deleted(dirty), sum(f.deleted for f in dirty))
            parts.append(rows(dirty, True).join(gone, (F.col(FILE) == F.col(_IN)) & (F.col(PLACE) == F.col(_AT)), "left_anti"))
        parts = [p.select(*_columns(schema), *tail) if p.columns != schema.names else p for p in parts]
        return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])

    def _deleted(self, files: list[DataFile]) -> DataFrame:
        """(file, place) of the deleted rows of these files."""
        folders = sorted({d for f in files for d in f.deletes})
        named = self.spark.read.schema("file string, place long").parquet(*(f"{self.path}/{d}" for d in folders)).select(F.col("file").alias(_IN), F.col("place").alias(_AT))
        names = self.spark.createDataFrame([(f.name,) for f in files], f"{_OF} string")
        return named.join(self._sent(names, len(files)), F.col(_IN) == F.col(_OF), "left_semi")

    def rows_of(self, files: Iterable[DataFile], version: int | None = None) -> DataFrame:
        """The rows of some files of a version."""
        return self._scan(files, self.snapshot(version).schema)

    def files_near(self, files: Iterable[DataFile], others: Iterable[DataFile], columns: list[str], version: int | None = None) -> list[DataFile]:
        """Those of ``files`` that can have a row whose columns all equal those of a row of the others, by the log's bounds."""
        schema, files, others = self.snapshot(version).schema, list(files), list(others)
        for f in (field_of(schema, c) for c in columns):
            told = [o.bounds.get(f.name) for o in others]
            if all(t is not None and t[0] is not None and not t[2] for t in told) and told:  # a null equals nulls, which have no bounds
                as_key = lambda v: _comparable(v, f.dataType)  # noqa: B023, E731
                low, high = min((t[0] for t in told), key=as_key), max((t[1] for t in told), key=as_key)
                files = [x for x in files if may_hold(x, f.dataType, f.name, low, high)]
        return files

    def scan(self, snapshot: Snapshot, row_id: bool = False) -> DataFrame:
        """A snapshot's rows with the columns FILE and PLACE, which ``delete_rows`` takes."""
        return self._scan(snapshot.files, snapshot.schema, row_id, places=True)

    def files_between(self, between: dict[str, tuple[Any, Any]], version: int | None = None) -> list[DataFile]:
        """The files that can have rows within the bounds of every column: {column: (low, high)}, None for no bound, both included."""
        s = self.snapshot(version)
        asked = [(field_of(s.schema, c), low, high) for c, (low, high) in between.items()]
        return [f for f in s.files if all(may_hold(f, c.dataType, c.name, low, high) for c, low, high in asked)]

    def read(self, version: int | None = None, row_id: bool = False, between: dict[str, tuple[Any, Any]] | None = None) -> DataFrame:
        """The rows of a version, the last one by default; with row_id, each row's id in the column _row_id.

        ``between`` = {column: (low, high)} leaves rows out (nulls too) that aren't within the bounds, and doesn't open files
        that the log says have none."""
        s = self.snapshot(version)
        if not between:
            return self._scan(s.files, s.schema, row_id)
        rows = self._scan(self.files_between(between, s.version), s.schema, row_id)
        for column, ends in between.items():
            c, kind = F.col(quoted(column)), field_of(s.schema, column).dataType
            rows = rows.where(c.isNotNull())
            for end, fits in zip(ends, (lambda x: c >= x, lambda x: c <= x)):  # noqa: B023
                if end is not None:
                    rows = rows.where(fits(end.column(kind.simpleString()) if isinstance(end, Moment) else F.lit(end).cast(kind)))
        return rows

    def history(self) -> DataFrame:
        """A row per commit, read from the log by Spark."""
        told = "version long, timestamp string, operation string, add array<struct<rows:long>>, remove array<string>, delete array<struct<rows:long>>"
        if not self.exists():
            raise TableMissing(self.path)
        rows = lambda c: F.aggregate(F.coalesce(c, F.array().cast("array<struct<rows:long>>")), F.lit(0).cast("long"), lambda a, x: a + x["rows"])
        log = self.spark.read.schema(told).json(f"{self.path}/_log/*.json")
        return log.select("version", "timestamp", "operation", F.size("add").alias("files_added"), F.size("remove").alias("files_removed"), rows(F.col("add")).alias("rows_added"), rows(F.col("delete")).alias("rows_deleted")).orderBy("version")

    def detail(self) -> dict[str, int]:
        s = self.snapshot()
        return {"version": s.version, "num_files": len(s.files), "size_in_bytes": sum(f.bytes for f in s.files), "rows": s.rows}

    def latest(self, column: str) -> Any:
        """The greatest value of a column: of days and times a Moment from the log, else from the rows; None if there is none.

        Files that don't have it in the log, or have deleted rows, are read for it."""
        s = self.snapshot()
        column, kind = field_of(s.schema, column).name, field_of(s.schema, column).dataType
        if not isinstance(kind, TIMES):
            return self._scan(s.files, s.schema).agg(F.max(quoted(column))).first()[0]
        told = [f for f in s.files if column in f.bounds and not f.deletes]
        values = [f.bounds[column][1] for f in told]
        if rest := [f for f in s.files if f not in told]:
            values.append(self._scan(rest, s.schema).agg(micros(F.max(quoted(column)), kind)).first()[0])
        most = max((v for v in values if v is not None), default=None)
        return None if most is None else Moment(most, isinstance(kind, T.TimestampType))

    # -- writing -----------------------------------------------------------

    def _dealt_out(self, df: DataFrame, least: int = 4 << 20, most: int = 1 << 30) -> DataFrame:
        """Rows read from fewer files than there are cores, of ``least`` to ``most`` bytes: dealt out, as one file would be one task
        now and whenever the table is read. Rows that a shuffle has dealt out already, or that the caller has put together
        (``coalesce``), stay as they are."""
        files, cores = df.inputFiles(), self.spark.sparkContext.defaultParallelism
        few = 0 < len(files) < cores and least <= sum(map(self.disk.size, files)) <= most
        return df.repartition(cores) if few and not _DEALT.search(df._jdf.queryExecution().executedPlan().toString()) else df

    def _ends(self, folder: str, schema: T.StructType, listed: list[T.StructField]) -> DataFrame:
        """The number of rows of each file in a folder, and the bounds and held values of its columns.

        For the ends of texts alone Spark would sort all rows of a task by their file; beside an aggregate whose state is an
        object (the set here) it keeps them in a hash table, a row a file."""
        ends = [e.alias(f"_{side}{i}") for i, f in enumerate(listed) for side, e in zip(("low", "high", "held"), (*bounds(f), F.count(quoted(f.name))))]
        if any(isinstance(f.dataType, T.StringType) for f in listed):
            ends.append(F.collect_set(F.lit(1)).alias("_hashed"))
        own = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        return own.groupBy(F.col("_metadata.file_name").alias("_name")).agg(F.count(F.lit(1)).alias("_rows"), *ends)

    def _write(self, df: DataFrame, clustered: str = "") -> list[DataFile]:
        """Writes immutable files, and notes their rows and bounds; the files stay where and as Spark has put them. Their rows have no ids yet."""
        folder = f"data/{uuid.uuid4().hex}"
        try:
            df.write.parquet(f"{self.path}/{folder}")
            listed = bounded(df.schema)
            told = {r["_name"]: r for r in self._ends(folder, df.schema, listed).collect()}  # a row per file of this commit
            sizes = self.disk.names(f"{self.path}/{folder}")
        except Exception:
            self.disk.remove(f"{self.path}/{folder}")
            raise
        files = []
        for name in sorted(told):
            r = told[name]
            ends_of = {f.name: [r[f"_low{i}"], r[f"_high{i}"], r["_rows"] - r[f"_held{i}"]] for i, f in enumerate(listed)}
            files.append(DataFile(f"{folder}/{name}", r["_rows"], sizes[name], -1, ends_of, clustered=clustered))
        return files

    def _settle(self, base: Snapshot | None, commit: Callable[[Snapshot | None], int | None], touched: Iterable[DataFile] = (), folders: Iterable[str] = (), alone: bool = False) -> int | None:
        """commit(base); where others have committed meanwhile, commit(their last version), if what they did doesn't meet this.

        It doesn't if the files that this commit removes, or names deleted rows of, are as they were (and no ``alone`` says that
        any commit matters): what was appended or deleted elsewhere stays. Else, and if anything fails, ConcurrentCommit or
        what has failed is raised, and this writer's own folders go."""
        touched = list(touched)
        try:
            while True:
                try:
                    return commit(base)
                except ConcurrentCommit:
                    now = self.snapshot()
                    held = {f.path: f for f in now.files}
                    if alone or now.version <= (base.version if base else -1) or any(held.get(f.path) != f for f in touched):
                        raise
                    base = now
        except Exception:
            for folder in folders:
                self.disk.remove(f"{self.path}/{folder}")
            raise

    @staticmethod
    def _folders(files: Iterable[DataFile]) -> set[str]:
        return {f.path.rpartition("/")[0] for f in files}

    @staticmethod
    def _numbered(files: list[DataFile], first: int) -> tuple[list[DataFile], int]:
        """The files with their rows' ids from ``first`` on, and the next id."""
        out = []
        for f in files:
            out.append(replace(f, first_id=first))
            first += f.rows
        return out, first

    def create(self, schema: T.StructType, properties: dict[str, str] | None = None) -> int:
        return self._commit(None, "create", _checked(schema), properties=properties or {})

    def append(self, df: DataFrame, transaction: tuple[str, int] | None = None) -> int | None:
        """Adds rows; new fields widen the schema, other types raise SchemaConflict. Creates the table if there is none.
        Names that differ from the table's by case only are the table's.

        ``transaction`` (writer, number): nothing happens, and None comes back, if
        the writer has committed this number or a later one already.
        """
        base = self.snapshot() if self.exists() else None
        if base and transaction and base.transactions.get(transaction[0], -1) >= transaction[1]:
            return None
        own = _checked(df.schema)
        written = self._write(self._dealt_out(self._spelt(df, evolve(base.schema, own) if base else own)))
        folders = self._folders(written)

        def commit(base: Snapshot | None) -> int | None:
            if base and transaction and base.transactions.get(transaction[0], -1) >= transaction[1]:
                for folder in folders:  # the same rows have come by another way meanwhile
                    self.disk.remove(f"{self.path}/{folder}")
                return None
            files, next_id = self._numbered(written, base.next_id if base else 0)
            return self._commit(base, "append", evolve(base.schema, own) if base else own, files, next_id=next_id, transaction=transaction)

        return self._settle(base, commit, folders=folders)

    def _spelt(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """df with the schema's names; those of nested fields are matched without case by readers."""
        names = by_name(schema)
        wrong = any(names[f.name.lower()].name != f.name for f in df.schema.fields)
        return df.select(*(F.col(quoted(f.name)).alias(names[f.name.lower()].name) for f in df.schema.fields)) if wrong else df

    def overwrite(self, df: DataFrame, schema_mode: str = "replace", check: Callable[[DataFrame], None] | None = None, operation: str = "overwrite") -> int:
        """Replaces all rows in one commit; the old files stay for history. All rows get new ids.

        df may read this table. schema_mode "replace" takes df's schema, "merge"
        widens the table's. ``check`` is called with what was written, before the
        commit: if it raises, the table stays as it was.
        """
        base = self.snapshot() if self.exists() else None
        own = _checked(df.schema)
        schema = evolve(base.schema, own) if base and schema_mode == "merge" else own
        written = self._write(self._spelt(df, schema))
        old = base.files if base else ()

        def commit(base: Snapshot | None) -> int:
            now = evolve(base.schema, own) if base and schema_mode == "merge" else own
            files, next_id = self._numbered(written, base.next_id if base else 0)
            return self._commit(base, operation, now, files, [f.path for f in old], next_id=next_id)

        def checked_commit(base: Snapshot | None) -> int:
            nonlocal check
            if check:
                check(self._scan(written, schema))
                check = None
            return commit(base)

        return self._settle(base, checked_commit, old, self._folders(written), alone=operation == "overwrite")

    def _rewrite(self, base: Snapshot, operation: str, old: list[DataFile], rows: DataFrame, clustered: str = "") -> int:
        """Puts ``rows``, which have their ids in _row_id, in the place of the old files."""
        files = [replace(f, first_id=-1) for f in self._write(rows.withColumnRenamed(ROW_ID, _STORED_ID), clustered)]
        return self._settle(base, lambda now: self._commit(now, operation, now.schema, files, [f.path for f in old], next_id=now.next_id), old, self._folders(files))

    def update(self, condition: Column, values: dict[str, Column]) -> int | None:
        """Sets columns where the condition holds, by rewriting the files with such rows; ids stay. None if no row matches."""
        base = self.snapshot()
        hit = {r["name"] for r in self._scan(base.files, base.schema, places=True).where(condition).select(F.col(FILE).alias("name")).distinct().collect()}
        old = [f for f in base.files if f.name in hit]
        if not old:
            return None
        kept = self._scan(old, base.schema, row_id=True)
        for name, value in values.items():
            own = field_of(base.schema, name)
            kept = kept.withColumn(own.name, F.when(condition, value).otherwise(F.col(quoted(own.name))).cast(own.dataType))
        return self._rewrite(base, "update", old, kept)

    def delete_rows(self, places: DataFrame, operation: str = "delete", base: Snapshot | None = None, check: Callable[[DataFrame], None] | None = None, expect: int | None = None) -> int | None:
        """Deletes rows by file and place (of a scan of ``base``), without rewriting a file: a commit names the rows, scans leave
        them out. None if there are none. ``check`` is called with what is left, before the commit; ``expect`` is how many rows
        there have to be."""
        base = base or self.snapshot()
        folder = f"deletes/{uuid.uuid4().hex}"
        try:
            places.select(F.col(FILE).alias("file"), F.col(PLACE).alias("place")).repartitionByRange("file").sortWithinPartitions("file", "place").write.parquet(f"{self.path}/{folder}")
            named = self.spark.read.schema("file string, place long").parquet(f"{self.path}/{folder}")
            told = {r["file"]: r["count"] for r in named.groupBy("file").count().collect()}  # a row per file with deleted rows
            hit = [f for f in base.files if f.name in told]
            if expect is not None and sum(told.values()) != expect:
                raise ValueError(f"{self.path}: {sum(told.values())} rows to delete, not {expect}")
            delete = [{"path": f.path, "deletes": folder, "rows": told[f.name]} for f in hit]
            if check and delete:
                left = self._apply(base, {"version": base.version + 1, "schema": base.schema.jsonValue(), "add": [], "remove": [], "delete": delete, "properties": {}, "next_id": 0, "transaction": None})
                check(self._scan(left.files, left.schema))
        except Exception:
            self.disk.remove(f"{self.path}/{folder}")
            raise
        if not delete:
            self.disk.remove(f"{self.path}/{folder}")
            return None
        return self._settle(base, lambda now: self._commit(now, operation, now.schema, next_id=now.next_id, delete=delete), hit, [folder])

    def compact(self, target: int = 128 << 20) -> int | None:
        """Puts small files (of less than half of ``target`` bytes), and those with deleted rows, together into files of about
        ``target``: rows and ids stay, and it is no change in the feed. None if there is nothing to gain.

        Files that follow one another by their first rows are packed together, in one job with a task for each new file. It writes
        rows as they come, what was read together in its order: ids are stored, so a file's worth of rows needn't be sorted in memory."""
        base = self.snapshot()
        small = sorted((f for f in base.files if f.deletes or f.bytes < target // 2), key=lambda f: (f.first_id, f.path))
        bins: list[list[DataFile]] = []
        for f in small:
            if not bins or sum(x.bytes for x in bins[-1]) + f.bytes > target:
                bins.append([])
            bins[-1].append(f)
        bins = [b for b in bins if len(b) > 1 or b[0].deletes]
        old = [f for b in bins for f in b]
        if not old:
            return None
        listed = self.spark.createDataFrame([(f.name, i) for i, b in enumerate(bins) for f in b], f"{_OF} string, {_BIN} int")
        rows = self._scan(old, base.schema, row_id=True, places=True).join(self._sent(listed, len(old)), F.col(FILE) == F.col(_OF))
        packed = rows.repartitionById(len(bins), F.col(_BIN)).select(*_columns(base.schema), ROW_ID)
        return self._rewrite(base, "compact", old, packed)

    def cluster(self, columns: list[str], target: int = 128 << 20, bits: int = 6) -> int | None:
        """Deals rows out so that those which are near each other in all of some columns (numbers, days, times) share files of
        about ``target`` bytes: a filter on any one of them skips files then. Rows and ids stay, and it is no change in the feed.

        Only files that haven't been dealt out by these columns yet are rewritten; None if there are none. Rows go by ranges of a
        Z-order curve over the columns' quantiles, 2 ** bits of each (which is what the driver gets); nulls come first."""
        base = self.snapshot()
        tag = ",".join(columns)
        old = [f for f in base.files if f.clustered != tag or f.deletes]
        if not old:
            return None
        rows = self._scan(old, base.schema, row_id=True)
        places = []
        for name in columns:
            kind, c = field_of(base.schema, name).dataType, F.col(quoted(name))
            if not isinstance(kind, (T.NumericType, *TIMES)):
                raise ValueError(f"{name}: rows can't be dealt out by a {kind.simpleString()}")
            value = (micros(c, kind) if isinstance(kind, TIMES) else c).cast("double")
            ends = rows.select(value.alias("v")).approxQuantile("v", [i / 2**bits for i in range(1, 2**bits)], 0.5 / 2**bits)
            places.append(F.coalesce(_range_of(value, sorted(set(ends))), F.lit(0)))
        curve = F.lit(0).cast("long")
        for b in range(bits):
            for i, p in enumerate(places):
                curve = curve.bitwiseOR(F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1)).cast("long"), b * len(places) + i))
        files = max(1, -(-sum(f.bytes for f in old) // target))
        dealt = rows.withColumn(_BIN, curve).repartitionByRange(files, _BIN, ROW_ID).sortWithinPartitions(_BIN, *map(quoted, columns)).drop(_BIN)
        return self._rewrite(base, "cluster", old, dealt, tag)

    @contextmanager
    def working(self, df: DataFrame) -> Iterator[DataFrame]:
        """df, written beside the table while it is worked with."""
        path = f"{self.path}/_work/{uuid.uuid4().hex}"
        try:
            df.write.parquet(path)
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            self.disk.remove(path)

    def note(self, name: str, value: dict) -> None:
        """Keeps something small beside the log, in place of what was there by that name."""
        self.disk.make(f"{self.path}/_notes")
        self.disk.write(f"{self.path}/_notes/{name}.json", json.dumps(value))

    def noted(self, name: str) -> dict | None:
        path = f"{self.path}/_notes/{name}.json"
        return json.loads(self.disk.read(path)) if self.disk.exists(path) else None

    def sweep(self, retention_hours: int = 168) -> int:
        """Deletes files that no commit names, which failed writers have left, if they are older than the retention (running
        writers' aren't); returns how many. What any version has stays. The folder's listing and the log are read and compared
        by Spark; the names of what goes come to the driver one after the other."""
        folders = [f"{self.path}/{d}" for d in ("data", "deletes") if self.disk.exists(f"{self.path}/{d}")]
        if not folders:
            return 0
        there = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folders)
        parts = F.split("path", "/")
        there = there.where(F.unix_micros("modificationTime") < F.unix_micros(F.current_timestamp()) - F.lit(retention_hours * 3_600_000_000))
        there = there.select(F.array_join(F.slice(parts, -3, 3), "/").alias("file"), F.array_join(F.slice(parts, -3, 2), "/").alias("folder"))
        log = self.spark.read.schema("add array<struct<path:string>>, delete array<struct<deletes:string>>").json(f"{self.path}/_log/*.json")
        files, deletes = log.select(F.explode("add.path").alias("file")), log.select(F.explode("delete.deletes").alias("folder")).distinct()
        gone = 0
        for r in there.join(files, "file", "left_anti").join(deletes, "folder", "left_anti").toLocalIterator():
            self.disk.remove(f"{self.path}/{r.file}")
            gone += 1
        return gone

    def set_properties(self, properties: dict[str, str]) -> int:
        """A commit of the log alone."""
        base = self.snapshot()
        return self._commit(base, "set properties", base.schema, properties=base.properties | properties, next_id=base.next_id)

    # -- changes -----------------------------------------------------------

    def changes(self, first: int, last: int | None = None) -> DataFrame:
        """The rows that commits first..last inserted, deleted or updated, in the schema of the last one.

        Columns _change_type (insert, delete, update_preimage, update_postimage),
        _commit_version and _commit_timestamp follow the table's.
        """
        last = self.version() if last is None else last
        schema = self.snapshot(last).schema
        state = self.snapshot(first - 1) if first else None
        moved: dict[str, list[tuple[DataFile, int, str]]] = {"delete": [], "insert": []}
        marked: list[tuple[DataFile, dict, int, str]] = []  # a file, and what the log says of its deleted rows
        parts: list[DataFrame] = []
        for v in range(first, last + 1):
            record = self.commit_record(v)
            known = {f.path: f for f in (state.files if state else ())}
            added, removed = [DataFile.of(f) for f in record["add"]], [known[p] for p in record["remove"]]
            state = self._apply(state, record)
            marked += [(known[d["path"]], d, v, record["timestamp"]) for d in record.get("delete", ())]
            if record["operation"] in SAME_ROWS:
                continue
            if record["operation"] == "update":
                stamp = [F.lit(v).cast("long").alias("_commit_version"), F.lit(record["timestamp"]).cast("timestamp").alias("_commit_timestamp")]
                parts.append(self._updated(removed, added, schema).select("*", *stamp))
            else:
                moved["delete"] += [(f, v, record["timestamp"]) for f in removed]
                moved["insert"] += [(f, v, record["timestamp"]) for f in added]
        for kind, files in moved.items():  # one scan for all commits: a file's name says which one it belongs to
            if files:
                commits = self.spark.createDataFrame([(f.name, v, t) for f, v, t in files], f"{_OF} string, _commit_version long, _commit_timestamp string")
                rows = self._scan([f for f, _, _ in files], schema, places=True)
                stamped = rows.join(self._sent(commits, len(files)), F.col(FILE) == F.col(_OF))  # a row per file of these commits
                parts.append(stamped.select(*_columns(schema), F.lit(kind).alias("_change_type"), "_commit_version", F.col("_commit_timestamp").cast("timestamp").alias("_commit_timestamp")))
        if marked:
            commits = self.spark.createDataFrame([(f.name, d["deletes"], v, t) for f, d, v, t in marked], f"{_OF} string, {_BIN} string, _commit_version long, _commit_timestamp string")
            folders = sorted({d["deletes"] for _, d, _, _ in marked})
            named = self.spark.read.schema("file string, place long").parquet(*(f"{self.path}/{d}" for d in folders))
            named = named.select(F.col("file").alias(_IN), F.col("place").alias(_AT), F.concat(F.lit("deletes/"), F.element_at(F.split("_metadata.file_path", "/"), -2)).alias("folder"))
            named = named.join(self._sent(commits, len(marked)), (F.col(_IN) == F.col(_OF)) & (F.col("folder") == F.col(_BIN))).drop("folder")
            whole = {f.path: replace(f, deletes=(), deleted=0) for f, _, _, _ in marked}
            rows = self._scan(whole.values(), schema, places=True)
            stamped = rows.join(self._sent(named, sum(d["rows"] for _, d, _, _ in marked)), (F.col(FILE) == F.col(_IN)) & (F.col(PLACE) == F.col(_AT)))
            parts.append(stamped.select(*_columns(schema), F.lit("delete").alias("_change_type"), "_commit_version", F.col("_commit_timestamp").cast("timestamp").alias("_commit_timestamp")))
        if not parts:
            tail = "_change_type string, _commit_version long, _commit_timestamp timestamp"
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *T.StructType.fromDDL(tail).fields]))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _updated(self, removed: list[DataFile], added: list[DataFile], schema: T.StructType) -> DataFrame:
        """Both images of the rows that differ between the files that an update has replaced and its own."""
        content = F.struct(*_columns(schema))
        a = self._scan(removed, schema, row_id=True).select(ROW_ID, content.alias("old"))
        b = self._scan(added, schema, row_id=True).select(ROW_ID, content.alias("new"))
        as_one = lambda c: comparable(F.col(c), schema) if has_map(schema) else F.col(c)
        changed = a.join(b, ROW_ID).where(~as_one("old").eqNullSafe(as_one("new")))
        images = F.explode(F.array(F.struct(F.col("old").alias("r"), F.lit("update_preimage").alias("t")), F.struct(F.col("new").alias("r"), F.lit("update_postimage").alias("t"))))
        return changed.select(images.alias("i")).select("i.r.*", F.col("i.t").alias("_change_type"))


class ArchiveStore:
    """Tables by schema and name below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def create_schema(self, schema: str) -> None:
        """Does nothing if it is there."""
        Files(self.spark).make(f"{self.root}/{schema}")

    def drop_schema(self, schema: str) -> None:
        """With all its tables; for tests."""
        Files(self.spark).remove(f"{self.root}/{schema}")

    def table(self, schema: str, name: str) -> ArchiveTable:
        return ArchiveTable(self.spark, f"{self.root}/{schema}/{name}")
