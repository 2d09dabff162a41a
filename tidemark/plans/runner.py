"""Runs tables and tasks, collects their reports, and fails at the end, not at the first error."""

from __future__ import annotations

import json
import time
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_table
from tidemark.operators.features import ensure_features
from tidemark.operators.freshness import check_table
from tidemark.operators.merge import process_overwrite_table, process_watermark_table
from tidemark.plans.config import EngineConfig
from tidemark.plans.registry import OVERWRITE, STREAM, WATERMARK, TableSpec, keys_of
from tidemark.sources.store import ArchiveStore

#: One schema for the reports of all kinds of tasks.
RESULTS = "table string, strategy string, status string, reason string, ordering string, rows_read bigint, count_before bigint, count_after bigint, duplicates_removed bigint, elapsed_s double, error string, note string"
FAILED = "failed"


class TablesFailed(RuntimeError):
    """Some tables failed; the others have been processed."""


class RunReport(list):
    """What became of each table of a run, in the order of the tables; a failure is a report like others until ``settle``."""

    @classmethod
    def of(cls, specs: Iterable[TableSpec], work: Callable[[TableSpec], dict], at_once: int = 1) -> RunReport:
        """Works on all tables, ``at_once`` of them side by side."""

        def attempt(spec: TableSpec) -> dict:
            began = time.monotonic()
            try:
                return work(spec)
            except Exception as e:
                return {"table": spec.name, "status": FAILED, "error": str(e) or type(e).__name__, "elapsed_s": time.monotonic() - began}

        with ThreadPoolExecutor(max(1, at_once)) as pool:
            return cls(pool.map(attempt, specs))

    @property
    def failures(self) -> dict[str, str]:
        return {r["table"]: r.get("error") for r in self if r["status"] == FAILED}

    def settle(self) -> RunReport:
        """Raises if a table failed, and names them all."""
        if self.failures:
            raise TablesFailed(f"{len(self.failures)} of {len(self)} tables failed: " + "; ".join(f"{t}: {e}" for t, e in self.failures.items()))
        return self

    def frame(self, spark: SparkSession) -> DataFrame:
        names = [c.split(" ")[0] for c in RESULTS.split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in self], RESULTS)

    def exit_value(self) -> str:
        """What the run hands to its scheduler, as JSON."""
        return json.dumps({"tables": len(self), "by_status": Counter(r["status"] for r in self), "results": self}, default=str)


def summary(results: DataFrame) -> DataFrame:
    """By status: tables, rows read, duplicates removed, seconds."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"), F.coalesce(F.sum("rows_read"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("duplicates_removed"), F.lit(0)).alias("duplicates_removed"), F.coalesce(F.sum("elapsed_s"), F.lit(0.0)).alias("elapsed_s"),
    )


# -- what the tasks do ------------------------------------------------------


@dataclass
class Engine:
    """The run over a registry: where sources are read (by spec) and archives stand."""

    spark: SparkSession
    specs: list[TableSpec]
    config: EngineConfig
    source: Callable[[TableSpec], DataFrame]
    warnings: list[dict] = field(default_factory=list)

    def __post_init__(self):
        self.store = ArchiveStore(self.spark, self.config.root)

    def setup(self) -> None:
        """Creates the schemas, once or again."""
        for schema in sorted({s.schema for s in self.specs}):
            self.store.create_schema(schema)

    def _features(self, specs: Iterable[TableSpec]) -> None:
        """Turns features on; a failure is a warning."""
        for spec in specs:
            table = self.store.table(spec.schema, spec.table)
            try:
                if table.exists():
                    ensure_features(table, spec.name)
            except Exception as e:
                self.warnings.append({"table": spec.name, "warning": str(e)})

    def dedup(self, at_once: int = 1) -> RunReport:
        """Dedups all streamed tables, excluded ones too (their rows stay), then turns features on for those that didn't fail.

        Raises at the end if a table failed."""
        streamed = [s for s in self.specs if s.strategy == STREAM]

        def one(s: TableSpec) -> dict:
            table = self.store.table(s.schema, s.table)
            keys = keys_of(s, self.config.request_key) if table.exists() else []
            return {"strategy": "dedup"} | dedup_table(table, s.name, keys, s.tiebreaker, s.newest_version_wins)

        report = RunReport.of(streamed, one, at_once)
        self._features(s for s in streamed if s.name not in report.failures)
        return report.settle()

    def batch(self, at_once: int = 1) -> RunReport:
        """Merges, then features for merged tables, then replacements. Never raises: failures are in the reports."""
        chosen = [s for s in self.specs if self.config.should_process(s.source)]

        def merge(s: TableSpec) -> dict:
            self.store.create_schema(s.schema)
            source = self.source(s)
            return process_watermark_table(source, self.store.table(s.schema, s.table), s.name, keys_of(s, self.config.request_key), s.time_column, self.config.watermark_buffer_hours)

        def replace(s: TableSpec) -> dict:
            self.store.create_schema(s.schema)
            return process_overwrite_table(self.source(s), self.store.table(s.schema, s.table), s.name)

        merged = [s for s in chosen if s.strategy == WATERMARK]
        report = RunReport.of(merged, merge, at_once)
        self._features(merged)
        return RunReport([*report, *RunReport.of([s for s in chosen if s.strategy == OVERWRITE], replace, at_once)])

    def freshness(self) -> list[dict]:
        """A report per incremental table (those that are replaced outright are not checked)."""
        out = []
        for s in self.specs:
            if s.strategy != OVERWRITE:
                excluded = s.source in self.config.excludes
                out.append(check_table(s.name, s.time_column, lambda s=s: self.source(s), self.store.table(s.schema, s.table), self.config.stale_threshold_hours, excluded))
        return out


def daily(steps: dict[str, Callable[[], object]]) -> dict[str, dict]:
    """The daily run's steps (ingest, dedup, batch) in their order, each whatever became of the one before, as sources don't
    keep their rows for ever. Returns each step's state (success, failed) with its value or error."""
    done: dict[str, dict] = {}
    for name, step in steps.items():
        try:
            done[name] = {"state": "success", "value": step()}
        except Exception as e:
            done[name] = {"state": FAILED, "error": str(e)}
    return done
