"""Which archive tables lag behind their source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import Moment, quoted
from tidemark.functions.schema import field_of
from tidemark.operators.merge import high_water_mark
from tidemark.sources.store import ArchiveTable, TableMissing

OK, STALE, ERROR, SKIPPED = "OK", "STALE", "ERROR", "SKIPPED"


class StaleTables(RuntimeError):
    """Some tables are stale or could not be checked."""


def _beyond(column: str, kind: str, after: Moment) -> Column:
    c = F.col(quoted(column))
    return (c.cast("timestamp_ntz") if kind == "date" else c) > after.column(kind)


def check_table(name: str, column: str, source, table: ArchiveTable, threshold_hours: int = 48, excluded: bool = False) -> dict:
    """Stale: the source has a row more than the threshold later than the archive's last; so a quiet table stays OK.

    ``source`` is called for the source's rows. Without an archive, or with an
    empty one, any source row makes it stale. Excluded tables and those whose
    source does not exist are skipped; other failures are errors of this table.
    """

    def says(status: str, note: str) -> dict:
        return {"table": name, "strategy": "freshness", "status": status, "note": note}

    if excluded:
        return says(SKIPPED, "excluded")
    try:
        rows: DataFrame = source()
        last = high_water_mark(table, column) if table.exists() else None
        if last is None:
            what = "archive is empty" if table.exists() else "no archive"
            return says(OK, f"{what}, source too") if rows.isEmpty() else says(STALE, f"{what}, source has rows")
        after = last.plus(threshold_hours)
        newer = rows.where(_beyond(column, field_of(rows.schema, column).dataType.simpleString(), after))
        return says(OK, f"archive reaches {last}") if newer.isEmpty() else says(STALE, f"archive reaches {last}, source goes beyond {after}")
    except TableMissing as e:
        return says(SKIPPED, f"no source: {e}"[:200])
    except AnalysisException as e:
        if e.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"):
            return says(SKIPPED, f"no source: {str(e).splitlines()[0]}"[:200])
        return says(ERROR, str(e).splitlines()[0][:200])
    except Exception as e:
        return says(ERROR, str(e).splitlines()[0][:200] if str(e) else type(e).__name__)


def lagging(archive: DataFrame, source: DataFrame, group: list[str], column: str, threshold_hours: int = 48) -> DataFrame:
    """The same for the groups of one table in one query: a row per group of the source with its status."""
    limit = F.expr(f"INTERVAL {int(threshold_hours)} HOURS")
    last = archive.groupBy(*group).agg(F.max(column).alias("archive_max"))
    newest = source.groupBy(*group).agg(F.max(column).alias("source_max"))
    joined = newest.join(last, group, "left")
    late = F.col("archive_max").isNull() | (F.col("source_max") > F.col("archive_max") + limit)
    return joined.select(*group, "archive_max", "source_max", F.when(late, STALE).otherwise(OK).alias("status"))


def raise_if_stale(results: list[dict]) -> None:
    bad = [r for r in results if r["status"] in (STALE, ERROR)]
    if bad:
        raise StaleTables(f"{len(bad)} of {len(results)} tables: " + "; ".join(f"{r['table']} {r['status']} ({r.get('note', '')})" for r in bad))
