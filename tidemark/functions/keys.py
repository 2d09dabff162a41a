"""Expressions over natural keys, where nulls are equal, and over time columns."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column's name as an expression takes it: dots and backticks in it are its own."""
    return "`" + name.replace("`", "``") + "`"


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """All keys equal, null equal to null; Spark hashes such a join."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{quoted(k)}").eqNullSafe(F.col(f"{right}.{quoted(k)}")) for k in keys))


def key_struct(keys: list[str]) -> Column:
    """One value for the whole key, so that a distinct count takes keys with nulls too."""
    return F.struct(*map(quoted, keys))


def survivor_order(tiebreaker: str, row_id: str | None, newest_version_wins: bool = False) -> list[Column]:
    """Which of equal keys comes first.

    Without row ids the latest tiebreaker. With them the row written first, the
    tiebreaker only deciding between equal ids; or, where the newest version
    wins, the latest tiebreaker and among equals the row written first. A null
    tiebreaker loses.
    """
    latest = F.col(quoted(tiebreaker)).desc_nulls_last()
    if row_id is None:
        return [latest]
    written = F.col(row_id).asc()
    return [latest, written] if newest_version_wins else [written, latest]


TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_EPOCH = dt.datetime(1970, 1, 1)
_MICRO = dt.timedelta(microseconds=1)


def micros(c: Column, kind: T.DataType) -> Column:
    """A day or a time as microseconds since 1970: an instant's in UTC, a day's or a wall clock's as they stand. Python's own
    dates end with the year 9999; these don't."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    days = F.unix_date(c if isinstance(kind, T.DateType) else c.cast("date")).cast("long") * 86_400_000_000
    if isinstance(kind, T.DateType):
        return days
    return days + F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


@dataclass(frozen=True)
class Moment:
    """A time of any year; ``zoned`` if it is an instant, not what a wall clock shows."""

    micros: int
    zoned: bool = False

    @classmethod
    def of(cls, value: dt.datetime) -> Moment:
        return cls((value - _EPOCH) // _MICRO)

    def plus(self, hours: int) -> Moment:
        return Moment(self.micros + hours * 3_600_000_000, self.zoned)

    def column(self, kind: str) -> Column:
        """A literal, once the plan is optimized, of the type timestamp or timestamp_ntz (for days too)."""
        kind = "timestamp_ntz" if kind == "date" else kind
        days, rest = divmod(self.micros, 86_400_000_000)
        wall = F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval({days}, 0, 0, CAST({rest} AS DECIMAL(18, 0)) / 1000000)")
        return (F.timestamp_micros(F.lit(self.micros).cast("long")) if self.zoned else wall).cast(kind)

    def datetime(self) -> dt.datetime:
        return _EPOCH + self.micros * _MICRO

    def __str__(self) -> str:
        try:
            return str(self.datetime()) + ("Z" if self.zoned else "")
        except OverflowError:
            return f"{self.micros} microseconds from 1970"


def as_datetime(value: dt.date | dt.datetime | None) -> dt.datetime | None:
    """A day is its midnight."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime.combine(value, dt.time())
    return value


def comparable(value: Column, kind: T.DataType) -> Column:
    """The value with every map in it as its entries in order of their keys, since maps can't be compared."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.sort_array(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields)))
    return value


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def bytes_taken(df: DataFrame) -> int:
    """About what the rows take in memory: texts by their length, nested values by that of their JSON."""
    taken = F.lit(16)
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            taken = taken + 8 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            taken = taken + 8 + 8 * F.octet_length(F.to_json(F.struct(c)))
        else:
            taken = taken + 16
    return int(df.agg(F.sum(taken.cast("long"))).first()[0] or 0)
