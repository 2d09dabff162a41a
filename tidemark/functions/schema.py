"""Additive schema evolution: what is new is added, at any depth; what is there keeps its type."""

from __future__ import annotations

from pyspark.sql import types as T


class SchemaConflict(ValueError):
    """A column of the new rows has another type than the table's."""


def evolve(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """old with the struct fields, also in array elements and map values, that only new has (nullable, at the end).

    Names are the same whatever their case, and keep the table's spelling."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        theirs, mine = by_name(new, path), by_name(old, path)
        fields = [T.StructField(f.name, evolve(f.dataType, theirs[n].dataType, f"{path}{f.name}.") if n in theirs else f.dataType, True, f.metadata) for n, f in mine.items()]
        return T.StructType(fields + [T.StructField(f.name, nullable(f.dataType), True, f.metadata) for n, f in theirs.items() if n not in mine])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(evolve(old.elementType, new.elementType, f"{path}element."), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if old.keyType != new.keyType:
            raise SchemaConflict(f"{path}key: {old.keyType.simpleString()} cannot become {new.keyType.simpleString()}")
        return T.MapType(old.keyType, evolve(old.valueType, new.valueType, f"{path}value."), True)
    if old != new:
        raise SchemaConflict(f"{path.rstrip('.')}: {old.simpleString()} cannot become {new.simpleString()}")
    return old


def by_name(kind: T.StructType, path: str = "") -> dict[str, T.StructField]:
    """The fields by name without case; two that differ by case only can't be told apart when they are read."""
    out: dict[str, T.StructField] = {}
    for f in kind.fields:
        if (other := out.setdefault(f.name.lower(), f)) is not f:
            raise SchemaConflict(f"{path}{f.name}: there is {path}{other.name} too, and case doesn't tell columns apart")
    return out


def field_of(kind: T.StructType, name: str) -> T.StructField:
    """The field of that name, whatever its case."""
    return by_name(kind)[name.lower()]


def checked(kind: T.DataType, path: str = "") -> None:
    """Raises SchemaConflict if names at any depth differ by case only."""
    if isinstance(kind, T.StructType):
        for f in by_name(kind, path).values():
            checked(f.dataType, f"{path}{f.name}.")
    elif isinstance(kind, T.ArrayType):
        checked(kind.elementType, f"{path}element.")
    elif isinstance(kind, T.MapType):
        checked(kind.keyType, f"{path}key.")
        checked(kind.valueType, f"{path}value.")


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every part nullable: files written before a field came have none of it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, nullable(kind.valueType), True)
    return kind
