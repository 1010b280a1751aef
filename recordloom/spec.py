"""Declarations: what a table is called, how it is keyed, typed, cut out of a record and kept up to date."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|(?:^|(?<=: )|(?<=<))(OBJECT(?=<)|(?:VOID|VARIANT)(?=[,>]|$))")


def variant_schema(text: str) -> T.DataType:
    """Type for the schema text of VARIANT values; fields of no or mixed type are text. Only types are replaced, never names.

    In that text a type stands at its start, behind a field's colon or in an array; names of other than plain letters are quoted.
    """
    ddl = _VARIANT_TYPE.sub(lambda m: {None: m[0], "OBJECT": "STRUCT"}.get(m[1], "STRING"), text)
    return T._parse_datatype_string(ddl)


class Policy(Enum):
    """How a table is read on later runs."""

    FULL = "full"  # every run reads everything
    MODIFIED = "modified"  # from a modification-time cursor on
    CREATED = "created"  # from a creation-time cursor on; only for write-once logs
    WINDOW = "window"  # the last N days, whatever the cursor says
    BY_PARENT = "by_parent"  # children of the parents that changed
    MAX_ID = "max_id"  # ids above the highest one seen


@dataclass(frozen=True)
class TableSpec:
    """Name, primary key and partial column types; columns that are not listed keep their type."""

    name: str
    pk: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)
    policy: Policy = Policy.FULL
    cursor: tuple[str, ...] = ()
    window_days: int = 0
    future_days: int | None = None
    sparse: bool = False
    delete_flag: str | None = None
    delete_statuses: tuple[str, ...] = ()
    status_column: str | None = None


@dataclass(frozen=True)
class Child:
    """An array of a record that becomes a table of its own.

    ``keys`` maps columns of the record to columns of the child. ``own_key`` is filled with the
    position where an element brings none. ``inner`` names an array inside the elements that
    becomes the junction ``inner_table``, keyed by the child's keys and ``own_key``.
    """

    array: str
    table: str
    keys: tuple[tuple[str, str], ...]
    own_key: str | None = None
    drop: tuple[str, ...] = ()
    style: str | None = None
    inner: str | None = None
    inner_table: str | None = None
    inner_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Entity:
    """One kind of record: how it is flattened and which tables it feeds."""

    spec: TableSpec
    style: str = "plain"
    drop: tuple[str, ...] = ()
    paths: tuple[tuple[str, str], ...] = ()
    children: tuple[Child, ...] = ()
    id_keys: tuple[str, ...] = ()
    spread: tuple[str, ...] = ()
    slash_dates: bool = False
    transform: Callable[[DataFrame], DataFrame] | None = None


# Names of declared column types and their Spark types.
DECLARED_TYPES = {
    "STRING": "string",
    "INT": "int",
    "LONG": "bigint",
    "FLOAT": "double",
    "BOOLEAN": "boolean",
    "UTC_DATETIME": "timestamp",
}


def spark_type(name: str) -> str:
    return DECLARED_TYPES.get(name, name)


def parse_tables(text: str, **common) -> dict[str, TableSpec]:
    """Specs from lines of ``table: key, key``; keyword arguments apply to every table."""
    specs = {}
    for line in text.strip().splitlines():
        name, _, keys = line.partition(":")
        if not name.strip() or name.strip().startswith("#"):
            continue
        pk = tuple(k.strip() for k in keys.split(",") if k.strip()) or ("id",)
        specs[name.strip()] = TableSpec(name.strip(), pk, **common)
    return specs


def struct_field(schema: T.StructType, name: str) -> T.StructField | None:
    """Field of that exact name, or None."""
    return next((f for f in schema.fields if f.name == name), None)


def fields_only(t: T.StructType, paths: Sequence[str]) -> T.StructType:
    """Objects with the fields at dotted paths only, in their old order; lists are passed through. A path that is not there fails."""
    wanted: dict[str, list[str]] = {}
    for path in paths:
        name, _, inner = path.partition(".")
        wanted.setdefault(name, []).append(inner)
    if lacking := wanted.keys() - {f.name for f in t.fields}:
        raise KeyError(f"no such field: {', '.join(sorted(lacking))}")

    def cut(t: T.DataType, inner: list[str]) -> T.DataType:
        if "" in inner:
            return t
        return T.ArrayType(cut(t.elementType, inner), t.containsNull) if isinstance(t, T.ArrayType) else fields_only(t, inner)

    return T.StructType([T.StructField(f.name, cut(f.dataType, wanted[f.name]), f.nullable) for f in t.fields if f.name in wanted])


def ddl_of(t: T.DataType) -> str:
    """Type as text with every field name quoted, so that any name survives."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"{quote(f.name)}:{ddl_of(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{ddl_of(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{ddl_of(t.keyType)},{ddl_of(t.valueType)}>"
    return t.simpleString()


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
