"""From the declaration of a record kind to the DataFrames of its tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.scalars import first_truthy, parse_slash_date
from recordloom.operators.flatten import (
    apply_types,
    as_json,
    at,
    coalesce_keys,
    flatten_record,
    merge_case_variants,
    project_deep,
    stamp,
    strip_nulls,
)
from recordloom.operators.shred import child_table, grandchild_bridge
from recordloom.spec import Entity, TableSpec, struct_field

TRACKING = ("TrackingCategoryID", "TrackingOptionID", "Name", "Option")


def typed_specs(specs: Iterable[TableSpec], types: Mapping[str, str]) -> dict[str, TableSpec]:
    """Specs with the column types of their domain: a column means the same in every table."""
    return {s.name: TableSpec(**{**s.__dict__, "types": {**types, **s.types}}) for s in specs}


def convert_slash_dates(df: DataFrame) -> DataFrame:
    """Vendor dates in any text column to ISO; other text is unchanged."""
    return df.select(
        *[
            parse_slash_date(at(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else at(f.name)
            for f in df.schema.fields
        ]
    )


def _finish(df: DataFrame, entity: Entity, spec: TableSpec | None) -> DataFrame:
    if entity.slash_dates:
        df = convert_slash_dates(df)
    if spec is not None:
        df = apply_types(df, spec)
        if spec.sparse:
            df = strip_nulls(df, spec.pk)
    return df


def shred_entity(
    entity: Entity,
    records: DataFrame,
    specs: Mapping[str, TableSpec] | None = None,
    **context,
) -> dict[str, DataFrame]:
    """All tables that records of one kind feed. ``context`` are constant columns such as a tenant.

    Every table is a plan of its own over the same records, so land the records as Parquet (or
    cut their lineage) before several of them are written.
    """
    specs = specs or {}
    df = stamp(records, **context) if context else records
    if entity.id_keys:
        df = coalesce_keys(df, entity.id_keys, entity.spec.pk[-1])
    if entity.transform:
        df = entity.transform(df)
    out: dict[str, DataFrame] = {}
    arrays = [c.array for c in entity.children]
    have = set(df.columns)
    if entity.paths:
        parents = {p.split(".")[0] for p, _ in entity.paths}
        wanted = {p: n for p, n in entity.paths if p.split(".")[0] in have}
        head = project_deep(df, wanted, drop=parents)
    else:
        head = df
    kept = [*context, *([entity.spec.pk[-1]] if entity.id_keys else [])]
    flat = flatten_record(head, entity.style, drop=[*entity.drop, *arrays], spread=entity.spread, keep=kept)
    out[entity.spec.name] = _finish(flat, entity, entity.spec)
    for child in entity.children:
        field = struct_field(df.schema, child.array)
        if field is None or not isinstance(field.dataType, T.ArrayType):
            continue
        keys = dict(child.keys)
        inherited = {c: c for c in context}
        dropped = [*child.drop, *([child.inner] if child.inner else [])]
        rows = child_table(
            df, child.array, {**keys, **inherited}, style=child.style or entity.style, drop=dropped, own_key=child.own_key
        )
        out[child.table] = _finish(rows, entity, specs.get(child.table))
        if child.inner and child.inner in field.dataType.elementType.fieldNames():
            own = {child.own_key: child.own_key} if child.own_key else {"LineItemID": "LineItemID"}
            fields = {n: n for n in child.inner_fields}
            pairs = grandchild_bridge(_keyed(df, child), child.array, child.inner, {**keys, **inherited}, own, fields)
            out[child.inner_table] = _finish(pairs, entity, specs.get(child.inner_table))
    return out


def _keyed(df: DataFrame, child) -> DataFrame:
    """Elements with their key filled from the position, so that child and junction agree."""
    if not child.own_key:
        return df

    def keyed(e: Column, i: Column) -> Column:
        names = df.schema[child.array].dataType.elementType.fieldNames()
        known = first_truthy(e[child.own_key]) if child.own_key in names else F.lit(None).cast("string")
        return e.withField(child.own_key, F.coalesce(known, i.cast("string")))

    return df.withColumn(child.array, F.transform(at(child.array), keyed))


# ---- columns by the naming rule --------------------------------------------------------------


def camel(name: str, upper: bool = False) -> str:
    """``job_name`` to ``jobName`` (or ``JobName``)."""
    first, *rest = name.split("_")
    return (first.capitalize() if upper else first) + "".join(r.capitalize() for r in rest)


def pick_columns(
    records: DataFrame,
    names: Sequence[str],
    sources: Mapping[str, Sequence[str]] | None = None,
    raw: str | None = "raw_record",
) -> DataFrame:
    """Columns in snake case from records in camel case.

    ``names`` are the wanted columns; each is taken from the field of the same name in camel
    case (small or capital first letter), unless ``sources`` lists its alternative fields (dotted
    paths allowed). Fields the batch lacks are NULL, nested values JSON, and ``raw`` keeps the
    whole record.
    """
    records = merge_case_variants(records)
    made: list[Column] = []
    for name in names:
        options = (sources or {}).get(name) or (camel(name), camel(name, upper=True))
        made.append(first_field(records, options).alias(name))
    if raw:
        made.append(F.to_json(F.struct(*[at(c) for c in records.columns])).alias(raw))
    return records.select(*made)


def first_field(df: DataFrame, paths: Sequence[str]) -> Column:
    """First known of alternative fields (dotted paths), or NULL where the schema has none of them."""
    found = [c for c in (_at_path(df, p) for p in paths) if c is not None]
    if len(found) > 1:
        return first_truthy(*found)
    return found[0] if found else F.lit(None).cast("string")


def _at_path(df: DataFrame, path: str) -> Column | None:
    t: T.DataType = df.schema
    for part in path.split("."):
        f = struct_field(t, part) if isinstance(t, T.StructType) else None
        if f is None:
            return None
        t = f.dataType
    return as_json(at(*path.split(".")), t)
