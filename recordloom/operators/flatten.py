"""Records to flat rows.

All decisions are taken on the driver from the schema, so each operator is one
``select``: no Python touches a row and Catalyst prunes what nobody reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.naming import safe_name
from recordloom.functions.scalars import coalesce_blank, first_truthy, ms_to_iso
from recordloom.spec import TableSpec, quote, spark_type, struct_field

Pairs = list[tuple[str, Column]]

# Field names and sub-keys that decide how an object is spread.
ADDRESS_FIELDS = ("billing_address", "delivery_address", "address")
ADDRESS_SUBKEYS = (
    "address_line_1", "address_line_2", "district_city", "state_province",
    "postal_code", "country", "latitude", "longitude",
)
NAME_SUBKEYS = ("prefix", "first_name", "last_name", "suffix")
FILE_SUBKEYS = ("filepath", "file_path", "url")
LOOKUP_IDS = ("id", "id_string", "Zoho_ID", "ID")
LOOKUP_NAMES = ("name", "full_name", "displayName", "display_name", "value")
UNPREFIXED = ("refundDetails", "jobReference")
CUSTOM_FIELD = r"^UDF_[A-Z]+\d+$"


def at(*path: str) -> Column:
    """Column at a path of exact field names."""
    return F.col(".".join(quote(p) for p in path))


def is_nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def as_json(c: Column, t: T.DataType) -> Column:
    """JSON text of a nested value; an empty array or map is NULL. Scalars pass through."""
    if isinstance(t, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, F.to_json(c))
    if isinstance(t, (T.StructType, T.VariantType)):
        return F.to_json(c)
    return c


def _scalar_or_json(field: T.StructField, *path: str) -> Column:
    return as_json(at(*path, field.name), field.dataType)


def names_of(t: T.StructType) -> set[str]:
    return {f.name for f in t.fields}


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two shapes of a field: objects get the union of their fields, an empty list
    takes the other's elements, numbers become double, anything else text."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = merge_types(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        pair = (a.elementType, b.elementType)
        structs = [t for t in pair if isinstance(t, T.StructType)]
        if len(structs) == 1:
            return T.ArrayType(structs[0])
        return T.ArrayType(merge_types(*pair))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def conform(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the wider shape made by ``merge_types``."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        made = [
            (conform(c[f.name], types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNotNull(), F.struct(*made))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        if isinstance(want.elementType, T.StructType) and not isinstance(have.elementType, T.StructType):
            return F.lit(None).cast(want)  # inferred from empty lists only
        return F.transform(c, lambda x: conform(x, have.elementType, want.elementType))
    if is_nested(have):
        return as_json(c, have)
    return c.cast(want)


def merge_case_variants(df: DataFrame) -> DataFrame:
    """Columns whose names differ only in case become one, known values first; Spark could not tell them apart."""
    grouped: dict[str, list[int]] = {}
    for i, name in enumerate(df.columns):
        grouped.setdefault(name.lower(), []).append(i)
    if len(grouped) == len(df.columns):
        return df
    names, types = df.columns, [f.dataType for f in df.schema.fields]
    by_place = df.toDF(*[f"_c{i}" for i in range(len(names))])
    out = []
    for places in grouped.values():
        cs = [F.col(f"_c{i}") for i in places]
        if len(cs) > 1 and any(types[i] != types[places[0]] for i in places):
            cs = [as_json(c, types[i]).cast("string") for c, i in zip(cs, places, strict=True)]
        text = all(isinstance(types[i], T.StringType) for i in places)
        out.append((coalesce_blank(cs) if text else F.coalesce(*cs)).alias(names[places[0]]))
    return by_place.select(*out)


# ---- the shapes an object can have ----------------------------------------------------------


def fk_columns(name: str, t: T.StructType) -> Pairs:
    """Reference object: scalars as ``name_k``, an object with an id as ``name_k_id``, the rest as JSON."""
    out: Pairs = []
    for f in t.fields:
        if isinstance(f.dataType, T.StructType) and "id" in names_of(f.dataType):
            out.append((f"{name}_{f.name}_id", at(name, f.name, "id")))
        else:
            out.append((f"{name}_{f.name}", _scalar_or_json(f, name)))
    return out


def spread_columns(name: str, t: T.StructType) -> Pairs:
    """Every sub-field as ``name_k``, nested ones as JSON. Also the rule for addresses."""
    return [(f"{name}_{f.name}", _scalar_or_json(f, name)) for f in t.fields]


def _present(t: T.StructType, path: str, keys: Sequence[str]) -> list[Column]:
    have = names_of(t)
    return [at(path, k) for k in keys if k in have]


def _first(columns: list[Column]) -> Column:
    return first_truthy(*columns) if columns else F.lit(None).cast("string")


def name_columns(name: str, t: T.StructType) -> Pairs:
    """Person name: its four parts, blanks as NULL, and the display value where the schema has one."""
    have = names_of(t)
    out: Pairs = [
        (f"{name}_{k}", first_truthy(at(name, k)) if k in have else F.lit(None).cast("string"))
        for k in NAME_SUBKEYS
    ]
    display = _present(t, name, ("zc_display_value", "display_value"))
    if display:
        out.append((f"{name}_display_value", _first(display)))
    return out


def file_columns(name: str, t: T.StructType) -> Pairs:
    """File reference: address and name of the file; the content is never read."""
    return [
        (f"{name}_url", _first(_present(t, name, ("url", "file_path", "filepath")))),
        (f"{name}_filename", _first(_present(t, name, ("file_name", "filename")))),
    ]


def lookup_by_capital_id(name: str, t: T.StructType) -> Pairs:
    return [
        (f"{name}_id", at(name, "ID")),
        (f"{name}_display_value", _first(_present(t, name, ("zc_display_value", "display_value")))),
    ]


def lookup_by_display(name: str, t: T.StructType) -> Pairs:
    ids = _present(t, name, ("id", "Zoho_ID", "recordId"))
    shown = _present(t, name, ("displayValue", "display_value", "name", "value"))
    return [(f"{name}_id", _first(ids)), *([(f"{name}_display_value", _first(shown))] if shown else [])]


def lookup_by_name(name: str, t: T.StructType) -> Pairs:
    """Id, name (put together from first and last name where it is missing) and e-mail."""
    have = names_of(t)
    names = [first_truthy(c) for c in _present(t, name, LOOKUP_NAMES)]
    parts = _present(t, name, ("first_name", "last_name"))
    if parts:
        names.append(F.nullif(F.trim(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])), F.lit("")))
    out: Pairs = [
        (f"{name}_id", _first(_present(t, name, LOOKUP_IDS))),
        (f"{name}_name", F.coalesce(*names)),
    ]
    mails = _present(t, name, ("email", "email_id"))
    if have & {"email", "email_id"}:
        out.append((f"{name}_email", _first(mails)))
    return out


def _is_display_lookup(have: set[str]) -> bool:
    return ("id" in have and bool(have & {"displayValue", "value", "name"})) or "Zoho_ID" in have


def _is_name_lookup(have: set[str]) -> bool:
    return bool(have & set(LOOKUP_IDS)) and bool(have & {*LOOKUP_NAMES, "first_name"})


# ---- rule sets ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Style:
    """How the objects of one family of records are recognised and spread, tried in order."""

    shapes: tuple[tuple[Callable[[str, set[str]], bool], Callable[[str, T.StructType], Pairs]], ...] = ()
    safe_names: bool = False
    blanks_to_null: bool = False
    strip_custom_fields: bool = False
    pair_epochs: bool = False
    nested_as_json: bool = True


STYLES: dict[str, Style] = {
    # keep scalars, nested values to JSON
    "plain": Style(),
    # keep scalars only
    "scalars": Style(nested_as_json=False),
    # reference objects with ``id``, addresses by field name
    "fk": Style(
        shapes=(
            (lambda n, have: n in ADDRESS_FIELDS, spread_columns),
            (lambda n, have: "id" in have, fk_columns),
        )
    ),
    # form builder: lookup, address, name, file
    "forms": Style(
        shapes=(
            (lambda n, have: "ID" in have, lookup_by_capital_id),
            (lambda n, have: bool(have & set(ADDRESS_SUBKEYS)), spread_columns),
            (lambda n, have: bool(have & set(NAME_SUBKEYS)), name_columns),
            (lambda n, have: bool(have & set(FILE_SUBKEYS)), file_columns),
        ),
        safe_names=True,
        blanks_to_null=True,
    ),
    # HR forms and bookings: lookups with a display value
    "display": Style(
        shapes=((lambda n, have: _is_display_lookup(have), lookup_by_display),),
        safe_names=True,
        blanks_to_null=True,
    ),
    # projects: lookups with a name, custom fields apart, epoch pairs
    "named": Style(
        shapes=((lambda n, have: _is_name_lookup(have), lookup_by_name),),
        safe_names=True,
        blanks_to_null=True,
        strip_custom_fields=True,
        pair_epochs=True,
    ),
}


def flatten_record(
    df: DataFrame,
    style: str | Style = "plain",
    drop: Iterable[str] = (),
    spread: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """One flat row per record.

    ``drop`` names fields that go to child tables or are redundant, ``spread`` names objects
    whose sub-fields become columns, ``keep`` names columns that pass through untouched.
    Source columns that end in the same safe name are merged, first known value first.
    """
    rules = STYLES[style] if isinstance(style, str) else style
    dropped, spread_, kept = set(drop), set(spread), set(keep)
    pairs: Pairs = []
    for f in df.schema.fields:
        if f.name in kept:
            pairs.append((f.name, at(f.name)))
        elif f.name not in dropped and not (rules.strip_custom_fields and _is_custom(f.name)):
            pairs.extend(_flatten_field(f, rules, spread_, kept))
    out = _merge_pairs(pairs) if rules.safe_names else pairs
    flat = df.select(*[c.alias(n) for n, c in out])
    return pair_dates(flat) if rules.pair_epochs else flat


def _is_custom(name: str) -> bool:
    return re.match(CUSTOM_FIELD, name) is not None


def _flatten_field(f: T.StructField, rules: Style, spread_: set[str], kept: set[str]) -> Pairs:
    t = f.dataType
    if isinstance(t, T.StructType):
        if not t.fields:
            return []
        found = next((make for test, make in rules.shapes if test(f.name, names_of(t))), None)
        if found is None and f.name in spread_:
            found = spread_columns
        pairs = found(f.name, t) if found else [(f.name, as_json(at(f.name), t))]
        if found is None and not rules.nested_as_json:
            return []
    elif is_nested(t):
        pairs = [(f.name, as_json(at(f.name), t))] if rules.nested_as_json else []
    else:
        c = at(f.name)
        if rules.blanks_to_null and isinstance(t, T.StringType):
            c = F.nullif(c, F.lit(""))
        pairs = [(f.name, c)]
    return [(safe_name(n), c) for n, c in pairs] if rules.safe_names else pairs


def _merge_pairs(pairs: Pairs) -> Pairs:
    grouped: dict[str, list[Column]] = {}
    for n, c in pairs:
        grouped.setdefault(n, []).append(c)
    return [(n, coalesce_blank([c.cast("string") for c in cs]) if len(cs) > 1 else cs[0]) for n, cs in grouped.items()]


def merge_collisions(df: DataFrame) -> DataFrame:
    """Safe names for all columns; columns that collapse to one name are merged, known values first."""
    return df.select(*[c.alias(n) for n, c in _merge_pairs([(safe_name(n), at(n)) for n in df.columns])])


# ---- single projections ---------------------------------------------------------------------


def explode_fk(df: DataFrame, drop: Iterable[str] = ()) -> DataFrame:
    """Objects with an ``id`` become ``<field>_id`` and ``<field>_<scalar>`` columns."""
    return flatten_record(df, "fk", drop)


def explode_lookup(df: DataFrame, kind: str = "named", **options) -> DataFrame:
    """Lookup objects to id and shown value; ``kind`` is ``forms``, ``display`` or ``named``."""
    return flatten_record(df, kind, **options)


def _replace(df: DataFrame, name: str, make: Callable[[str, T.StructType], Pairs]) -> DataFrame:
    f = struct_field(df.schema, name)
    if f is None or not isinstance(f.dataType, T.StructType):
        return df
    new = make(name, f.dataType)
    taken = {n for n, _ in new}
    rest = [at(c) for c in df.columns if c != name and c not in taken]
    return df.select(*rest, *[c.alias(n) for n, c in new])


def flatten_address(df: DataFrame, fields: Sequence[str] = ADDRESS_FIELDS) -> DataFrame:
    for name in fields:
        df = _replace(df, name, spread_columns)
    return df


def flatten_name(df: DataFrame, field: str) -> DataFrame:
    return _replace(df, field, name_columns)


def flatten_file(df: DataFrame, field: str) -> DataFrame:
    return _replace(df, field, file_columns)


def spread(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Listed objects to ``<field>_<sub>`` columns."""
    for name in fields:
        df = _replace(df, name, spread_columns)
    return df


def flatten_prefix(
    df: DataFrame,
    fields: Sequence[str],
    unprefixed: Sequence[str] = UNPREFIXED,
    overrides: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """Listed objects become prefixed columns, to any depth; ``guid`` is named ``id`` on the way.

    A key that already starts with the prefix keeps its name, and so do the keys of the
    ``unprefixed`` fields. ``overrides`` maps ``(prefix, key)`` to a name of its own.
    """
    special = {("refund", "tipRefundAmount"): "refund_tip_amount", **(overrides or {})}

    def walk(path: tuple[str, ...], t: T.StructType, prefix: str) -> Pairs:
        out: Pairs = []
        for f in t.fields:
            key = "id" if f.name == "guid" else f.name
            if key.startswith(prefix) or prefix in unprefixed:
                name = special.get((prefix, key), key)
            else:
                name = special.get((prefix, key), f"{prefix}_{key}")
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out.extend(walk(here, f.dataType, name))
            else:
                out.append((name, at(*here)))
        return out

    rest: Pairs = []
    spread_: Pairs = []
    for f in df.schema.fields:
        if f.name in fields and isinstance(f.dataType, T.StructType):
            spread_.extend((n, F.when(at(f.name).isNotNull(), c)) for n, c in walk((f.name,), f.dataType, f.name))
        elif f.name not in fields:
            rest.append(("id" if f.name == "guid" else f.name, at(f.name)))
    merged: dict[str, Column] = {}
    for n, c in [*rest, *spread_]:
        merged[n] = F.coalesce(c, merged[n]) if n in merged else c
    return df.select(*[c.alias(n) for n, c in merged.items()])


def extract_path(df: DataFrame, paths: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Take one sub-field of an object and drop the object: ``(field, sub_field, new_name)``.

    Where the schema has no such sub-field the object stays as it is.
    """
    taken: dict[str, str] = {}
    parents = set()
    for name, sub, new in paths:
        f = struct_field(df.schema, name)
        if f is not None and isinstance(f.dataType, T.StructType) and sub in names_of(f.dataType):
            taken[new] = name
            parents.add(name)
    subs = {new: sub for name, sub, new in paths if new in taken}
    rest = [at(c) for c in df.columns if c not in parents and c not in taken]
    return df.select(*rest, *[at(name, subs[new]).alias(new) for new, name in taken.items()])


def flatten_jsonapi(df: DataFrame) -> DataFrame:
    """``{id, type, attributes, relationships}`` to one row.

    A relation to one record gives ``<name>_id``, a relation to many gives ``<name>_ids`` as a
    JSON array; attributes that are nested become JSON.
    """
    attributes = df.schema["attributes"].dataType
    pairs: Pairs = [("id", at("id"))]
    pairs += [(f.name, _scalar_or_json(f, "attributes")) for f in attributes.fields]
    relationships = struct_field(df.schema, "relationships")
    for f in relationships.dataType.fields if relationships is not None else []:
        data = struct_field(f.dataType, "data") if isinstance(f.dataType, T.StructType) else None
        if data is not None and isinstance(data.dataType, T.ArrayType):
            if isinstance(data.dataType.elementType, T.StructType):
                ids = F.transform(at("relationships", f.name, "data"), lambda r: r["id"])
                pairs.append((f"{f.name}_ids", F.when(F.size(ids) > 0, F.to_json(ids))))
            else:  # the list is empty in every record of the batch
                pairs.append((f"{f.name}_ids", F.lit(None).cast("string")))
        elif data is not None and isinstance(data.dataType, T.StructType):
            pairs.append((f"{f.name}_id", at("relationships", f.name, "data", "id")))
        else:
            pairs.append((f"{f.name}_id", F.lit(None).cast("string")))
    merged = dict(pairs)
    return df.select(*[c.alias(n) for n, c in merged.items()])


def json_rest(df: DataFrame) -> DataFrame:
    """What is still nested becomes JSON text; an empty list becomes NULL."""
    return df.select(*[as_json(at(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def rename(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename columns; without a map, ``guid`` becomes ``id``."""
    return df.withColumnsRenamed(dict(names or {"guid": "id"}))


def drop_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Drop redundant fields; a dotted name drops a field inside an object."""
    for name in fields:
        parent, _, inner = name.partition(".")
        if not inner:
            df = df.drop(parent)
        elif parent in df.columns:
            df = df.withColumn(parent, at(parent).dropFields(inner))
    return df


def strip_nulls(df: DataFrame, pk: Sequence[str] = (), present: str = "present") -> DataFrame:
    """Scalar columns only, plus ``present``: the names of the columns this row really sets.

    The sparse merge leaves all other columns of the stored row alone.
    """
    scalars = [f.name for f in df.schema.fields if not is_nested(f.dataType)]
    marks = [F.when(at(c).isNotNull(), F.lit(c)) for c in scalars if c not in pk]
    names = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return df.select(*[at(c) for c in scalars], names.alias(present))


def promote(df: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Root scalars, then ``<section>_<key>`` for the listed objects, then the rest as JSON."""
    scalars = [(f.name, at(f.name)) for f in df.schema.fields if not is_nested(f.dataType)]
    lifted: Pairs = []
    rest: Pairs = []
    for f in df.schema.fields:
        if not is_nested(f.dataType):
            continue
        if f.name in sections and isinstance(f.dataType, T.StructType):
            lifted += spread_columns(f.name, f.dataType)
        else:
            rest.append((f.name, as_json(at(f.name), f.dataType)))
    return df.select(*[c.alias("id" if n == "guid" else n) for n, c in [*scalars, *lifted, *rest]])


def project_deep(df: DataFrame, paths: Mapping[str, str], drop: Iterable[str] = ()) -> DataFrame:
    """Fixed deep paths to columns: ``{"a.b.c": "name"}``; a missing step gives NULL."""
    made = [_deep(df.schema, path).alias(name) for path, name in paths.items()]
    return df.select(*[at(c) for c in df.columns if c not in set(drop)], *made)


def _deep(schema: T.StructType, path: str) -> Column:
    t: T.DataType = schema
    for part in path.split("."):
        f = struct_field(t, part) if isinstance(t, T.StructType) else None
        if f is None:
            return F.lit(None).cast("string")
        t = f.dataType
    return at(*path.split("."))


# Where the parts of a voided payment are found.
VOID_PATHS = {
    "voidInfo.voidApprover.guid": "void_info_approver_guid",
    "voidInfo.voidBusinessDate": "void_info_business_date",
    "voidInfo.voidDate": "void_info_date",
    "voidInfo.voidUser.guid": "void_info_user_guid",
    "voidInfo.voidReason.entityType": "void_info_reason_entity_type",
    "voidInfo.voidReason.guid": "void_info_reason_guid",
}


def coalesce_keys(df: DataFrame, keys: Sequence[str], name: str, blanks: bool = True) -> DataFrame:
    """First of several alternative fields that the schema has; with ``blanks`` empty text counts as missing."""
    have = [at(k) for k in keys if k in df.columns]
    if not have:
        value = F.lit(None).cast("string")
    else:
        value = first_truthy(*have) if blanks else F.coalesce(*[c.cast("string") for c in have])
    return df.withColumn(name, value)


def stamp(df: DataFrame, **columns) -> DataFrame:
    """Constant or derived columns (tenant, scope, type) on every row."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in columns.items()})


def split_row(df: DataFrame, columns: Sequence[str], singleton: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One record to two tables: the listed columns (with a fixed ``_singleton`` key if named), and the full row."""
    part = df.select(*[at(c) for c in columns if c in df.columns])
    return (stamp(part, _singleton=singleton) if singleton else part), df


def typed_lines(df: DataFrame, field: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Header object to typed columns: ``{sub_field: (new_name, type)}``; the object is dropped."""
    f = struct_field(df.schema, field)
    have = names_of(f.dataType) if f is not None and isinstance(f.dataType, T.StructType) else set()
    made = [
        (at(field, sub) if sub in have else F.lit(None)).try_cast(spark_type(t)).alias(name)
        for sub, (name, t) in columns.items()
    ]
    return df.select(*[at(c) for c in df.columns if c != field], *made)


def keep_raw(df: DataFrame, name: str = "raw_record", fields: Sequence[str] | None = None) -> DataFrame:
    """The record as JSON text beside its columns."""
    return df.withColumn(name, F.to_json(F.struct(*[at(c) for c in (fields or df.columns)])))


def pair_dates(df: DataFrame) -> DataFrame:
    """Each ``<n>_long`` epoch column gets an ISO ``<n>_at`` column, unless there is one already."""
    have = set(df.columns)
    new = {
        c[: -len("_long")] + "_at": ms_to_iso(at(c))
        for c in df.columns
        if c.endswith("_long") and c[: -len("_long")] + "_at" not in have
    }
    return df.withColumns(new) if new else df


def apply_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared column types; what cannot be read as its type becomes NULL. Other columns pass through."""
    wanted = {n: spark_type(t) for n, t in spec.types.items()}
    return df.select(
        *[at(c).try_cast(wanted[c]).alias(c) if c in wanted else at(c) for c in df.columns]
    )


# ---- union of varying shapes ----------------------------------------------------------------


def _rank(t: T.DataType) -> str:
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    return "string"


def widen(a: str, b: str) -> str:
    """Common type of two: equal, or number with number to double, else text."""
    if a == b:
        return a
    return "double" if {a, b} == {"bigint", "double"} else "string"


def union_columns(dfs: Sequence[DataFrame]) -> DataFrame:
    """Rows of varying shape under the union of their columns, names compared without case."""
    types: dict[str, str] = {}
    shown: dict[str, str] = {}
    for df in dfs:
        for f in df.schema.fields:
            if isinstance(f.dataType, T.NullType):
                continue
            key = f.name.lower()
            shown.setdefault(key, f.name)
            rank = _rank(f.dataType)
            types[key] = widen(types[key], rank) if key in types else rank

    def shaped(df: DataFrame) -> DataFrame:
        have = {f.name.lower(): f for f in df.schema.fields}
        columns = []
        for key, name in shown.items():
            f = have.get(key)
            c = F.lit(None) if f is None else as_json(at(f.name), f.dataType)
            columns.append(c.cast(types[key]).alias(name))
        return df.select(*columns)

    out = shaped(dfs[0])
    for df in dfs[1:]:
        out = out.unionByName(shaped(df))
    return out
