"""Nested arrays, maps and trees to tables.

Each output table is its own chain of ``explode`` over the staged record, which is a narrow
plan: nothing is shuffled, one huge parent is still many rows after the first explode, and
nested column pruning reads only the branch that the table needs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.naming import child_table_name
from recordloom.functions.scalars import attr_value, bool_text, first_truthy, parse_amount
from recordloom.operators.flatten import (
    CUSTOM_FIELD,
    Style,
    as_json,
    at,
    conform,
    extract_path,
    flatten_prefix,
    flatten_record,
    is_nested,
    json_rest,
    merge_types,
    names_of,
)
from recordloom.operators.keys import hash_key, parent_index_key
from recordloom.spec import quote, struct_field, variant_schema
from recordloom.store import cut_lineage


def _element(df: DataFrame, array: str) -> T.DataType | None:
    t: T.DataType = df.schema
    for part in array.split("."):
        f = struct_field(t, part) if isinstance(t, T.StructType) else None
        if f is None:
            return None
        t = f.dataType
    return t.elementType if isinstance(t, T.ArrayType) else None


def _rows_of(df: DataFrame, columns: Sequence[Column], array: Column, name: str = "_e", pos: str | None = None) -> DataFrame:
    """One row per element that is there.

    An outer explode with a filter behind it: for an inner explode Spark pushes ``size > 0``
    below the projection, and a column that is parsed from text would be parsed again for it.
    """
    if pos:
        return df.select(*columns, F.posexplode_outer(array).alias(pos, name)).filter(F.col(name).isNotNull())
    return df.select(*columns, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def child_table(
    df: DataFrame,
    array: str,
    parent: Mapping[str, str] | None = None,
    style: str | Style = "plain",
    drop: Sequence[str] = (),
    position: str | None = None,
    own_key: str | None = None,
) -> DataFrame:
    """Array of objects to rows that carry the parent's columns (``{source: name}``).

    ``position`` names a column for the 0-based index; ``own_key`` is an element field that
    gets the index where it has no value. Elements are flattened by ``style``.
    """
    carried = dict(parent or {"id": "parent_id"})
    index = position or "_pos"
    parents = [at(*s.split(".")).alias(n) for s, n in carried.items()]
    rows = _rows_of(df, parents, at(*array.split(".")), pos=index)
    fields = [f for f in rows.schema["_e"].dataType.fields if f.name not in carried.values() and f.name != index]
    flat = rows.select(*carried.values(), index, *[F.col(f"_e.`{f.name}`") for f in fields])
    if own_key:
        value = F.col(own_key).cast("string") if own_key in flat.columns else F.lit(None).cast("string")
        flat = flat.withColumn(own_key, F.coalesce(F.nullif(value, F.lit("")), F.col(index).cast("string")))
    if position is None:
        flat = flat.drop(index)
    keep = [*carried.values(), *([position] if position else [])]
    return flatten_record(flat, style, drop, keep=keep)


def with_position(df: DataFrame, array: str, position: str = "pos", element: str = "element") -> DataFrame:
    """One row per element with its 0-based position; the other columns stay."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.posexplode(array).alias(position, element))


# ---- fixed trees ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """A level of a document tree.

    ``spread`` are objects to flatten with a prefix, ``extract`` single sub-fields to take
    (``field, sub_field, name``), ``drop`` fields that other outputs cover, ``derived_key`` the
    columns a missing id is hashed from (a zero counts as missing there).
    """

    table: str
    array: str = ""
    spread: tuple[str, ...] = ()
    extract: tuple[tuple[str, str, str], ...] = ()
    drop: tuple[str, ...] = ()
    children: tuple[Node, ...] = ()
    derived_key: tuple[str, ...] = ()


def shred_tree(
    df: DataFrame,
    root: Node,
    tenant: str | Sequence[str] | None = None,
    key: str = "guid",
    emit_root: bool = True,
) -> dict[str, DataFrame]:
    """A document with nested arrays to one DataFrame per level.

    Every level carries ``<parent_table>_id`` and the tenant column (or several columns of the root), so that no join back to
    the root is needed. The arrays that have a level of their own leave their parent.
    """
    carried = [tenant] if isinstance(tenant, str) else list(tenant or ())
    out: dict[str, DataFrame] = {}

    def visit(node: Node, rows: DataFrame, inherited: list[str]) -> None:
        child_arrays = [c.array for c in node.children]
        if node is not root or emit_root:
            flat = extract_path(rows.drop(*child_arrays, *node.drop), node.extract)
            flat = flatten_prefix(flat, node.spread)
            if node.derived_key:
                flat = flat.withColumn("id", F.coalesce("id", hash_key(_parts(flat, node.derived_key))))
            out[node.table] = json_rest(flat)
        for child in node.children:
            if child.array not in rows.columns:
                continue
            parent_id = f"{node.table}_id"
            above = [at(key).alias(parent_id), *[at(c) for c in inherited]]
            exploded = _rows_of(rows, above, at(child.array))
            fields = [n for n in exploded.schema["_e"].dataType.fieldNames() if n not in (parent_id, *inherited)]
            visit(
                child,
                exploded.select(parent_id, *inherited, *[F.col(f"_e.`{n}`") for n in fields]),
                inherited,
            )

    visit(root, df, carried)
    return out


def _parts(df: DataFrame, names: Sequence[str]) -> list[Column]:
    def part(name: str) -> Column:
        f = struct_field(df.schema, name)
        if f is None:
            return F.lit(None).cast("string")
        return F.nullif(at(name), F.lit(0)) if isinstance(f.dataType, T.NumericType) else at(name)

    return [part(n) for n in names]


def payment_junction(
    orders: DataFrame, tenant: str = "restaurant_id"
) -> tuple[DataFrame, DataFrame]:
    """Pairs of check and payment, and the payment records themselves."""
    checks = _rows_of(orders, [at("guid").alias("orders_id"), at(tenant)], F.col("checks"), "_c")
    above = [F.col("orders_id"), F.col(tenant), F.col("_c.guid").alias("orders_check_id")]
    payments = _rows_of(checks, above, F.col("_c.payments"), "_p")
    junction = payments.select("orders_check_id", F.col("_p.guid").alias("payment_id"), "orders_id", tenant)
    return junction, payments.select(tenant, "_p.*")


# ---- arrays of scalars ----------------------------------------------------------------------


def bridge(
    df: DataFrame,
    a: str,
    array: str,
    b: str,
    a_as: str | None = None,
    singular: str | None = None,
    scope: str | None = None,
    carry: Sequence[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Pairs of the record key and each element, as text; NULL elements are skipped.

    Without elements the ``singular`` field is used, then the ``scope`` column the record was
    read under. Pairs are de-duplicated with partial aggregation, so a hot side is harmless.
    """
    many = at(*array.split(".")).cast("array<string>")
    sources = [F.when(F.size(many) > 0, many)]
    if singular:
        one = F.nullif(at(singular).cast("string"), F.lit(""))
        sources.insert(0, F.when(one.isNotNull(), F.array(one)))
    if scope:
        sources.append(F.array(at(scope).cast("string")))
    key = at(a).cast("string")
    left = [*[at(c) for c in carry], key.alias(a_as or a)]
    # said of the array: a filter on the key alone goes below the parsing of a record, which is then parsed for it as well
    pairs = _rows_of(df, left, F.when(key.isNotNull(), F.coalesce(*sources)), b)
    return pairs.distinct() if distinct else pairs


def grandchild_bridge(
    df: DataFrame,
    array: str,
    inner: str,
    parent: Mapping[str, str],
    child: Mapping[str, str],
    fields: Mapping[str, str],
) -> DataFrame:
    """Array inside an array element to a junction keyed by both.

    ``parent`` maps record columns, ``child`` element fields and ``fields`` inner fields to
    output names; missing text is empty, as the keys may not be NULL.
    """
    outer = _rows_of(df, [at(s).alias(n) for s, n in parent.items()], at(array), "_c")
    above = [
        *[F.col(n) for n in parent.values()],
        *[F.coalesce(F.col(f"_c.`{s}`"), F.lit("")).alias(n) for s, n in child.items()],
    ]
    both = _rows_of(outer, above, F.col(f"_c.`{inner}`"), "_g")
    have = names_of(both.schema["_g"].dataType)
    return both.select(
        *parent.values(),
        *child.values(),
        *[(F.coalesce(F.col(f"_g.`{s}`"), F.lit("")) if s in have else F.lit("")).alias(n) for s, n in fields.items()],
    )


# ---- found at run time ----------------------------------------------------------------------


def auto_children(
    df: DataFrame,
    table: str,
    id_column: str = "ID",
    parent_key: str = "parent_id",
    child_key: str = "id",
    style: str | Style = "forms",
    id_keys: Sequence[str] = ("ID",),
) -> dict[str, DataFrame]:
    """Every array-of-objects field becomes ``<table>__sub_<field>``, the rest stays the parent.

    A child without an id gets ``<parent>__<position>``. An empty array leaves NULL.
    """
    arrays = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    ]
    out = {table: flatten_record(df, style, drop=arrays)}
    for name in arrays:
        rows = _rows_of(df, [at(id_column).cast("string").alias(parent_key)], at(name), pos="_pos")
        have = [k for k in id_keys if k in rows.schema["_e"].dataType.fieldNames()]
        made = parent_index_key(parent_key, "_pos")
        key = F.coalesce(first_truthy(*[F.col(f"_e.`{k}`") for k in have]), made) if have else made
        fields = [n for n in rows.schema["_e"].dataType.fieldNames() if n not in (parent_key, *have)]
        flat = rows.select(key.alias(child_key), parent_key, *[F.col(f"_e.`{n}`") for n in fields if n != child_key])
        out[child_table_name(table, name)] = flatten_record(flat, style, keep=[child_key, parent_key])
    return out


# ---- maps -----------------------------------------------------------------------------------


def explode_dated_map(
    df: DataFrame, column: str, carry: Sequence[str], key_as: str = "date", fields: Sequence[str] = ()
) -> DataFrame:
    """Map of date to object: one row per date. Entries without an object or a key are skipped."""
    rows = df.select(*[at(c) for c in carry], F.explode(at(column)).alias(key_as, "_v"))
    rows = rows.filter(F.col("_v").isNotNull() & (F.coalesce(F.col(key_as), F.lit("")) != ""))
    names = list(fields) or rows.schema["_v"].dataType.fieldNames()
    return rows.select(*carry, key_as, *[F.col(f"_v.`{n}`") for n in names])


def unpivot_map2(
    df: DataFrame, column: str, outer_key: str, inner_key: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Map of maps: one row per pair of keys with the fields of the inner object."""
    outer = df.select(*[at(c) for c in carry], F.explode(at(column)).alias(outer_key, "_m"))
    inner = outer.select(*carry, outer_key, F.explode("_m").alias(inner_key, "_v")).filter("_v is not null")
    return inner.select(*carry, outer_key, inner_key, "_v.*")


# ---- several sources of one table -----------------------------------------------------------


def tagged_union(
    df: DataFrame,
    arrays: Mapping[str, str],
    tag: str,
    carry: Sequence[str] = (),
    position: str | None = None,
) -> DataFrame:
    """Sibling arrays to one table with a source tag, in one explode.

    Elements of different shape are widened to the union of their fields.
    """
    elements = {n: _element(df, n) for n in arrays}
    present = [n for n, t in elements.items() if isinstance(t, T.StructType)]
    if not present:
        # no record of the batch has any of them: no rows, but the columns that are known
        text = F.lit(None).cast("string")
        made = [text.alias(tag), *([text.alias(position)] if position else [])]
        return df.filter(F.lit(False)).select(*[at(c) for c in carry], *made)
    common = reduce(merge_types, [elements[n] for n in present])
    fields = {f.name: f.dataType for f in common.fields}

    def lifted(name: str) -> Column:
        have = {f.name: f.dataType for f in elements[name].fields}

        def make(x: Column, i: Column) -> Column:
            body = [
                (conform(x[n], have[n], t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields.items()
            ]
            return F.struct(F.lit(arrays[name]).alias("_tag"), i.alias("_pos"), *body)

        empty = F.array().cast(_lifted_type(fields))
        return F.coalesce(F.transform(at(*name.split(".")), make), empty)

    rows = _rows_of(df, [at(c) for c in carry], F.concat(*[lifted(n) for n in present]))
    made = [F.col("_e._tag").alias(tag)]
    if position:
        made.append(F.concat_ws("_", F.col("_e._tag"), F.col("_e._pos").cast("string")).alias(position))
    taken = {*carry, tag, position}
    return rows.select(*carry, *made, *[F.col(f"_e.`{n}`") for n in fields if n not in taken])


def _lifted_type(fields: Mapping[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(
        T.StructType(
            [
                T.StructField("_tag", T.StringType()),
                T.StructField("_pos", T.IntegerType()),
                *[T.StructField(n, t) for n, t in fields.items()],
            ]
        )
    )


def carry_context(
    df: DataFrame, inner: str, carry: Sequence[str], defaults: Mapping[str, str] | None = None
) -> DataFrame:
    """Scalars of an entry go onto its inner rows, where the inner value wins.

    An entry whose ``inner`` array is missing or empty is itself the row. ``defaults`` fills
    ``{column: carried column}`` where the value is still unknown.
    """
    context = [f.name for f in df.schema.fields if not is_nested(f.dataType) and f.name not in carry]
    array = F.when(F.size(at(inner)) > 0, at(inner))
    rows = df.select(*[at(c) for c in carry], *[at(c) for c in context], F.explode_outer(array).alias("_i"))
    names = list(dict.fromkeys([*rows.schema["_i"].dataType.fieldNames(), *context]))
    have = names_of(rows.schema["_i"].dataType)
    made = []
    for n in names:
        options = [F.col(f"_i.`{n}`")] if n in have else []
        options += [at(n)] if n in context else []
        if defaults and n in defaults:
            options.append(at(defaults[n]))
        made.append(F.coalesce(*options).alias(n))
    extra = [at(s).alias(n) for n, s in (defaults or {}).items() if n not in names and n not in carry]
    return rows.select(*[at(c) for c in carry], *made, *extra)


def shape_union(df: DataFrame, candidates: Sequence[str], name: str) -> DataFrame:
    """First of several places (dotted paths) that holds a list, as one array column."""
    arrays = []
    for path in candidates:
        if _element(df, path) is not None:
            arrays.append(at(*path.split(".")))
    return df.withColumn(name, F.coalesce(*arrays)) if arrays else df.withColumn(name, F.lit(None))


def variant_list(value: Column, keys: Sequence[str]) -> Column:
    """The list itself, or the list an object holds under the first matching key."""
    direct = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(direct, *[F.try_variant_get(value, f"$['{k}']", "array<variant>") for k in keys])


# ---- custom fields and tags -----------------------------------------------------------------

# Type codes in custom-field names and the slot they are stored in.
NUMBER_CODES = ("NUMBER", "LONG", "INT", "DECIMAL", "PERCENT", "CURRENCY")
DATETIME_CODES = ("DATETIME", "TIMESTAMP")
ENTITY_CODES = {
    "project": "2", "milestone": "3", "tasklist": "4", "task": "5", "bug": "6", "forum": "7", "status": "8",
}


def _entry(name: Column, value: Column) -> Column:
    """Name, text and kind of one custom-field value; a JSON null has no text."""
    kind = F.schema_of_variant(value)
    return F.struct(
        name.alias("name"),
        F.try_variant_get(value, "$", "string").alias("text"),
        F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False)).alias("nested"),
    )


def melt_custom_fields(
    df: DataFrame,
    keys: Sequence[str],
    record: str = "record",
    meta: DataFrame | None = None,
    meta_on: Sequence[str] = (),
) -> DataFrame:
    """Custom fields of a VARIANT record, long form with one typed slot per value.

    Two shapes are read: keys named ``UDF_<TYPE><N>`` and a ``customfields`` array. The slot
    follows the type code in the name; a number that cannot be read stays text; a list or an
    object is JSON text. ``meta`` (``field_api_name, field_label, field_type`` and the columns
    ``meta_on``) is joined for label and type; Spark picks the join by the measured size.
    """
    value = F.col(record)
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    top = F.transform(
        F.filter(F.map_entries(fields), lambda e: e["key"].rlike(CUSTOM_FIELD)),
        lambda e: _entry(e["key"], e["value"]),
    )
    listed = F.transform(
        F.try_variant_get(value, "$.customfields", "array<variant>"),
        lambda v: _entry(
            first_truthy(
                F.try_variant_get(v, "$.column_name", "string"),
                F.try_variant_get(v, "$.api_name", "string"),
                F.try_variant_get(v, "$.field_api_name", "string"),
            ),
            F.try_variant_get(v, "$.value", "variant"),
        ),
    )
    entry_type = "array<struct<name:string,text:string,nested:boolean>>"
    named = F.filter(listed, lambda e: F.coalesce(e["name"], F.lit("")) != "")
    empty = F.array().cast(entry_type)
    entries = F.concat(F.coalesce(top.cast(entry_type), empty), F.coalesce(named.cast(entry_type), empty))
    rows = _rows_of(df, [at(k) for k in keys], entries).select(
        *keys,
        F.col("_e.name").alias("field_api_name"),
        F.col("_e.text").alias("raw_value"),
        F.col("_e.nested").alias("_nested"),
        F.regexp_extract("_e.name", r"^UDF_([A-Z]+)\d+$", 1).alias("_code"),
    )
    known = F.nullif(F.col("raw_value"), F.lit(""))
    code = F.col("_code")
    scalar = known.isNotNull() & ~F.col("_nested")
    is_number = code.isin(*NUMBER_CODES)
    typed = rows.withColumn("_number", F.when(scalar & is_number, known.try_cast("double")))
    slots = typed.select(
        *keys,
        "field_api_name",
        "raw_value",
        F.when(F.col("_nested"), F.col("raw_value"))
        .when(scalar & is_number & F.col("_number").isNull(), known)
        .when(scalar & ~is_number & ~code.isin("BOOL", "DATE", *DATETIME_CODES), known)
        .alias("value_text"),
        F.col("_number").alias("value_number"),
        F.when(scalar & (code == "DATE"), known).alias("value_date"),
        F.when(scalar & code.isin(*DATETIME_CODES), known).alias("value_datetime"),
        F.when(scalar & (code == "BOOL"), bool_text(known)).alias("value_boolean"),
        F.nullif(F.lower(code), F.lit("")).alias("_code"),
    )
    if meta is None:
        return slots.withColumns(
            {"field_label": F.lit(None).cast("string"), "field_type": F.col("_code")}
        ).drop("_code")
    return label_join(slots, meta, meta_on)


def label_join(eav: DataFrame, meta: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Label and type of custom fields from their metadata; the type falls back to the name's code."""
    wanted = meta.select(*on, "field_api_name", "field_label", F.col("field_type").alias("_meta_type"))
    joined = eav.join(wanted, [*on, "field_api_name"], "left")
    kind = F.coalesce(first_truthy("_meta_type"), *([F.col("_code")] if "_code" in eav.columns else []))
    return joined.withColumn("field_type", kind).drop("_code", "_meta_type")


def tag_associations(df: DataFrame, entity_type: str, entity_id: str, scope: str = "portal_id") -> DataFrame:
    """Tags of one kind of entity: ``tags[]`` objects and bare ``tag_ids[]``.

    Only the known entity types carry tags. An id that comes without a name never hides the
    name from the other list.
    """
    if entity_type not in ENTITY_CODES:
        raise ValueError(f"entities of type {entity_type!r} carry no tags")
    pieces = []
    element = _element(df, "tags")
    shape = "array<struct<tag_id:string,tag_name:string,tag_color:string>>"
    if element is not None:
        have = names_of(element)

        def pick(x: Column, keys: Sequence[str]) -> Column:
            options = [x[k] for k in keys if k in have]
            return first_truthy(*options) if options else F.lit(None).cast("string")

        pieces.append(
            F.transform(
                at("tags"),
                lambda x: F.struct(
                    pick(x, ("id", "tag_id", "id_string")).alias("tag_id"),
                    pick(x, ("name", "tag_name")).alias("tag_name"),
                    pick(x, ("color", "colour")).alias("tag_color"),
                ),
            ).cast(shape)
        )
    if _element(df, "tag_ids") is not None:
        none = F.lit(None).cast("string")
        pieces.append(
            F.transform(
                at("tag_ids").cast("array<string>"),
                lambda x: F.struct(x.alias("tag_id"), none.alias("tag_name"), none.alias("tag_color")),
            ).cast(shape)
        )
    empty = F.array().cast(shape)
    rows = df.select(
        at(scope),
        F.lit(entity_type).alias("entity_type"),
        at(entity_id).cast("string").alias("entity_id"),
        F.explode(F.concat(*[F.coalesce(p, empty) for p in pieces]) if pieces else empty).alias("_t"),
    ).select(scope, "entity_type", "entity_id", "_t.*")
    return (
        rows.filter("tag_id is not null and tag_id <> '' and entity_id is not null")
        .groupBy(scope, "entity_type", "entity_id", "tag_id")
        .agg(F.min("tag_name").alias("tag_name"), F.min("tag_color").alias("tag_color"))
    )


# ---- trees of any depth ---------------------------------------------------------------------


def tree_depth(df: DataFrame, rows: Column, child_key: str) -> int:
    """Levels of the deepest tree in the batch, from the merged schema: one pass, one text to the driver.

    Where some records hold something else than lists the schema does not tell; levels are then counted one by one.
    """
    level = variant_schema(df.agg(F.schema_of_variant_agg(rows.cast("variant"))).first()[0])
    depth = 0
    while isinstance(level, T.ArrayType) and isinstance(level.elementType, T.StructType):
        depth += 1
        below = next((f for f in level.elementType.fields if f.name == child_key), None)
        if below is not None and isinstance(below.dataType, T.StringType):
            return _counted_depth(df, rows, child_key)
        level = below.dataType if below is not None else None
    return max(depth, 1)


def _counted_depth(df: DataFrame, rows: Column, child_key: str) -> int:
    """Levels until no node has children: one job per level."""

    def nodes(lists: DataFrame, children: Column) -> DataFrame:
        return cut_lineage(lists.select(F.explode(children).alias("node")))

    level, depth = nodes(df, F.try_variant_get(rows.cast("variant"), "$", "array<variant>")), 0
    while not level.isEmpty():
        depth += 1
        level = nodes(level, F.try_variant_get("node", f"$['{child_key}']", "array<variant>"))
    return max(depth, 1)


def _too_deep(children: Column, result: Column) -> Column:
    """``result``, unless there is a level that the measured depth did not show: then the job fails."""
    return F.when(
        F.coalesce(F.size(children), F.lit(0)) > 0, F.raise_error(F.lit("tree is deeper than measured")).cast("boolean")
    ).otherwise(result)


def walk_tree(
    df: DataFrame,
    roots: Column,
    child_key: str,
    keys: Sequence[str],
    depth: int | None = None,
) -> DataFrame:
    """All nodes of VARIANT trees: ``keys``, ``depth``, ``path``, ``parent`` and ``node``.

    ``roots`` is the array of top nodes (``array<variant>``). A tree is one landed document, so it
    is unrolled inside its row, level by level to the depth of the batch, and exploded once: the
    plan is narrow, without a loop of jobs. A tree deeper than ``depth`` fails, it is never cut.
    """
    staged = df.select(*[at(k) for k in keys], roots.alias("_roots"))
    levels = depth or tree_depth(staged, F.col("_roots"), child_key)
    inner = f"$['{child_key}']"

    def children(node: Column) -> Column:
        return F.try_variant_get(node, inner, "array<variant>")

    def unroll(nodes: Column, level: int, parent: Column, path: Column) -> Column:
        def own(n: Column, i: Column) -> Column:
            entry = F.struct(
                F.lit(level).alias("depth"), F.concat(path, F.array(i)).alias("path"), parent.alias("parent"), n.alias("node")
            )
            return entry if level + 1 < levels else _checked(n, entry)

        def _checked(n: Column, entry: Column) -> Column:
            return F.when(_too_deep(children(n), F.lit(True)), entry)

        mine = F.transform(nodes, own)
        if level + 1 >= levels:
            return mine
        below = F.transform(nodes, lambda n, i: unroll(children(n), level + 1, n, F.concat(path, F.array(i))))
        return F.concat(mine, F.flatten(F.filter(below, lambda b: b.isNotNull())))

    everything = unroll(F.col("_roots"), 0, F.lit(None).cast("variant"), F.array().cast("array<int>"))
    rows = _rows_of(staged, [at(k) for k in keys], everything)
    return rows.select(*keys, "_e.depth", "_e.path", "_e.parent", "_e.node")


def walk_levels(df: DataFrame, roots: Column, child_key: str, keys: Sequence[str], most: int = 10_000) -> DataFrame:
    """The rows of ``walk_tree`` by a recursive query: a level is made from the nodes of the level before.

    Nothing is measured beforehand and no expression grows with the depth, so trees of any and of mixed depth, and nodes whose
    children are no list, are walked alike; each level is a job over that level's nodes. Records with ``keys`` alike stay apart only by their
    paths. A tree of more than ``most`` levels fails.
    """
    spark = df.sparkSession
    # Spark stops recursion at a million rows by default
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    names = ", ".join(quote(k) for k in keys)
    start = df.select(*[at(k) for k in keys], F.posexplode(F.try_variant_get(roots.cast("variant"), "$", "array<variant>")).alias("_i", "_n"))
    inner = child_key.replace("'", "\\'")
    return spark.sql(
        f"""
        WITH RECURSIVE tree({names}, depth, path, parent, node) MAX RECURSION LEVEL {most} AS (
            SELECT {names}, 0, array(_i), CAST(NULL AS VARIANT), _n FROM {{start}}
            UNION ALL
            SELECT {names}, depth + 1, concat(path, array(b.pos)), node, b.col
            FROM tree, LATERAL posexplode(try_variant_get(node, "$['{inner}']", 'array<variant>')) AS b(pos, col)
        )
        SELECT {names}, depth, path, parent, node FROM tree
        """,
        start=start,
    )


def node_text(path: str, of: str = "node") -> Column:
    """Text of a field of a VARIANT node."""
    return F.try_variant_get(of, "$." + path, "string")


def typed_variant(value: Column, shape: str) -> Column:
    """VARIANT to a declared shape. The direct cast is fast but gives up on a value in which any part
    does not fit; such a value takes the lenient way through its text, where only that part is NULL."""
    return F.coalesce(F.try_variant_get(value, "$", shape), F.from_json(F.to_json(value), shape))


# ---- hierarchical reports -------------------------------------------------------------------

_CELLS = "array<struct<Value:string,Attributes:array<struct<Id:string,Value:string>>>>"


def flatten_report(df: DataFrame, keys: Sequence[str], rows: str = "Rows", depth: int | None = None) -> DataFrame:
    """Rows of reports: ``keys, row_index, section, row_type, cells``.

    All rows of one level come first; then the rows of its **last** section, and so on to the
    first. A blank section title is inherited. The order key is the path of negated section
    positions: a prefix sorts before what it is a prefix of, and later sections sort first.

    A report is one landed document, so it is unrolled and sorted inside its row: no shuffle.
    """
    staged = df.select(*[at(k) for k in keys], at(rows).alias("_rows"))
    levels = depth or tree_depth(staged, F.col("_rows"), "Rows")
    # one level more than measured, so that a deeper report is noticed
    shape = f"array<struct<RowType:string,Title:string,Cells:{_CELLS}>>"
    for _ in range(levels):
        shape = f"array<struct<RowType:string,Title:string,Cells:{_CELLS},Rows:{shape}>>"
    typed = staged.select(*keys, typed_variant(F.col("_rows"), shape).alias("_rows"))

    def unroll(level_rows: Column, level: int, group: Column, outer: Column) -> Column:
        def title(r: Column) -> Column:
            # the outer title is named once, so that the expression grows with the depth, not with its powers
            return F.coalesce(F.when(r["RowType"] == "Section", F.nullif(r["Title"], F.lit(""))), outer)

        def own(r: Column, i: Column) -> Column:
            entry = F.struct(
                group.alias("group"),
                i.alias("pos"),
                title(r).alias("section"),
                F.coalesce(r["RowType"], F.lit("")).alias("row_type"),
                r["Cells"].alias("cells"),
            )
            return entry if level < levels else F.when(_too_deep(r["Rows"], F.lit(True)), entry)

        mine = F.transform(level_rows, own)
        if level >= levels:
            return mine

        def section(r: Column, i: Column) -> Column:
            inside = unroll(r["Rows"], level + 1, F.concat(group, F.array(-i - 1)), title(r))
            return F.when(r["RowType"] == "Section", inside)

        below = F.filter(F.transform(level_rows, section), lambda b: b.isNotNull())
        return F.concat(mine, F.flatten(below))

    everything = unroll(F.col("_rows"), 1, F.array().cast("array<int>"), F.lit(""))
    flat = _rows_of(typed, [at(k) for k in keys], F.sort_array(everything), pos="row_index")
    return flat.select(*keys, "row_index", "_e.section", "_e.row_type", "_e.cells")


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def trial_balance(report_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Typed rows: account, debit, credit, and both year to date. Rows without cells stay only as sections."""
    rows = report_rows.filter((F.coalesce(F.size("cells"), F.lit(0)) > 0) | (F.col("row_type") == "Section"))
    return rows.select(
        *keys,
        "row_index",
        "section",
        "row_type",
        attr_value(_cell(0)["Attributes"], "account").alias("account_id"),
        F.when(_cell(0).isNotNull(), _cell(0)["Value"]).otherwise(F.lit("")).alias("account_name"),
        parse_amount(_cell(1)["Value"]).alias("debit"),
        parse_amount(_cell(2)["Value"]).alias("credit"),
        parse_amount(_cell(3)["Value"]).alias("ytd_debit"),
        parse_amount(_cell(4)["Value"]).alias("ytd_credit"),
    )


def report_cells(report_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per cell; a missing value is the empty text."""
    cells = report_rows.select(
        *keys, "row_index", "section", "row_type", F.posexplode("cells").alias("cell_index", "_c")
    )
    return cells.select(
        *keys,
        "row_index",
        "cell_index",
        "section",
        "row_type",
        F.coalesce(F.col("_c.Value"), F.lit("")).alias("cell_value"),
        attr_value(F.col("_c.Attributes"), "account").alias("cell_account_id"),
    )


def report_runs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One header row per report and date."""
    return df.select(*columns).distinct()


def derive_dim(facts: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Dimension rows met in facts: the attributes of the first fact in ``order`` win.

    ``min_by`` aggregates before the shuffle, so a dominant key does not matter.
    """
    seen = facts.filter(F.col(key).isNotNull())
    first = F.min_by(F.struct(*attributes), F.struct(*order))
    return seen.groupBy(key).agg(first.alias("_a")).select(key, "_a.*")


