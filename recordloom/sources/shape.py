"""Shape of records before a schema is made of them: which objects are records, which are dictionaries keyed by data.

An object whose keys are dates or ids has as many "fields" as there are data, and a merged schema of such records
grows with the input until it no longer fits the driver. So keys are counted first, per path and with a sketch of fixed size: a path with more than
``most_keys`` distinct keys becomes a map, whose values share one path, and only the keys of the others are named. The batch is
walked level by level, one job each over what is left of the records at that level. What reaches the driver is one row per
path of the resulting schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import at
from recordloom.operators.shred import typed_variant
from recordloom.spec import ddl_of, quote, variant_schema
from recordloom.store import cut_lineage

MOST_KEYS = 500
#: Marks in a path for the values of a map and the elements of an array; names are written as JSON texts, so they cannot be mistaken.
VALUES, ELEMENTS = "{}", "[]"


def _kind(v: Column) -> Column:
    schema = F.schema_of_variant(v)
    return F.when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").when(schema == "VOID", "void").otherwise("scalar")


def paths_of(df: DataFrame, column: str = "record", most_keys: int = MOST_KEYS) -> dict[tuple[str, ...], dict]:
    """{path: kinds that stand there, type of its scalars, whether its objects are maps}."""
    nodes = df.select(F.array().cast("array<string>").alias("path"), at(column).alias("v")).filter("v is not null")
    found: dict[tuple[str, ...], dict] = {}
    while True:
        nodes = cut_lineage(nodes.withColumn("kind", _kind(F.col("v"))))
        scalar = F.when(F.col("kind") == "scalar", F.col("v"))
        keys = F.when(F.col("kind") == "object", F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")))
        known = nodes.groupBy("path").agg(F.collect_set("kind").alias("kinds"), F.schema_of_variant_agg(scalar).alias("type"))
        # explode before the sketch: it holds keys, not lists of keys
        wide = nodes.select("path", F.explode(keys).alias("key")).groupBy("path").agg(F.approx_count_distinct("key").alias("keys"))
        rows = known.join(wide, "path", "left").collect()
        if not rows:
            return found
        for r in rows:
            found[tuple(r["path"])] = {"kinds": set(r["kinds"]), "type": r["type"], "map": (r["keys"] or 0) > most_keys}
        maps = [list(r["path"]) for r in rows if found[tuple(r["path"])]["map"]]
        is_map = F.lit(False)
        for path in maps:
            is_map = is_map | (F.col("path") == F.array(*map(F.lit, path)).cast("array<string>"))
        step = F.when(is_map, F.lit(VALUES)).otherwise(F.concat(F.lit('"'), F.col("key"), F.lit('"')))
        entries = nodes.filter("kind = 'object'").select("path", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("key", "v"))
        members = nodes.filter("kind = 'array'").select("path", F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        nodes = (
            entries.select(F.array_append("path", step).alias("path"), "v")
            .unionByName(members.select(F.array_append("path", F.lit(ELEMENTS)).alias("path"), "v"))
            .filter("v is not null")
        )


def shape_of(df: DataFrame, column: str = "record", most_keys: int = MOST_KEYS) -> T.DataType:
    """Type of the records: structs, maps where keys are data, arrays; text where kinds are mixed or nothing but null is known."""
    found = paths_of(df, column, most_keys)
    below: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for path in sorted(found):
        if path:
            below.setdefault(path[:-1], []).append(path)

    def kind(path: tuple[str, ...]) -> T.DataType:
        about = found[path]
        kinds = about["kinds"] - {"void"}
        if kinds == {"scalar"}:
            return variant_schema(about["type"])
        if kinds == {"array"}:
            return T.ArrayType(kind(below[path][0]) if path in below else T.StringType())
        if kinds == {"object"} and path in below:
            if about["map"]:
                return T.MapType(T.StringType(), kind(below[path][0]))
            return T.StructType([T.StructField(p[-1][1:-1], kind(p)) for p in below[path]])
        return T.StringType()

    return kind(()) if found else T.StructType([])


def shaped(df: DataFrame, column: str = "record", most_keys: int = MOST_KEYS) -> DataFrame:
    """VARIANT records as typed columns of their shape; the other columns stay. Records that are no objects give NULL columns."""
    shape = shape_of(df, column, most_keys)
    if not isinstance(shape, T.StructType):
        shape = T.StructType([T.StructField("value", shape)])
        df = df.withColumn(column, F.parse_json(F.to_json(F.struct(at(column).alias("value")))))
    others = [quote(c) for c in df.columns if c != column]
    return df.select(*others, typed_variant(at(column), ddl_of(shape)).alias("_r")).select(*others, "_r.*")


__all__ = ["MOST_KEYS", "paths_of", "shape_of", "shaped"]
