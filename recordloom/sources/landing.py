"""Landed response pages and bulk exports to one row per record.

A page is one JSON document. Pages come as files (``read_text_pages``) or as any
DataFrame with a text column, so everything below is a narrow, map-only plan:
no shuffle happens between the landed bytes and the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import merge_case_variants
from recordloom.operators.shred import typed_variant
from recordloom.spec import ddl_of, variant_schema

GENERIC_KEYS = ("data", "result")

# Keys that mark an error envelope and keys that mark a record.
ERROR_KEYS = ("errorcode", "errorCode", "error_code", "errors", "Errors", "error", "message", "Message")
ENVELOPE_ERROR_KEYS = ("error_msg", "errormessage", "error_code", "errorCode", "errors")
RECORD_KEYS = ("recordId", "Zoho_ID", "ZohoID", "id", "ID", "EntityId", "Erecno", "erecno")


def read_text_pages(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed JSON text: one page per line, or one per file. Keeps the file and its time for sequencing."""
    raw = spark.read.text(path, wholetext=whole_file)
    return raw.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("page_file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def _path(key: str) -> str:
    """JSON path of a dotted key."""
    return "$" + "".join(f"['{part}']" for part in key.split(".") if part)


def _array_at(value: Column, key: str) -> Column:
    return F.try_variant_get(value, _path(key), "array<variant>")


def _first_list(candidates: list[Column]) -> Column:
    """First list with elements, else the first list at all."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in candidates], *candidates)


def read_pages(
    pages: DataFrame,
    array_keys: Sequence[str] = (),
    body: str = "body",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Records of paged envelopes: one row per element with its 0-based ``pos`` in the page.

    The list is taken from the first of ``array_keys`` (dotted paths allowed), then
    ``data`` and ``result``, that holds elements; a body that is a list itself is accepted.
    With ``schema`` the record is a struct parsed straight from the text (fastest, prunes
    columns); without it the record is a VARIANT.
    """
    keys = [*array_keys, *(k for k in GENERIC_KEYS if k not in array_keys)]
    others = [c for c in pages.columns if c != body]
    text = F.col(body)
    if schema is not None:
        element = schema if isinstance(schema, T.DataType) else T._parse_datatype_string(schema)
        is_list = F.ltrim(text).startswith("[")
        parsed = pages.select(
            *others,
            F.when(~is_list, F.from_json(text, _envelope(keys, element))).alias("_page"),
            F.when(is_list, F.from_json(text, T.ArrayType(element))).alias("_bare"),
        )
        lists = [F.col("_page." + ".".join(f"`{part}`" for part in key.split("."))) for key in keys]
        lists.append(F.col("_bare"))
    else:
        parsed = pages.select(*others, F.try_parse_json(text).alias("_page"))
        lists = [_array_at(F.col("_page"), key) for key in keys]
        lists.append(F.try_variant_get("_page", "$", "array<variant>"))
    # each list is a column of its own, so that it is taken out of the page only once
    taken = parsed.select(*others, *[c.alias(f"_l{i}") for i, c in enumerate(lists)])
    found = _first_list([F.col(f"_l{i}") for i in range(len(lists))])
    return taken.select(*others, F.posexplode_outer(found).alias("pos", "record")).filter("record is not null")


def _envelope(keys: Sequence[str], element: T.DataType) -> T.StructType:
    """Schema of an envelope that may hold the list under any of the dotted keys."""
    tree: dict = {}
    for key in keys:
        node = tree
        *above, last = key.split(".")
        for part in above:
            node = node.setdefault(part, {})
        node.setdefault(last, None)

    def shape(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(n, T.ArrayType(element) if sub is None else shape(sub)) for n, sub in node.items()]
        )

    return shape(tree)


def read_single(pages: DataFrame, keys: Sequence[str] = (), body: str = "body") -> DataFrame:
    """One record per page: the object, or the first element of the list, under the first matching key."""
    others = [c for c in pages.columns if c != body]
    page = F.col("_page")
    candidates = []
    for key in keys:
        at_key = F.try_variant_get(page, _path(key), "variant")
        first = F.get(_array_at(page, key), F.lit(0))
        candidates.append(F.when(F.schema_of_variant(at_key).startswith("OBJECT"), at_key))
        candidates.append(first)
    record = F.coalesce(*candidates, page) if candidates else page
    return (
        pages.select(*others, F.try_parse_json(F.col(body)).alias("_page"))
        .select(*others, record.alias("record"))
        .filter(F.schema_of_variant("record").startswith("OBJECT"))
    )


def read_keyed(pages: DataFrame, map_key: str = "", key_as: str = "key", body: str = "body") -> DataFrame:
    """Dictionary responses: one row per entry with the key as a column; values that are no objects are skipped."""
    others = [c for c in pages.columns if c != body]
    entries = F.try_variant_get(F.try_parse_json(F.col(body)), _path(map_key), "map<string,variant>")
    return pages.select(*others, F.explode_outer(entries).alias(key_as, "record")).filter(
        F.schema_of_variant("record").startswith("OBJECT")
    )


def as_record(df: DataFrame, schema: T.StructType | str, column: str = "record") -> DataFrame:
    """VARIANT record to typed columns; fields of another type become NULL instead of failing the row."""
    element = ddl_of(schema if isinstance(schema, T.DataType) else T._parse_datatype_string(schema))
    others = [c for c in df.columns if c != column]
    parsed = typed_variant(F.col(column), element)
    return merge_case_variants(df.select(*others, parsed.alias("_r")).select(*others, "_r.*"))


def infer_schema(df: DataFrame, column: str = "record") -> T.StructType:
    """Schema of the records in a batch, from one distributed pass; fields of mixed type stay text."""
    merged = df.agg(F.schema_of_variant_agg(column)).first()[0]
    return variant_schema(merged)


# ---- bulk CSV -------------------------------------------------------------------------------


def _bulk_cell(cell: Column) -> Column:
    """Blank to NULL, valid bracketed JSON to its compact form, everything else as it is."""
    stripped = F.trim(cell)
    bracketed = stripped.rlike(r"(?s)^[\{\[].*[\}\]]$")
    as_json = F.to_json(F.try_parse_json(stripped))
    return F.when(stripped != "", F.when(bracketed, F.coalesce(as_json, cell)).otherwise(cell))


def parse_bulk_csv(lines: DataFrame, columns: Sequence[str], text: str = "line") -> DataFrame:
    """The same cells from a column of CSV rows."""
    others = [c for c in lines.columns if c != text]
    ddl = ", ".join(f"`{c}` string" for c in columns)
    row = F.from_csv(F.col(text), ddl, {"escape": '"'})
    return lines.select(*others, row.alias("_row")).select(
        *others, *[_bulk_cell(F.col(f"_row.`{c}`")).alias(c) for c in columns]
    )


# ---- what is not data -----------------------------------------------------------------------


def _has_any(record: Column, keys: Sequence[str]) -> Column:
    """Is any of the keys there, with whatever value? Stops at the first one."""
    found = F.lit(False)
    for key in keys:
        found = found | F.try_variant_get(record, f"$['{key}']", "variant").isNotNull()
    return found


def drop_sentinels(records: DataFrame, column: str = "record") -> tuple[DataFrame, DataFrame]:
    """Split VARIANT records into data and rejects.

    A record that has an error key and no record key is an error envelope, not a row.
    Returns both sides so that a rejected page is counted, never lost.
    """
    record = F.col(column)
    sentinel = ~_has_any(record, RECORD_KEYS) & _has_any(record, ERROR_KEYS)
    tagged = records.withColumn(
        "reject_reason",
        F.when(~F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False)), "not an object")
        .when(sentinel, "error envelope"),
    )
    return (
        tagged.filter("reject_reason is null").drop("reject_reason"),
        tagged.filter("reject_reason is not null"),
    )


def parse_pages(pages: DataFrame, schema: T.StructType | str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Pages parsed with ``schema`` as ``page``, and the pages that it cannot read: the other columns, reason and body.

    Text that is no JSON is refused, and so is a page with a field of another type than declared, which
    would come out as NULL otherwise; its text is kept as it stands. A null body is refused as well.
    """
    element = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    corrupt = "_corrupt_body"
    others = [c for c in pages.columns if c != body]
    options = {"columnNameOfCorruptRecord": corrupt}
    read = F.from_json(F.col(body), T.StructType([*element.fields, T.StructField(corrupt, T.StringType())]), options)
    parsed = pages.withColumn("_page", read)
    bad = F.col("_page").isNull() | F.col(f"_page.{corrupt}").isNotNull()
    reason = F.when(F.try_parse_json(body).isNull(), "malformed json").otherwise("other type than declared")
    return (
        parsed.filter(~bad).select(*others, F.col("_page").dropFields(corrupt).alias("page")),
        parsed.filter(bad).select(*others, reason.alias("reason"), F.col(body).alias("body")),
    )


def land_by_day(df: DataFrame, path: str, day: Column, column: str = "landed_on") -> None:
    """Append rows to a landed table, partitioned by the day on which they were landed; a day's rows are in few files."""
    df.withColumn(column, day.cast("date")).hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def drop_failed_pages(pages: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Split pages into good ones and rejects: unreadable text, non-zero status, inner ``failure``."""
    page = F.try_parse_json(F.col(body))
    status = F.try_variant_get(page, "$.response.status", "string")
    code = F.try_variant_get(page, "$.response.errorcode", "string")
    inner = F.try_variant_get(page, "$.response.returnvalue.status", "string")
    bare_error = _has_any(page, ENVELOPE_ERROR_KEYS) & ~_has_any(page, ("data", "result", "response"))
    reason = (
        F.when(page.isNull(), "unreadable")
        .when(F.lower(inner) == "failure", "inner failure")
        .when(status.isNotNull() & ~F.lower(status).isin("", "0", "success"), "status")
        .when(code.isNotNull() & (code != "0"), "error code")
        .when(bare_error, "error envelope")
    )
    tagged = pages.withColumn("reject_reason", reason)
    return (
        tagged.filter("reject_reason is null").drop("reject_reason"),
        tagged.filter("reject_reason is not null"),
    )


def snapshot_complete(
    pages: DataFrame,
    group: Sequence[str],
    page_no: str = "page_no",
    first_page: int = 1,
    page_size: int | None = None,
    records: str = "n_records",
    has_next: str | None = None,
    next_link: str | None = None,
    total_pages: str | None = None,
) -> DataFrame:
    """One row per ``group``: is the landed list whole?

    Whole means that the last page says so (short page, no next page, page number reached)
    and that no page before it is missing. Aggregates partially, so a group of any size is fine.
    """
    ends = F.lit(False)
    if page_size is not None:
        ends = ends | (F.col(records) < page_size)
    if has_next is not None:
        ends = ends | ~F.coalesce(F.col(has_next), F.lit(False))
    if next_link is not None:
        ends = ends | F.col(next_link).isNull()
    if total_pages is not None:
        ends = ends | (F.col(page_no) >= F.col(total_pages))
    distinct_pages = pages.groupBy(*group, page_no).agg(F.max(ends).alias("_ends"))
    return (
        distinct_pages.groupBy(*group)
        .agg(
            F.count("*").alias("pages"),
            F.min(page_no).alias("_first"),
            F.max(page_no).alias("_last"),
            F.max_by("_ends", page_no).alias("_ended"),
        )
        .select(
            *group,
            "pages",
            (
                F.col("_ended")
                & (F.col("_first") == first_page)
                & (F.col("_last") - F.col("_first") + 1 == F.col("pages"))
            ).alias("complete"),
        )
    )


def scan_filtered(df: DataFrame, *predicates: Column) -> DataFrame:
    """Source-side predicate; on landed Parquet it reaches the scan and prunes landing partitions."""
    for predicate in predicates:
        df = df.filter(predicate)
    return df
