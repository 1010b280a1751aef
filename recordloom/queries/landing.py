"""Landed pages, exports and metadata to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.queries.registry import day, nest, query, table
from recordloom.sources import (
    as_record,
    catalog_tables,
    discover_forms,
    discover_reports,
    drop_sentinels,
    parse_bulk_csv,
    read_keyed,
    read_pages,
    read_single,
    scan_filtered,
    snapshot_complete,
)


def _event_pages(spark, sf):
    """Pages per user and day. Business days come under their own key, Saturdays under ``data``,
    Sundays in a nested envelope; each user and day has an error envelope as well."""
    events = table(spark, sf, "events").withColumn("day", day("ts"))
    pages = nest(
        events,
        ["user_id", "day"],
        F.struct("event_id", "user_id", "event_type", "value", "props"),
        "rows",
    )
    weekday = F.dayofweek(F.col("day").cast("date"))
    body = (
        F.when(weekday == 1, F.to_json(F.struct(F.struct(F.col("rows").alias("result")).alias("response"))))
        .when(weekday == 7, F.to_json(F.struct(F.col("rows").alias("data"))))
        .otherwise(
            F.to_json(F.struct(F.array().cast("array<string>").alias("items"), F.col("rows").alias("events")))
        )
    )
    sentinel = F.concat(
        F.lit('[{"errorcode":7300,"message":"No records found for '), F.col("user_id").cast("string"), F.lit('"}]')
    )
    return pages.select("user_id", "day", F.explode(F.array(body, sentinel)).alias("body"))


@query("land_pages_events", "SELECT event_id, user_id, event_type, value, props FROM events")
def land_pages_events(spark, sf):
    pages = _event_pages(spark, sf).select("body")
    records = read_pages(pages, ["items", "events", "response.result"])
    data, _ = drop_sentinels(records)
    return as_record(
        data.select("record"), "event_id bigint, user_id bigint, event_type string, value double, props string"
    )


@query("land_pages_typed", "SELECT event_id, event_type, value FROM events")
def land_pages_typed(spark, sf):
    """The same pages with a declared record schema: parsed once, only the fields asked for."""
    pages = _event_pages(spark, sf).select("body")
    records = read_pages(
        pages,
        ["items", "events", "response.result"],
        schema="event_id bigint, user_id bigint, event_type string, value double",
    )
    return records.filter("record.event_id is not null").select(
        "record.event_id", "record.event_type", "record.value"
    )


@query(
    "rejected_pages",
    "SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS rejected FROM events GROUP BY user_id",
)
def rejected_pages(spark, sf):
    records = read_pages(_event_pages(spark, sf), ["items", "events", "response.result"])
    _, rejects = drop_sentinels(records)
    per_page = rejects.select("user_id", "day").distinct()
    return per_page.groupBy("user_id").agg(F.count("*").alias("rejected"))


@query(
    "snapshot_complete",
    """
    WITH pages AS (
      SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS page_no, COUNT(*) AS n
      FROM events GROUP BY ALL),
    ends AS (SELECT user_id, COUNT(*) AS pages, MIN(page_no) AS f, MAX(page_no) AS l, MAX_BY(n, page_no) AS n FROM pages GROUP BY user_id)
    SELECT user_id, pages, (n < 4 AND f = 1 AND l - f + 1 = pages) AS complete FROM ends
    """,
)
def complete_snapshots(spark, sf):
    pages = (
        table(spark, sf, "events")
        .withColumn("page_no", F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) + 1)
        .groupBy("user_id", "page_no")
        .agg(F.count("*").alias("n_records"))
    )
    return snapshot_complete(pages, ["user_id"], page_size=4)


@query(
    "read_single_orders",
    "SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS total, o_orderstatus AS status FROM orders",
)
def read_single_orders(spark, sf):
    """Detail responses in the three shapes: object under a key, list under a key, bare object."""
    o = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
    )
    body = (
        F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct(o.alias("order"))))
        .when(F.col("o_orderstatus") == "O", F.to_json(F.struct(F.array(o).alias("order"))))
        .otherwise(F.to_json(o))
    )
    pages = table(spark, sf, "orders").select(body.alias("body"))
    return as_record(
        read_single(pages, ["order"]), "id bigint, customer bigint, total double, status string"
    )


@query(
    "read_keyed_customers",
    "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_acctbal AS balance FROM customer",
)
def read_keyed_customers(spark, sf):
    """One dictionary per nation, keyed by customer, beside an entry that is no object."""
    pages = nest(
        table(spark, sf, "customer"),
        ["c_nationkey"],
        F.struct(
            F.col("c_custkey").cast("string").alias("key"),
            F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("value"),
        ),
        "entries",
    ).select(
        F.concat(
            F.lit('{"status":0,"records":{"note":"as of today",'),
            F.expr("substring(to_json(map_from_entries(entries)), 2)"),
            F.lit("}"),
        ).alias("body")
    )
    return as_record(read_keyed(pages, "records", "customer_id"), "name string, balance double")


@query(
    "bulk_csv_parts",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand,
           CAST(p_size AS VARCHAR) AS size, CASE WHEN p_size > 25 THEN p_type END AS note,
           '{not json}' AS remark
    FROM part
    """,
)
def bulk_csv_parts(spark, sf):
    """Export rows with JSON in a cell, blanks, quotes and commas."""
    spec = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")))
    note = F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("  "))
    row = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), spec.alias("spec"),
        note.alias("note"), F.lit("{not json}").alias("remark"),
    )
    lines = table(spark, sf, "part").select(
        F.to_csv(row, {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("line")
    )
    cells = parse_bulk_csv(lines, ["id", "name", "spec", "note", "remark"])
    return cells.select(
        "id",
        "name",
        F.get_json_object("spec", "$.brand").alias("brand"),
        F.get_json_object("spec", "$.size").alias("size"),
        "note",
        "remark",
    )


@query(
    "scan_since",
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS lines
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'N' GROUP BY ALL
    """,
)
def scan_since(spark, sf):
    lines = scan_filtered(
        table(spark, sf, "lineitem"),
        F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"),
        F.col("l_returnflag") == "N",
    )
    return lines.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("lines"))


def _app_metadata(spark, sf):
    """Each supplier is an application of its nation's workspace, with two forms and three reports."""
    link = F.lower(F.regexp_replace("s_name", "#", "-"))
    kinds = ("orders", "Price List")

    def field(name, kind):
        return F.struct(F.lit(name).alias("link_name"), F.lit(name.upper()).alias("display_name"), F.lit(kind).alias("type"))

    def form(name):
        fields = F.array(field("id", "1"), field("lines", "19"), field("", "1"), field("history", "SubForm"))
        return F.struct(
            F.lit(name).alias("link_name"), F.col("s_name").alias("display_name"), F.lit("form").alias("type"), fields.alias("fields")
        )

    def report(name, kind):
        return F.struct(F.lit(name).alias("link_name"), F.col("s_name").alias("display_name"), F.lit(kind).alias("type"))

    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("workspace"),
            link.alias("link_name"),
            F.col("s_name").alias("display_name"),
            F.col("s_nationkey").alias("category"),
            F.array(*[form(k) for k in kinds]).alias("forms"),
            F.array(report("All_Orders", "list"), report("Start", "Page"), report("", "list")).alias("reports"),
        )
    )


@query(
    "catalog_reports",
    """
    SELECT n_name AS workspace, lower(replace(s_name, '#', '-')) AS app_link_name, 'All_Orders' AS link_name,
           s_name AS display_name,
           'data_' || regexp_replace(lower(n_name), '[^a-z0-9]+', '_', 'g') || '__' ||
           regexp_replace(lower(s_name), '[^a-z0-9]+', '_', 'g') || '__all_orders' AS "table"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def catalog_reports(spark, sf):
    return discover_reports(_app_metadata(spark, sf))


@query(
    "catalog_subform_fields",
    """
    SELECT n_name AS workspace, lower(replace(s_name, '#', '-')) AS app_link_name, f.name AS form_link_name,
           d.name AS link_name, upper(d.name) AS display_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey,
         (VALUES ('orders'), ('Price List')) AS f(name), (VALUES ('lines'), ('history')) AS d(name)
    """,
)
def catalog_subform_fields(spark, sf):
    return catalog_tables(_app_metadata(spark, sf))["subform_fields"]


@query(
    "catalog_counts",
    """
    SELECT 'applications' AS "table", COUNT(*) AS objects FROM supplier
    UNION ALL SELECT 'forms', 2 * COUNT(*) FROM supplier
    UNION ALL SELECT 'form_fields', 6 * COUNT(*) FROM supplier
    UNION ALL SELECT 'subform_fields', 4 * COUNT(*) FROM supplier
    UNION ALL SELECT 'reports', 2 * COUNT(*) FROM supplier
    """,
)
def catalog_counts(spark, sf):
    tables = catalog_tables(_app_metadata(spark, sf))
    counted = [
        df.agg(F.count("*").alias("objects")).select(F.lit(name).alias("table"), "objects")
        for name, df in tables.items()
    ]
    out = counted[0]
    for other in counted[1:]:
        out = out.union(other)
    return out


@query(
    "catalog_forms",
    """
    SELECT c_name AS form_link_name, c_mktsegment AS display_name,
           CASE WHEN c_acctbal > 9000 THEN c_name || 'View'
                WHEN c_acctbal > 5000 THEN 'All'
                WHEN c_acctbal < 0 THEN c_mktsegment
                ELSE c_mktsegment END AS default_view,
           'form_' || regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g') AS "table"
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    """,
)
def catalog_forms(spark, sf):
    """Each customer describes a form; the skipped ones are named by the caller."""
    balance = F.col("c_acctbal")

    def view(name, flag):
        return F.struct(name.alias("view_name"), flag.alias("is_default"))

    views = F.when(
        balance <= 9000,
        F.array(
            view(F.lit(None).cast("string"), F.lit(True)),
            view(F.col("c_mktsegment"), F.lit(None).cast("boolean")),
            view(F.lit("All"), balance > 5000),
        ),
    )
    forms = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", "P_internal").otherwise(F.col("c_name")).alias("link_name"),
        F.col("c_mktsegment").alias("display_name"),
        views.alias("views"),
    )
    return discover_forms(forms, skip=["P_internal"])
