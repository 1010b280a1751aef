"""Whole record kinds through the plans of their domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.plans import accounting, bookings, hr, payroll, pos, projects, psa
from recordloom.queries.registry import day, nest, query, table
from recordloom.sources import drop_failed_pages


def _invoices(spark, sf, how="inner"):
    """Orders as accounting documents: lines with their tracking, vendor dates, a contact object.

    With ``how`` left the orders without lines too, and the number of the document within its order.
    """
    tracking = F.struct(
        F.lit("flag").alias("TrackingCategoryID"), F.col("l_returnflag").alias("TrackingOptionID"),
        F.lit("Flag").alias("Name"), F.col("l_linestatus").alias("Option"),
    )
    line = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("LineItemID"),
        F.col("l_quantity").cast("string").alias("Quantity"),
        F.col("l_extendedprice").alias("LineAmount"),
        F.struct(F.col("l_partkey").alias("ItemID")).alias("Item"),
        F.array(tracking).alias("Tracking"),
    )
    lines = nest(table(spark, sf, "lineitem"), ["l_orderkey"], line, "LineItems", part_as="page")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)")
    return (
        table(spark, sf, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), how)
        .select(
            *(["page"] if how == "left" else []),
            F.col("o_orderkey").cast("string").alias("InvoiceID"),
            F.when(F.col("o_orderstatus") == "F", "VOIDED").otherwise("PAID").alias("Status"),
            F.concat(F.lit("/Date("), (micros / 1000).cast("bigint").cast("string"), F.lit("+0000)/")).alias("UpdatedDateUTC"),
            F.col("o_totalprice").cast("string").alias("Total"),
            F.struct(F.col("o_custkey").alias("ContactID"), F.lit("x").alias("Name")).alias("Contact"),
            F.lit("redundant").alias("DateString"),
            "LineItems",
        )
    )


@query(
    "accounting_invoices",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "InvoiceID", CASE WHEN o_orderstatus = 'F' THEN 'VOIDED' ELSE 'PAID' END AS "Status",
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "UpdatedDateUTC", o_totalprice AS "Total", o_custkey AS "ContactID"
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
    """,
)
def accounting_invoices(spark, sf):
    return accounting.shred("accounting_invoice", _invoices(spark, sf))["accounting_invoice"].drop("present").distinct()


@query(
    "accounting_invoices_all",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "InvoiceID", CASE WHEN o_orderstatus = 'F' THEN 'VOIDED' ELSE 'PAID' END AS "Status",
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "UpdatedDateUTC", o_totalprice AS "Total", o_custkey AS "ContactID" FROM orders
    """,
)
def accounting_invoices_all(spark, sf):
    """Invoices with and without lines, once each: the header of an order's first document."""
    first = _invoices(spark, sf, "left").filter("coalesce(page, 0) = 0").drop("page")
    return accounting.shred("accounting_invoice", first)["accounting_invoice"].drop("present")


@query(
    "accounting_invoice_lines",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS "InvoiceID", concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS "LineItemID",
           l_quantity AS "Quantity", l_extendedprice AS "LineAmount"
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def accounting_invoice_lines(spark, sf):
    return accounting.shred("accounting_invoice", _invoices(spark, sf))["accounting_invoice_line_item"].drop("present")


@query(
    "accounting_invoice_tracking",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS "InvoiceID", concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS "LineItemID",
           'flag' AS "TrackingCategoryID", l_returnflag AS "TrackingOptionID", 'Flag' AS "Name", l_linestatus AS "Option"
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def accounting_invoice_tracking(spark, sf):
    out = accounting.shred("accounting_invoice", _invoices(spark, sf))
    return out["accounting_invoice_line_item_tracking"].drop("present")


@query(
    "payslip_lines",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "paySlipID", '0' AS "earningsLineID", c_acctbal AS amount FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, CAST(c_nationkey AS DOUBLE) FROM customer
    """,
)
def payslip_lines(spark, sf):
    """Two earnings per payslip, the first without an id."""
    none = F.lit(None).cast("string")
    earnings = F.array(
        F.struct(none.alias("earningsLineID"), F.col("c_acctbal").alias("amount")),
        F.struct(F.col("c_mktsegment").alias("earningsLineID"), F.col("c_nationkey").cast("double").alias("amount")),
    )
    slips = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("paySlipID"), earnings.alias("earningsLines"))
    return payroll.shred("payroll_payslip", slips)["payroll_payslip_earning_line"].drop("present")


@query(
    "leave_days",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS leave_id, strftime(o_orderdate, '%Y-%m-%d') AS date, '1.0' AS leave_count, o_orderstatus AS start_time FROM orders
    """,
)
def leave_days(spark, sf):
    """Orders as leave records with a date-keyed map of days, one of them empty."""
    meta = F.struct(F.lit("1.0").alias("LeaveCount"), F.col("o_orderstatus").alias("StartTime"))
    days = F.map_from_arrays(F.array(day("o_orderdate"), F.lit("")), F.array(meta, meta))
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("recordId"), F.col("o_orderpriority").alias("Leavetype"), days.alias("Days")
    )
    return hr.shred_leave(records)["leave_records_days"].select("leave_id", "date", "leave_count", "start_time")


@query(
    "leave_types",
    """
    SELECT o_orderpriority AS id, o_orderstatus AS unit FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderkey AS VARCHAR)) = 1
    """,
)
def leave_types(spark, sf):
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("recordId"), F.col("o_orderpriority").alias("leaveTypeId"), F.col("o_orderstatus").alias("Unit")
    )
    return hr.shred_leave(records)["leave_types"].select("id", "unit")


@query(
    "service_workspaces",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS service_id, CASE WHEN s_acctbal > 5000 THEN 'nation-' || s_nationkey ELSE 'queried' END AS workspace_id FROM supplier
    """,
)
def service_workspaces(spark, sf):
    services = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("nation-"), "s_nationkey")).alias("assigned_workspace"),
        F.lit("queried").alias("workspace_id"),
    )
    return bookings.shred_services(services)["service_workspace_assignments"]


@query(
    "project_time_logs",
    """
    SELECT 'p' AS portal_id, CAST(event_id AS VARCHAR) AS log_id, CASE WHEN event_type = 'error' THEN 'bug' ELSE 'task' END AS component_type,
           'user ' || user_id AS task_name, value AS hours, strftime(ts, '%Y-%m-%d') AS log_date
    FROM events
    """,
)
def project_time_logs(spark, sf):
    """A bucket per event: tasks carry an inner log, bugs are the log themselves."""
    name = F.concat(F.lit("user "), "user_id").alias("task_name")
    inner = F.struct(F.col("event_id").cast("string").alias("id"), F.col("value").alias("hours"))
    task = F.struct(name, F.array(inner).alias("logs"))
    bug = F.struct(F.col("event_id").cast("string").alias("id"), F.col("value").alias("hours"), name)
    is_bug = F.col("event_type") == "error"
    buckets = table(spark, sf, "events").select(
        day("ts").alias("date"), F.when(~is_bug, F.array(task)).alias("tasklogs"), F.when(is_bug, F.array(bug)).alias("buglogs")
    )
    logs = projects.time_logs(buckets, "p")
    return logs.select("portal_id", "log_id", "component_type", "task_name", "hours", "log_date")


@query(
    "task_dependencies",
    """
    SELECT 'p' AS portal_id, CAST(o_custkey AS VARCHAR) AS project_id, CAST(o_orderkey AS VARCHAR) AS task_id,
           o_orderstatus AS depends_on_task_id, 'successor' AS direction FROM orders
    UNION ALL SELECT 'p', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority, 'predecessor' FROM orders
    """,
)
def task_dependencies(spark, sf):
    tasks = table(spark, sf, "orders").select(
        F.lit("p").alias("portal_id"),
        F.col("o_custkey").cast("string").alias("project_id"),
        F.col("o_orderkey").cast("string").alias("task_id"),
        F.struct(
            F.array(F.struct(F.col("o_orderstatus").alias("id"))).alias("successor"),
            F.array(F.struct(F.lit("").alias("id"), F.col("o_orderpriority").alias("dependent_task_id"))).alias("predecessor"),
        ).alias("dependency"),
    )
    return projects.dependencies(tasks).select("portal_id", "project_id", "task_id", "depends_on_task_id", "direction")


@query(
    "menu_items",
    """
    SELECT p_brand AS restaurant_id, CAST(p_partkey AS VARCHAR) AS id, p_type || '/' || p_partkey AS menu_group_id, p_name AS name FROM part
    """,
)
def menu_items(spark, sf):
    """A menu per part with a group inside a group that holds the item."""
    key = F.col("p_partkey").cast("string")
    item = F.struct(key.alias("guid"), F.col("p_name").alias("name"))
    inner = F.struct(F.concat_ws("/", "p_type", key).alias("guid"), F.array(item).alias("menuItems"))
    outer = F.struct(F.concat_ws("-", "p_type", key).alias("guid"), F.array(inner).alias("menuGroups"))
    menu = F.struct(F.concat(F.lit("m"), key).alias("guid"), F.array(outer).alias("menuGroups"))
    pages = table(spark, sf, "part").select(
        F.col("p_brand").alias("restaurant_id"), F.parse_json(F.to_json(F.struct(F.array(menu).alias("menus")))).alias("menu")
    )
    return pos.widen_fields(pos.shred_menus(pages)["menu_v2_menu_item"], ["name"])


@query(
    "psa_present_columns",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, 'name' || CASE WHEN c_acctbal < 0 THEN '' ELSE ',balance' END || ',nation_id' AS present FROM customer
    """,
)
def psa_present_columns(spark, sf):
    attributes = F.struct(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    nation = F.struct(F.struct(F.col("c_nationkey").cast("string").alias("id")).alias("data")).alias("nation")
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), attributes.alias("attributes"), F.struct(nation).alias("relationships")
    )
    return psa.shred("companies", records)["companies"].select("id", F.array_join("present", ",").alias("present"))


@query(
    "failed_pages",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'inner failure' WHEN 'P' THEN 'unreadable' END AS reason, COUNT(*) AS pages
    FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1
    """,
)
def failed_pages(spark, sf):
    body = (
        F.when(F.col("o_orderstatus") == "F", F.lit('{"response":{"returnvalue":{"status":"failure"},"status":"success"}}'))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("<html>"), "o_orderkey"))
        .otherwise(F.concat(F.lit('{"data":[{"id":'), "o_orderkey", F.lit("}]}")))
    )
    _, bad = drop_failed_pages(table(spark, sf, "orders").select(body.alias("body")))
    return bad.groupBy(F.col("reject_reason").alias("reason")).agg(F.count("*").alias("pages"))
