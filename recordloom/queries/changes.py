"""Upserts, deletes, snapshots: what a table looks like after a delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import parse_amount
from recordloom.operators.keys import composite_key, require_key
from recordloom.operators.merge import (
    active_rows,
    apply_changes,
    apply_delete_feed,
    cascade_delete,
    dedupe_run,
    drop_keys,
    latest_per_key,
    reconcile_snapshot,
    reject_log,
    route_delete_feed,
    tombstone_flag,
    tombstone_status,
    upsert,
    upsert_sparse,
)
from recordloom.plans.psa import DELETE_ROUTING
from recordloom.queries.registry import day, query, table
from recordloom.sources import snapshot_complete

LINE_KEY = composite_key("l_orderkey|l_linenumber")
LINE_SEQ = [
    "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
_LINE_ORDER = ", ".join(f"{c} DESC" for c in LINE_SEQ)
_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag"
_LATEST_LINES = (
    f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1"
)


@query("latest_lineitem", f"WITH x AS ({_LATEST_LINES}) SELECT {_LINE_COLUMNS} FROM x")
def latest_lineitem(spark, sf):
    lines = latest_per_key(table(spark, sf, "lineitem"), LINE_KEY, LINE_SEQ)
    return lines.select(*[c.strip() for c in _LINE_COLUMNS.split(",")])


@query(
    "upsert_lineitem_latest",
    f"""
    WITH base AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1),
    delta AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1)
    SELECT {_LINE_COLUMNS} FROM delta UNION ALL
    SELECT {_LINE_COLUMNS} FROM base WHERE NOT EXISTS (SELECT 1 FROM delta WHERE delta.l_orderkey = base.l_orderkey AND delta.l_linenumber = base.l_linenumber)
    """,
)
def upsert_lineitem_latest(spark, sf):
    """Lines shipped from 2000 on arrive as a delta over the lines before."""
    lines = table(spark, sf, "lineitem")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    base = latest_per_key(lines.filter(F.col("l_shipdate") < cut), LINE_KEY, LINE_SEQ)
    merged = upsert(base, lines.filter(F.col("l_shipdate") >= cut), LINE_KEY, LINE_SEQ)
    return merged.select(*[c.strip() for c in _LINE_COLUMNS.split(",")])


@query(
    "upsert_new_columns",
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority FROM orders
    """,
)
def upsert_new_columns(spark, sf):
    """A delta that brings a column the target does not have yet."""
    orders = table(spark, sf, "orders")
    target = orders.select(F.col("o_orderkey").alias("id"), F.lit("?").alias("status"))
    plain = orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("run_id"))
    wide = orders.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.lit(1).alias("run_id")
    )
    return upsert(upsert(target, plain, ["id"], ["run_id"]), wide, ["id"], ["run_id"])


@query(
    "upsert_sparse_orders",
    """
    SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'old' WHEN 'F' THEN 'second' ELSE 'first' END AS status,
           CASE o_orderstatus WHEN 'O' THEN o_totalprice ELSE -o_totalprice END AS total,
           CASE o_orderstatus WHEN 'O' THEN NULL ELSE o_orderpriority END AS note
    FROM orders
    """,
)
def upsert_sparse_orders(spark, sf):
    """Two partial deltas; a column that a row does not set keeps its stored value."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey").alias("id")
    target = orders.select(key, F.lit("old").alias("status"), F.col("o_totalprice").alias("total"))

    def delta(rows, run, status, total, note):
        none = F.lit(None)
        return rows.select(
            key,
            (F.lit(status) if status else none).cast("string").alias("status"),
            (-F.col("o_totalprice") if total else none).cast("double").alias("total"),
            (F.col("o_orderpriority") if note else none).cast("string").alias("note"),
            F.array(*[F.lit(n) for n, on in (("status", status), ("total", total), ("note", note)) if on]).alias("present"),
            F.lit(run).alias("run_id"),
        )

    first = delta(orders.filter("o_orderstatus <> 'O'"), 1, "first", True, False)
    second = delta(orders.filter("o_orderstatus = 'F'"), 2, "second", False, True)
    third = delta(orders.filter("o_orderstatus = 'P'"), 2, "", False, True)
    return upsert_sparse(target, first.union(second).union(third), ["id"], ["run_id"])


@query(
    "tombstone_flag_orders",
    "SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders WHERE o_orderstatus <> 'F'",
)
def tombstone_flag_orders(spark, sf):
    """Every order is upserted; the finished ones come again in the same run, flagged as deleted."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("s")
    )
    target = orders.filter("s = 'F'").select("id", F.lit("stale").alias("priority"))
    upserts = orders.select("id", "priority", F.lit(False).alias("deleted"), F.lit(1).alias("op_rank"))
    deletes = orders.filter("s = 'F'").select("id", "priority", F.lit(True).alias("deleted"), F.lit(2).alias("op_rank"))
    changes = tombstone_flag(upserts.union(deletes)).drop("deleted")
    return apply_changes(target, changes, ["id"], ["op_rank"])


@query(
    "tombstone_status_orders",
    """
    SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'AUTHORISED' ELSE 'VOIDED' END AS status, o_totalprice AS total FROM orders WHERE o_orderstatus = 'O'
    """,
)
def tombstone_status_orders(spark, sf):
    changes = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "O", "AUTHORISED").when(F.col("o_orderstatus") == "F", "DELETED").otherwise("VOIDED").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.lit(1).alias("run_id"),
    )
    target = changes.drop("run_id")
    return apply_changes(target, tombstone_status(changes, "status"), ["id"], ["run_id"])


@query(
    "cascade_delete_lines",
    "SELECT l_orderkey, COUNT(*) AS lines FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1",
)
def cascade_delete_lines(spark, sf):
    gone = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    left = cascade_delete(table(spark, sf, "lineitem"), gone, {"l_orderkey": "o_orderkey"})
    return left.groupBy("l_orderkey").agg(F.count("*").alias("lines"))


@query(
    "delete_feed",
    """
    SELECT 'tasks' AS "table", CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'companies', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0
    """,
)
def delete_feed(spark, sf):
    """Singular and plural types, an unknown type, and ids as text."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")

    def feed(rows, kind, key):
        return rows.select(kind.alias("item_type"), F.col(key).cast("string").alias("item_id"))

    singular = F.when(F.col("o_orderpriority") == "1-URGENT", "task").otherwise("tasks")
    routed = route_delete_feed(
        feed(orders.filter("o_orderstatus = 'F'"), singular, "o_orderkey")
        .union(feed(customers.filter("c_acctbal < 0"), F.lit("company"), "c_custkey"))
        .union(feed(orders, F.lit("unknown_type"), "o_orderkey")),
        DELETE_ROUTING,
    )
    tasks = apply_delete_feed(orders, routed, "tasks", "o_orderkey").select(
        F.lit("tasks").alias("table"), F.col("o_orderkey").cast("string").alias("id")
    )
    companies = apply_delete_feed(customers, routed, "companies", "c_custkey").select(
        F.lit("companies").alias("table"), F.col("c_custkey").cast("string").alias("id")
    )
    return tasks.union(companies)


@query(
    "reconcile_snapshot",
    "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal < 0",
)
def reconcile_customers(spark, sf):
    """Ids stored as text, read as numbers; customers with a debt are missing now."""
    customers = table(spark, sf, "customer")
    before = customers.select(F.col("c_custkey").cast("string").alias("id"))
    now = customers.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    return reconcile_snapshot(before, now, ["id"])


@query(
    "reconcile_composite",
    """
    SELECT DISTINCT l_suppkey, l_partkey FROM lineitem
    EXCEPT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
    """,
)
def reconcile_composite(spark, sf):
    pairs = table(spark, sf, "lineitem")
    now = pairs.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return reconcile_snapshot(
        pairs.select("l_suppkey", "l_partkey").distinct(), now.select("l_suppkey", "l_partkey"), ["l_suppkey", "l_partkey"]
    )


@query(
    "reconcile_scoped",
    """
    WITH c AS (SELECT c_nationkey, COUNT(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1),
    whole AS (SELECT c_nationkey FROM c WHERE n < (SELECT MAX(n) FROM c))
    SELECT c_nationkey AS nation, c_custkey AS id FROM customer
    WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING' AND c_nationkey IN (SELECT c_nationkey FROM whole)
    """,
)
def reconcile_scoped(spark, sf):
    """Only nations whose list was read to its end, and only segments that the read covers."""
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id"), "c_acctbal", F.col("c_mktsegment").alias("segment")
    )
    now = customers.filter("c_acctbal >= 0")
    page = now.groupBy("nation").agg(F.count("*").alias("n_records")).withColumn("page_no", F.lit(1))
    longest = page.agg(F.max("n_records")).scalar()
    pages = page.withColumn("has_next", F.col("n_records") >= longest)
    complete = snapshot_complete(pages, ["nation"], has_next="has_next")
    return reconcile_snapshot(
        customers, now, ["id"], scope=["nation"], complete=complete, within=F.col("segment") != "BUILDING"
    )


@query(
    "reconcile_incomplete",
    "SELECT c_custkey AS id FROM customer WHERE false",
)
def reconcile_incomplete(spark, sf):
    """A snapshot that was not read to its end deletes nothing."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    now = customers.filter("c_acctbal >= 0")
    pages = now.agg(F.count("*").alias("n_records")).withColumns({"page_no": F.lit(1), "has_next": F.lit(True)})
    complete = snapshot_complete(pages, [], has_next="has_next")
    return reconcile_snapshot(customers, now, ["id"], complete=complete)


@query(
    "drop_missing",
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0",
)
def drop_missing(spark, sf):
    customers = table(spark, sf, "customer")
    gone = reconcile_snapshot(customers, customers.filter("c_acctbal >= 0"), ["c_custkey"])
    return drop_keys(customers, gone.select(F.col("c_custkey").cast("bigint").alias("c_custkey")), ["c_custkey"]).select("c_custkey", "c_name")


@query("active_view", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def active_view(spark, sf):
    orders = table(spark, sf, "orders").withColumn("deleted", F.when(F.col("o_orderstatus") == "F", day("o_orderdate")))
    return active_rows(orders).select("o_orderkey", "o_orderstatus")


@query(
    "dedupe_run",
    """
    SELECT l_suppkey, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) = 1
    """,
)
def dedupe_suppliers(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    return dedupe_run(table(spark, sf, "lineitem"), ["l_suppkey"], order).select("l_suppkey", "l_partkey", "l_extendedprice")


@query(
    "rejects_by_reason",
    """
    SELECT 'balances' AS "table", 'missing key: nation' AS reason, COUNT(*) AS rows FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 0
    UNION ALL SELECT 'balances', 'missing key: nation, amount', COUNT(*) FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0
    UNION ALL SELECT 'balances', 'missing key: amount', COUNT(*) FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal < 0
    """,
)
def rejects_by_reason(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("nation"),
        parse_amount(F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))).alias("amount"),
        "c_name",
    )
    _, rejects = require_key(rows, ["nation", "amount"])
    return reject_log(rejects, "balances").groupBy("table", "reason").agg(F.count("*").alias("rows"))


@query(
    "reject_fields",
    """
    SELECT 'labels' AS "table", 'missing key: doc' AS reason, 'doc:bigint=null, quality:int=' || quality || ', toxic:int=' || toxic AS fields FROM labels WHERE toxic = 1
    """,
)
def reject_fields(spark, sf):
    rows = table(spark, sf, "labels").select(F.when(F.col("toxic") != 1, F.col("doc_id")).alias("doc"), "quality", "toxic")
    _, rejects = require_key(rows, ["doc"])
    return reject_log(rejects, "labels")
