"""References, scopes, counts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.profile import (
    cap,
    distinct_dims,
    max_value,
    ordered_read,
    report_sample,
    run_summary,
    status_distribution,
    table_counts,
)
from recordloom.operators.relate import (
    Reference,
    id_difference,
    id_union,
    multi_pass_union,
    orphan_report,
    orphans,
    recover_orphans,
    scope_filter,
    scope_override,
)
from recordloom.queries.registry import day, query, table

_LISTED = "c_acctbal >= 0"  # what the list interface shows; the others are archived


@query(
    "orphan_customers",
    "SELECT DISTINCT o_custkey AS id FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0",
)
def orphan_customers(spark, sf):
    listed = table(spark, sf, "customer").filter(_LISTED)
    return orphans(table(spark, sf, "orders"), "o_custkey", listed, "c_custkey")


def _referring_tables(spark, sf):
    customers = table(spark, sf, "customer")
    tables = {
        "orders": table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id")),
        "customers": customers.filter(_LISTED).select(
            F.col("c_custkey").alias("id"), "c_name", F.col("c_nationkey").alias("nation_id")
        ),
        # the list interface shows no nation at all
        "nations": table(spark, sf, "nation").filter(F.lit(False)).select(F.col("n_nationkey").alias("id"), "n_name"),
    }
    details = {
        "customers": customers.select(F.col("c_custkey").alias("id"), "c_name", F.col("c_nationkey").alias("nation_id")),
        "nations": table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), "n_name"),
    }
    refs = [Reference("orders", "customer_id", "customers"), Reference("customers", "nation_id", "nations")]
    return tables, details, refs, {"customers": "id", "nations": "id"}


@query(
    "orphan_report",
    """
    SELECT 'orders' AS "table", 'customer_id' AS "column", 'customers' AS target, COUNT(DISTINCT o_custkey) AS unresolved FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0
    UNION ALL SELECT 'customers', 'nation_id', 'nations', COUNT(DISTINCT c_nationkey) FROM customer WHERE c_acctbal >= 0
    """,
)
def orphan_counts(spark, sf):
    tables, _, refs, ids = _referring_tables(spark, sf)
    return orphan_report(tables, refs, ids)


@query(
    "orphan_recovery",
    """
    SELECT 'customers' AS "table", c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal < 0 AND c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'nations', n_nationkey, n_name FROM nation WHERE n_nationkey IN
      (SELECT c_nationkey FROM customer WHERE c_acctbal >= 0 OR c_custkey IN (SELECT o_custkey FROM orders))
    """,
)
def orphan_recovery(spark, sf):
    """Archived customers of orders, and in a second hop the nations that only they refer to."""
    tables, details, refs, ids = _referring_tables(spark, sf)
    found, _ = recover_orphans(tables, details, refs, ids)
    customers = found["customers"].select(F.lit("customers").alias("table"), "id", F.col("c_name").alias("name"))
    nations = found["nations"].select(F.lit("nations").alias("table"), F.col("id").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    return customers.union(nations)


@query(
    "orphan_recovery_resolved",
    "SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders)",
)
def orphan_recovery_resolved(spark, sf):
    """Ids that an earlier run resolved are not looked up again."""
    tables, details, refs, ids = _referring_tables(spark, sf)
    resolved = {"customers": table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))}
    found, _ = recover_orphans(tables, {"customers": details["customers"]}, refs, ids, resolved)
    return found["customers"].select("id")


@query(
    "scope_filter",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS scope FROM customer
    WHERE c_acctbal < 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY')
    """,
)
def scoped_customers(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("scope")
    )
    return scope_filter(customers, "scope", ["BUILDING", "MACHINERY"])


@query(
    "scope_filter_table",
    """
    SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def scoped_orders(spark, sf):
    allowed = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    return scope_filter(table(spark, sf, "orders"), "o_custkey", allowed).select("o_orderkey")


@query(
    "document_labels",
    "SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def document_labels(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "unlabelled_documents",
    "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unlabelled_documents(spark, sf):
    return orphans(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


@query(
    "multi_pass_orders",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'active' WHEN o_orderpriority = '1-URGENT' THEN 'archived' ELSE 'template' END AS pass
    FROM orders WHERE o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' OR o_orderstatus = 'P'
    """,
)
def multi_pass_orders(spark, sf):
    """Overlapping passes: the first one that shows an order names it."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    passes = {
        "active": orders.filter("o_orderstatus = 'O'"),
        "archived": orders.filter("o_orderpriority = '1-URGENT'"),
        "template": orders.filter("o_orderstatus = 'P'"),
    }
    return multi_pass_union(passes, "pass", ["o_orderkey"], ["o_orderkey"]).select("o_orderkey", "pass")


@query(
    "scope_override",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE r_name END AS name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def overridden_names(spark, sf):
    customers = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    general = customers.select("c_custkey", F.col("r_name").alias("name"))
    specific = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.col("c_name").alias("name"))
    return scope_override(general, specific, ["c_custkey"])


@query(
    "id_set_ops",
    """
    SELECT 'missing' AS kind, id FROM (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'either', id FROM (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    """,
)
def id_set_ops(spark, sf):
    orders = table(spark, sf, "orders").withColumn("id", F.col("o_custkey"))
    finished, partial = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'P'")
    missing = id_difference(finished, partial, ["id"]).select(F.lit("missing").alias("kind"), "id")
    return missing.union(id_union(finished, partial, ["id"]).select(F.lit("either").alias("kind"), "id"))


# ---- counts and reports ---------------------------------------------------------------------

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}"
        for t in ALL_TABLES
    ),
)
def counts(spark, sf):
    return table_counts({n: table(spark, sf, n) for n in ALL_TABLES})


@query(
    "run_summary",
    """
    SELECT 'orders' AS "table", CASE WHEN o_orderstatus = 'F' THEN 'delete' ELSE 'upsert' END AS op, COUNT(*) AS rows FROM orders GROUP BY 2
    UNION ALL SELECT 'lines', 'upsert', COUNT(*) FROM lineitem
    """,
)
def summary(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.lit("orders").alias("table"), F.when(F.col("o_orderstatus") == "F", "delete").otherwise("upsert").alias("op")
    )
    lines = table(spark, sf, "lineitem").select(F.lit("lines").alias("table"), F.lit("upsert").alias("op"))
    return run_summary(orders.union(lines))


@query(
    "status_distribution",
    "SELECT o_orderstatus, COUNT(*) AS rows, COUNT(*) / (SELECT COUNT(*) FROM orders)::DOUBLE AS share FROM orders GROUP BY 1",
)
def order_status(spark, sf):
    return status_distribution(table(spark, sf, "orders"), "o_orderstatus")


@query("max_cursor", "SELECT event_type, MAX(event_id) AS max_event_id FROM events GROUP BY 1")
def max_event(spark, sf):
    return max_value(table(spark, sf, "events"), "event_id", ["event_type"])


@query(
    "distinct_dims",
    "SELECT COUNT(DISTINCT user_id) AS n_user_id, COUNT(DISTINCT event_type) AS n_event_type FROM events",
)
def dims(spark, sf):
    return distinct_dims(table(spark, sf, "events"), ["user_id", "event_type"])


@query("cap_events", "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 500")
def capped_events(spark, sf):
    """The announcements rule: an entity that is capped by design."""
    return cap(table(spark, sf, "events"), 500, ["ts", "event_id"]).select("event_id", "event_type")


@query("ordered_read", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def newest_first(spark, sf):
    rows = ordered_read(table(spark, sf, "orders"), [F.col("o_orderdate").desc(), "o_orderkey"])
    return rows.select("o_orderkey", day("o_orderdate").alias("ordered"))


@query(
    "top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_orders(spark, sf):
    return report_sample(
        table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], [F.col("o_totalprice").desc(), "o_orderkey"], 20, "o_orderstatus = 'O'"
    )


@query("benchmark_items", "SELECT item_id AS id, text FROM benchmark")
def benchmark_items(spark, sf):
    """Items met once each, first seen first."""
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return multi_pass_union({"first": items, "second": items}, "pass", ["id"], ["text"]).select("id", "text")
