"""Arrays, maps and trees to tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import flatten_prefix, project_deep, stamp
from recordloom.operators.keys import require_key
from recordloom.operators.merge import upsert
from recordloom.operators.relate import bridge_join
from recordloom.operators.shred import (
    auto_children,
    bridge,
    carry_context,
    child_table,
    derive_dim,
    explode_dated_map,
    flatten_report,
    grandchild_bridge,
    melt_custom_fields,
    payment_junction,
    report_cells,
    report_runs,
    shape_union,
    shred_tree,
    tag_associations,
    tagged_union,
    trial_balance,
    unpivot_map2,
    variant_list,
    walk_tree,
    with_position,
)
from recordloom.plans.pos import ORDER_TREE, VOIDED_PAYMENT
from recordloom.queries.registry import cents, day, nest, query, table
from recordloom.sources import as_record
from recordloom.spec import fields_only
from recordloom.store import stage

# ---- the order document: header, checks, selections, taxes, payments --------------------------

_SELECTION = (
    "guid string, item struct<guid:string,entityType:string>, quantity double, price double, deferred boolean,"
    " appliedTaxes array<struct<guid:string,name:string,rate:double,taxRate:struct<guid:string>>>"
)
_CHECK = (
    "guid string, amount double, deleted boolean, customer struct<guid:string,name:string>,"
    f" selections array<struct<{_SELECTION}>>,"
    " payments array<struct<guid:string,amount:double,"
    "refund:struct<refundAmount:double,tipRefundAmount:double>,"
    "voidInfo:struct<voidApprover:struct<guid:string>,voidBusinessDate:int,voidDate:string>>>"
)
ORDER_SCHEMA = (
    "guid string, restaurant_id string, openedDate string, deleted boolean,"
    " server struct<guid:string,entityType:string>, diningOption struct<guid:string>,"
    f" pricingFeatures array<string>, checks array<struct<{_CHECK}>>"
)


def order_documents(spark, sf, *extra):
    """Landed order documents as JSON text; the lines of an order are the selections of its check.

    An order with very many lines comes as several documents that repeat its header, so what is
    read from the header is made distinct, or taken from ``page`` 0.
    """
    read = "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_tax l_returnflag l_linestatus".split()

    def line(x):
        line_id = F.concat_ws("-", "l_orderkey", x["l_linenumber"], x["l_partkey"], x["l_suppkey"])
        tax = F.struct(
            F.when(x["l_returnflag"] == "A", F.concat(F.lit("tax-"), line_id)).alias("guid"),
            F.lit("VAT").alias("name"),
            x["l_tax"].alias("rate"),
            F.struct(x["l_suppkey"].cast("string").alias("guid")).alias("taxRate"),
        )
        return F.struct(
            line_id.alias("guid"),
            F.struct(x["l_partkey"].cast("string").alias("guid"), F.lit("MenuItem").alias("entityType")).alias("item"),
            x["l_quantity"].alias("quantity"),
            x["l_extendedprice"].alias("price"),
            (x["l_linestatus"] == "O").alias("deferred"),
            F.array(tax).alias("appliedTaxes"),
        )

    # the lists that are grouped and shuffled hold the columns of the lines; the much wider selections are made behind the join
    lines = nest(table(spark, sf, "lineitem"), ["l_orderkey"], F.struct(*read), "lines", part_as="page")
    key = F.col("o_orderkey").cast("string")
    status = F.col("o_orderstatus")
    payment = F.struct(
        F.concat(F.lit("pay-"), key).alias("guid"),
        F.col("o_totalprice").alias("amount"),
        F.when(status == "F", F.struct(F.col("o_totalprice").alias("refundAmount"), F.lit(0.5).alias("tipRefundAmount"))).alias("refund"),
        F.when(
            status == "P",
            F.struct(
                F.struct(F.col("o_custkey").cast("string").alias("guid")).alias("voidApprover"),
                F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("voidBusinessDate"),
                day("o_orderdate").alias("voidDate"),
            ),
        ).alias("voidInfo"),
    )
    check = F.struct(
        F.concat(F.lit("chk-"), key).alias("guid"),
        F.col("o_totalprice").alias("amount"),
        (status == "F").alias("deleted"),
        F.struct(F.col("o_custkey").cast("string").alias("guid"), F.col("o_orderpriority").alias("name")).alias("customer"),
        F.transform("lines", line).alias("selections"),
        F.array(payment).alias("payments"),
    )
    order = F.struct(
        key.alias("guid"),
        F.col("o_custkey").cast("string").alias("restaurant_id"),
        day("o_orderdate").alias("openedDate"),
        (status == "F").alias("deleted"),
        F.struct(F.col("o_orderpriority").alias("guid"), F.lit("User").alias("entityType")).alias("server"),
        F.struct(status.alias("guid")).alias("diningOption"),
        F.array(F.col("o_orderpriority"), status).alias("pricingFeatures"),
        F.array(check).alias("checks"),
    )
    orders = table(spark, sf, "orders")
    # an inner join can be split on the side of the lines, where an order may be hot; orders without lines come beside it
    with_lines = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    keys = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    bare = orders.join(keys, "o_orderkey", "left_anti")
    return with_lines.unionByName(bare, allowMissingColumns=True).select(*extra, F.to_json(order).alias("body"))


def staged_orders(spark, sf, *fields, carry=()):
    """Parsed order documents with the fields at dotted paths that their tables are made of, and columns of ``order_documents`` to carry.

    Spark prunes what it parses only where a single field is read, so the schema says it.
    """
    schema = fields_only(T._parse_datatype_string(ORDER_SCHEMA), fields)
    return order_documents(spark, sf, *carry).select(*carry, F.from_json("body", schema).alias("o")).select(*carry, "o.*")


@query(
    "shred_orders_header",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS restaurant_id,
           strftime(o_orderdate, '%Y-%m-%d') AS "openedDate", o_orderstatus = 'F' AS deleted,
           o_orderpriority AS server_id, 'User' AS "server_entityType", o_orderstatus AS "diningOption_guid"
    FROM orders
    """,
)
def shred_orders_header(spark, sf):
    orders = staged_orders(spark, sf, "guid", "restaurant_id", "openedDate", "deleted", "server", "diningOption")
    return shred_tree(orders, ORDER_TREE, "restaurant_id")["orders"].select(
        "id", "restaurant_id", "openedDate", "deleted", "server_id", "server_entityType",
        "diningOption_guid",
    ).distinct()


@query(
    "shred_orders_checks",
    """
    SELECT 'chk-' || o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS orders_id, CAST(o_custkey AS VARCHAR) AS restaurant_id,
           o_totalprice AS amount, o_orderstatus = 'F' AS deleted, CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderpriority AS customer_name
    FROM orders
    """,
)
def shred_orders_checks(spark, sf):
    orders = staged_orders(spark, sf, "guid", "restaurant_id", "checks.guid", "checks.amount", "checks.deleted", "checks.customer")
    return shred_tree(orders, ORDER_TREE, "restaurant_id")["orders_check"].distinct()


@query(
    "shred_orders_lines",
    """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, 'chk-' || l_orderkey AS orders_check_id,
           CAST(o_custkey AS VARCHAR) AS restaurant_id, CAST(l_partkey AS VARCHAR) AS item_id, 'MenuItem' AS "item_entityType",
           l_quantity AS quantity, l_extendedprice AS price, l_linestatus = 'O' AS deferred
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def shred_orders_lines(spark, sf):
    fields = [f"checks.selections.{name}" for name in ("guid", "item", "quantity", "price", "deferred")]
    return shred_tree(staged_orders(spark, sf, "guid", "restaurant_id", "checks.guid", *fields), ORDER_TREE, "restaurant_id")["orders_check_selection"]


@query(
    "hash_key_taxes",
    """
    SELECT CASE WHEN l_returnflag = 'A' THEN 'tax-' || line
                ELSE 'gen-' || md5(line || '_' || l_suppkey || '_VAT_' || CASE WHEN l_tax = 0 THEN '' ELSE CAST(l_tax AS VARCHAR) END) END AS id,
           line AS orders_check_selection_id, CAST(o_custkey AS VARCHAR) AS restaurant_id,
           'VAT' AS name, l_tax AS rate, CAST(l_suppkey AS VARCHAR) AS "taxRate_id"
    FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
    """,
)
def hash_key_taxes(spark, sf):
    orders = staged_orders(spark, sf, "guid", "restaurant_id", "checks.guid", "checks.selections.guid", "checks.selections.appliedTaxes")
    return shred_tree(orders, ORDER_TREE, "restaurant_id")["orders_check_selection_applied_tax"]


@query(
    "payment_junction",
    """
    SELECT 'chk-' || o_orderkey AS orders_check_id, 'pay-' || o_orderkey AS payment_id,
           CAST(o_orderkey AS VARCHAR) AS orders_id, CAST(o_custkey AS VARCHAR) AS restaurant_id
    FROM orders
    """,
)
def payment_pairs(spark, sf):
    return payment_junction(staged_orders(spark, sf, "guid", "restaurant_id", "checks.guid", "checks.payments.guid"))[0].distinct()


@query(
    "voided_payments",
    """
    SELECT 'pay-' || o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS restaurant_id, o_totalprice AS amount,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS "refundAmount",
           CASE WHEN o_orderstatus = 'F' THEN 0.5::DOUBLE END AS refund_tip_amount,
           CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) END AS void_info_approver_guid,
           CASE WHEN o_orderstatus = 'P' THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS void_info_business_date,
           CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS void_info_date
    FROM orders
    """,
)
def voided_payments(spark, sf):
    payments = payment_junction(staged_orders(spark, sf, "guid", "restaurant_id", "checks.guid", "checks.payments"))[1]
    flat = project_deep(payments, VOIDED_PAYMENT, drop=["voidInfo"])
    flat = flatten_prefix(flat, ["refund"])
    return flat.drop("void_info_user_guid", "void_info_reason_entity_type", "void_info_reason_guid").distinct()


@query(
    "pricing_features",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS orders_id, f AS pricing_feature, CAST(o_custkey AS VARCHAR) AS restaurant_id
    FROM orders, UNNEST([o_orderpriority, o_orderstatus]) AS t(f)
    """,
)
def pricing_features(spark, sf):
    orders = staged_orders(spark, sf, "guid", "restaurant_id", "pricingFeatures")
    return bridge(orders, "guid", "pricingFeatures", "pricing_feature", a_as="orders_id", carry=["restaurant_id"])


@query(
    "segment_revenue",
    """
    WITH latest AS (
      SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status FROM orders),
    lines AS (SELECT l_orderkey, SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS revenue, COUNT(*) AS n FROM lineitem GROUP BY 1)
    SELECT c_mktsegment AS segment, status, CAST(COUNT(*) AS BIGINT) AS orders,
           CAST(SUM(n) AS BIGINT) AS lines, CAST(SUM(revenue) AS BIGINT) AS revenue_cents
    FROM latest JOIN lines ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL
    """,
)
def segment_revenue(spark, sf):
    """Flagship: documents are shredded, a second delivery closes the open orders, then the report."""
    orders, lines = _closed_orders(spark, sf)
    return _revenue(orders.join(lines, "id"), spark, sf)


def _closed_orders(spark, sf):
    """Headers after the second delivery, and figures of the lines by order. The documents are parsed once, and each side reads its own columns."""
    # what is written is not pruned by what is read of it, so it is the fields that the two tables below need
    fields = ("guid", "restaurant_id", "diningOption", "checks.guid", "checks.selections.guid", "checks.selections.price")
    documents = staged_orders(spark, sf, *fields, carry=["page"])
    staged = stage(documents.withColumn("order_id", F.col("guid")))
    tables = shred_tree(staged, ORDER_TREE, ("restaurant_id", "order_id", "page"))
    header, _ = require_key(tables["orders"], ["id"])
    # the other documents of an order repeat its header
    header = header.filter("coalesce(page, 0) = 0").select("id", "restaurant_id", F.col("diningOption_guid").alias("status"))
    second = (
        table(spark, sf, "orders")
        .filter("o_orderstatus = 'O'")
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_custkey").cast("string").alias("restaurant_id"),
            F.lit("F").alias("status"),
            F.lit(2).alias("run_id"),
        )
    )
    orders = upsert(header, second, ["id"], ["run_id"])
    lines = (
        tables["orders_check_selection"]
        .groupBy(F.col("order_id").alias("id"))
        .agg(F.sum(cents("price")).alias("revenue"), F.count("*").alias("n"))
    )
    return orders, lines


def _revenue(orders, spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("restaurant_id"), F.col("c_mktsegment").alias("segment")
    )
    return (
        orders.join(customers, "restaurant_id")
        .groupBy("segment", "status")
        .agg(
            F.count("*").alias("orders"), F.sum("n").alias("lines"), F.sum("revenue").alias("revenue_cents")
        )
    )


@query(
    "segment_revenue_all",
    """
    WITH latest AS (
      SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status FROM orders),
    lines AS (SELECT l_orderkey, SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS revenue, COUNT(*) AS n FROM lineitem GROUP BY 1)
    SELECT c_mktsegment AS segment, status, CAST(COUNT(*) AS BIGINT) AS orders,
           CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS lines, CAST(SUM(COALESCE(revenue, 0)) AS BIGINT) AS revenue_cents
    FROM latest LEFT JOIN lines ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL
    """,
)
def segment_revenue_all(spark, sf):
    """The report with the orders that have no lines."""
    orders, lines = _closed_orders(spark, sf)
    return _revenue(orders.join(lines, "id", "left").fillna(0, ["n", "revenue"]), spark, sf)


# ---- children and bridges -------------------------------------------------------------------


def _customers_with_orders(spark, sf):
    order = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("id"), F.col("o_orderpriority").alias("name")).alias("status"),
        F.col("o_totalprice").alias("total"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags"),
    )
    orders = nest(table(spark, sf, "orders"), ["o_custkey"], order, "orders")
    return (
        table(spark, sf, "customer")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"))
        .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "orders")
    )


@query(
    "child_customer_orders",
    """
    SELECT o_custkey AS customer_id, o_orderkey AS id, o_orderstatus AS status_id, o_orderpriority AS status_name, o_totalprice AS total,
           '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS tags
    FROM orders
    """,
)
def child_customer_orders(spark, sf):
    return child_table(_customers_with_orders(spark, sf), "orders", {"id": "customer_id"}, style="fk")


@query(
    "bridge_supplier_part",
    """
    SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS supplier_id, CAST(l_partkey AS VARCHAR) AS part_id FROM lineitem
    """,
)
def bridge_supplier_part(spark, sf):
    parts = nest(table(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_partkey"), "assigned_parts")
    return bridge(parts, "l_suppkey", "assigned_parts", "part_id", a_as="supplier_id")


@query(
    "bridge_fallbacks",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS service_id,
           CASE WHEN c_acctbal < 0 THEN c_mktsegment WHEN c_acctbal < 5000 THEN CAST(c_nationkey AS VARCHAR) ELSE 'home' END AS workspace_id
    FROM customer
    """,
)
def bridge_fallbacks(spark, sf):
    """The singular field, else the list, else the scope the record was read under."""
    balance = F.col("c_acctbal")
    services = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(balance < 0, F.col("c_mktsegment")).otherwise(F.when(balance < 5000, F.lit(""))).alias("assigned_workspace"),
        F.when(balance < 5000, F.array(F.lit(None), F.col("c_nationkey"))).alias("assigned_workspaces"),
        F.lit("home").alias("queried"),
    )
    return bridge(
        services, "id", "assigned_workspaces", "workspace_id",
        a_as="service_id", singular="assigned_workspace", scope="queried",
    )


@query(
    "bridge_report",
    """
    SELECT s_name AS supplier, p_brand AS brand, COUNT(*) AS parts
    FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
    GROUP BY ALL
    """,
)
def bridge_report(spark, sf):
    pairs = bridge_supplier_part(spark, sf)
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("supplier_id"), F.col("s_name").alias("supplier")
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("part_id"), F.col("p_brand").alias("brand")
    )
    joined = bridge_join(suppliers, pairs, parts, "supplier_id", "part_id")
    return joined.groupBy("supplier", "brand").agg(F.count("*").alias("parts"))


@query(
    "grandchild_bridge",
    """
    SELECT o_custkey AS "ContactID", CAST(o_orderkey AS VARCHAR) AS "LineItemID", t.c AS "TrackingCategoryID", t.o AS "TrackingOptionID", '' AS "Name"
    FROM orders, UNNEST([{'c': 'priority', 'o': o_orderpriority}, {'c': 'status', 'o': o_orderstatus}]) AS u(t)
    """,
)
def grandchild(spark, sf):
    def tracking(kind, value):
        return F.struct(F.lit(kind).alias("TrackingCategoryID"), F.col(value).alias("TrackingOptionID"))

    line = F.struct(
        F.col("o_orderkey").cast("string").alias("LineItemID"),
        F.array(tracking("priority", "o_orderpriority"), tracking("status", "o_orderstatus")).alias("Tracking"),
    )
    invoices = nest(table(spark, sf, "orders"), ["o_custkey"], line, "LineItems")
    return grandchild_bridge(
        invoices,
        "LineItems",
        "Tracking",
        {"o_custkey": "ContactID"},
        {"LineItemID": "LineItemID"},
        {n: n for n in ("TrackingCategoryID", "TrackingOptionID", "Name")},
    )


@query(
    "positions",
    """
    SELECT l_orderkey AS order_id, l_linenumber AS line, t.pos, t.kind, CAST(round(t.amount * 100) AS BIGINT) AS cents
    FROM lineitem, UNNEST([{'pos': 0, 'kind': 'price', 'amount': l_extendedprice}, {'pos': 1, 'kind': 'quantity', 'amount': l_quantity},
                           {'pos': 2, 'kind': 'tax', 'amount': l_tax}]) AS u(t)
    """,
)
def positions(spark, sf):
    def charge(kind, column):
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias("amount"))

    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.array(charge("price", "l_extendedprice"), charge("quantity", "l_quantity"), charge("tax", "l_tax")).alias("charges"),
    )
    return with_position(lines, "charges").select(
        "order_id", "line", "pos", "element.kind", cents("element.amount").alias("cents")
    )


@query(
    "positional_keys",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS "PaySlipID", CASE WHEN t.pos = 1 THEN '1' ELSE 'id-' || p_size END AS "lineID", t.pos AS pos, t.amount
    FROM part, UNNEST([{'pos': 0, 'amount': p_retailprice}, {'pos': 1, 'amount': CAST(p_size AS DOUBLE)}]) AS u(t)
    """,
)
def positional_keys(spark, sf):
    """Elements without an id are keyed by their position."""
    lines = F.array(
        F.struct(F.concat(F.lit("id-"), F.col("p_size")).alias("lineID"), F.col("p_retailprice").alias("amount")),
        F.struct(F.lit("").alias("lineID"), F.col("p_size").cast("double").alias("amount")),
    )
    slips = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("PaySlipID"), lines.alias("lines"))
    return child_table(slips, "lines", {"PaySlipID": "PaySlipID"}, style="scalars", position="pos", own_key="lineID")


def _nation_forms(spark, sf, how="inner"):
    """A nation's form; with ``how`` left the nations without suppliers too, and the number of the document."""
    suppliers = nest(
        table(spark, sf, "supplier"),
        ["s_nationkey"],
        F.struct(F.col("s_suppkey").cast("string").alias("ID"), F.col("s_name").alias("Supplier.Name")),
        "Top Suppliers",
        part_as="page",
    )
    return (
        table(spark, sf, "nation")
        .join(suppliers, F.col("n_nationkey") == F.col("s_nationkey"), how)
        .select(
            *(["page"] if how == "left" else []),
            F.col("n_nationkey").alias("ID"),
            F.col("n_name").alias("Nation Name"),
            F.col("Top Suppliers"),
            F.array(
                F.struct(F.concat(F.col("n_name"), F.lit(" east")).alias("Site"), F.lit("").alias("Remark")),
                F.struct(F.concat(F.col("n_name"), F.lit(" west")).alias("Site"), F.lit("main").alias("Remark")),
            ).alias("Sites"),
            F.array().cast("array<struct<a:int>>").alias("Empty"),
            F.array(F.col("n_nationkey"), F.col("n_regionkey")).alias("Numbers"),
        )
    )


@query(
    "auto_children_sites",
    """
    SELECT n_nationkey || '__' || t.i AS id, CAST(n_nationkey AS VARCHAR) AS parent_id, n_name || t.s AS site, NULLIF(t.r, '') AS remark
    FROM nation, (VALUES (0, ' east', ''), (1, ' west', 'main')) AS t(i, s, r) WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
    """,
)
def auto_children_sites(spark, sf):
    return auto_children(_nation_forms(spark, sf), "data_forms")["data_forms__sub_sites"].distinct()


@query(
    "auto_children_all",
    """
    SELECT n_nationkey AS id, n_name AS nation_name, COUNT(s_suppkey) AS suppliers, 2 AS sites
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL
    """,
)
def auto_children_all(spark, sf):
    """Forms of all nations, those without suppliers as well: parents with the number of rows in each sub-form."""
    tables = auto_children(_nation_forms(spark, sf, "left").filter("coalesce(page, 0) = 0").drop("page"), "data_forms")
    suppliers = auto_children(_nation_forms(spark, sf, "left").drop("page"), "data_forms")["data_forms__sub_top_suppliers"]
    parents = tables["data_forms"].select("id", "nation_name")
    for rows, name in ((suppliers, "suppliers"), (tables["data_forms__sub_sites"], "sites")):
        counted = rows.groupBy(F.col("parent_id").cast("int").alias("id")).agg(F.count("*").alias(name))
        parents = parents.join(counted, "id", "left").fillna(0, [name])
    return parents


@query(
    "auto_children_suppliers",
    "SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(s_nationkey AS VARCHAR) AS parent_id, s_name AS supplier_name FROM supplier",
)
def auto_children_suppliers(spark, sf):
    return auto_children(_nation_forms(spark, sf), "data_forms")["data_forms__sub_top_suppliers"]


@query(
    "auto_children_parent",
    """
    SELECT n_nationkey AS id, n_name AS nation_name, '[' || n_nationkey || ',' || n_regionkey || ']' AS numbers
    FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
    """,
)
def auto_children_parent(spark, sf):
    return auto_children(_nation_forms(spark, sf), "data_forms")["data_forms"].distinct()


# ---- maps -----------------------------------------------------------------------------------


@query(
    "map_explode_daily",
    """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events GROUP BY ALL
    """,
)
def map_explode_daily(spark, sf):
    """Month sheets per user: date to figures; a month has at most 31 entries."""
    daily = (
        table(spark, sf, "events")
        .groupBy("user_id", day("ts").alias("date"))
        .agg(F.count("*").alias("n"), F.sum(cents("value")).alias("cents"))
    )
    entry = F.struct(F.col("date").alias("key"), F.struct("n", "cents").alias("value"))
    sheets = daily.groupBy("user_id", F.substring("date", 1, 7).alias("month")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("days")
    )
    return explode_dated_map(sheets, "days", ["user_id"])


@query(
    "map2_unpivot",
    """
    SELECT strftime(ts, '%Y-%m-%d %H') AS hour, CAST(user_id AS VARCHAR) AS employee_id, event_type AS leave_type_id, COUNT(*) AS booked,
           CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS balance
    FROM events GROUP BY ALL
    """,
)
def map2_unpivot(spark, sf):
    """Reports per hour and user: employee to type to figures."""
    facts = (
        table(spark, sf, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "user_id", "event_type")
        .agg(F.count("*").alias("booked"), F.sum(cents("value")).alias("balance"))
    )
    value = F.create_map("event_type", F.struct("booked", "balance"))
    reports = facts.select("hour", F.create_map(F.col("user_id").cast("string"), value).alias("report"))
    return unpivot_map2(reports, "report", "employee_id", "leave_type_id", ["hour"])


# ---- several sources ------------------------------------------------------------------------


@query(
    "tagged_union_events",
    """
    SELECT user_id, CASE event_type WHEN 'click' THEN 'task' WHEN 'error' THEN 'bug' ELSE 'general' END AS component_type,
           event_id, CASE WHEN event_type = 'click' THEN value END AS hours, CASE WHEN event_type = 'error' THEN props END AS detail
    FROM events
    """,
)
def tagged_union_events(spark, sf):
    """Sibling lists of different shape in one bucket."""
    kind = F.col("event_type")
    click = F.when(kind == "click", F.struct("event_id", F.col("value").alias("hours")))
    error = F.when(kind == "error", F.struct("event_id", F.col("props").alias("detail")))
    other = F.when(~kind.isin("click", "error"), F.struct("event_id"))
    rows = nest(
        table(spark, sf, "events"),
        ["user_id"],
        F.struct(click.alias("c"), error.alias("e"), other.alias("o")),
        "rows",
    )

    def only(name):
        return F.array_compact(F.transform("rows", lambda r: r[name]))

    buckets = rows.select(
        "user_id", only("c").alias("tasklogs"), only("e").alias("buglogs"), only("o").alias("generallogs")
    )
    return tagged_union(
        buckets, {"tasklogs": "task", "buglogs": "bug", "generallogs": "general"}, "component_type", ["user_id"]
    )


@query(
    "carry_context_events",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type = 'view' THEN event_id ELSE 10 * event_id + 1 END AS id,
           CASE WHEN event_type = 'click' THEN 'outer' WHEN event_type = 'view' THEN 'outer' ELSE 'inner' END AS owner,
           user_id AS task, strftime(ts, '%Y-%m-%d') AS log_date
    FROM events
    """,
)
def carry_context_events(spark, sf):
    """Entries with inner logs, and entries that are the log themselves."""
    inner = F.struct(
        (F.col("event_id") * 10 + 1).alias("id"),
        F.when(F.col("event_type") != "click", "inner").alias("owner"),
        F.lit(None).cast("string").alias("log_date"),
    )
    entries = table(spark, sf, "events").select(
        day("ts").alias("date"),
        F.col("event_id").alias("id"),
        F.lit("outer").alias("owner"),
        F.col("user_id").alias("task"),
        F.when(F.col("event_type") != "view", F.array(inner)).alias("logs"),
    )
    return carry_context(entries, "logs", ["date"], {"log_date": "date"})


@query(
    "melt_part_fields",
    """
    WITH f AS (
      SELECT p_partkey, 'UDF_CHAR1' AS field_api_name, p_brand AS raw_value, p_brand AS value_text, NULL::DOUBLE AS value_number, NULL::VARCHAR AS value_date, NULL::BOOLEAN AS value_boolean FROM part
      UNION ALL SELECT p_partkey, 'UDF_NUMBER1', CAST(p_size AS VARCHAR), NULL, p_size, NULL, NULL FROM part
      UNION ALL SELECT p_partkey, 'UDF_NUMBER2', p_type, p_type, NULL, NULL, NULL FROM part
      UNION ALL SELECT p_partkey, 'UDF_BOOL1', CASE WHEN p_size > 25 THEN 'Yes' ELSE 'no' END, NULL, NULL, NULL, p_size > 25 FROM part
      UNION ALL SELECT p_partkey, 'UDF_DATE1', '2024-01-05', NULL, NULL, '2024-01-05', NULL FROM part
      UNION ALL SELECT p_partkey, 'UDF_MULTI1', '["a","' || p_name || '"]', '["a","' || p_name || '"]', NULL, NULL, NULL FROM part
      UNION ALL SELECT p_partkey, 'color', split_part(p_name, ' ', 1), split_part(p_name, ' ', 1), NULL, NULL, NULL FROM part),
    m(field_api_name, field_label, t) AS (VALUES ('UDF_CHAR1', 'Brand', 'text'), ('UDF_NUMBER1', 'Size', ''), ('color', 'Colour', 'pick'))
    SELECT p_partkey, field_api_name, raw_value, value_text, value_number, value_date, NULL::VARCHAR AS value_datetime, value_boolean, field_label,
           COALESCE(NULLIF(t, ''), CASE WHEN field_api_name LIKE 'UDF%' THEN lower(regexp_extract(field_api_name, 'UDF_([A-Z]+)', 1)) END) AS field_type
    FROM f LEFT JOIN m USING (field_api_name)
    """,
)
def melt_part_fields(spark, sf):
    """Custom fields in both shapes, labelled from metadata that the parts bring along."""
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("UDF_CHAR1"),
        F.col("p_size").alias("UDF_NUMBER1"),
        F.col("p_type").alias("UDF_NUMBER2"),
        F.when(F.col("p_size") > 25, "Yes").otherwise("no").alias("UDF_BOOL1"),
        F.lit("2024-01-05").alias("UDF_DATE1"),
        F.array(F.lit("a"), F.col("p_name")).alias("UDF_MULTI1"),
        F.array(
            F.struct(F.lit("color").alias("column_name"), F.substring_index("p_name", " ", 1).alias("value")),
            F.struct(F.lit("").alias("column_name"), F.lit("x").alias("value")),
        ).alias("customfields"),
    )
    part = table(spark, sf, "part")
    records = part.select("p_partkey", F.parse_json(F.to_json(record)).alias("record"))

    def described(name, label, kind):
        return F.struct(F.lit(name).alias("field_api_name"), F.lit(label).alias("field_label"), F.lit(kind).alias("field_type"))

    described_fields = F.array(
        described("UDF_CHAR1", "Brand", "text"), described("UDF_NUMBER1", "Size", ""), described("color", "Colour", "pick")
    )
    meta = part.select(F.explode(described_fields).alias("m")).select("m.*").distinct()
    return melt_custom_fields(records, ["p_partkey"], meta=meta)


@query(
    "tag_assoc",
    """
    SELECT 'portal' AS portal_id, 'task' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id, CAST(c_nationkey AS VARCHAR) AS tag_id,
           c_mktsegment AS tag_name, 'red' AS tag_color FROM customer
    UNION ALL SELECT 'portal', 'task', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL, NULL FROM customer
    UNION ALL SELECT 'portal', 'bug', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), s_name, NULL FROM supplier
    """,
)
def tag_assoc(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("portal").alias("portal_id"),
        "c_custkey",
        F.array(
            F.struct(F.col("c_nationkey").cast("string").alias("id"), F.col("c_mktsegment").alias("name"), F.lit("red").alias("color"))
        ).alias("tags"),
        F.array(F.col("c_nationkey").cast("string"), F.col("c_mktsegment"), F.lit("")).alias("tag_ids"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit("portal").alias("portal_id"),
        "s_suppkey",
        F.array(F.struct(F.col("s_nationkey").alias("tag_id"), F.col("s_name").alias("tag_name"))).alias("tags"),
    )
    return tag_associations(customers, "task", "c_custkey").union(tag_associations(suppliers, "bug", "s_suppkey"))


@query(
    "followers_shapes",
    """
    SELECT c_custkey AS task_id, CAST(c_nationkey AS VARCHAR) AS user_id, c_mktsegment AS name FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
)
def followers_shapes(spark, sf):
    """A list, the same list inside an object, or an object without one."""
    person = F.struct(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name"))
    segment = F.col("c_mktsegment")
    followers = (
        F.when(segment == "MACHINERY", F.to_json(F.array(person)))
        .when(segment == "BUILDING", F.lit('{"count":0}'))
        .when(segment == "FURNITURE", F.to_json(F.struct(F.array(person).alias("users"))))
        .otherwise(F.to_json(F.struct(F.array(person).alias("USERS"))))
    )
    tasks = table(spark, sf, "customer").select(F.col("c_custkey").alias("task_id"), F.parse_json(followers).alias("f"))
    rows = tasks.select("task_id", F.explode(variant_list(F.col("f"), ["USERS", "users", "user_list", "list"])).alias("record"))
    return as_record(rows, "id string, name string").select("task_id", F.col("id").alias("user_id"), "name")


@query(
    "owners_shapes",
    "SELECT s_suppkey AS task_id, CASE WHEN s_acctbal > 5000 THEN 'deep' ELSE 'flat' END AS owner FROM supplier",
)
def owners_shapes(spark, sf):
    tasks = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("task_id"),
        F.struct(F.when(F.col("s_acctbal") > 5000, F.array(F.lit("deep"))).alias("owners")).alias("details"),
        F.array(F.lit("flat")).alias("assignees"),
    )
    return shape_union(tasks, ["details.owners", "assignees", "owners"], "people").select("task_id", F.explode("people").alias("owner"))


@query(
    "derive_dim_event_type",
    """
    SELECT event_type, value, props FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1
    """,
)
def derive_dim_event_type(spark, sf):
    return derive_dim(table(spark, sf, "events"), "event_type", ["value", "props"], ["ts", "event_id"])


# ---- trees and reports ----------------------------------------------------------------------


@query(
    "walk_category_tree",
    """
    SELECT p_partkey AS menu_id, 0 AS depth, p_type AS name, NULL::VARCHAR AS parent FROM part
    UNION ALL SELECT p_partkey, 1, p_brand, p_type FROM part
    UNION ALL SELECT p_partkey, 2, t.n, p_brand FROM part, UNNEST(string_split(p_name, ' ')) AS t(n)
    """,
)
def walk_category_tree(spark, sf):
    """Each part brings a tree of groups: type, in it the brand, in it the words of its name."""
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name")))
    brand = F.struct(F.col("p_brand").alias("name"), words.alias("menuGroups"))
    root = F.struct(F.col("p_type").alias("name"), F.array(brand).alias("menuGroups"))
    menus = table(spark, sf, "part").select(
        F.col("p_partkey").alias("menu_id"),
        F.parse_json(F.to_json(F.struct(F.array(root).alias("menuGroups")))).alias("menu"),
    )
    roots = F.try_variant_get("menu", "$.menuGroups", "array<variant>")
    return walk_tree(menus, roots, "menuGroups", ["menu_id"]).select(
        "menu_id",
        "depth",
        F.try_variant_get("node", "$.name", "string").alias("name"),
        F.try_variant_get("parent", "$.name", "string").alias("parent"),
    )


def order_reports(spark, sf):
    """One small report per order: two sections with a row each, a nested section, and a closing row."""

    def cell(value, account=None):
        attributes = F.array(F.struct(F.lit("account").alias("Id"), account.alias("Value"))) if account is not None else None
        parts = [value.alias("Value")] + ([attributes.alias("Attributes")] if attributes is not None else [])
        return F.to_json(F.struct(*parts))

    def amount(c):
        return F.format_number(c, 2)

    price = F.col("o_totalprice")

    def row(*cells):
        return F.concat(F.lit('{"RowType":"Row","Cells":['), F.concat_ws(",", *cells), F.lit("]}"))

    def section(title, *rows):
        head = F.concat(F.lit('{"RowType":"Section","Title":'), F.to_json(F.struct(title.alias("t"))), F.lit(',"Rows":['))
        head = F.regexp_replace(head, r'\{"t":(.*)\},"Rows"', '$1,"Rows"')
        return F.concat(head, F.concat_ws(",", *rows), F.lit("]}"))

    status_row = row(cell(F.col("o_orderstatus"), F.col("o_custkey").cast("string")), cell(amount(price)), cell(F.lit("")))
    nested_row = row(cell(F.lit("nested")), cell(F.concat(F.lit("("), amount(price), F.lit(")"))))
    second = section(F.col("o_orderstatus"), row(cell(F.lit("deep"))), section(F.lit(""), nested_row))
    first = section(F.col("o_orderpriority"), status_row)
    closing = F.lit('{"RowType":"Row"}')
    rows = F.concat(F.lit("["), F.concat_ws(",", first, second, closing), F.lit("]"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("report_id"),
        F.lit("BalanceSheet").alias("report_type"),
        day("o_orderdate").alias("report_date"),
        F.parse_json(rows).alias("Rows"),
    )


@query(
    "report_rows",
    """
    SELECT o_orderkey AS report_id, t.i AS row_index,
           CASE t.i WHEN 0 THEN o_orderpriority WHEN 1 THEN o_orderstatus WHEN 2 THEN '' WHEN 6 THEN o_orderpriority ELSE o_orderstatus END AS section,
           t.k AS row_type, t.n AS n_cells
    FROM orders, (VALUES (0, 'Section', 0), (1, 'Section', 0), (2, 'Row', 0), (3, 'Row', 1), (4, 'Section', 0), (5, 'Row', 2), (6, 'Row', 3)) AS t(i, k, n)
    """,
)
def report_rows(spark, sf):
    """Level by level, later sections first: heads, the second section with its nested one, the first section."""
    rows = flatten_report(order_reports(spark, sf), ["report_id"])
    return rows.withColumn("n_cells", F.coalesce(F.size("cells"), F.lit(0))).drop("cells")


@query(
    "report_trial_balance",
    """
    SELECT o_orderkey AS report_id, t.i AS row_index,
           CASE t.i WHEN 0 THEN o_orderpriority WHEN 6 THEN o_orderpriority ELSE o_orderstatus END AS section, t.k AS row_type,
           CASE WHEN t.i = 6 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS account_id,
           CASE t.i WHEN 3 THEN 'deep' WHEN 5 THEN 'nested' WHEN 6 THEN o_orderstatus ELSE '' END AS account_name,
           CASE t.i WHEN 5 THEN -o_totalprice WHEN 6 THEN o_totalprice END AS debit,
           NULL::DOUBLE AS credit, NULL::DOUBLE AS ytd_debit, NULL::DOUBLE AS ytd_credit
    FROM orders, (VALUES (0, 'Section'), (1, 'Section'), (3, 'Row'), (4, 'Section'), (5, 'Row'), (6, 'Row')) AS t(i, k)
    """,
)
def report_trial_balance(spark, sf):
    return trial_balance(flatten_report(order_reports(spark, sf), ["report_id"]), ["report_id"])


@query(
    "report_cells",
    """
    SELECT o_orderkey AS report_id, t.r AS row_index, t.c AS cell_index, CASE t.r WHEN 6 THEN o_orderpriority ELSE o_orderstatus END AS section, 'Row' AS row_type,
           CASE WHEN t.r = 3 THEN 'deep' WHEN t.r = 5 AND t.c = 0 THEN 'nested' WHEN t.r = 5 THEN '(' || format('{:,.2f}', o_totalprice) || ')'
                WHEN t.c = 0 THEN o_orderstatus WHEN t.c = 1 THEN format('{:,.2f}', o_totalprice) ELSE '' END AS cell_value,
           CASE WHEN t.r = 6 AND t.c = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS cell_account_id
    FROM orders, (VALUES (3, 0), (5, 0), (5, 1), (6, 0), (6, 1), (6, 2)) AS t(r, c)
    """,
)
def report_cell_rows(spark, sf):
    return report_cells(flatten_report(order_reports(spark, sf), ["report_id"]), ["report_id"])


@query(
    "report_runs",
    "SELECT DISTINCT 'BalanceSheet' AS report_type, strftime(o_orderdate, '%Y-%m-%d') AS report_date FROM orders",
)
def report_headers(spark, sf):
    return report_runs(order_reports(spark, sf), ["report_type", "report_date"])


@query(
    "conversation_turns",
    "SELECT conv_id, turn, role, text, 'chat' AS source FROM conversations",
)
def conversation_turns(spark, sf):
    turns = nest(table(spark, sf, "conversations"), ["conv_id"], F.struct("turn", "role", "text"), "turns")
    landed = turns.select(F.to_json(F.struct(F.col("conv_id").alias("id"), "turns")).alias("body"))
    schema = "id bigint, turns array<struct<turn:bigint,role:string,text:string>>"
    records = landed.select(F.from_json("body", schema).alias("r")).select("r.*")
    return stamp(child_table(records, "turns", {"id": "conv_id"}), source="chat")
