"""Flattening, naming, typing, dates and amounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.functions import (
    bool_text,
    business_dates,
    is_older_than,
    join_list,
    ms_to_iso,
    parse_amount,
    parse_dmy,
    parse_slash_date,
    relative_window,
    report_date,
    window_chunks,
)
from recordloom.functions.scalars import attr_value
from recordloom.operators.flatten import (
    apply_types,
    coalesce_keys,
    drop_fields,
    explode_fk,
    explode_lookup,
    extract_path,
    flatten_address,
    flatten_file,
    flatten_jsonapi,
    flatten_name,
    flatten_prefix,
    flatten_record,
    json_rest,
    keep_raw,
    merge_collisions,
    pair_dates,
    promote,
    rename,
    split_row,
    spread,
    stamp,
    strip_nulls,
    typed_lines,
    union_columns,
)
from recordloom.queries.registry import cents, day, iso, nest, query, table
from recordloom.spec import TableSpec

# ---- objects --------------------------------------------------------------------------------


def _customers_in_nations(spark, sf):
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


@query(
    "flatten_fk_customer",
    """
    SELECT c_custkey AS id, n_nationkey AS nation_id, n_name AS nation_name, n_regionkey AS nation_region_id,
           '{"code":"' || r_name || '"}' AS nation_meta, n_name AS address_city,
           '{"lat":' || CAST(c_acctbal AS VARCHAR) || '}' AS address_geo, '{"segment":"' || c_mktsegment || '"}' AS custom_fields,
           CAST(NULL AS VARCHAR) AS tags
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def flatten_fk_customer(spark, sf):
    nation = F.struct(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")).alias("region"),
        F.struct(F.col("r_name").alias("code")).alias("meta"),
    )
    address = F.struct(F.col("n_name").alias("city"), F.struct(F.col("c_acctbal").alias("lat")).alias("geo"))
    records = _customers_in_nations(spark, sf).select(
        F.col("c_custkey").alias("id"),
        nation.alias("nation"),
        address.alias("address"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("custom_fields"),
        F.array().cast("array<string>").alias("tags"),
        F.array(F.col("c_name")).alias("contacts"),
    )
    return explode_fk(records, drop=["contacts"])


@query(
    "flatten_lookup_nation",
    """
    SELECT c_custkey AS record, CAST(n_nationkey AS VARCHAR) AS owner_id, 'Mr ' || n_name AS owner_name, n_name || '@example.com' AS owner_email,
           CAST(r_regionkey AS VARCHAR) AS region_id, r_name AS region_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def flatten_lookup_nation(spark, sf):
    owner = F.struct(
        F.col("n_nationkey").cast("string").alias("id_string"),
        F.lit("").alias("name"),
        F.lit("Mr").alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.concat("n_name", F.lit("@example.com")).alias("email"),
    )
    region = F.struct(
        F.lit("").alias("id"), F.col("r_regionkey").alias("id_string"), F.col("r_name").alias("displayName")
    )
    records = _customers_in_nations(spark, sf).select(
        F.col("c_custkey").alias("Record"), owner.alias("Owner"), region.alias("Region"),
        F.col("c_name").alias("UDF_CHAR1"),
    )
    return explode_lookup(records, "named")


@query(
    "flatten_lookup_display",
    """
    SELECT c_custkey AS key, CAST(n_nationkey AS VARCHAR) AS nation_id, n_name AS nation_display_value,
           NULLIF(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, '') AS segment, c_name AS more_name, c_acctbal AS more_balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def flatten_lookup_display(spark, sf):
    records = _customers_in_nations(spark, sf).select(
        F.col("c_custkey").alias("Key"),
        F.struct(F.col("n_nationkey").alias("id"), F.lit("").alias("displayValue"), F.col("n_name").alias("value")).alias("Nation"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("Segment"),
        F.struct(F.col("c_name").alias("Name"), F.col("c_acctbal").alias("Balance")).alias("More"),
    )
    return flatten_record(records, "display", spread=["More"])


@query(
    "flatten_jsonapi_customer",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance, '{"segment":"' || c_mktsegment || '"}' AS settings,
           CAST(NULL AS VARCHAR) AS labels, CAST(c_nationkey AS VARCHAR) AS nation_id,
           '["' || c_nationkey || '","' || c_custkey || '"]' AS tags_ids, CAST(NULL AS VARCHAR) AS manager_id
    FROM customer
    """,
)
def flatten_jsonapi_customer(spark, sf):
    def link(c):
        return F.struct(F.lit("x").alias("type"), c.cast("string").alias("id"))

    attributes = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("settings"),
        F.array().cast("array<string>").alias("labels"),
    )
    relationships = F.struct(
        F.struct(link(F.col("c_nationkey")).alias("data")).alias("nation"),
        F.struct(F.array(link(F.col("c_nationkey")), link(F.col("c_custkey"))).alias("data")).alias("tags"),
        F.struct(F.lit(None).cast("string").alias("data")).alias("manager"),
    )
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("customers").alias("type"),
        attributes.alias("attributes"), relationships.alias("relationships"),
    )
    return flatten_jsonapi(records)


@query(
    "collision_merge",
    """
    SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE p_name END AS p_name, p_type AS p_type_id, CAST(NULL AS VARCHAR) AS col
    FROM part
    """,
)
def collision_merge(spark, sf):
    """Names that differ only in case and punctuation become one column."""
    big = F.col("p_size") > 25
    records = table(spark, sf, "part").select(
        "p_partkey",
        F.when(big, "").otherwise(F.col("p_name")).alias("P.Name"),
        F.col("p_brand").alias("p_name"),
        F.when(big, F.col("p_type")).alias("P_Type.id"),
        F.col("p_type").alias("P Type (ID)"),
        F.lit(None).cast("string").alias("..."),
    )
    return merge_collisions(records)


@query(
    "union_columns_parties",
    """
    SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS suppkey FROM customer
    UNION ALL SELECT s_name, 'n' || s_nationkey, s_nationkey, NULL, s_suppkey FROM supplier
    """,
)
def union_columns_parties(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("NAME"), F.concat(F.lit("n"), "s_nationkey").alias("nation"),
        F.col("s_nationkey").alias("balance"), F.col("s_suppkey").alias("suppkey"),
    )
    return union_columns([customers, suppliers])


@query(
    "extract_paths_orders",
    """
    SELECT o_orderkey AS id, o_custkey AS "ContactID", o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS "Schedule_Start",
           CAST(o_totalprice AS BIGINT) AS "Schedule_Amount", '{"keep":"' || o_orderpriority || '"}' AS other
    FROM orders
    """,
)
def extract_paths_orders(spark, sf):
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("guid"),
        F.struct(F.col("o_custkey").alias("ContactID"), F.lit("x").alias("Name")).alias("Contact"),
        F.col("o_orderstatus").alias("status"),
        F.struct(day("o_orderdate").alias("StartDate"), F.format_string("%.0f", F.rint("o_totalprice")).alias("Amount")).alias("Schedule"),
        F.struct(F.col("o_orderpriority").alias("keep"), F.lit(1).alias("dropped")).alias("other"),
        F.array(F.lit("w")).alias("Warnings"),
    )
    flat = extract_path(records, [("Contact", "ContactID", "ContactID"), ("other", "absent", "nothing")])
    flat = typed_lines(flat, "Schedule", {"StartDate": ("Schedule_Start", "STRING"), "Amount": ("Schedule_Amount", "LONG")})
    return json_rest(rename(drop_fields(flat, ["Warnings", "other.dropped"])))


@query(
    "split_settings",
    """
    SELECT c_custkey AS "OrganisationID", c_mktsegment AS "BaseCurrency", 'settings' AS _singleton FROM customer
    """,
)
def split_settings(spark, sf):
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("OrganisationID"), F.col("c_mktsegment").alias("BaseCurrency"), "c_name"
    )
    return split_row(records, ["OrganisationID", "BaseCurrency"], "settings")[0]


@query(
    "composites_supplier",
    """
    SELECT s_suppkey AS id, 'portal-1' AS portal_id, s_name AS contact_first_name, CAST(NULL AS VARCHAR) AS contact_last_name,
           CAST(NULL AS VARCHAR) AS contact_prefix, CAST(NULL AS VARCHAR) AS contact_suffix, 'Dr ' || s_name AS contact_display_value,
           's/' || s_suppkey AS logo_url, 'logo.png' AS logo_filename, n_name AS address_city, '["a"]' AS address_lines,
           s_acctbal AS settings_balance, s_name AS general_name, '{"h":1}' AS general_hours, '{"k":"v"}' AS rest
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def composites_supplier(spark, sf):
    """Name, file, address, settings and promoted sections in one record."""
    records = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("id"),
            F.struct(
                F.lit("").alias("prefix"), F.col("s_name").alias("first_name"), F.lit("").alias("last_name"),
                F.concat(F.lit("Dr "), "s_name").alias("zc_display_value"),
            ).alias("contact"),
            F.struct(
                F.lit("").alias("url"), F.concat(F.lit("s/"), F.col("s_suppkey")).alias("filepath"), F.lit("logo.png").alias("file_name")
            ).alias("logo"),
            F.struct(F.col("n_name").alias("city"), F.array(F.lit("a")).alias("lines")).alias("address"),
            F.struct(F.col("s_acctbal").alias("balance")).alias("settings"),
            F.struct(F.col("s_name").alias("name"), F.struct(F.lit(1).alias("h")).alias("hours")).alias("general"),
            F.struct(F.lit("v").alias("k")).alias("rest"),
        )
    )
    flat = flatten_file(flatten_name(flatten_address(records), "contact"), "logo")
    return stamp(promote(spread(flat, ["settings"]), ["general"]), portal_id="portal-1")


@query(
    "flatten_prefix_cash",
    """
    SELECT o_orderkey AS id, o_custkey AS employee_id, o_orderpriority AS employee_name, o_orderstatus AS "employee_job_code",
           o_orderpriority AS "employeeNumber", o_totalprice AS "refundAmount", 1.5::DOUBLE AS refund_tip_amount, o_orderstatus AS code
    FROM orders
    """,
)
def flatten_prefix_cash(spark, sf):
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("guid"),
        F.struct(
            F.col("o_custkey").alias("guid"), F.col("o_orderpriority").alias("name"),
            F.struct(F.col("o_orderstatus").alias("code")).alias("job"), F.col("o_orderpriority").alias("employeeNumber"),
        ).alias("employee"),
        F.struct(F.col("o_totalprice").alias("refundAmount"), F.lit(1.5).cast("double").alias("tipRefundAmount")).alias("refund"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("refundDetails"),
    )
    return flatten_prefix(records, ["employee", "refund", "refundDetails"])


@query(
    "json_rest_events",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS account, 'Title; ' || event_type AS title,
           CASE WHEN value > 50 THEN 'data' ELSE '' END AS missing, user_id AS raw_user
    FROM events
    """,
)
def json_rest_events(spark, sf):
    """What stays nested becomes JSON; the record is kept as JSON beside its columns."""
    attributes = F.array(
        F.struct(F.lit("other").alias("Id"), F.lit("x").alias("Value")),
        F.struct(F.lit("account").alias("Id"), F.col("event_type").alias("Value")),
    )
    big = F.when(F.col("value") > 50, F.array(F.struct(F.lit("missing").alias("Id"), F.lit("data").alias("Value"))))
    records = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.from_json("props", "struct<k:bigint>").alias("props"),
        attributes.alias("Attributes"),
        big.alias("More"),
        F.array(F.lit("Title"), F.col("event_type")).alias("Titles"),
    )
    flat = json_rest(
        keep_raw(records, "raw", ["user_id"])
        .withColumn("account", attr_value("Attributes", "account"))
        .withColumn("missing", attr_value("More", "missing"))
        .withColumn("title", join_list("Titles"))
    )
    return flat.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "account",
        "title",
        "missing",
        F.get_json_object("raw", "$.user_id").cast("bigint").alias("raw_user"),
    )


@query(
    "strip_nulls_events",
    """
    SELECT event_id, CASE WHEN value > 50 THEN value END AS value, CASE WHEN event_type = 'click' THEN props END AS props,
           concat_ws(',', CASE WHEN value > 50 THEN 'value' END, CASE WHEN event_type = 'click' THEN 'props' END) AS present
    FROM events
    """,
)
def strip_nulls_events(spark, sf):
    records = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("value") > 50, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", F.col("props")).alias("props"),
        F.array("user_id").alias("nested"),
    )
    return strip_nulls(records, ["event_id"]).withColumn("present", F.concat_ws(",", "present"))


@query(
    "coalesce_keys_people",
    """
    SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN c_name ELSE c_mktsegment END AS employee, CAST(c_custkey AS VARCHAR) AS record_id FROM customer
    """,
)
def coalesce_keys_people(spark, sf):
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("Employee"),
        F.col("c_name").alias("employeeName"),
        F.lit(None).cast("bigint").alias("recordId"),
        F.col("c_custkey").alias("EntityId"),
    )
    named = coalesce_keys(records, ["Employee", "employeeName", "absent"], "employee")
    found = coalesce_keys(named, ["recordId", "EntityId"], "record_id", blanks=False)
    return found.select("k", "employee", "record_id")


@query(
    "apply_types_orders",
    """
    SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus = 'F' AS closed, CAST(NULL AS INTEGER) AS number, strftime(o_orderdate, '%Y-%m-%d') AS opened, o_orderpriority AS note
    FROM orders
    """,
)
def apply_types_orders(spark, sf):
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("closed"),
        F.concat(F.lit("no "), "o_orderkey").alias("number"),
        iso("o_orderdate").alias("opened"),
        F.col("o_orderpriority").alias("note"),
    )
    spec = TableSpec(
        "orders", ("id",), {"id": "LONG", "amount": "FLOAT", "closed": "BOOLEAN", "number": "INT", "opened": "UTC_DATETIME"}
    )
    return apply_types(records, spec).withColumn("opened", day("opened"))


# ---- dates and amounts ----------------------------------------------------------------------

_MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})"


@query(
    "slash_date_orders",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ordered, CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS updated
    FROM orders
    """,
)
def slash_date_orders(spark, sf):
    ms = F.expr(_MICROS.format("o_orderdate")) / 1000
    text = F.concat(F.lit("/Date("), ms.cast("bigint").cast("string"))
    records = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(text, F.lit("+1300)/")).alias("ordered"),
        F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.concat(text, F.lit(")/"))).alias("updated"),
    )
    return records.select("o_orderkey", parse_slash_date("ordered").alias("ordered"), parse_slash_date("updated").alias("updated"))


@query(
    "epoch_pair_events",
    """
    SELECT event_id, CAST((epoch_us(ts) // 1000) AS VARCHAR) AS created_long,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN (epoch_us(ts) // 1000) % 1000 = 0 THEN '' ELSE '.' || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || '000' END || '+00:00' AS created_at,
           0 AS closed_long, CAST(NULL AS VARCHAR) AS closed_at, 5 AS seen_long, 'kept' AS seen_at
    FROM events
    """,
)
def epoch_pair_events(spark, sf):
    ms = F.floor(F.expr(_MICROS.format("ts")) / 1000).cast("bigint")
    records = table(spark, sf, "events").select(
        "event_id", ms.cast("string").alias("created_long"), F.lit(0).alias("closed_long"), F.lit(5).alias("seen_long"),
        F.lit("kept").alias("seen_at"),
    )
    return pair_dates(records)


@query(
    "dmy_dates",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS shift_date, strftime(o_orderdate, '%Y-%m-%d') AS iso_date FROM orders",
)
def dmy_dates(spark, sf):
    records = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd-MMM-yyyy").alias("vendor"), day("o_orderdate").alias("iso")
    )
    return records.select("o_orderkey", parse_dmy("vendor").alias("shift_date"), parse_dmy("iso").alias("iso_date"))


@query(
    "parse_amounts",
    "SELECT c_custkey, c_acctbal AS amount, CAST(NULL AS DOUBLE) AS bad, CAST(NULL AS DOUBLE) AS empty FROM customer",
)
def parse_amounts(spark, sf):
    text = F.format_number(F.abs("c_acctbal"), 2)
    records = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.concat(F.lit(" ("), text, F.lit(")"))).otherwise(text).alias("text"), "c_name"
    )
    return records.select(
        "c_custkey", parse_amount("text").alias("amount"), parse_amount("c_name").alias("bad"), parse_amount(F.lit("")).alias("empty")
    )


def _order_spans(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))


_SPANS = "WITH s AS (SELECT o_custkey, MIN(o_orderdate) AS lo, MAX(o_orderdate) AS hi FROM orders GROUP BY 1)"


@query(
    "business_dates",
    _SPANS + """ SELECT strftime(t.d, '%Y%m%d') AS business_date, COUNT(*) AS customers, MIN(o_custkey) AS first_customer
    FROM s, UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS t(d) GROUP BY 1""",
)
def business_date_rows(spark, sf):
    """Every day of each customer's span, summed up per day."""
    days = _order_spans(spark, sf).select("o_custkey", F.explode(business_dates("lo", "hi")).alias("business_date"))
    return days.groupBy("business_date").agg(F.count("*").alias("customers"), F.min("o_custkey").alias("first_customer"))


def _chunks_sql(days: int, mode: str) -> str:
    span = "date_diff('day', CAST(lo AS DATE), CAST(hi AS DATE))"
    if mode == "stitched":
        count, start, end = f"greatest(CAST(ceil({span} / {days}.0) AS BIGINT), 1)", f"lo + to_days({days} * i)", f"least(hi, lo + to_days({days} * i + {days}))"
    elif mode == "backward":
        count, start, end = f"{span} // {days} + 1", f"greatest(lo, hi - to_days({days} * i + {days - 1}))", f"hi - to_days({days} * i)"
    else:
        count, start, end = f"{span} // {days} + 1", f"lo + to_days({days} * i)", f"least(hi, lo + to_days({days} * i + {days - 1}))"
    return (
        _SPANS + f", n AS (SELECT o_custkey, date_trunc('day', lo) AS lo, date_trunc('day', hi) AS hi, {count} AS n FROM s),"
        " x AS (SELECT o_custkey, lo, hi, CAST(t.i AS INTEGER) AS i FROM n, UNNEST(range(n)) AS t(i))"
        f" SELECT o_custkey, strftime({start}, '%Y-%m-%d') AS from_date, strftime({end}, '%Y-%m-%d') AS to_date FROM x"
    )


def _chunk_rows(spark, sf, days, mode):
    chunks = _order_spans(spark, sf).select("o_custkey", F.explode(window_chunks("lo", "hi", days, mode)).alias("w"))
    return chunks.select("o_custkey", day("w.from_date").alias("from_date"), day("w.to_date").alias("to_date"))


@query("window_chunks_365", _chunks_sql(365, "forward"))
def window_chunks_365(spark, sf):
    return _chunk_rows(spark, sf, 365, "forward")


@query("window_chunks_29", _chunks_sql(29, "forward"))
def window_chunks_29(spark, sf):
    return _chunk_rows(spark, sf, 29, "forward")


@query("window_chunks_31_back", _chunks_sql(31, "backward"))
def window_chunks_31_back(spark, sf):
    return _chunk_rows(spark, sf, 31, "backward")


@query("window_chunks_30_stitched", _chunks_sql(30, "stitched"))
def window_chunks_30_stitched(spark, sf):
    return _chunk_rows(spark, sf, 30, "stitched")


@query(
    "date_rules",
    """
    SELECT event_id, CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-22' AS in_window,
           ts < TIMESTAMP '2024-01-05 12:00:00' AS older,
           CASE WHEN event_type = 'click' THEN '2024-02-01' ELSE '2024-01-20' END AS report_date,
           event_type IN ('view', 'signup') AS flag
    FROM events
    """,
)
def date_rules(spark, sf):
    as_of = F.lit("2024-01-20 12:00:00")
    word = (
        F.when(F.col("event_type") == "view", " Yes").when(F.col("event_type") == "signup", "1").when(F.col("event_type") == "error", "2").otherwise("off")
    )
    return table(spark, sf, "events").select(
        "event_id",
        relative_window("ts", as_of, 10, 2).alias("in_window"),
        is_older_than("ts", as_of, 15).alias("older"),
        report_date(F.when(F.col("event_type") == "click", "2024-02-01").otherwise(""), as_of).alias("report_date"),
        bool_text(word).alias("flag"),
    )


@query(
    "epoch_text_orders",
    "SELECT o_custkey, strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS last_modified, CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1",
)
def epoch_text_orders(spark, sf):
    ms = F.floor(F.expr(_MICROS.format("o_orderdate")) / 1000).cast("bigint")
    return (
        table(spark, sf, "orders")
        .select("o_custkey", ms.alias("modified_long"), cents("o_totalprice").alias("c"))
        .groupBy("o_custkey")
        .agg(ms_to_iso(F.max("modified_long")).alias("last_modified"), F.sum("c").alias("cents"))
    )


@query(
    "document_profile",
    """
    SELECT doc_id, text, lang, source AS source_id, n_chars AS stats_chars, length(text) AS stats_length FROM documents
    """,
)
def document_profile(spark, sf):
    """Whole texts through landing and flattening unchanged."""
    record = F.struct(
        "doc_id", "text", "lang", F.struct(F.col("source").alias("id")).alias("source"),
        F.struct(F.col("n_chars").alias("chars"), F.length("text").cast("bigint").alias("length")).alias("stats"),
    )
    landed = table(spark, sf, "documents").select(F.to_json(record).alias("body"))
    schema = "doc_id bigint, text string, lang string, source struct<id:string>, stats struct<chars:bigint,length:bigint>"
    records = landed.select(F.from_json("body", schema).alias("r")).select("r.*")
    return explode_fk(spread(records, ["stats"]))


@query(
    "page_links",
    "SELECT page_id, url, html, CAST(NULL AS VARCHAR) AS filename FROM pages",
)
def page_links(spark, sf):
    records = table(spark, sf, "pages").select(
        "page_id", F.struct(F.col("url").alias("url"), F.lit("").alias("file_name")).alias("file"), "html"
    )
    flat = flatten_file(records, "file")
    return flat.withColumnsRenamed({"file_url": "url", "file_filename": "filename"})


@query(
    "nested_vectors",
    "SELECT vec_id, label, len(embedding) AS size FROM embeddings",
)
def nested_vectors(spark, sf):
    vectors = nest(table(spark, sf, "embeddings"), ["label"], F.struct("vec_id", "embedding"), "items")
    rows = vectors.select("label", F.explode("items").alias("i"))
    return rows.select("i.vec_id", "label", F.size("i.embedding").cast("bigint").alias("size"))
