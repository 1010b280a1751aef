"""Runs over time: cursors, windows, policies, and stored tables after several runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from recordloom.operators.incremental import (
    advance_cursor,
    append_only_by_id,
    changed_parents_children,
    full_refresh_due,
    initial_hold,
    offset_cursor,
    partial_run,
    read_by_policy,
    recent_snapshot,
    replace_children,
    scoped_since,
    since,
    skip_unchanged,
    state_for_version,
    stitch_windows,
    trailing_window,
    two_phase,
    window_keyed_history,
)
from recordloom.operators.merge import commit, upsert
from recordloom.queries.registry import cents, day, query, table
from recordloom.spec import Policy, TableSpec
from recordloom.store import TableStore, checkpoint_dir
from recordloom.streaming import stream_merge


def scratch_store(spark) -> TableStore:
    """A store of its own for one query run, in the folder that all executors share."""
    return TableStore(spark, f"{checkpoint_dir(spark)}/recordloom-{uuid.uuid4().hex}")


@query("cursor_inclusive", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'")
def cursor_inclusive(spark, sf):
    return since(table(spark, sf, "orders"), "o_orderdate", "2000-06-01").select("o_orderkey")


@query("cursor_exclusive", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01'")
def cursor_exclusive(spark, sf):
    return since(table(spark, sf, "orders"), "o_orderdate", "2000-06-01", inclusive=False).select("o_orderkey")


@query(
    "cursor_scoped",
    """
    WITH c AS (SELECT o_custkey, MAX(o_orderdate) AS cursor FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o_orderkey FROM orders LEFT JOIN c USING (o_custkey) WHERE cursor IS NULL OR o_orderdate >= cursor
    """,
)
def cursor_scoped(spark, sf):
    """Each customer has its own cursor: its last finished order."""
    orders = table(spark, sf, "orders")
    cursors = advance_cursor(orders.filter("o_orderstatus = 'F'"), ["o_orderdate"], by=["o_custkey"])
    cursors = cursors.withColumn("cursor", F.col("cursor").cast("timestamp_ntz"))
    return scoped_since(orders, cursors, ["o_custkey"], "o_orderdate").select("o_orderkey")


@query(
    "advance_cursor",
    """
    SELECT event_type, strftime(GREATEST(MAX(CASE WHEN value > 50 THEN ts ELSE date_trunc('day', ts) END), TIMESTAMP '2024-01-15'), '%Y-%m-%d %H:%M:%S') AS cursor
    FROM events GROUP BY 1
    """,
)
def advanced(spark, sf):
    """First known of two times per row; text that is no time never wins."""
    rows = table(spark, sf, "events").select(
        "event_type",
        F.when(F.col("value") > 50, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise("zzz").alias("updated_at"),
        day("ts").alias("created_at"),
    )
    cursor = advance_cursor(rows, ["updated_at", "created_at"], "2024-01-15", ["event_type"])
    return cursor.withColumn("cursor", F.date_format("cursor", "yyyy-MM-dd HH:mm:ss"))


@query(
    "trailing_window_events",
    """
    SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-23' THEN value * 2 ELSE value END AS value FROM events
    """,
)
def trailing_window_events(spark, sf):
    """The last seven days are read and merged again, older rows stay as they are."""
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    edited = events.withColumns({"value": F.col("value") * 2, "run_id": F.lit(2)})
    delta = trailing_window(edited, "ts", "2024-01-30", 7)
    return upsert(events, delta, ["event_id"], ["run_id"]).drop("ts")


@query(
    "append_only_events",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END AS id FROM events
    WHERE event_type = 'error' OR event_id > (SELECT MAX(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15')
    """,
)
def append_only_events(spark, sf):
    events = table(spark, sf, "events")
    seen = events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).agg(F.max("event_id")).first()[0]
    ids = events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "event_id")).otherwise(F.col("event_id").cast("string")).alias("id")
    )
    return append_only_by_id(ids, "id", seen)


@query(
    "changed_parent_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderdate >= TIMESTAMP '2001-01-01' OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
    """,
)
def changed_parent_lines(spark, sf):
    """Lines of the orders changed since the cursor, and of those left pending by an earlier run."""
    orders = table(spark, sf, "orders")
    changed = since(orders, "o_orderdate", "2001-01-01").select("o_orderkey")
    pending = orders.filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'").select("o_orderkey")
    lines = changed_parents_children(table(spark, sf, "lineitem"), "l_orderkey", changed, pending)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "replace_children",
    """
    SELECT l_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS version, COUNT(*) AS lines
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' OR l_returnflag = 'N' GROUP BY ALL
    """,
)
def replaced_children(spark, sf):
    """The lines of finished orders are delivered anew and replace all their former lines."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    finished = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    delivered = changed_parents_children(lines.filter("l_returnflag = 'N'"), "l_orderkey", finished)
    merged = replace_children(
        lines.withColumn("version", F.lit("old")), delivered.withColumn("version", F.lit("new")), "l_orderkey", finished
    )
    return merged.groupBy("l_orderkey", "version").agg(F.count("*").alias("lines"))


@query(
    "skip_unchanged",
    "SELECT l_orderkey, COUNT(*) AS lines FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate > TIMESTAMP '2000-01-01' GROUP BY 1",
)
def unchanged_skipped(spark, sf):
    lines = skip_unchanged(
        table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "orders"), "o_orderkey", "o_orderdate", "2000-01-01"
    )
    return lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"))


@query("recent_snapshot", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00'")
def recent_events(spark, sf):
    return recent_snapshot(table(spark, sf, "events"), "ts", "2024-01-30 12:00:00", 1440).select("event_id")


@query("offset_resume", "SELECT event_id FROM events WHERE event_id > (SELECT MAX(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def offset_resume(spark, sf):
    events = table(spark, sf, "events")
    offset = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).agg(F.max("event_id")).first()[0]
    return offset_cursor(events, "event_id", offset).select("event_id")


@query(
    "refresh_due",
    """
    SELECT o_orderkey, o_orderstatus = 'P' OR date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') >= 7 AS due,
           o_orderstatus = 'P' OR epoch_us(TIMESTAMP '2001-08-01') - epoch_us(o_orderdate) > 604800000000 AS due_exact
    FROM orders
    """,
)
def refresh_due(spark, sf):
    last = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    as_of = F.lit("2001-08-01")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        full_refresh_due(last, as_of).alias("due"),
        full_refresh_due(last, as_of, whole_days=False).alias("due_exact"),
    )


@query(
    "two_phase",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '1997-01-01' THEN 1 WHEN o_orderdate <= TIMESTAMP '1999-01-01' THEN 2
                            WHEN o_orderdate <= TIMESTAMP '2001-01-01' THEN 3 ELSE 4 END AS run
    FROM orders
    """,
)
def two_phases(spark, sf):
    """Three bounded backfill runs and a steady one read every order exactly once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    cursor, done, parts = None, False, []
    for run, limit in enumerate(["1997-01-01", "1999-01-01", "2001-01-01", None], start=1):
        rows, done = two_phase(orders, "o_orderdate", cursor, done, limit)
        parts.append(rows.withColumn("run", F.lit(run)))
        cursor = limit
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.drop("o_orderdate")


@query(
    "window_history",
    """
    SELECT user_id, from_date, to_date, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS booked
    FROM events, (VALUES ('2024-01-01', '2024-01-14'), ('2024-01-08', '2024-01-21')) AS w(from_date, to_date)
    WHERE CAST(ts AS DATE) BETWEEN CAST(from_date AS DATE) AND CAST(to_date AS DATE) GROUP BY ALL
    """,
)
def window_history(spark, sf):
    """Balances of two overlapping windows side by side; reading a window again replaces only its own."""
    events = table(spark, sf, "events")
    key = ["user_id", "from_date", "to_date"]

    def balances(low, high, factor):
        rows = events.filter(F.col("ts").cast("date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
        sums = rows.groupBy("user_id").agg(F.sum(cents("value") * factor).alias("booked"))
        return window_keyed_history(sums, low, high)

    first = balances("2024-01-01", "2024-01-14", 2)
    with_second = upsert(first, balances("2024-01-08", "2024-01-21", 1), key)
    return upsert(with_second, balances("2024-01-01", "2024-01-14", 1), key)


@query(
    "read_by_policy",
    """
    SELECT 'window' AS policy, COUNT(*) AS rows FROM events WHERE ts >= TIMESTAMP '2024-01-20'
    UNION ALL SELECT 'modified', COUNT(*) FROM events WHERE ts >= TIMESTAMP '2024-01-10'
    UNION ALL SELECT 'max_id', COUNT(*) FROM events WHERE event_id > 1000
    UNION ALL SELECT 'full', COUNT(*) FROM events
    """,
)
def policies(spark, sf):
    events = table(spark, sf, "events")
    runs = {
        "window": (TableSpec("e", ("event_id",), policy=Policy.WINDOW, cursor=("ts",), window_days=10), {}),
        "modified": (TableSpec("e", ("event_id",), policy=Policy.MODIFIED, cursor=("ts",)), {"cursor": "2024-01-10"}),
        "max_id": (TableSpec("e", ("event_id",), policy=Policy.MAX_ID, cursor=("event_id",)), {"max_id": 1000}),
        "full": (TableSpec("e", ("event_id",)), {"cursor": "2024-01-10"}),
    }
    out = None
    for name, (spec, state) in runs.items():
        n = read_by_policy(events, spec, state, "2024-01-30").agg(F.count("*").alias("rows"))
        n = n.select(F.lit(name).alias("policy"), "rows")
        out = n if out is None else out.union(n)
    return out


# ---- stored tables --------------------------------------------------------------------------

_ORDERS = TableSpec("orders", ("id",), policy=Policy.MODIFIED, cursor=("modified",), delete_flag="deleted")


def _order_changes(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("modified"),
        F.lit(False).alias("deleted"),
        F.lit(1).alias("run_id"),
    )


@query(
    "stitched_backfill",
    "SELECT event_id AS id, event_type, value FROM events",
)
def stitched_backfill(spark, sf):
    """Backfill in ten-day windows that share their boundaries, committed one by one."""
    store = scratch_store(spark)
    spec = TableSpec("events", ("id",))
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "value", "ts")

    def run(rows, high):
        commit(store, spec, rows.withColumn("run_id", F.lit(str(high))), ["run_id"], {"to_ts": str(high)}, buckets=8)

    # as text from Spark, whatever the driver's time zone
    first, last = events.agg(*(F.date_format(f("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS") for f in (F.min, F.max))).first()
    if first is not None:
        stitch_windows(events, "ts", datetime.fromisoformat(first), datetime.fromisoformat(last), run, days=10)
    # rows in no window come last and move no cursor
    commit(store, spec, events.filter("ts is null").withColumn("run_id", F.lit("")), ["run_id"], buckets=8)
    return store.read("events").drop("ts")


@query(
    "committed_rejects",
    """
    SELECT 'orders' AS "table", 'missing key: id' AS reason,
           'id:bigint=null, number:bigint=' || o_orderkey || ', status:string=' || o_orderstatus || ', run_id:int=' || (1 + o_orderkey % 2) AS fields
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def committed_rejects(spark, sf):
    """Two runs with orders that lack their key: the table's rejects are those of both."""
    store = scratch_store(spark)
    number = F.col("o_orderkey").cast("long")
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "F", number).alias("id"), number.alias("number"), F.col("o_orderstatus").alias("status")
    )
    for run_id in (1, 2):
        commit(store, TableSpec("orders", ("id",)), rows.filter(1 + F.col("number") % 2 == run_id).withColumn("run_id", F.lit(run_id)), ["run_id"], buckets=8)
    return store.rejects("orders")


@query(
    "incremental_orders",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'changed' ELSE o_orderstatus END AS status, o_totalprice AS total
    FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'F')
    """,
)
def incremental_orders(spark, sf):
    """Full load, then a delta from the cursor on with changes and deletes; only touched buckets are rewritten."""
    store = scratch_store(spark)
    first = _order_changes(spark, sf)
    commit(store, _ORDERS, first, ["run_id"], {"cursor": "2000-01-01"}, buckets=8)
    delta = read_by_policy(first, _ORDERS, store.state("orders")).withColumns(
        {"deleted": F.col("status") == "F", "status": F.lit("changed"), "run_id": F.lit(2)}
    )
    commit(store, _ORDERS, delta, ["run_id"], {"cursor": "2001-08-01"})
    return store.read("orders").select("id", "status", "total")


@query(
    "initial_hold",
    "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders",
)
def held_cursor(spark, sf):
    """The first load stops half way and keeps no cursor, so the next run reads everything."""
    store = scratch_store(spark)
    changes = _order_changes(spark, sf)
    half = changes.filter("status = 'F'")
    held = initial_hold(None, "2001-08-01", complete=False)
    commit(store, _ORDERS, half, ["run_id"], {"cursor": held}, buckets=8)
    rest = read_by_policy(changes, _ORDERS, store.state("orders")).withColumn("run_id", F.lit(2))
    commit(store, _ORDERS, rest, ["run_id"], {"cursor": initial_hold(held, "2001-08-01", complete=True)})
    return store.read("orders").select("id", "status")


@query(
    "version_reset",
    "SELECT o_orderkey AS id, o_totalprice AS total FROM orders",
)
def version_reset(spark, sf):
    """State written by another version of the job is dropped, which makes the next run a full one."""
    store = scratch_store(spark)
    changes = _order_changes(spark, sf)
    commit(store, _ORDERS, changes.filter("status = 'O'"), ["run_id"], {"cursor": "2001-08-01", "version": "1"}, buckets=8)
    state = state_for_version(store.state("orders"), "2")
    rows = read_by_policy(changes, _ORDERS, state).withColumn("run_id", F.lit(2))
    commit(store, _ORDERS, rows, ["run_id"], state)
    return store.read("orders").select("id", "total")


@query(
    "partial_run",
    """
    SELECT 'orders' AS "table", COUNT(*) AS rows FROM orders UNION ALL SELECT 'customers', COUNT(*) FROM customer
    """,
)
def partial(spark, sf):
    """One of three tables fails; the others are committed."""
    store = scratch_store(spark)

    def failing():
        raise ValueError("page could not be read")

    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name", F.lit(1).alias("run_id"))
    partial_run(
        {
            "orders": lambda: commit(store, _ORDERS, _order_changes(spark, sf), ["run_id"], buckets=8),
            "contacts": failing,
            "customers": lambda: commit(store, TableSpec("customers", ("id",)), customers, ["run_id"], buckets=8),
        }
    )
    stored = [n for n in ("orders", "contacts", "customers") if store.exists(n)]
    counts = [store.read(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n in stored]
    return counts[0].union(counts[1])


@query("stream_merge_events", "SELECT event_id AS id, event_type, value FROM events")
def stream_merge_events(spark, sf):
    """The event file as a stream, merged until everything that has landed is in the table."""
    store = scratch_store(spark)
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    changes = stream.select(F.col("event_id").alias("id"), "event_type", "value", F.col("ts").alias("run_id"))
    query_ = stream_merge(
        changes, store, TableSpec("events", ("id",)), ["run_id"], f"{store.root}/_checkpoint", buckets=8
    )
    query_.awaitTermination()
    return store.read("events").select("id", "event_type", "value")
