"""Keeping tables up to date at scale: exports read in parallel, pushed reads, commits by period, ledgers, frontiers, streams."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from recordloom.operators.incremental import read_by_policy, read_scopes
from recordloom.operators.relate import Reference, complete_references
from recordloom.operators.shred import node_text, walk_levels
from recordloom.operators.windows import WindowLedger, backfill, covered, islands, missing_windows
from recordloom.periods import PeriodTable
from recordloom.plans import bookings
from recordloom.queries.chronology import scratch_store
from recordloom.queries.registry import cents, nest, query, table
from recordloom.sources import land_by_day, parse_pages, read_bulk_csv, split_bulk_csv
from recordloom.sources.shape import shaped
from recordloom.spec import Policy, TableSpec
from recordloom.streaming.merge import late_rows, trailing_stream

# ---- landed files ---------------------------------------------------------------------------


def _export(spark, sf) -> str:
    """Parts as an export of several files; remarks hold quotes, separators and line ends."""
    folder = f"{scratch_store(spark).root}/export"
    remark = F.concat(F.lit('first "line", of\n\n'), F.col("p_type"), F.lit(',\n"" end'))
    cells = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))).alias("spec"),
        F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("  ")).alias("note"),
        F.when(F.col("p_size") % 3 == 0, remark).otherwise(F.col("p_type")).alias("remark"),
    )
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    cells.repartition(3, "id").write.options(**options).csv(folder, header=True)
    return folder


@query(
    "bulk_csv_files",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, CAST(p_size AS VARCHAR) AS size,
           CASE WHEN p_size > 25 THEN p_type END AS note,
           CASE WHEN p_size % 3 = 0 THEN 'first "line", of' || chr(10) || chr(10) || p_type || ',' || chr(10) || '"" end' ELSE p_type END AS remark
    FROM part
    """,
)
def bulk_csv_files(spark, sf):
    """An export written as files and read back, in as many tasks as there are splits."""
    cells = read_bulk_csv(spark, _export(spark, sf))
    return cells.select(
        "id", "name", F.get_json_object("spec", "$.brand").alias("brand"), F.get_json_object("spec", "$.size").alias("size"), "note", "remark"
    )


@query(
    "bulk_csv_rejects",
    """
    SELECT p_partkey || ',"' || p_name || chr(10) || '",x,y' AS body, 'malformed csv' AS reason FROM part WHERE p_size > 40
    """,
)
def bulk_csv_rejects(spark, sf):
    """Records with a cell too many, one of them over two lines, keep their text among the rejects."""
    folder = f"{scratch_store(spark).root}/export"
    cell = F.concat(F.lit('"'), F.col("p_name"), F.lit('\n"'))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), cell, F.lit("x"), F.when(F.col("p_size") > 40, F.lit("y")))
    parts = table(spark, sf, "part").select(line.alias("value"), "p_partkey")
    head = spark.range(1).select(F.lit("id,name,mark").alias("value"), F.lit(-1).cast("long").alias("p_partkey"))
    head.union(parts).coalesce(1).sortWithinPartitions("p_partkey").select("value").write.text(folder)
    return split_bulk_csv(spark, folder)[1].select("body", "reason")


@query(
    "corrupt_pages",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'malformed json' WHEN 'view' THEN 'other type than declared' END AS reason,
           CASE event_type WHEN 'error' THEN '{"id": ' || event_id || ', "kind"' WHEN 'view' THEN '{"id": ' || event_id || ', "amount": "x"}' END AS body,
           CASE WHEN event_type NOT IN ('error', 'view') THEN event_id END AS id
    FROM events
    """,
)
def corrupt_pages(spark, sf):
    """Pages that end in the middle, and pages with a field of another type, keep their text among the rejects."""
    number, kind = F.col("event_id").cast("string"), F.col("event_type")
    body = (
        F.when(kind == "error", F.concat(F.lit('{"id": '), number, F.lit(', "kind"')))
        .when(kind == "view", F.concat(F.lit('{"id": '), number, F.lit(', "amount": "x"}')))
        .otherwise(F.concat(F.lit('{"id": '), number, F.lit(', "amount": 1.5}')))
    )
    pages = table(spark, sf, "events").select("event_id", body.alias("body"))
    good, bad = parse_pages(pages, "id bigint, amount double")
    return bad.select("event_id", "reason", "body", F.lit(None).cast("bigint").alias("id")).unionByName(
        good.select("event_id", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("body"), "page.id")
    )


@query(
    "shaped_objects",
    "SELECT user_id, CAST(event_id AS VARCHAR) AS event, event_type AS type, CAST(round(value * 100) AS BIGINT) AS cents FROM events",
)
def shaped_objects(spark, sf):
    """Objects keyed by event: as many keys as events, so the field becomes a map and the schema stays small."""
    entry = F.struct(
        F.col("event_id").cast("string").alias("key"), F.struct(F.col("event_type").alias("type"), F.col("value").alias("value")).alias("value")
    )
    documents = nest(table(spark, sf, "events"), ["user_id"], entry, "rows")
    body = F.to_json(F.struct(F.col("user_id").alias("user"), F.map_from_entries("rows").alias("by_event")))
    records = shaped(documents.select(F.parse_json(body).alias("record")), most_keys=100)
    rows = records.select(F.col("user").cast("bigint").alias("user_id"), F.explode("by_event").alias("event", "e"))
    return rows.select("user_id", "event", "e.type", cents(F.col("e.value").cast("double")).alias("cents"))


@query(
    "walk_deep_trees",
    """
    SELECT p_partkey AS id, t.d AS depth, CASE WHEN t.d = p_size % 31 THEN 'leaf ' || p_brand ELSE 'level' END AS name,
           CASE WHEN t.d > 0 THEN 'level' END AS parent
    FROM part, LATERAL (SELECT UNNEST(range(0, p_size % 31 + 1)) AS d) AS t
    """,
)
def walk_deep_trees(spark, sf):
    """Trees of 1 to 31 levels; the children of some leaves are text instead of a list."""
    depth = F.col("p_size") % 31
    leaf = F.concat(
        F.lit('{"name":"leaf '), F.col("p_brand"), F.when(F.col("p_size") % 5 == 0, F.lit('","below":"none"}')).otherwise(F.lit('"}'))
    )
    tree = F.concat(F.lit("["), F.repeat(F.lit('{"name":"level","below":['), depth), leaf, F.repeat(F.lit("]}"), depth), F.lit("]"))
    trees = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.parse_json(tree).alias("tree"))
    nodes = walk_levels(trees, F.col("tree"), "below", ["id"])
    return nodes.select("id", "depth", node_text("name").alias("name"), node_text("name", "parent").alias("parent"))


# ---- reads by policy ------------------------------------------------------------------------


@query(
    "pushed_policies",
    """
    SELECT 'two cursors' AS policy, event_id FROM events
      WHERE CASE WHEN event_type = 'click' THEN ts + INTERVAL 1 DAY ELSE ts END >= TIMESTAMP '2024-01-15'
    UNION ALL SELECT 'text cursor', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 06:00:00' AND event_type <> 'error'
    UNION ALL SELECT 'appointments', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-19'
    UNION ALL SELECT 'window by landing', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-26'
    """,
)
def pushed_policies(spark, sf):
    """A landed table by day of landing, read by two cursors, by a text cursor, and by windows with and without a column."""
    folder = f"{scratch_store(spark).root}/events"
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "click", F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("updated_at"),
        F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("noted"),
        F.date_format("ts", "dd-MMM-yyyy HH:mm:ss").alias("start_time"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    land_by_day(events, folder, F.coalesce("updated_at", "created_at"))
    landed = spark.read.parquet(folder)
    near = replace(bookings.SPECS["appointments"], window_days=5, future_days=3)
    reads = {
        "two cursors": (landed, TableSpec("e", ("event_id",), policy=Policy.MODIFIED, cursor=("updated_at", "created_at")), {"cursor": "2024-01-15"}, None, "landed_on"),
        "text cursor": (landed, TableSpec("e", ("event_id",), policy=Policy.MODIFIED, cursor=("noted",)), {"cursor": "2024-01-20 06:00:00"}, None, "landed_on"),
        "appointments": (landed, near, {}, "2024-01-15", None),
        "window by landing": (
            landed.withColumn("day", F.col("day").cast("date")), TableSpec("e", ("event_id",), policy=Policy.WINDOW, window_days=4), {}, "2024-01-30", "day",
        ),
    }
    out = None
    for name, (rows, spec, state, as_of, landed_on) in reads.items():
        part = read_by_policy(rows, spec, state, as_of, landed_on).select(F.lit(name).alias("policy"), "event_id")
        out = part if out is None else out.union(part)
    return out


@query(
    "due_scopes",
    "SELECT event_id, event_type FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 HAVING MAX(value) >= (SELECT MAX(value) FROM events))",
)
def due_scopes(spark, sf):
    """A table partitioned by scope: only the partitions of the scopes that are due are read."""
    folder = f"{scratch_store(spark).root}/events"
    events = table(spark, sf, "events")
    events.select("event_id", "event_type").write.partitionBy("event_type").parquet(folder)
    highest = events.groupBy("event_type").agg(F.max("value").alias("top"))
    due = highest.filter(F.col("top") >= events.agg(F.max("value")).scalar()).select("event_type")
    return read_scopes(spark.read.parquet(folder), due, "event_type").select("event_id", "event_type")


# ---- commits by period ----------------------------------------------------------------------

_PLACED = TableSpec("orders", ("id",), policy=Policy.MODIFIED, cursor=("placed",), delete_flag="deleted")


def _placed_orders(spark, sf):
    """Two commits: all orders, then those from 2000 on; finished ones go, pending ones move to a later month, some lack their key."""
    orders = table(spark, sf, "orders")
    first = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("placed"), F.lit(False).alias("deleted"), F.lit(1).alias("run_id"),
    )
    placed = F.when(F.col("status") == "P", F.col("placed") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("placed"))
    second = first.filter(F.col("placed") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        F.when(F.col("id") % 97 != 0, F.col("id")).alias("id"), F.concat(F.lit("now "), "status").alias("status"), "total",
        placed.alias("placed"), (F.col("status") == "F").alias("deleted"), F.lit(2).alias("run_id"),
    )
    store = PeriodTable(spark, scratch_store(spark).root, _PLACED, F.date_format("placed", "yyyy-MM"))
    store.commit(first, ["run_id"], {"cursor": "2000-01-01"})
    store.commit(second, ["run_id"], {"cursor": "2001-08-01"})
    return store


@query(
    "period_orders",
    """
    WITH o AS (SELECT *, o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderkey % 97 <> 0 AS changed FROM orders)
    SELECT o_orderkey AS id, CASE WHEN changed THEN 'now ' || o_orderstatus ELSE o_orderstatus END AS status, o_totalprice AS total,
           strftime(CASE WHEN changed AND o_orderstatus = 'P' THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END, '%Y-%m-%d') AS placed
    FROM o WHERE NOT (changed AND o_orderstatus = 'F')
    """,
)
def period_orders(spark, sf):
    """Months of orders: a delta of one window rewrites the months it touches, before and after rows moved."""
    return _placed_orders(spark, sf).read().select("id", "status", "total", F.date_format("placed", "yyyy-MM-dd").alias("placed"))


@query(
    "commit_summaries",
    """
    SELECT 1 AS "commit", COUNT(*) AS rows, COUNT(*) AS upserts, 0 AS deletes, 0 AS rejects, '2000-01-01' AS "cursor" FROM orders
    UNION ALL
    SELECT 2, COUNT(*), COUNT(*) FILTER (WHERE o_orderkey % 97 <> 0 AND o_orderstatus <> 'F'),
           COUNT(*) FILTER (WHERE o_orderkey % 97 <> 0 AND o_orderstatus = 'F'), COUNT(*) FILTER (WHERE o_orderkey % 97 = 0), '2001-08-01'
    FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """,
)
def commit_summaries(spark, sf):
    """What each commit counted while it wrote."""
    counts = _placed_orders(spark, sf).summaries()
    return counts.select("commit", "rows", "upserts", "deletes", "rejects", F.get_json_object("state", "$.cursor").alias("cursor"))


# ---- windows that were read -----------------------------------------------------------------


@query(
    "window_gaps",
    """
    WITH w AS (SELECT user_id, ts AS low, ts + INTERVAL 12 HOUR AS high FROM events),
    r AS (SELECT *, MAX(high) OVER (PARTITION BY user_id ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM w)
    SELECT user_id, strftime(low, '%Y-%m-%d %H:%M:%S') AS low, strftime(high, '%Y-%m-%d %H:%M:%S') AS high FROM (
      SELECT user_id, COALESCE(before, TIMESTAMP '2023-12-31') AS low, low AS high FROM r WHERE before IS NULL OR before < low
      UNION ALL SELECT user_id, MAX(high), TIMESTAMP '2024-02-15' FROM w GROUP BY 1)
    """,
)
def window_gaps(spark, sf):
    """Each event stands for a window of half a day that was read for its user; what is missing from the end of 2023 to February."""
    events = table(spark, sf, "events")
    ledger = events.select("user_id", F.col("ts").alias("low"), (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("high"))
    gaps = missing_windows(ledger, "2023-12-31", "2024-02-15", ["user_id"])
    return gaps.select("user_id", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("low", "high")))


def _bounds(events) -> tuple[datetime, datetime] | None:
    """First and last time as text from Spark, whatever the driver's zone."""
    low, high = events.agg(*(F.date_format(f("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS") for f in (F.min, F.max))).first()
    return None if low is None else (datetime.fromisoformat(low), datetime.fromisoformat(high) + timedelta(microseconds=1))


@query(
    "resumed_backfill",
    """
    SELECT event_id AS id, event_type, value, ts < (SELECT MIN(ts) FROM events) + INTERVAL 20 DAY AS in_first_runs FROM events WHERE ts IS NOT NULL
    """,
)
def resumed_backfill(spark, sf):
    """A backfill that stopped after two windows, one read by hand that overlaps, and the rest: appended, then merged once."""
    store = scratch_store(spark)
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "value", "ts")
    ledger = WindowLedger(spark, f"{store.root}/backfill")
    bounds = _bounds(events)

    def fetch(low, high):
        return events.filter(covered("ts", [(F.lit(str(low)).cast("timestamp_ntz"), F.lit(str(high)).cast("timestamp_ntz"))]))

    target = PeriodTable(spark, store.root, TableSpec("events", ("id",)), F.date_format("ts", "yyyy-MM-dd"))
    if bounds is None:
        return events.drop("ts").withColumn("in_first_runs", F.lit(None).cast("boolean"))
    low, high = bounds
    backfill(ledger, fetch, low, high, days=7, most=2)
    by_hand = (low + timedelta(days=10), low + timedelta(days=20))
    ledger.append(fetch(*by_hand), *by_hand)
    first = islands(ledger.read()).select("low", "high")
    whole = cut_rows(first)
    backfill(ledger, fetch, low, high, days=7)
    target.commit(ledger.rows(), ["batch"], {"windows": "all"})
    return target.read().select("id", "event_type", "value", covered("ts", whole).alias("in_first_runs"))


def cut_rows(windows) -> list[tuple]:
    """A few windows as literals."""
    rows = windows.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("low", "high"))).collect()
    return [tuple(F.lit(v).cast("timestamp_ntz") for v in r) for r in rows]


# ---- references -----------------------------------------------------------------------------


@query(
    "recovery_chain",
    """
    WITH o AS (SELECT DISTINCT l_orderkey AS id FROM lineitem),
    c AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderkey IN (SELECT id FROM o)),
    n AS (SELECT DISTINCT c_nationkey AS id FROM customer WHERE c_acctbal >= 0 AND c_custkey IN (SELECT id FROM c)),
    r AS (SELECT DISTINCT n_regionkey AS id FROM nation WHERE n_nationkey IN (SELECT id FROM n))
    SELECT 'orders' AS target, id, true AS found, true AS converged, 4 AS rounds FROM o
    UNION ALL SELECT 'customers', c.id, c_acctbal >= 0, true, 4 FROM c JOIN customer ON c_custkey = c.id
    UNION ALL SELECT 'nations', id, true, true, 4 FROM n UNION ALL SELECT 'regions', id, true, true, 4 FROM r
    """,
)
def recovery_chain(spark, sf):
    """Lines point to orders, these to customers, nations and regions, of which none is listed; some customers cannot be found."""
    details = {
        "orders": table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id")),
        "customers": table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation_id")),
        "nations": table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("region_id")),
        "regions": table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), "r_name"),
    }
    tables = {"lines": table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"))} | {n: d.limit(0) for n, d in details.items()}
    chain = [("lines", "order_id", "orders"), ("orders", "customer_id", "customers"), ("customers", "nation_id", "nations"), ("nations", "region_id", "regions")]
    out = complete_references(tables, details, [Reference(*c) for c in chain], dict.fromkeys(details, "id"))
    parts = []
    for found, side in ((True, out.found), (False, out.not_found)):
        parts += [df.select(F.lit(t).alias("target"), F.col("id").cast("bigint").alias("id"), F.lit(found).alias("found")) for t, df in side.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows.withColumns({"converged": F.lit(out.converged), "rounds": F.lit(out.rounds)})


# ---- streams --------------------------------------------------------------------------------


@query(
    "trailing_window_stream",
    "SELECT event_id, event_type, event_id % 7 = 0 AND ts < TIMESTAMP '2024-01-06' AS late FROM events",
)
def trailing_window_stream(spark, sf):
    """Three files: most events, later ones with repeats of the first, and some that come weeks too late."""
    store = scratch_store(spark)
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    too_late = (F.col("event_id") % 7 == 0) & (F.col("ts") < F.lit("2024-01-06").cast("timestamp"))
    early = F.col("ts") < F.lit("2024-01-21").cast("timestamp")
    repeated = F.col("ts") >= F.lit("2024-01-18").cast("timestamp")
    landed = f"{store.root}/landed"
    for part in (events.filter(early & ~too_late), events.filter(repeated), events.filter(too_late)):
        part.coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    spec = TableSpec("events", ("event_id",))
    trailing_stream(stream, store, spec, "ts", 10, ["ts"], f"{store.root}/_checkpoint", buckets=4).awaitTermination()
    late = late_rows(spark.read.parquet(landed), store, spec).select("event_id", "event_type")
    return store.read("events").select("event_id", "event_type", F.lit(False).alias("late")).union(late.withColumn("late", F.lit(True)))
