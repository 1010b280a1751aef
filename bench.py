"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Nested inputs
are landed once as Parquet before the clock starts; each job has one warm-up and ``BENCH_RUNS``
timed runs, of which the median counts. Reads end in a no-op sink, merges in a real commit.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.flatten import flatten_prefix
from recordloom.operators.incremental import trailing_window
from recordloom.operators.merge import commit, reconcile_snapshot
from recordloom.operators.shred import flatten_report, melt_custom_fields, shred_tree
from recordloom.plans.pos import ORDER_TREE
from recordloom.queries import QUERIES
from recordloom.queries.changes import LINE_KEY, LINE_SEQ
from recordloom.queries.registry import table
from recordloom.queries.shapes import ORDER_SCHEMA, order_documents, order_reports
from recordloom.spec import TableSpec
from recordloom.store import TableStore

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Queries that run as they are registered, input building included.
REGISTERED = (
    "segment_revenue", "land_pages_typed", "upsert_lineitem_latest", "latest_lineitem", "changed_parent_lines",
    "orphan_customers", "orphan_recovery", "reconcile_composite", "map_explode_daily", "scan_since",
)


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("recordloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark: SparkSession, scratch: str) -> dict:
    """Jobs over staged input."""
    landed = f"{scratch}/orders_json"
    nested = f"{scratch}/orders_nested"
    order_documents(spark, SF).write.parquet(landed)
    parsed = spark.read.parquet(landed).select(F.from_json("body", ORDER_SCHEMA).alias("o")).select("o.*")
    parsed.write.parquet(nested)
    staged = spark.read.parquet(nested)

    parts = table(spark, SF, "part").select(
        "p_partkey",
        F.to_json(
            F.struct(
                F.col("p_brand").alias("UDF_CHAR1"), F.col("p_size").alias("UDF_NUMBER1"), F.col("p_type").alias("UDF_CHAR2"),
                F.col("p_retailprice").alias("UDF_NUMBER2"), F.lit("yes").alias("UDF_BOOL1"), F.lit("2024-01-05").alias("UDF_DATE1"),
            )
        ).alias("body"),
    )
    parts.repartition(int(CPUS)).write.parquet(f"{scratch}/parts")
    melt_input = spark.read.parquet(f"{scratch}/parts").select("p_partkey", F.parse_json("body").alias("record"))

    order_reports(spark, SF).repartition(int(CPUS)).write.parquet(f"{scratch}/reports")
    reports = spark.read.parquet(f"{scratch}/reports")

    lines = table(spark, SF, "lineitem")
    spec = TableSpec("lineitem", tuple(LINE_KEY))
    store = TableStore(spark, f"{scratch}/store")
    commit(store, spec, lines, LINE_SEQ, buckets=32)
    recent = lines.filter(F.col("l_shipdate") >= F.lit("2000-12-01").cast("timestamp_ntz")).withColumn(
        "l_tax", F.col("l_tax") + 0.01
    )

    events = table(spark, SF, "events").withColumn("run_id", F.lit(1))
    event_spec = TableSpec("events", ("event_id",))
    commit(store, event_spec, events, ["run_id"], buckets=16)

    def trailing() -> None:
        delta = trailing_window(events, "ts", "2024-01-30", 7).withColumn("run_id", F.lit(2))
        commit(store, event_spec, delta, ["run_id"])

    pairs = lines.select("l_orderkey", "l_linenumber").distinct()
    now = lines.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))

    def tree(name: str, source: DataFrame):
        return lambda: read(shred_tree(source, ORDER_TREE, "restaurant_id")[name])

    return {
        "parse_orders_json": lambda: read(parsed),
        "shred_header_staged": tree("orders", staged),
        "shred_lines_staged": tree("orders_check_selection", staged),
        "shred_taxes_staged": tree("orders_check_selection_applied_tax", staged),
        "flatten_header_staged": lambda: read(flatten_prefix(staged.drop("checks"), ["server", "diningOption"])),
        "commit_recent_lines": lambda: commit(store, spec, recent, LINE_SEQ),
        "commit_trailing_window": trailing,
        "reconcile_line_keys": lambda: read(reconcile_snapshot(pairs, now, LINE_KEY)),
        "report_rows_staged": lambda: read(flatten_report(reports, ["report_id"])),
        "melt_part_x6": lambda: read(melt_custom_fields(melt_input, ["p_partkey"])),
    }


def timed(job) -> float:
    job()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    scratch = f"{tempfile.gettempdir()}/recordloom-bench-{uuid.uuid4().hex}"
    spark = session(scratch)
    seconds = {name: timed(job) for name, job in jobs(spark, scratch).items()}
    for name in REGISTERED:
        seconds[name] = timed(lambda name=name: read(QUERIES[name](spark, SF)))
    print(
        json.dumps(
            {
                "metric": "total median seconds of headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS) if CPUS.isdigit() else CPUS,
                "runs": RUNS,
                "spark": spark.version,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
