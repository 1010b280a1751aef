"""Cursors, windows, policies, runs; streaming equals batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.operators import incremental as I
from recordloom.operators.merge import commit
from recordloom.spec import Policy, TableSpec
from recordloom.store import TableStore
from recordloom.streaming import stream_merge, window_dedupe


@pytest.fixture
def log(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), f"v{i}") for i in range(100)]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, v string")


def test_since_boundary(log):
    assert I.since(log, "ts", "2024-01-11").count() == 90
    assert I.since(log, "ts", "2024-01-11", inclusive=False).count() == 89
    assert I.since(log, "ts", None).count() == 100


def test_since_reaches_the_scan(spark, tmp_path, log):
    log.write.parquet(str(tmp_path / "p"))
    plan = I.since(spark.read.parquet(str(tmp_path / "p")), "ts", dt.datetime(2024, 1, 11))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_cursor_never_goes_back(spark):
    df = spark.createDataFrame([("a", "2024-01-02T00:00:00Z", None), ("b", "nonsense", "2024-01-03")], "id string, u string, c string")
    assert I.advance_cursor(df, ["u", "c"]).first()["cursor"] == dt.datetime(2024, 1, 3)
    assert I.advance_cursor(df, ["u", "c"], "2025-01-01").first()["cursor"] == dt.datetime(2025, 1, 1)


def test_initial_hold():
    assert I.initial_hold(None, "5", complete=False) is None
    assert I.initial_hold(None, "5", complete=True) == "5"
    assert I.initial_hold("7", "5", complete=False) == "7"


def test_two_phase_reads_everything_once(log):
    seen, cursor, done = [], None, False
    for limit in ("2024-01-31", "2024-02-29", None, None):
        rows, done = I.two_phase(log, "ts", cursor, done, limit)
        seen += [r["id"] for r in rows.collect()]
        cursor = limit or "2024-04-09"
    assert sorted(seen) == list(range(100)) and done


def test_trailing_window(log):
    assert I.trailing_window(log, "ts", "2024-02-10", 10).count() == 70
    assert I.trailing_window(log, "ts", "2024-02-10", 10, 5).count() == 16


def test_append_only(spark, rows_of):
    df = spark.createDataFrame([("5",), ("12",), ("abc",)], "id string")
    assert rows_of(I.append_only_by_id(df, "id", 9)) == [("12",), ("abc",)]
    assert I.append_only_by_id(df, "id", None).count() == 3


def test_refresh_due(spark):
    df = spark.createDataFrame(
        [(None, "2024-01-08 00:00:00"), ("2024-01-01 00:00:00", "2024-01-08 00:00:00"), ("2024-01-01 00:00:01", "2024-01-08 00:00:00")],
        "last string, now string",
    )
    assert [r[0] for r in df.select(I.full_refresh_due("last", "now")).collect()] == [True, True, False]
    assert [r[0] for r in df.select(I.full_refresh_due("last", "now", whole_days=False)).collect()] == [True, False, False]


def test_children_of_changed_and_pending(spark, rows_of):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "order_id int, v string")
    changed = spark.createDataFrame([(1,), (1,)], "id int")
    pending = spark.createDataFrame([(3,)], "id int")
    assert rows_of(I.changed_parents_children(children, "order_id", changed, pending)) == [(1, "a"), (3, "c")]
    new = spark.createDataFrame([(1, "n")], "order_id int, v string")
    assert rows_of(I.replace_children(children, new, "order_id", changed)) == [(1, "n"), (2, "b"), (3, "c")]


def test_skip_unchanged(spark, rows_of):
    parents = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "id int, updated string")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    assert rows_of(I.skip_unchanged(rows, "p", parents, "id", "updated", "2024-01-15")) == [(2, "b")]
    assert I.skip_unchanged(rows, "p", parents, "id", "updated", None).count() == 2


def test_windows_share_their_boundaries():
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 10)
    got = I.windows_between(start, end, 30)
    assert got[0][0] == start and got[-1][1] == end and all(a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    assert I.windows_between(end, end, 30) == [(end, end)]


def test_stitched_windows_equal_one_load(spark, tmp_path, log, rows_of):
    store = TableStore(spark, str(tmp_path / "s"))
    spec = TableSpec("log", ("id",))

    def run(rows, high):
        commit(store, spec, rows.withColumn("run", F.lit(str(high))), ["run"], {"to": str(high)}, buckets=4)

    I.stitch_windows(log, "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 9), run, days=30)
    assert rows_of(store.read("log")) == rows_of(log)
    assert store.state("log")["to"] == "2024-04-09 00:00:00"


def test_scoped_cursor(spark, rows_of):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1), ("c", 1)], "s string, t int")
    cursors = spark.createDataFrame([("a", 3), ("b", 1)], "s string, cursor int")
    assert rows_of(I.scoped_since(rows, cursors, ["s"], "t")) == [("a", 5), ("b", 1), ("c", 1)]
    assert rows_of(I.scoped_since(rows, cursors, ["s"], "t", inclusive=False)) == [("a", 5), ("c", 1)]


def test_policies(log):
    modified = TableSpec("t", ("id",), policy=Policy.MODIFIED, cursor=("ts",))
    assert I.read_by_policy(log, modified, {}).count() == 100
    assert I.read_by_policy(log, modified, {"cursor": "2024-01-31"}).count() == 70
    window = TableSpec("t", ("id",), policy=Policy.WINDOW, cursor=("ts",), window_days=5)
    assert I.read_by_policy(log, window, {"cursor": "2030-01-01"}, "2024-04-09").count() == 6


def test_state_version():
    assert I.state_for_version({"version": "2", "cursor": "x"}, "2") == {"version": "2", "cursor": "x"}
    assert I.state_for_version({"version": "1", "cursor": "x"}, "2") == {"version": "2"}


def test_partial_run():
    class QuotaUsedUp(Exception):
        pass

    done = []

    def fail():
        raise ValueError("bad page")

    def quota():
        raise QuotaUsedUp

    got = I.partial_run(
        {"a": lambda: done.append("a"), "b": fail, "c": lambda: done.append("c"), "d": quota, "e": lambda: done.append("e")}, QuotaUsedUp
    )
    assert got == {"a": "done", "b": "failed: bad page", "c": "done", "d": "pending", "e": "pending"} and done == ["a", "c"]


def test_stream_equals_batch(spark, tmp_path, log, rows_of):
    landed = str(tmp_path / "landed")
    log.filter("id < 60").write.parquet(landed)
    store = TableStore(spark, str(tmp_path / "s"))
    spec = TableSpec("log", ("id",))

    def run():
        stream = spark.readStream.schema(log.schema).parquet(landed).withColumn("seq", F.col("ts"))
        stream_merge(stream, store, spec, ["seq"], str(tmp_path / "ckpt"), buckets=4).awaitTermination()

    run()
    assert store.read("log").count() == 60
    late = log.filter("id >= 50").withColumns({"v": F.lit("late"), "ts": F.col("ts") + F.expr("interval 1 hour")})
    late.write.mode("append").parquet(landed)
    run()
    run()
    expected = log.filter("id < 50").unionByName(late)
    assert rows_of(store.read("log"), "id", "v") == rows_of(expected, "id", "v")


def test_window_dedupe(spark, tmp_path):
    landed = str(tmp_path / "landed")
    rows = [(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-03")]
    spark.createDataFrame(rows, "id int, t string").select("id", F.col("t").cast("timestamp").alias("t")).write.parquet(landed)
    stream = spark.readStream.schema("id int, t timestamp").parquet(landed)
    query = (
        window_dedupe(stream, "t", 30, ["id"]).writeStream.format("memory").queryName("deduped")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("deduped").count() == 2
