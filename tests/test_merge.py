"""What a table looks like after deliveries, and what must not happen to it."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators import merge as M
from recordloom.spec import TableSpec
from recordloom.store import TableStore, bucket_of

CHANGES = [("a", 1, 1), ("b", 2, 1), ("a", 3, 2), ("c", 4, 1), ("b", 5, 3), ("b", 6, 2)]
LATEST = [("a", 3), ("b", 5), ("c", 4)]


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(CHANGES, "id string, v int, seq int")


def test_latest_and_first(changes, rows_of):
    assert rows_of(M.latest_per_key(changes, ["id"], ["seq"]), "id", "v") == LATEST
    assert rows_of(M.dedupe_run(changes, ["id"], ["seq"]), "id", "v") == [("a", 1), ("b", 2), ("c", 4)]


def test_latest_is_limited_before_the_shuffle(changes):
    """A key with most of the rows sends one row per task."""
    plan = M.latest_per_key(changes, ["id"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > plan.index("Exchange")


def test_upsert_twice_is_once(spark, changes, rows_of):
    target = spark.createDataFrame([("a", 0), ("z", 9)], "id string, v int")
    once = M.upsert(target, changes, ["id"], ["seq"])
    assert rows_of(once, "id", "v") == [*LATEST, ("z", 9)]
    assert rows_of(M.upsert(once, changes, ["id"], ["seq"]), "id", "v") == rows_of(once, "id", "v")


def test_input_order_does_not_matter(spark, rows_of):
    target = spark.createDataFrame([("z", 9)], "id string, v int")
    for rows in (CHANGES, CHANGES[::-1], CHANGES[3:] + CHANGES[:3]):
        df = spark.createDataFrame(rows, "id string, v int, seq int")
        assert rows_of(M.upsert(target, df, ["id"], ["seq"]), "id", "v") == [*LATEST, ("z", 9)]


def test_batches_equal_one_batch(spark, changes, rows_of):
    target = spark.createDataFrame([], "id string, v int")
    whole = M.upsert(target, changes, ["id"], ["seq"])
    parts = target
    for seq in (1, 2, 3):
        parts = M.upsert(parts, changes.filter(F.col("seq") == seq), ["id"], ["seq"])
    assert rows_of(parts, "id", "v") == rows_of(whole, "id", "v")


def test_sparse_merge(spark, rows_of):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, t string")
    delta = spark.createDataFrame(
        [("a", 5, None, ["n"], 1), ("a", 7, None, [], 2), ("b", None, None, ["t"], 1), ("c", 3, "z", ["n", "t"], 1)],
        "id string, n int, t string, present array<string>, seq int",
    )
    got = M.upsert_sparse(target, delta, ["id"], ["seq"])
    assert rows_of(got, "id", "n", "t") == [("a", 5, "x"), ("b", 2, None), ("c", 3, "z")]


def test_delete_then_upsert_reappears(spark, rows_of):
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    changes = spark.createDataFrame(
        [("a", 1, True, 1), ("a", 2, False, 2), ("b", 3, False, 1), ("b", 3, True, 2)], "id string, v int, deleted boolean, seq int"
    )
    got = M.apply_changes(target, M.tombstone_flag(changes).drop("deleted"), ["id"], ["seq"])
    assert rows_of(got, "id", "v") == [("a", 2)]


def test_status_and_cascade(spark, rows_of):
    rows = spark.createDataFrame([("a", "PAID"), ("b", "VOIDED"), ("c", None), ("d", "ARCHIVED")], "id string, Status string")
    marked = M.tombstone_status(rows, "Status")
    assert rows_of(marked, "id", "_op") == [("a", "U"), ("b", "D"), ("c", "U"), ("d", "D")]
    lines = spark.createDataFrame([("a", 1), ("b", 2)], "doc string, n int")
    assert rows_of(M.cascade_delete(lines, marked.filter("_op = 'D'"), {"doc": "id"})) == [("a", 1)]


def test_delete_feed(spark, rows_of):
    feed = spark.createDataFrame([("task", "1"), ("tasks", "2"), ("person", "1"), ("what", "3"), ("task", None)], "item_type string, item_id string")
    routed = M.route_delete_feed(feed, {"task": "tasks", "tasks": "tasks", "person": "people"})
    assert rows_of(routed, "table", "id") == [("people", "1"), ("tasks", "1"), ("tasks", "2")]
    tasks = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows_of(M.apply_delete_feed(tasks, routed, "tasks")) == [(3,)]


def test_reconcile(spark, rows_of):
    before = spark.createDataFrame([("p1", "1"), ("p1", "2"), ("p2", "3")], "portal string, id string")
    now = spark.createDataFrame([("p1", 1)], "portal string, id int")
    whole = spark.createDataFrame([("p1", True), ("p2", False)], "portal string, complete boolean")
    assert rows_of(M.reconcile_snapshot(before, now, ["portal", "id"])) == [("p1", "2"), ("p2", "3")]
    assert rows_of(M.reconcile_snapshot(before, now, ["id"], ["portal"], whole)) == [("p1", "2")]
    assert rows_of(M.reconcile_snapshot(before, now, ["id"], ["portal"], within=F.col("id") != "2")) == [("p2", "3")]


def test_incomplete_snapshot_deletes_nothing(spark):
    before = spark.createDataFrame([("1",), ("2",)], "id string")
    now = spark.createDataFrame([("1",)], "id string")
    for complete, gone in ((False, 0), (True, 1)):
        flag = spark.createDataFrame([(complete,)], "complete boolean")
        assert M.reconcile_snapshot(before, now, ["id"], complete=flag).count() == gone


def test_reject_log(spark):
    rejects = spark.createDataFrame([(None, "x", "missing key: id")], "id int, v string, reject_reason string")
    row = M.reject_log(rejects, "t").first()
    assert row["fields"] == "id:int=null, v:string=x" and row["reason"] == "missing key: id"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


SPEC = TableSpec("t", ("id",), delete_flag="deleted")


def delta(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string, deleted boolean, seq int")


def test_commit_rewrites_touched_buckets_only(spark, store, rows_of):
    M.commit(store, SPEC, delta(spark, [(i, "old", False, 1) for i in range(200)]), ["seq"], {"cursor": "1"}, buckets=8)
    before = store.current("t")["versions"]
    touched = M.commit(store, SPEC, delta(spark, [(7, "new", False, 2), (9, "x", True, 2), (None, "lost", False, 2)]), ["seq"], {"cursor": "2"})
    after = store.current("t")["versions"]
    assert touched <= 2 and len(after) == 8
    assert sum(before[b] != after[b] for b in before) == touched
    rows = {r["id"]: r["v"] for r in store.read("t").collect()}
    assert len(rows) == 199 and rows[7] == "new" and 9 not in rows and rows[8] == "old"
    assert store.state("t")["cursor"] == "2"


def test_commit_is_idempotent(spark, store, rows_of):
    rows = delta(spark, [(1, "a", False, 1), (2, "b", False, 1), (1, "c", False, 2)])
    M.commit(store, SPEC, rows, ["seq"], buckets=4)
    once = rows_of(store.read("t"), "id", "v")
    M.commit(store, SPEC, rows, ["seq"])
    assert rows_of(store.read("t"), "id", "v") == once == [(1, "c"), (2, "b")]


def test_empty_delta_moves_only_the_state(spark, store, rows_of):
    M.commit(store, SPEC, delta(spark, [(1, "a", False, 1)]), ["seq"], {"cursor": "1"}, buckets=4)
    assert M.commit(store, SPEC, delta(spark, []), ["seq"], {"cursor": "2"}) == 0
    assert store.state("t") == {"cursor": "2"} and rows_of(store.read("t"), "id", "v") == [(1, "a")]


def test_deleting_every_row_of_a_bucket(spark, store):
    M.commit(store, SPEC, delta(spark, [(1, "a", False, 1)]), ["seq"], buckets=4)
    M.commit(store, SPEC, delta(spark, [(1, "a", True, 2)]), ["seq"])
    assert store.read("t").count() == 0


def test_failed_write_leaves_the_former_version(spark, store, rows_of):
    M.commit(store, SPEC, delta(spark, [(1, "a", False, 1)]), ["seq"], {"cursor": "1"}, buckets=4)
    bad = delta(spark, [(1, "b", False, 2)]).withColumn("v", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        M.commit(store, SPEC, bad, ["seq"], {"cursor": "2"})
    assert rows_of(store.read("t"), "id", "v") == [(1, "a")] and store.state("t") == {"cursor": "1"}


def test_sparse_commit(spark, store, rows_of):
    spec = TableSpec("s", ("id",), sparse=True, status_column="Status")
    schema = "id string, Status string, n int, present array<string>, seq int"
    M.commit(store, spec, spark.createDataFrame([("a", "PAID", 1, ["Status", "n"], 1), ("b", "PAID", 2, ["Status", "n"], 1)], schema), ["seq"], buckets=4)
    M.commit(store, spec, spark.createDataFrame([("a", "DRAFT", None, ["Status"], 2), ("b", "VOIDED", None, ["Status"], 2)], schema), ["seq"])
    assert rows_of(store.read("s"), "id", "Status", "n") == [("a", "DRAFT", 1)]


def test_new_column_in_a_later_delta(spark, store, rows_of):
    spec = TableSpec("t", ("id",))
    M.commit(store, spec, spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, seq int"), ["seq"], buckets=2)
    M.commit(store, spec, spark.createDataFrame([(2, "c", "w", 2)], "id int, v string, w string, seq int"), ["seq"])
    assert rows_of(store.read("t"), "id", "v", "w") == [(1, "a", None), (2, "c", "w")]


def test_bucket_ignores_the_type_of_an_id(spark):
    df = spark.createDataFrame([(7, "7")], "a int, b string")
    row = df.select(bucket_of(["a"], 16).alias("x"), bucket_of(["b"], 16).alias("y")).first()
    assert row["x"] == row["y"]


def test_vacuum_keeps_the_current_version(spark, store, rows_of):
    for v in ("a", "b", "c"):
        M.commit(store, SPEC, delta(spark, [(1, v, False, 1)]), ["seq"], buckets=2)
    assert store.vacuum("t") == 2 and store.vacuum("t") == 0
    assert rows_of(store.read("t"), "id", "v") == [(1, "c")]


def test_rows_outside_the_announced_buckets_are_refused(spark, store, rows_of):
    M.commit(store, SPEC, delta(spark, [(i, "a", False, 1) for i in range(20)]), ["seq"], buckets=4)
    before = store.current("t")
    rows = store.read("t")
    with pytest.raises(RuntimeError, match="announced"):
        store.write("t", rows, ["id"], 4, touched=[0])
    assert store.current("t") == before


def test_empty_first_load_makes_an_empty_table(spark, store):
    M.commit(store, SPEC, delta(spark, []), ["seq"], {"cursor": "0"}, buckets=4)
    assert store.read("t").count() == 0 and store.state("t") == {"cursor": "0"}
    M.commit(store, SPEC, delta(spark, [(1, "a", False, 1)]), ["seq"])
    assert store.read("t").count() == 1


def test_snapshot_of_several_lists_needs_all_complete(spark):
    before = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    now = spark.createDataFrame([(1,)], "id long")
    for flags, gone in (([True, False], []), ([True, None], []), ([], []), ([True, True], [2, 3])):
        lists = spark.createDataFrame([(f,) for f in flags], "complete boolean")
        assert sorted(r["id"] for r in M.reconcile_snapshot(before, now, ["id"], complete=lists).collect()) == gone


def test_rejected_values_stay_whole(spark):
    rows = spark.createDataFrame([("x" * 200, "no key")], "v string, reject_reason string")
    assert "x" * 200 in M.reject_log(rows, "t").first()["fields"]


def test_upsert_without_order_takes_no_key_twice(spark, rows_of):
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    one = spark.createDataFrame([("a", 2), ("b", 3)], "id string, v int")
    assert rows_of(M.upsert(target, one, ["id"]), "id", "v") == [("a", 2), ("b", 3)]
    with pytest.raises(Exception, match="two rows of one key"):
        M.upsert(target, one.union(one), ["id"]).collect()


def test_key_column_that_a_batch_lacks(spark):
    good, bad = M.require_key(spark.createDataFrame([("a",)], "v string"), ["id"])
    assert good.count() == 0 and bad.first()["reject_reason"] == "missing key: id"


def test_commit_keeps_rejects(spark, store, rows_of):
    assert store.rejects(SPEC.name).isEmpty()
    M.commit(store, SPEC, delta(spark, [(1, "a", False, 1), (None, "lost", False, 1)]), ["seq"], buckets=4)
    M.commit(store, SPEC, delta(spark, [(2, "b", False, 2)]), ["seq"])
    # a delta of rejects alone, without a state
    assert M.commit(store, SPEC, delta(spark, [(None, "gone", True, 3), (None, "gone", True, 3)]), ["seq"]) == 0
    store.vacuum(SPEC.name)
    got = rows_of(store.rejects(SPEC.name))
    assert [r[1] for r in got] == ["missing key: id"] * 3 and [sum(w in r[2] for r in got) for w in ("lost", "gone")] == [1, 2]
    assert rows_of(store.read(SPEC.name), "id") == [(1,), (2,)] and len(store.current(SPEC.name)["rejects"]) == 2
