"""References, scopes, counts."""

import pytest

from recordloom.operators import profile as P
from recordloom.operators import relate as R


@pytest.fixture
def shop(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 11), (5, 99)], "id int, customer_id int"),
        "customers": spark.createDataFrame([(10, 1)], "id int, created_by_id int"),
        "users": spark.createDataFrame([(1, None)], "id int, manager_id int"),
    }
    details = {
        "customers": spark.createDataFrame([(10, 1), (11, 2)], "id int, created_by_id int"),
        "users": spark.createDataFrame([(1, None), (2, 3), (3, 4), (4, None)], "id int, manager_id int"),
    }
    refs = [
        R.Reference("orders", "customer_id", "customers"), R.Reference("customers", "created_by_id", "users"),
        R.Reference("users", "manager_id", "users"),
    ]
    return tables, details, refs, {"customers": "id", "users": "id"}


def test_orphans_and_report(shop, rows_of):
    tables, _, refs, ids = shop
    assert rows_of(R.orphans(tables["orders"], "customer_id", tables["customers"], "id")) == [(11,), (99,)]
    assert rows_of(R.orphan_report(tables, refs, ids)) == [("orders", "customer_id", "customers", 2)]


def test_recovery_follows_references(shop, rows_of):
    tables, details, refs, ids = shop
    found, done = R.recover_orphans(tables, details, refs, ids)
    assert rows_of(found["customers"], "id") == [(11,)]
    assert rows_of(found["users"], "id") == [(2,), (3,), (4,)]
    assert rows_of(done["customers"]) == [(11,), (99,)]


def test_recovery_stops_after_its_rounds(shop, rows_of):
    tables, details, refs, ids = shop
    found, _ = R.recover_orphans(tables, details, refs, ids, max_iterations=1)
    assert rows_of(found["users"], "id") == [(2,)]


def test_resolved_ids_are_not_looked_up_again(shop):
    tables, details, refs, ids = shop
    _, done = R.recover_orphans(tables, details, refs, ids)
    found, _ = R.recover_orphans(tables, details, refs, ids, resolved={"customers": done["customers"]})
    assert "customers" not in found


def test_scope_filter(spark, rows_of):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, ""), (4, None)], "id int, w string")
    assert rows_of(R.scope_filter(df, "w", ["a"]), "id") == [(1,), (3,), (4,)]
    assert R.scope_filter(df, "w", []).count() == 4
    allowed = spark.createDataFrame([("b",), ("b",)], "x string")
    assert rows_of(R.scope_filter(df, "w", allowed), "id") == [(2,), (3,), (4,)]


def test_passes_and_overrides(spark, rows_of):
    a = spark.createDataFrame([(1, "x"), (2, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "y")], "id int, v string")
    assert rows_of(R.multi_pass_union({"active": a, "old": b}, "pass", ["id"], ["v"]), "id", "pass") == [(1, "active"), (2, "active"), (3, "old")]
    assert rows_of(R.scope_override(a, b, ["id"])) == [(1, "x"), (2, "y"), (3, "y")]
    assert rows_of(R.id_difference(a, b, ["id"])) == [(1,)] and R.id_union(a, b, ["id"]).count() == 3


def test_profile(spark, rows_of):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "s string, n int")
    assert rows_of(P.status_distribution(df, "s")) == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]
    assert rows_of(P.table_counts({"t": df, "u": df.filter("n > 2")})) == [("t", 3), ("u", 1)]
    assert [r["n"] for r in P.cap(df, 2, ["n"]).collect()] == [1, 2]
    assert P.distinct_dims(df, ["s", "n"]).first().asDict() == {"n_s": 2, "n_n": 3}
    assert rows_of(P.max_value(df, "n", ["s"])) == [("a", 2), ("b", 3)]
    assert [r["n"] for r in P.report_sample(df, ["n"], [df.n.desc()], 1, "s = 'a'").collect()] == [2]


def test_scope_table_empty_allows_all_and_blank_is_not_doubled(spark):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,)], "s string")
    none, some = spark.createDataFrame([], "k string"), spark.createDataFrame([("a",), ("",)], "k string")
    assert R.scope_filter(df, "s", none).count() == 4
    assert sorted(str(r["s"]) for r in R.scope_filter(df, "s", some).collect()) == ["", "None", "a"]


def test_long_chains_of_references_are_followed_to_their_end(spark):
    tables = {"orders": spark.createDataFrame([(1, "p1")], "id int, part string"), "parts": spark.createDataFrame([], "id string, made_of string")}
    chain = spark.createDataFrame([(f"p{i}", f"p{i + 1}" if i < 6 else None) for i in range(1, 7)], "id string, made_of string")
    refs = [R.Reference("orders", "part", "parts"), R.Reference("parts", "made_of", "parts")]
    found, _ = R.recover_orphans(tables, {"parts": chain}, refs, {"parts": "id"})
    assert sorted(r["id"] for r in found["parts"].collect()) == [f"p{i}" for i in range(1, 7)]
