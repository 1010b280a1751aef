"""Nested arrays, maps and trees to tables."""

import json
import random

from pyspark.sql import functions as F

from recordloom.operators import shred as S
from recordloom.operators.keys import composite_key, hash_key, parent_index_key, require_key


def test_child_table_keys_by_position(records, rows_of):
    df = records('{"id":1,"lines":[{"lineID":"a","v":1},{"v":2},{"lineID":"","v":3}]}', '{"id":2,"lines":[]}', '{"id":3}')
    got = S.child_table(df, "lines", {"id": "parent"}, own_key="lineID")
    assert rows_of(got, "parent", "lineID", "v") == [(1, "1", 2), (1, "2", 3), (1, "a", 1)]


def test_child_flattened_like_its_parent(records, rows_of):
    df = records('{"id":1,"entries":[{"stock_item":{"id":5,"name":"malt"},"id":9}]}')
    got = S.child_table(df, "entries", {"id": "purchase_order_id"}, style="fk")
    assert rows_of(got, "purchase_order_id", "id", "stock_item_id", "stock_item_name") == [(1, 9, 5, "malt")]


TREE = S.Node(
    "orders", spread=("server",),
    children=(S.Node("check", "checks", children=(S.Node("tax", "taxes", spread=("rate",), derived_key=("check_id", "rate_id", "name", "pct")),)),),
)


def test_shred_tree(records, rows_of):
    df = records(
        '{"guid":"o1","r":"R","server":{"guid":"s"},"checks":[{"guid":"c1","taxes":[{"guid":"t1","name":"V","pct":0.5},'
        '{"guid":null,"name":"V","pct":0.0,"rate":{"guid":"x"}}],"labels":["a"]},{"guid":"c2"}]}',
        '{"guid":"o2","r":"R"}',
    )
    out = S.shred_tree(df, TREE, "r")
    assert rows_of(out["orders"], "id", "r", "server_id") == [("o1", "R", "s"), ("o2", "R", None)]
    assert rows_of(out["check"], "orders_id", "r", "id", "labels") == [("o1", "R", "c1", '["a"]'), ("o1", "R", "c2", None)]
    import hashlib

    made = "gen-" + hashlib.md5(b"c1_x_V_").hexdigest()
    assert rows_of(out["tax"], "check_id", "id") == [("c1", made), ("c1", "t1")]


def test_bridge(records, rows_of):
    df = records(
        '{"id":1,"many":[5,null,5,6],"q":"w"}', '{"id":2,"many":[],"one":"7","q":"w"}', '{"id":3,"one":"","q":"w"}', '{"id":null,"many":[1]}'
    )
    got = S.bridge(df, "id", "many", "b", a_as="a", singular="one", scope="q")
    assert rows_of(got, "a", "b") == [("1", "5"), ("1", "6"), ("2", "7"), ("3", "w")]


def test_bridge_parses_a_document_once(spark, rows_of):
    """A filter on the key below the parsing would parse each document for it as well."""
    texts = ['{"id":"1","many":["x",null,"y"],"c":"k"}', '{"many":["z"],"c":"k"}', '{"id":"2","c":"k"}']
    parsed = spark.createDataFrame([(t,) for t in texts], "body string").select(F.from_json("body", "id string, many array<string>, c string").alias("r"))
    got = S.bridge(parsed.select("r.*"), "id", "many", "b", a_as="a", carry=["c"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows_of(got) == [("k", "1", "x"), ("k", "1", "y")]


def test_grandchild_bridge(records, rows_of):
    df = records('{"InvoiceID":"i","LineItems":[{"LineItemID":"l","Tracking":[{"TrackingCategoryID":"c","Option":"o"}]},{"Tracking":[]}]}')
    got = S.grandchild_bridge(
        df, "LineItems", "Tracking", {"InvoiceID": "InvoiceID"}, {"LineItemID": "LineItemID"}, {n: n for n in ("TrackingCategoryID", "Name")}
    )
    assert rows_of(got) == [("i", "l", "c", "")]


def test_auto_children(records, rows_of):
    df = records(
        '{"ID":"7","Contact.Name":[{"ID":"x","A b":"1"},{"A b":""}],"Multi":["a"],"Empty":[]}', '{"ID":"8","Contact.Name":[]}'
    )
    out = S.auto_children(df, "data_t")
    assert set(out) == {"data_t", "data_t__sub_contact_name"}
    assert rows_of(out["data_t__sub_contact_name"], "parent_id", "id", "a_b") == [("7", "7__1", None), ("7", "x", "1")]
    assert rows_of(out["data_t"], "id", "multi", "empty") == [("7", '["a"]', None), ("8", None, None)]


def test_maps(records, rows_of):
    df = records('{"e":1,"days":{"2024-01-01":{"h":2},"2024-01-02":null,"":{"h":9}}}', schema="e int, days map<string,struct<h:int>>")
    assert rows_of(S.explode_dated_map(df, "days", ["e"])) == [(1, "2024-01-01", 2)]
    df = records('{"r":{"e1":{"t1":{"b":1},"totals":{"b":9}},"e2":{}}}', schema="r map<string,map<string,struct<b:int>>>")
    assert rows_of(S.unpivot_map2(df, "r", "e", "t")) == [("e1", "t1", 1), ("e1", "totals", 9)]


def test_tagged_union_of_different_shapes(records, rows_of):
    df = records('{"k":1,"x":[{"a":1},{"a":2}],"y":[{"b":"q"}]}', '{"k":2,"y":[]}')
    got = S.tagged_union(df, {"x": "task", "y": "bug", "absent": "none"}, "kind", ["k"], position="idx")
    assert rows_of(got, "k", "kind", "idx", "a", "b") == [
        (1, "bug", "bug_0", None, "q"), (1, "task", "task_0", 1, None), (1, "task", "task_1", 2, None),
    ]


def test_carry_context(records, rows_of):
    df = records(
        '{"date":"d","task":"t","id":0,"logs":[{"id":1,"task":"own"},{"id":2,"log_date":"e"}]}', '{"date":"d","task":"u","id":5,"logs":[]}'
    )
    got = S.carry_context(df, "logs", ["date"], {"log_date": "date"})
    assert rows_of(got, "id", "task", "log_date") == [(1, "own", "d"), (2, "t", "e"), (5, "u", "d")]


def test_melt_custom_fields(spark):
    record = {
        "id": 1, "UDF_CHAR1": "x", "UDF_NUMBER1": "12.5", "UDF_LONG2": "n/a", "UDF_BOOL1": "on", "UDF_DATE1": "01-02-2024",
        "UDF_TIMESTAMP1": 1700000000000, "UDF_MULTI1": ["a", "b"], "UDF_CHAR2": "", "UDF_CHAR3": None, "UDF_lower1": "no",
        "customfields": [{"column_name": "UDF_CHAR1", "value": "again"}, {"label_name": "no name", "value": 1}, {"api_name": "cf", "value": 3}],
    }
    df = spark.createDataFrame([(1, json.dumps(record))], "id int, j string").select("id", F.parse_json("j").alias("record"))
    meta = spark.createDataFrame([("UDF_CHAR1", "Label", "Text")], "field_api_name string, field_label string, field_type string")
    got = [r.asDict() for r in S.melt_custom_fields(df, ["id"], meta=meta).collect()]
    assert len(got) == 11
    by = {(r["field_api_name"], r["raw_value"]): r for r in got}
    assert by["UDF_NUMBER1", "12.5"]["value_number"] == 12.5 and by["UDF_NUMBER1", "12.5"]["field_type"] == "number"
    assert by["UDF_LONG2", "n/a"]["value_text"] == "n/a" and by["UDF_LONG2", "n/a"]["value_number"] is None
    assert by["UDF_BOOL1", "on"]["value_boolean"] is True
    assert by["UDF_DATE1", "01-02-2024"]["value_date"] == "01-02-2024"
    assert by["UDF_TIMESTAMP1", "1700000000000"]["value_datetime"] == "1700000000000"
    assert by["UDF_MULTI1", '["a","b"]']["value_text"] == '["a","b"]'
    assert by["UDF_CHAR2", ""]["value_text"] is None and by["UDF_CHAR3", None]["value_text"] is None
    assert {r["raw_value"] for r in got if r["field_label"] == "Label"} == {"x", "again"}
    assert by["cf", "3"]["value_text"] == "3" and by["cf", "3"]["field_type"] is None


def test_tags_keep_names(records, rows_of):
    df = records('{"portal_id":"p","t":1,"tags":[{"id":"9","name":"n","color":"c"}],"tag_ids":["9","10",""]}')
    got = S.tag_associations(df, "task", "t")
    assert rows_of(got, "entity_id", "tag_id", "tag_name") == [("1", "10", None), ("1", "9", "n")]


def test_walk_tree(spark, rows_of):
    tree = {"groups": [{"n": "a", "groups": [{"n": "b", "groups": [{"n": "c"}]}, {"n": "d"}]}, {"n": "e", "groups": []}]}
    df = spark.createDataFrame([("r1", json.dumps(tree)), ("r2", "{}")], "r string, j string")
    df = df.select("r", F.parse_json("j").alias("m"))
    got = S.walk_tree(df, F.try_variant_get("m", "$.groups", "array<variant>"), "groups", ["r"])
    named = got.select("r", "depth", "path", S.node_text("n").alias("n"), S.node_text("n", "parent").alias("p"))
    assert rows_of(named, "n", "depth", "p", "path") == [
        ("a", 0, None, [0]), ("b", 1, "a", [0, 0]), ("c", 2, "b", [0, 0, 0]), ("d", 1, "a", [0, 1]), ("e", 0, None, [1]),
    ]


def reference_order(rows):
    """The order rule in plain words: a level is listed whole, then its last section, and so on back to the first."""
    listed, out = [(rows, "")], []
    while listed:
        level, outer = listed.pop()
        inner = []
        for r in level:
            if r["RowType"] == "Section":
                title = r.get("Title") or outer
                out.append((title, "Section"))
                inner.append((r.get("Rows", []), title))
            else:
                out.append((outer, r["v"]))
        listed.extend(inner)
    return out


def random_rows(rng, depth):
    rows = []
    for i in range(rng.randint(0, 4)):
        if depth < 4 and rng.random() < 0.5:
            rows.append({"RowType": "Section", "Title": rng.choice(["", f"s{depth}{i}"]), "Rows": random_rows(rng, depth + 1)})
        else:
            v = f"{depth}-{i}-{rng.randint(0, 99)}"
            rows.append({"RowType": "Row", "v": v, "Cells": [{"Value": v}]})
    return rows


def test_report_order_on_random_reports(spark):
    rng = random.Random(5)
    reports = [random_rows(rng, 0) for _ in range(12)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(reports)], "id int, j string")
    got = S.flatten_report(df.select("id", F.parse_json("j").alias("Rows")), ["id"]).collect()
    for i, report in enumerate(reports):
        mine = sorted((r for r in got if r["id"] == i), key=lambda r: r["row_index"])
        assert [r["row_index"] for r in mine] == list(range(len(mine)))
        shown = [(r["section"], "Section" if r["row_type"] == "Section" else r["cells"][0]["Value"]) for r in mine]
        assert shown == reference_order(report)


def test_trial_balance_and_cells(spark, rows_of):
    rows = [
        {"RowType": "Header", "Cells": [{"Value": "Account"}]},
        {"RowType": "Section", "Title": "Assets", "Rows": [
            {"RowType": "Row", "Cells": [{"Value": "Bank", "Attributes": [{"Id": "account", "Value": "A1"}]}, {"Value": "(1,234.50)"}, {}, {"Value": ""}, {"Value": "7"}]},
            {"RowType": "Row"},
        ]},
    ]
    df = spark.createDataFrame([(1, json.dumps(rows))], "id int, j string").select("id", F.parse_json("j").alias("Rows"))
    flat = S.flatten_report(df, ["id"])
    assert rows_of(S.trial_balance(flat, ["id"]), "row_index", "section", "account_id", "account_name", "debit", "credit", "ytd_credit") == [
        (0, "", "", "Account", None, None, None), (1, "Assets", "", "", None, None, None), (2, "Assets", "A1", "Bank", -1234.5, None, 7.0),
    ]
    assert rows_of(S.report_cells(flat, ["id"]), "row_index", "cell_index", "cell_value", "cell_account_id") == [
        (0, 0, "Account", ""), (2, 0, "Bank", "A1"), (2, 1, "(1,234.50)", ""), (2, 2, "", ""), (2, 3, "", ""), (2, 4, "7", ""),
    ]


def test_derive_dim_first_wins(spark, rows_of):
    df = spark.createDataFrame([(2, "k", "late"), (1, "k", "early"), (3, None, "x")], "s int, k string, name string")
    assert rows_of(S.derive_dim(df, "k", ["name"], ["s"])) == [("k", "early")]


def test_shapes_of_people(records, rows_of):
    df = records('{"id":1,"details":{"owners":[{"zpuid":"a"}]},"assignees":[{"zpuid":"z"}]}', '{"id":2,"assignees":[{"zpuid":"b"}]}')
    got = S.shape_union(df, ["details.owners", "assignees", "owners"], "p").select("id", F.explode("p.zpuid").alias("u"))
    assert rows_of(got) == [(1, "a"), (2, "b")]


def test_keys(spark, rows_of):
    df = spark.createDataFrame([("a", None, 1.5), (None, "", 0.0)], "x string, y string, z double")
    import hashlib

    expected = sorted("gen-" + hashlib.md5(t.encode()).hexdigest() for t in ("a__1.5", "__0.0"))
    assert [r[0] for r in rows_of(df.select(hash_key(["x", "y", "z"]).alias("k")))] == expected
    assert df.select(parent_index_key("x", F.lit(3)).alias("k")).first()["k"] == "a__3"
    assert composite_key("portal_id|task_id") == ["portal_id", "task_id"]
    good, bad = require_key(df, ["x"])
    assert good.count() == 1 and bad.first()["reject_reason"] == "missing key: x"


def test_names_like_types_and_mixed_depths(spark):
    texts = ['{"VOIDReason":"x","VARIANT_CODE":"a","n":null,"list":[{"OBJECT":1}]}', '{"n":1}', '{"n":"one"}']
    from recordloom.sources import infer_schema

    records = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("record"))
    fields = {f.name: f.dataType.simpleString() for f in infer_schema(records).fields}
    assert fields == {"VOIDReason": "string", "VARIANT_CODE": "string", "n": "string", "list": "array<struct<OBJECT:bigint>>"}

    deep = '{"id":0}'
    for i in range(1, 13):
        deep = f'{{"id":{i},"below":[{deep}]}}'
    trees = spark.createDataFrame([(1, f"[{deep}]"), (2, '[{"id":99,"below":"none"}]'), (3, None)], "k int, t string")
    nodes = S.walk_tree(trees, F.try_variant_get(F.parse_json("t"), "$", "array<variant>"), "below", ["k"])
    assert nodes.filter("k = 1").agg(F.max("depth"), F.count("*")).first() == (12, 13)
    assert nodes.filter("k = 2").count() == 1


def test_union_of_absent_arrays(spark):
    df = spark.createDataFrame([("a",)], "k string")
    got = S.tagged_union(df, {"x": "task"}, "kind", ["k"], position="idx")
    assert got.columns == ["k", "kind", "idx"] and got.count() == 0
