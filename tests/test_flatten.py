"""One flat row per record."""

import json

import pytest

from recordloom.operators import flatten as L
from recordloom.spec import TableSpec


def row(df):
    return df.first().asDict()


def test_fk_objects(records):
    df = records(
        '{"id":1,"customer":{"id":7,"name":"Acme","parent":{"id":3,"name":"P"},"meta":{"a":1},"tags":[]},'
        '"billing_address":{"city":"X","geo":{"lat":1.5}},"custom_fields":{"a":"b"},"list":[1,2],"empty":[],"delivery_windows":{}}'
    )
    assert row(L.explode_fk(df)) == {
        "id": 1, "customer_id": 7, "customer_name": "Acme", "customer_parent_id": 3, "customer_meta": '{"a":1}',
        "customer_tags": None, "billing_address_city": "X", "billing_address_geo": '{"lat":1.5}',
        "custom_fields": '{"a":"b"}', "list": "[1,2]", "empty": None,
    }


def test_fk_with_null_id_keeps_its_columns(records):
    df = records('{"id":1,"customer":{"id":null,"name":"A"}}', '{"id":2}')
    got = {r["id"]: (r["customer_id"], r["customer_name"]) for r in L.explode_fk(df).collect()}
    assert got == {1: (None, "A"), 2: (None, None)}


def test_lookup_by_name(records):
    df = records(
        '{"id":1,"Owner":{"id_string":"9","first_name":"Jo","last_name":"Li","email":"j@x"},"task":{"id":5,"name":"T"},'
        '"plain":{"a":1},"UDF_CHAR1":"u","created_time_long":1700000000000,"x_long":5,"x_at":"kept","Note":""}'
    )
    got = row(L.explode_lookup(df))
    assert got["owner_id"] == "9" and got["owner_name"] == "Jo Li" and got["owner_email"] == "j@x"
    assert got["task_name"] == "T" and got["plain"] == '{"a":1}' and got["note"] is None
    assert got["created_time_at"] == "2023-11-14T22:13:20+00:00" and got["x_at"] == "kept"
    assert "udf_char1" not in got


def test_lookup_by_display(records):
    df = records('{"Dept":{"id":"4","displayValue":"Sales"},"Ref":{"Zoho_ID":8},"Other":{"id":1}}')
    got = row(L.explode_lookup(df, "display"))
    assert got == {"dept_id": "4", "dept_display_value": "Sales", "ref_id": "8", "other": '{"id":1}'}


def test_form_shapes(records):
    df = records(
        '{"ID":"1","Client_Title":{"ID":"5","zc_display_value":"Dr"},"Client_Title_ID":"","Name":{"prefix":"","first_name":"A"},'
        '"Addr":{"district_city":"C","extra":{"k":1}},"Doc":{"filepath":"p","filename":"f"},"Multi":["a"],"Obj":{"q":1}}'
    )
    assert row(L.flatten_record(df, "forms")) == {
        "id": "1", "client_title_id": "5", "client_title_display_value": "Dr", "name_prefix": None, "name_first_name": "A",
        "name_last_name": None, "name_suffix": None, "addr_district_city": "C", "addr_extra": '{"k":1}',
        "doc_url": "p", "doc_filename": "f", "multi": '["a"]', "obj": '{"q":1}',
    }


def test_collisions_prefer_known_values(spark):
    df = spark.createDataFrame([("", "b", None), ("a", "b", None), (None, "", None)], "`X.id` string, `X_ID` string, `x id` string")
    assert sorted(r["x_id"] for r in L.merge_collisions(df).collect()) == ["", "a", "b"]


def test_flatten_prefix(records):
    df = records(
        '{"guid":"g","server":{"guid":"s","serverName":"n","deep":{"guid":"d","k":1}},"refund":{"refundAmount":1.5,"tipRefundAmount":0.5},'
        '"refundDetails":{"reason":"r"},"list":[1]}'
    )
    assert row(L.flatten_prefix(df, ["server", "refund", "refundDetails", "absent"])) == {
        "id": "g", "server_id": "s", "serverName": "n", "server_deep_id": "d", "server_deep_k": 1, "refundAmount": 1.5,
        "refund_tip_amount": 0.5, "reason": "r", "list": [1],
    }


def test_extract_path_leaves_what_it_cannot_take(records):
    df = records('{"menu":{"guid":"m"},"area":{"name":"n"}}')
    got = row(L.extract_path(df, [("menu", "guid", "menu_id"), ("area", "guid", "area_id")]))
    assert got["menu_id"] == "m" and got["area"]["name"] == "n" and "area_id" not in got


def test_jsonapi(records):
    df = records(
        '{"id":"1","type":"t","attributes":{"a":1,"o":{"k":1},"e":[]},"relationships":{"one":{"data":{"id":"5","type":"x"}},'
        '"none":{"data":null},"many":{"data":[{"id":"7"},{"id":"8"}]},"nothing":{"data":[]}}}'
    )
    got = row(L.flatten_jsonapi(df))
    assert got["id"] == "1" and got["a"] == 1 and got["o"] == '{"k":1}' and got["e"] is None
    assert got["one_id"] == "5" and got["none_id"] is None and json.loads(got["many_ids"]) == ["7", "8"]


def test_strip_nulls(records):
    df = records('{"id":1,"a":5,"b":null,"c":{"x":1}}', '{"id":2,"b":"y"}')
    got = {r["id"]: sorted(r["present"]) for r in L.strip_nulls(df, ["id"]).collect()}
    assert got == {1: ["a"], 2: ["b"]}


def test_promote(records):
    df = records('{"guid":"g","general":{"name":"n","hours":{"h":1}},"other":{"k":1},"list":[1]}')
    assert row(L.promote(df, ["general", "location"])) == {
        "id": "g", "general_name": "n", "general_hours": '{"h":1}', "list": "[1]", "other": '{"k":1}',
    }


def test_project_deep_is_null_safe(records):
    df = records('{"id":1,"voidInfo":{"voidDate":"d","voidApprover":{"guid":"a"}}}', '{"id":2}')
    got = {r["id"]: (r["void_info_approver_guid"], r["void_info_user_guid"]) for r in L.project_deep(df, L.VOID_PATHS).collect()}
    assert got == {1: ("a", None), 2: (None, None)}


def test_types_and_typed_lines(spark, records):
    df = records('{"id":"1","n":"x","d":"2024-01-01T00:00:00Z","Schedule":{"Period":"3"}}')
    spec = TableSpec("t", ("id",), {"n": "INT", "d": "UTC_DATETIME", "absent": "FLOAT"})
    got = row(L.apply_types(L.typed_lines(df, "Schedule", {"Period": ("P", "INT"), "Unit": ("U", "STRING")}), spec))
    assert got["n"] is None and got["d"].year == 2024 and got["P"] == 3 and got["U"] is None


@pytest.mark.parametrize(
    ("a", "b", "common"),
    [("bigint", "double", "double"), ("boolean", "bigint", "string"), ("string", "double", "string"), ("bigint", "bigint", "bigint")],
)
def test_widen(a, b, common):
    assert L.widen(a, b) == common


def test_union_columns(spark, rows_of):
    a = spark.createDataFrame([(1, "x")], "Id int, v string")
    b = spark.createDataFrame([(1.5, True)], "id double, w boolean")
    assert rows_of(L.union_columns([a, b]), "Id", "v", "w") == [(1.0, "x", None), (1.5, None, True)]


def test_flatten_is_one_projection(records):
    """The whole record is flattened in a single narrow stage without Python."""
    df = records('{"id":1,"customer":{"id":7,"name":"A"},"list":[1]}')
    plan = L.explode_fk(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
