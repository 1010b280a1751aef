"""Envelopes, sentinels, completeness, CSV, metadata."""

import pytest

from recordloom import sources as S


@pytest.fixture
def pages(spark):
    return lambda *bodies: spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page_no int, body string")


ENVELOPES = {
    "bare": '[{"id":1},{"id":2}]',
    "data": '{"data":[{"id":1},{"id":2}]}',
    "nested": '{"response":{"result":[{"id":1},{"id":2}]}}',
    "second key": '{"tasks":[],"items":[{"id":1},{"id":2}]}',
    "generic after empty": '{"tasks":[],"data":[{"id":1},{"id":2}]}',
}


@pytest.mark.parametrize("name", ENVELOPES)
@pytest.mark.parametrize("schema", [None, "id bigint"])
def test_read_pages(pages, rows_of, name, schema):
    df = S.read_pages(pages(ENVELOPES[name]), ["tasks", "items", "response.result"], schema=schema)
    got = S.as_record(df, "id bigint") if schema is None else df.select("page_no", "pos", "record.id")
    assert rows_of(got, "page_no", "pos", "id") == [(0, 0, 1), (0, 1, 2)]


@pytest.mark.parametrize("schema", [None, "id bigint"])
def test_pages_without_records(pages, schema):
    df = S.read_pages(pages('{"data":[]}', "{}", "not json", "[]", '{"data":"x"}'), schema=schema)
    assert df.count() == 0


def test_read_single(pages, rows_of):
    df = S.read_single(pages('{"timer":{"id":1}}', '{"timer":[{"id":2},{"id":9}]}', '{"id":3}', "[]"), ["timer"])
    assert rows_of(S.as_record(df, "id bigint"), "page_no", "id") == [(0, 1), (1, 2), (2, 3)]


def test_read_keyed_skips_scalars(pages, rows_of):
    df = S.read_keyed(pages('{"r":{"a":{"n":1},"note":"x","b":{"n":2}}}'), "r", "name")
    assert rows_of(S.as_record(df, "n bigint"), "name", "n") == [("a", 1), ("b", 2)]


def test_sentinels_are_not_rows(pages):
    records = S.read_pages(
        pages('[{"errorcode":7300,"message":"No records found"}]', '[{"id":1,"message":"hello"}]', "[5]")
    )
    data, rejects = S.drop_sentinels(records)
    assert data.count() == 1
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["error envelope", "not an object"]


def test_failed_pages(pages):
    good, bad = S.drop_failed_pages(
        pages(
            '{"response":{"result":[1],"status":0}}',
            '{"response":{"returnvalue":{"status":"failure"},"status":"success"}}',
            '{"response":{"status":1,"message":"no"}}',
            '{"error_code":7014,"status":0}',
            "<html>",
            '{"data":[],"status":1}',
            '{"response":{"errorcode":7103}}',
        )
    )
    assert [r["page_no"] for r in good.collect()] == [0, 5]
    reasons = {r["page_no"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {1: "inner failure", 2: "status", 3: "error envelope", 4: "unreadable", 6: "error code"}


def test_snapshot_complete(spark, rows_of):
    rows = [
        ("whole", 1, 100, True), ("whole", 2, 3, False),
        ("gap", 1, 100, True), ("gap", 3, 3, False),
        ("cut", 1, 100, True), ("cut", 2, 100, True),
        ("twice", 1, 5, False), ("twice", 1, 5, False),
        ("late", 2, 5, False),
    ]
    df = spark.createDataFrame(rows, "list string, page_no int, n_records int, has_next boolean")
    expected = [("cut", False), ("gap", False), ("late", False), ("twice", True), ("whole", True)]
    assert rows_of(S.snapshot_complete(df, ["list"], page_size=100), "list", "complete") == expected
    assert rows_of(S.snapshot_complete(df, ["list"], has_next="has_next"), "list", "complete") == expected


def test_bulk_csv(spark, tmp_path, rows_of):
    (tmp_path / "part.csv").write_text(
        'ID,Client.Name,Lines,Note\n1,"A, ""B""","[{""a"": 1}]", \n2,,"{bad}","two\nlines"\n', encoding="utf-8"
    )
    df = S.read_bulk_csv(spark, str(tmp_path))
    assert rows_of(df) == [("1", 'A, "B"', '[{"a":1}]', None), ("2", None, "{bad}", "two\nlines")]
    named = S.read_bulk_csv(spark, str(tmp_path), ["ID", "Client.Name", "Lines", "Note"])
    assert rows_of(named) == rows_of(df)


def test_text_pages(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('[{"id":1}]\n[{"id":2}]\n')
    lines = S.read_text_pages(spark, str(tmp_path))
    assert S.read_pages(lines).count() == 2
    assert S.read_text_pages(spark, str(tmp_path), whole_file=True).count() == 1


def test_infer_schema_keeps_mixed_fields_as_text(pages):
    df = S.read_pages(pages('[{"id":1,"v":1},{"id":2,"v":"x"},{"id":3,"v":{"k":1},"w":null}]'))
    schema = S.infer_schema(df)
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {"id": "bigint", "v": "string", "w": "string"}


def test_discover_forms(spark, rows_of):
    view = "array<struct<view_name:string,is_default:boolean>>"
    df = spark.createDataFrame(
        [
            ("P_Employee", "E", [("A", None), ("B", True), ("C", True)]),
            ("leave", "L", [("", True), ("First", False)]),
            ("case", "C", None),
            ("skipme", "S", []),
            ("", "none", []),
        ],
        f"link_name string, display_name string, views {view}",
    )
    got = S.discover_forms(df, ["skipme"])
    assert rows_of(got, "form_link_name", "default_view", "table") == [
        ("P_Employee", "B", "form_p_employee"), ("case", "caseView", "form_case"), ("leave", "First", "form_leave"),
    ]


def test_records_with_any_field_name(pages, rows_of):
    df = S.read_pages(pages('[{"First Name":"A","a.b":{"x y":1},"n":"5"},{"First Name":"B","n":"bad"}]'))
    got = S.as_record(df, "`First Name` string, `a.b` struct<`x y`:bigint>, n bigint")
    assert rows_of(got.selectExpr("`First Name` f", "`a.b`.`x y` x", "n")) == [("A", 1, 5), ("B", None, None)]


def test_case_variants_are_merged(pages, rows_of):
    df = S.as_record(S.read_pages(pages('[{"Unit":"d"},{"unit":"h"}]')), "Unit string, unit string")
    assert df.columns.count("Unit") == 1 and rows_of(df, "Unit") == [("d",), ("h",)]
