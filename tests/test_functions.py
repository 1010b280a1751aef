"""Names, dates, amounts, flags, windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom import functions as R
from recordloom.functions.naming import form_table_name, group_by_safe_name


@pytest.mark.parametrize(
    ("name", "safe"),
    [("First Name", "first_name"), ("Client_Title.id", "client_title_id"), ("(x)--(y)", "x_y"), ("...", "col"), ("Ünï", "n")],
)
def test_safe_name(name, safe):
    assert R.safe_name(name) == safe


def test_table_names():
    assert R.report_table_name("Acme Ltd", "acme-crm", "All_Clients") == "data_acme_ltd__acme_crm__all_clients"
    assert R.child_table_name("form_p_employee", "Contact.Name") == "form_p_employee__sub_contact_name"
    assert R.safe_table("!!") == "sub"
    assert form_table_name("P_Employee") == "form_p_employee"
    assert group_by_safe_name(["A.id", "A_ID", "b"]) == {"a_id": ["A.id", "A_ID"], "b": ["b"]}


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "iso"),
    [
        ("/Date(1700000000999+0000)/", "2023-11-14T22:13:20Z"),
        ("/Date(1700000000000)/", "2023-11-14T22:13:20Z"),
        ("/Date(1700000000000+1300)/ tail", "2023-11-14T22:13:20Z"),
        ("x /Date(1700000000000)/", "x /Date(1700000000000)/"),
        ("/Date(-5)/", "/Date(-5)/"),
        ("2024-01-01", "2024-01-01"),
        ("/Date(99999999999999999999999)/", "/Date(99999999999999999999999)/"),
        (None, None),
    ],
)
def test_parse_slash_date(spark, text, iso):
    assert one(spark, R.parse_slash_date("a"), a=text) == iso


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1,234.50", 1234.5), ("(1,234.50)", -1234.5), (" (5) ", -5.0), ("", None), (None, None), ("abc", None), ("-3", -3.0),
        ("1e3", 1000.0),
    ],
)
def test_parse_amount(spark, text, number):
    assert one(spark, R.parse_amount("a"), a=text) == number


@pytest.mark.parametrize(
    ("text", "iso"),
    [
        ("29-Nov-2025", "2025-11-29"), ("31-Feb-2025", "2025-02-31"), ("2025-11-29", "2025-11-29"),
        ("29-NOV-2025", "29-NOV-2025"), ("9-Nov-2025", "9-Nov-2025"), (None, None),
    ],
)
def test_parse_dmy(spark, text, iso):
    assert one(spark, R.parse_dmy("a"), a=text) == iso


@pytest.mark.parametrize(
    ("text", "iso"),
    [
        ("1700000000000", "2023-11-14T22:13:20+00:00"), ("1700000000123", "2023-11-14T22:13:20.123000+00:00"),
        ("0", None), ("", None), (None, None), ("soon", None), ("-1000", "1969-12-31T23:59:59+00:00"),
    ],
)
def test_ms_to_iso(spark, text, iso):
    assert one(spark, R.ms_to_iso("a"), a=text) == iso


def test_bool_text(spark):
    words = {"1": True, " YES ": True, "On": True, "true": True, "no": False, "": False, None: None}
    for word, flag in words.items():
        assert one(spark, R.bool_text("a"), a=word) is flag


def test_fallbacks(spark):
    assert one(spark, R.first_truthy("a", "b"), a="", b="x") == "x"
    assert one(spark, R.first_truthy("a", "b"), a="", b=None) is None
    assert one(spark, R.first_known("a", "b"), a="", b="x") == ""
    assert one(spark, R.trim_text("a"), a="  ") is None
    assert one(spark, R.report_date("a", F.lit("2024-03-05 10:00:00")), a="") == "2024-03-05"
    assert one(spark, R.join_list(F.lit(None).cast("array<string>"))) == ""


def test_business_dates_counts_whole_days(spark):
    days = one(spark, R.business_dates(F.lit("2024-02-28 23:00:00"), F.lit("2024-03-01 22:00:00")))
    assert days == ["20240228", "20240229"]
    assert one(spark, R.business_dates(F.lit("2024-02-02"), F.lit("2024-02-01"))) == []


def chunks(spark, start, end, days, mode):
    got = one(spark, R.window_chunks(F.lit(start), F.lit(end), days, mode))
    return [(str(w["from_date"]), str(w["to_date"])) for w in got]


def test_window_chunks(spark):
    assert chunks(spark, "2024-01-01", "2024-01-10", 4, "forward") == [
        ("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-08"), ("2024-01-09", "2024-01-10"),
    ]
    assert chunks(spark, "2024-01-01", "2024-01-10", 4, "backward") == [
        ("2024-01-07", "2024-01-10"), ("2024-01-03", "2024-01-06"), ("2024-01-01", "2024-01-02"),
    ]
    assert chunks(spark, "2024-01-01", "2024-01-10", 4, "stitched") == [
        ("2024-01-01", "2024-01-05"), ("2024-01-05", "2024-01-09"), ("2024-01-09", "2024-01-10"),
    ]
    assert chunks(spark, "2024-01-01", "2024-01-05", 4, "stitched") == [("2024-01-01", "2024-01-05")]
    assert chunks(spark, "2024-01-01", "2024-01-01", 4, "forward") == [("2024-01-01", "2024-01-01")]
    assert chunks(spark, "2024-01-02", "2024-01-01", 4, "forward") == []


def test_older_is_strict(spark):
    as_of = F.lit("2024-01-31 00:00:00")
    assert one(spark, R.is_older_than(F.lit("2024-01-01 00:00:00"), as_of)) is False
    assert one(spark, R.is_older_than(F.lit("2023-12-31 23:59:59.999999"), as_of)) is True


def test_relative_window_includes_both_ends(spark):
    day = F.lit(dt.date(2024, 1, 10))
    for offset, inside in ((-4, False), (-3, True), (2, True), (3, False)):
        assert one(spark, R.relative_window(F.date_add(day, offset), day, 3, 2)) is inside


def test_amounts_take_no_type_suffix(spark):
    rows = spark.createDataFrame([("12D",), ("7f",), ("(1,234.50)",), (" .5 ",), ("1e3",), ("x",)], "v string")
    assert [r[0] for r in rows.select(R.parse_amount("v")).collect()] == [None, None, -1234.5, 0.5, 1000.0, None]
