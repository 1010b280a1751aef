"""Named queries: shape, agreement with their SQL on the small tables, and behaviour under skew."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from recordloom.queries.registry import nest

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


def test_every_query_has_sql():
    from recordloom.queries import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "status", "orders", "lines", "revenue_cents"] and df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


SAMPLE = [
    "land_pages_events", "bulk_csv_parts", "shred_orders_lines", "hash_key_taxes", "melt_part_fields", "report_rows",
    "upsert_lineitem_latest", "incremental_orders", "orphan_recovery", "stream_merge_events",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in cursor.fetchall()), key=repr)
    assert mine == theirs


def test_rejects_agree_with_sql(spark, duck):
    test_agrees_with_sql(spark, duck, "committed_rejects")


def test_backfill_of_any_months(spark, tmp_path):
    days = ["2023-11-30", "2024-01-01", "2024-01-11", "2024-01-31", "2024-03-05", None]
    rows = spark.createDataFrame([(i, "view", 1.5 * i, d) for i, d in enumerate(days)], "event_id long, event_type string, value double, ts string")
    for name, events in (("some", rows), ("none", rows.limit(0))):
        events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / name / "events.parquet"))
    got = entry.queries()["stitched_backfill"](spark, str(tmp_path / "some")).collect()
    assert sorted((r["id"], r["value"]) for r in got) == [(i, 1.5 * i) for i in range(len(days))]
    assert entry.queries()["stitched_backfill"](spark, str(tmp_path / "none")).isEmpty()


def test_nest_splits_a_hot_key(spark, tmp_path):
    """A key with a third of all rows, all of them equal, still gives documents of bounded size."""
    rows = [(0, "same")] * 3000 + [(i, "x") for i in range(1, 6001)]
    spark.createDataFrame(rows, "k int, v string").repartition(4).write.parquet(str(tmp_path / "hot"))
    df = nest(spark.read.parquet(str(tmp_path / "hot")), ["k"], F.struct("v"), "items", per_document=100)
    sizes = df.select("k", F.size("items").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 9000
    hot = [r["n"] for r in sizes if r["k"] == 0]
    assert len(hot) > 20 and max(hot) < 250


def test_nest_shuffles_rows_once(spark, tmp_path):
    """The keys that need several documents are known before the rows move; nothing else is shuffled with them."""
    spark.createDataFrame([(i % 50, "x") for i in range(500)], "k int, v string").write.parquet(str(tmp_path / "rows"))
    df = nest(spark.read.parquet(str(tmp_path / "rows")), ["k"], F.struct("v"), "items")
    assert df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert sorted((r["k"], len(r["items"])) for r in df.collect()) == [(i, 10) for i in range(50)]


def _order_tables(spark, folder):
    """Orders with and without lines, one without a key, one of two documents, and one whose customer is not there."""
    orders = [(1, 7, "O", 10.5, "1-URGENT"), (2, 7, "F", 20.0, None), (3, 8, "P", 30.0, "5-LOW"), (None, 8, "O", 1.0, "2-HIGH"), (4, 99, "O", 2.0, "5-LOW")]
    frame = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    frame.withColumn("o_orderdate", F.lit("2024-01-02").cast("timestamp_ntz")).write.parquet(f"{folder}/orders.parquet")
    lines = [(k, 5, 6, n, 1.0, 0.01 * n, 0.0, 0.1, "A", "O") for k, some in ((1, 450), (2, 3), (None, 2), (77, 1)) for n in range(some)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines, f"{schema}, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(7, "A"), (8, "B")], "c_custkey long, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_report_writes_only_what_it_reads(spark, tmp_path, monkeypatch, rows_of):
    from recordloom.queries import shapes

    written = []
    monkeypatch.setattr(shapes, "stage", lambda df, put=shapes.stage: written.append(df.schema) or put(df))
    sf = _order_tables(spark, tmp_path)
    columns = ("segment", "status", "orders", "lines", "revenue_cents")
    cents = sum(range(450))
    assert rows_of(shapes.segment_revenue(spark, sf), *columns) == [("A", "F", 2, 453, cents + 3)]
    assert "price" in written[0].simpleString() and not {"taxRate", "payments", "quantity"} & set(re.findall(r"\w+", written[0].simpleString()))
    assert ("B", "P", 1, 0, 0) in rows_of(shapes.segment_revenue_all(spark, sf), *columns)


def test_bridge_of_orders_parses_its_fields_once(spark, tmp_path, rows_of):
    from recordloom.queries import shapes

    sf = _order_tables(spark, tmp_path)
    got = shapes.pricing_features(spark, sf)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # once for the orders with lines and once for those without, and no more of a document than the bridge takes
    assert plan.count("from_json(") == 2 and "StructField(selections" not in "".join(re.findall(r"from_json\((.*?)invoke\(", plan))
    assert rows_of(got, "orders_id", "pricing_feature") == sorted(
        [("1", "1-URGENT"), ("1", "O"), ("2", "F"), ("3", "5-LOW"), ("3", "P"), ("4", "5-LOW"), ("4", "O")]
    )


def test_fields_only():
    from pyspark.sql import types as T
    from recordloom.spec import ddl_of, fields_only

    whole = T._parse_datatype_string("a string, b array<struct<c:int, d:struct<e:int,f:int>>>, g int")
    assert ddl_of(fields_only(whole, ["b.d.f", "a", "b.c"])) == "struct<`a`:string,`b`:array<struct<`c`:int,`d`:struct<`f`:int>>>>"
    with pytest.raises(KeyError):
        fields_only(whole, ["b.x"])
