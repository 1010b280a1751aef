"""Exports read in parallel, pushed reads, commits by period, ledgers of windows, frontiers, streams, shapes, deep trees."""

import csv
import io
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordloom.operators import incremental as I
from recordloom.operators import merge as M
from recordloom.operators import relate as R
from recordloom.operators import shred as S
from recordloom.operators import windows as W
from recordloom.periods import PeriodTable
from recordloom.sources import csv_records, land_by_day, parse_pages, read_bulk_csv, split_bulk_csv
from recordloom.sources.shape import paths_of, shape_of, shaped
from recordloom.spec import Policy, TableSpec
from recordloom.store import TableStore
from recordloom.streaming import late_rows, trailing_stream


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size if n.endswith("PartitionBytes") else 1)) for n in names]
    for n, v in before.items():
        spark.conf.set(n, v)


# bulk CSV


def test_csv_records_cross_splits(spark, tmp_path, small_splits):
    r, rows = random.Random(4), []
    for i in range(300):
        text = "".join(r.choice(['a', '"', "\n", ",", "\r\n", " ", "é"]) for _ in range(r.choice([0, 3, 8, 60])))
        rows.append([str(i), text, "x" * r.randrange(5)])
    for part in range(2):
        with open(tmp_path / f"p{part}.csv", "w", newline="", encoding="utf8") as f:
            w = csv.writer(f, lineterminator="\r\n" if part else "\n")
            w.writerows([["id", "text", "mark"], *rows[part::2]])
    small_splits(97)
    records = csv_records(spark, str(tmp_path))
    assert records.select("split").distinct().count() > 40
    got = [next(csv.reader(io.StringIO(t.text, newline=""))) for t in records.collect() if t.text]
    assert sorted(got) == sorted([*rows, ["id", "text", "mark"], ["id", "text", "mark"]])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    cells = {r.id: r for r in read_bulk_csv(spark, str(tmp_path)).collect()}
    assert len(cells) == 300 and all((cells[i].text or "").strip() == t.strip() for i, t, _ in rows if not t.strip())
    assert all(cells[i].text == t for i, t, _ in rows if t.strip() and "\r" not in t)


def test_csv_headers_and_malformed_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Client.Name\n1,"a ""b"""\n\n2\n3,x,y\n')
    rows, bad = split_bulk_csv(spark, str(tmp_path))
    assert [tuple(r) for r in rows.collect()] == [("1", 'a "b"')]
    assert sorted(r.body for r in bad.collect()) == ["2", "3,x,y"]
    assert read_bulk_csv(spark, str(tmp_path), ["x", "y"]).columns == ["x", "y"]
    (tmp_path / "b.csv").write_text("id,other\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_bulk_csv(spark, str(tmp_path))


def test_empty_export(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n")
    assert read_bulk_csv(spark, str(tmp_path)).count() == 0
    assert read_bulk_csv(spark, str(tmp_path)).columns == ["id", "name"]


def test_parse_pages_keeps_what_it_cannot_read(spark):
    pages = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": '), (3, '{"a": "x"}'), (4, None), (5, "{}")], "n int, body string")
    good, bad = parse_pages(pages, "a int")
    assert sorted((r.n, r.page.a) for r in good.collect()) == [(1, 1), (5, None)]
    assert sorted((r.n, r.reason, r.body) for r in bad.collect()) == [
        (2, "malformed json", '{"a": '), (3, "other type than declared", '{"a": "x"}'), (4, "malformed json", None)
    ]


# reads by policy


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def landed(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i), None if i % 3 else datetime(2024, 1, 2) + timedelta(hours=i)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, created_at timestamp_ntz, updated_at timestamp_ntz")
    df = df.withColumn("text", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"))
    land_by_day(df, str(tmp_path / "t"), F.coalesce("updated_at", "created_at"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_two_cursors_reach_the_scan(landed):
    spec = TableSpec("t", ("id",), policy=Policy.MODIFIED, cursor=("updated_at", "created_at"))
    got = I.read_by_policy(landed, spec, {"cursor": "2024-01-15 10:00:00"}, landed="landed_on")
    want = [r.id for r in landed.collect() if (r.updated_at or r.created_at) >= datetime(2024, 1, 15, 10)]
    assert sorted(r.id for r in got.collect()) == sorted(want)
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(landed_on" in plan
    assert "PushedFilters: [Or(GreaterThanOrEqual(updated_at" in plan


def test_text_cursor_reaches_the_scan(landed, spark):
    spec = TableSpec("t", ("id",), policy=Policy.MODIFIED, cursor=("text",))
    got = I.read_by_policy(landed, spec, {"cursor": "2024-01-15 10:00:00"})
    assert got.count() == sum(r.created_at >= datetime(2024, 1, 15, 10) for r in landed.collect())
    assert "GreaterThanOrEqual(text,2024-01-13)" in plan_of(got)
    odd = spark.createDataFrame([("2024-1-20 00:00:00",), ("+2024-01-20",), ("2024-01-14T23:00:00-12:00",), ("x",), (None,), ("2024-01-14",)], "text string")
    assert I.read_by_policy(odd, spec, {"cursor": "2024-01-15 10:00:00"}).count() == 3


def test_windows_of_any_column(landed, spark):
    appointments = spark.createDataFrame([("1", "14-Jan-2024 10:00:00"), ("2", "20-Jan-2026 10:00:00"), ("3", None)], "booking_id string, start_time string")
    from recordloom.plans.bookings import SPECS

    spec = SPECS["appointments"]
    assert [r.booking_id for r in I.read_by_policy(appointments, spec, {}, "2024-06-01").collect()] == ["1"]
    bare = TableSpec("t", ("id",), policy=Policy.WINDOW, window_days=3)
    assert I.read_by_policy(landed, bare, {}, "2024-01-20").count() == 600
    last = I.read_by_policy(landed, bare, {}, "2024-01-20", "landed_on")
    assert "PartitionFilters: [isnotnull(landed_on" in plan_of(last) and 0 < last.count() < 600


def test_due_scopes_prune_partitions(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 20 AS scope").write.partitionBy("scope").parquet(str(tmp_path / "s"))
    spark.createDataFrame([(3, 1), (5, 1), (7, 0)], "scope long, due int").write.parquet(str(tmp_path / "d"))
    due = spark.read.parquet(str(tmp_path / "d")).filter("due = 1")
    got = I.read_scopes(spark.read.parquet(str(tmp_path / "s")), due, "scope")
    assert got.count() == 100 and "dynamicpruning" in plan_of(got)


# commits by period

SPEC = TableSpec("t", ("id",), delete_flag="gone")


def orders(spark, n, run=1):
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(id div 100)")
    return spark.range(n).select("id", at.alias("placed"), F.md5(F.col("id").cast("string")).alias("text"), F.lit(False).alias("gone"), F.lit(run).alias("run"))


def folder_bytes(path):
    return {
        os.path.relpath(d, path): sum(os.path.getsize(f"{d}/{f}") for f in files if f.endswith(".parquet"))
        for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)
    }


def test_small_delta_rewrites_little(spark, tmp_path):
    t = PeriodTable(spark, str(tmp_path), SPEC, F.date_format("placed", "yyyy-MM"), target_bytes=20_000)
    t.commit(orders(spark, 100_000), ["run"])
    assert t.about()["buckets"] > 1
    before = folder_bytes(f"{tmp_path}/t/data")
    files = {f for d, _, fs in os.walk(f"{tmp_path}/t/data") for f in fs}
    delta = orders(spark, 100_000, 2).filter("id between 50000 and 50199").withColumn("text", F.lit("new"))
    touched = t.commit(delta, ["run"])
    rewritten = sum(before[f"_period={p}/_bucket={b}"] for p, b in touched)
    assert rewritten < 0.05 * sum(before.values())
    kept = {f for d, _, fs in os.walk(f"{tmp_path}/t/data") for f in fs}
    assert len(files & kept) > 0.9 * len(files)
    assert t.read().count() == 100_000 and t.read().filter("text = 'new'").count() == 200
    assert not os.listdir(f"{tmp_path}/t/staged")


def test_rows_move_vanish_and_come_again(spark, tmp_path, rows_of):
    t = PeriodTable(spark, str(tmp_path), SPEC, F.date_format("placed", "yyyy-MM-dd"))
    t.commit(orders(spark, 300), ["run"], {"cursor": 1})
    second = orders(spark, 300, 2)
    moved = second.filter("id < 100").withColumn("placed", F.expr("timestamp_ntz'2024-02-01'"))  # the first day is left without rows
    gone = second.filter("id between 100 and 149").withColumn("gone", F.lit(True))
    keyless = second.filter("id = 299").withColumn("id", F.lit(None).cast("long"))
    undated = spark.createDataFrame([(900, None, "x", False, 2)], "id long, placed timestamp_ntz, text string, gone boolean, run int")
    delta = moved.union(gone).union(keyless).union(undated)
    for _ in range(2):  # a commit that is run again gives the same table
        t.commit(delta, ["run"], {"cursor": 2})
        rows = {r.id: r for r in t.read().collect()}
        assert len(rows) == t.read().count() == 251 and rows[5].placed == datetime(2024, 2, 1) and rows[900].placed is None
        assert 120 not in rows and rows[299].text == orders(spark, 300).filter("id = 299").first().text
    assert t.state() == {"cursor": 2}
    assert t.rejects().count() == 2 and t.rejects().first().reason == "missing key: id"
    found = [(s["commit"], s.rows, s.upserts, s.deletes, s.rejects, s.no_period) for s in t.summaries().collect()]
    assert found == [(1, 300, 300, 0, 0, 0), (2, 152, 101, 50, 1, 1), (3, 152, 101, 50, 1, 1)]


def test_new_columns_and_empty_commits(spark, tmp_path):
    t = PeriodTable(spark, str(tmp_path), TableSpec("t", ("k.x",)), F.lit("a/b=c"))
    t.commit(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "`k.x` int, v string, run int"), ["run"])
    t.commit(spark.createDataFrame([(2, 5.0, 2), (2, 4.0, 1)], "`k.x` int, w double, run int"), ["run"])
    assert sorted(map(tuple, t.read().select("`k.x`", "v", "w").collect()), key=repr) == [(1, "a", None), (2, None, 5.0)]
    assert t.commit(spark.createDataFrame([], "`k.x` int, w double, run int"), ["run"], {"s": 1}) == []
    assert t.read().count() == 2 and t.state() == {"s": 1}


# windows


def test_islands_and_gaps_equal_brute_force(spark):
    r, rows = random.Random(8), []
    for scope in "abcd":
        for _ in range(r.randrange(1, 12)):
            low = r.randrange(0, 90)
            rows.append((scope, low, low + r.choice([0, 1, 3, 20])))
    day = "timestamp_ntz'2024-01-01' + make_dt_interval({})"
    ledger = spark.createDataFrame(rows, "scope string, a int, b int").selectExpr("scope", f"{day.format('a')} AS low", f"{day.format('b')} AS high")
    scopes = spark.createDataFrame([(s,) for s in "abcde"], "scope string")
    start, end = datetime(2024, 1, 6), datetime(2024, 3, 21)
    gaps = W.missing_windows(ledger, str(start), str(end), ["scope"], scopes).collect()
    base = datetime(2024, 1, 1)
    for s in "abcde":
        have = {d for scope, a, b in rows if scope == s for d in range(a, b)}
        want = {d for d in range(5, 80) if d not in have}
        got = [(g.low, g.high) for g in gaps if g.scope == s]
        assert {d for low, high in got for d in range((low - base).days, (high - base).days)} == want
        assert all(a[1] < b[0] for a, b in zip(sorted(got), sorted(got)[1:]))
    joined = W.islands(ledger, ["scope"]).collect()
    for s in "abcd":
        have = {d for scope, a, b in rows if scope == s for d in range(a, b)}
        assert sum((i.high - i.low).days for i in joined if i.scope == s) == len(have)


def test_backfill_goes_on_where_windows_are_missing(spark, tmp_path):
    events = spark.range(240).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts")
    ledger = W.WindowLedger(spark, str(tmp_path), ["shop"])
    asked = []

    def fetch(low, high):
        asked.append((low, high))
        if len(asked) == 3:
            raise RuntimeError("quota")
        return events.filter(W.covered("ts", [(F.lit(str(low)).cast("timestamp_ntz"), F.lit(str(high)).cast("timestamp_ntz"))]))

    low, high = datetime(2024, 1, 1), datetime(2024, 1, 11)
    with pytest.raises(RuntimeError):
        W.backfill(ledger, fetch, low, high, days=2, shop="a")
    assert ledger.rows().count() == 96
    W.backfill(ledger, fetch, low, high, days=2, shop="a")
    assert asked[2] == asked[3] and ledger.rows().count() == 240
    assert W.backfill(ledger, fetch, low, high, days=2, shop="a") == []
    assert len(W.backfill(ledger, fetch, low, high, days=9, shop="b")) == 2
    assert W.islands(ledger.read(), ["shop"]).count() == 2


# references


def test_recovery_reports_what_it_did(spark, rows_of):
    chain = spark.createDataFrame([(i, i + 1 if i < 6 else None) for i in range(1, 7)], "id int, next int")
    facts = spark.createDataFrame([(1, 9), (1, 1), (None, 2)], "a int, b int")
    refs = [R.Reference("facts", "a", "parts"), R.Reference("facts", "b", "parts"), R.Reference("parts", "next", "parts")]
    tables = {"facts": facts, "parts": chain.filter("id = 2")}
    out = R.complete_references(tables, {"parts": chain.filter("id <> 5")}, refs, {"parts": "id"})
    assert rows_of(out.rows["parts"], "id") == [(1,), (3,), (4,)] and out.converged
    assert rows_of(out.not_found["parts"]) == [(5,), (9,)] and rows_of(out.found["parts"]) == [(1,), (3,), (4,)]
    empty = {"facts": facts, "parts": chain.limit(0)}
    out = R.complete_references(empty, {"parts": chain.filter("id <> 5")}, refs, {"parts": "id"})
    assert rows_of(out.rows["parts"], "id") == [(1,), (2,), (3,), (4,)] and rows_of(out.not_found["parts"]) == [(5,), (9,)]
    assert out.converged and out.rounds == 4
    out = R.complete_references(empty, {"parts": chain}, refs, {"parts": "id"}, max_rounds=2)
    assert not out.converged and out.rounds == 2
    ring = spark.createDataFrame([(1, 2), (2, 1)], "id int, next int")
    out = R.complete_references(empty, {"parts": ring}, refs, {"parts": "id"}, resolved={"parts": spark.createDataFrame([(9,)], "id int")})
    assert out.converged and rows_of(out.rows["parts"], "id") == [(1,), (2,)] and rows_of(out.not_found["parts"]) == []


# merges


def test_sparse_merge_has_no_sort_aggregate(spark, rows_of):
    target = spark.createDataFrame([(1, "a", 1.0, None), (2, "b", 2.0, [1])], "`k.x` int, s string, d double, l array<int>")
    delta = spark.createDataFrame(
        [(1, 1, None, 9.0, None, ["s", "d"]), (1, 2, "z", 5.0, None, ["s"]), (2, 1, "q", None, None, ["l"]), (3, 1, None, None, None, []), (4, 1, "n", None, [7], ["s", "l"])],
        "`k.x` int, run int, s string, d double, l array<int>, present array<string>",
    )
    out = M.upsert_sparse(target, delta, ["k.x"], ["run"])
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "z", 9.0, None), (2, "b", 2.0, None), (3, None, None, None), (4, "n", None, [7])]
    assert "SortAggregate" not in plan_of(out)


def test_keys_with_dots(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "`k.x` int, v string")
    delta = spark.createDataFrame([(2, "c", 1, "U"), (3, "d", 1, "D")], "`k.x` int, v string, `r.n` int, _op string")
    assert sorted(map(tuple, M.upsert(target, delta.drop("_op"), ["k.x"], ["r.n"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, M.apply_changes(target, delta, ["k.x"], ["r.n"]).collect())) == [(1, "a"), (2, "c")]
    assert M.drop_keys(target, delta, ["k.x"]).count() == 1
    assert M.reconcile_snapshot(target, delta, ["k.x"]).first()[0] == 1
    store = TableStore(spark, str(tmp_path))
    M.commit(store, TableSpec("t", ("k.x",)), delta.drop("_op"), ["r.n"])
    M.commit(store, TableSpec("t", ("k.x",)), delta.withColumn("v", F.lit("e")), ["r.n"])
    assert sorted(map(tuple, store.read("t").collect())) == [(2, "e")]


# shapes and trees


def test_keys_that_are_data_become_maps(spark):
    days = ",".join('"d%05d":{"n":%d,"s":"x"}' % (i, i) for i in range(3000))
    texts = ['{"id":1,"days":{%s},"tags":["a"],"mixed":1,"empty":{},"deep":{"a":{"b":[{"c":1.5}]}}}' % days, '{"id":2,"mixed":"x","gone":null}', '{"Id.x":3}', "7"]
    df = spark.createDataFrame([(t,) for t in texts[:3]], "t string").select(F.parse_json("t").alias("record"))
    shape = shape_of(df, most_keys=100)
    kinds = {f.name: f.dataType.simpleString() for f in shape.fields}
    assert kinds["days"] == "map<string,struct<n:bigint,s:string>>" and kinds["tags"] == "array<string>" and kinds["mixed"] == "string"
    assert kinds["deep"] == "struct<a:struct<b:array<struct<c:decimal(2,1)>>>>" and "Id.x" in kinds and kinds["gone"] == "string"
    assert len(paths_of(df, most_keys=100)) < 25
    rows = shaped(df, most_keys=100)
    assert rows.filter("id = 1").select(F.size("days")).first()[0] == 3000
    assert shaped(spark.createDataFrame([("7",)], "t string").select(F.parse_json("t").alias("record"))).first()[0] == 7
    assert shape_of(df.limit(0)).fields == []


def test_trees_of_mixed_depth(spark):
    texts = [(1, '[{"n":"a","b":[{"n":"c","b":"text"},{"n":"d","b":[]}]},{"n":"e"}]'), (2, "[]"), (3, None), (4, '{"n":1}')]
    deep = "[" + '{"n":"x","b":[' * 150 + '{"n":"leaf"}' + "]}" * 150 + "]"
    df = spark.createDataFrame([*texts, (5, deep)], "`k.x` int, t string").select("`k.x`", F.try_parse_json("t").alias("t"))
    got = S.walk_levels(df, F.col("t"), "b", ["k.x"]).select("`k.x`", "depth", "path", S.node_text("n").alias("n"), S.node_text("n", "parent").alias("p")).collect()
    assert {(r[1], tuple(r[2]), r[3], r[4]) for r in got if r[0] == 1} == {(0, (0,), "a", None), (0, (1,), "e", None), (1, (0, 0), "c", "a"), (1, (0, 1), "d", "a")}
    assert max(r.depth for r in got if r[0] == 5) == 150 and len(got) == 4 + 151
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT"):
        S.walk_levels(df, F.col("t"), "b", ["k.x"], most=20).collect()


# streams


def test_late_rows_of_a_stream(spark, tmp_path):
    def land(name, rows):
        spark.createDataFrame(rows, "id long, ts timestamp, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    day = datetime(2024, 1, 1)
    land("a", [(i, day + timedelta(days=i), "a") for i in range(20)])
    land("b", [(19, day + timedelta(days=19), "again"), (30, day + timedelta(days=30), "b")])
    land("c", [(99, day, "late"), (18, day + timedelta(days=18), "repeat"), (31, day + timedelta(days=27), "in time"), (None, day, "keyless")])
    store, spec = TableStore(spark, f"{tmp_path}/store"), TableSpec("t", ("id",))
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for _ in range(2):  # stopped and started again: nothing new
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        trailing_stream(stream, store, spec, "ts", 10, ["ts"], f"{tmp_path}/cp", buckets=2).awaitTermination()
        assert sorted(r.id for r in store.read("t").collect()) == [*range(20), 30, 31]
        assert [r.id for r in late_rows(spark.read.parquet(f"{tmp_path}/in"), store, spec).collect()] == [99]
