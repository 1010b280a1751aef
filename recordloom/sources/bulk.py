"""Bulk CSV exports as files: records are found in parallel, however many lines a cell spans.

A line that ends a file split may stand inside a quoted cell, so no split can tell its own records. It can tell how many
quotes it holds. One narrow pass counts, per split, the quotes and the lines that begin a record if the split begins
outside quotes, and if it begins inside. A running sum over the splits of a file (a few rows) then says which
case holds and which split owns the record that is still open. A second narrow pass cuts the records; only the pieces of records that
cross a split are brought together by key. So a file of any size is read by as many tasks as it has splits.

Files follow RFC 4180: cells with quotes, separators or line ends are quoted, quotes in them are doubled. Each file begins
with the same header. The rows of a split come in file order, as Spark's text source gives them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.sources.landing import _bulk_cell
from recordloom.spec import quote

CORRUPT = "_corrupt"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with file and start of the split; only line feeds end a line, so that carriage returns in cells stay."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))


def _count_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, quotes, records that begin if the split begins outside quotes, and inside)."""
    at, state = None, [0, 0, 0]

    def row() -> pa.RecordBatch:
        values = [*at, *state]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["file", "split", "quotes", "outside", "inside"])

    for batch in batches:
        for file, split, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (file, split) != at:
                if at:
                    yield row()
                at, state = (file, split), [0, 0, 0]
            state[1 + state[0] % 2] += 1
            state[0] += line.count('"')
    if at:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (file, split, number, piece, text); piece is null for a whole record, else the split the piece stands in.

    Rows come with ``open`` (the split begins inside quotes) and the ``owner`` of the record that is open then.
    """
    at, quotes, key, held, crossing = None, 0, None, [], False
    out: list[tuple] = []

    def close(whole: bool) -> None:
        if held:
            out.append((at[0], *key, None if whole and not crossing else at[1], "\n".join(held)))

    for batch in batches:
        for file, split, line, opened, owner_split, owner_number in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if (file, split) != at:
                close(quotes % 2 == 0)
                at, quotes, number, held, crossing = (file, split), opened, 0, [], bool(opened)
                key = (owner_split, owner_number)
            if quotes % 2 == 0:
                close(True)
                number += 1
                key, held, crossing = (split, number), [], False
            held.append(line)
            quotes += line.count('"')
        if out:
            columns, out = list(zip(*out)), []
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "split", "number", "piece", "text"])
    close(quotes % 2 == 0)
    if out:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["file", "split", "number", "piece", "text"])


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Records of CSV files as text, with file, split and number in the split; a file's header is number 1 of split 0."""
    lines = _lines(spark, path)
    counts = lines.mapInArrow(_count_splits, "file string, split long, quotes long, outside long, inside long")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    begun = F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside"))
    splits = (
        counts.withColumn("open", opened.cast("int"))
        .withColumn("begun", begun)
        .select(
            "file", "split", "open",
            F.last(F.when(F.col("begun") > 0, F.col("split")), ignorenulls=True).over(before).alias("owner_split"),
            F.last(F.when(F.col("begun") > 0, F.col("begun")), ignorenulls=True).over(before).alias("owner_number"),
        )
    )
    placed = lines.withColumn("_row", F.monotonically_increasing_id()).join(splits, ["file", "split"])
    # the join may shuffle where a file has very many splits; the number of the row restores the order
    ordered = placed.sortWithinPartitions("file", "split", "_row").select("file", "split", "line", "open", "owner_split", "owner_number")
    cut = ordered.mapInArrow(_cut, "file string, split long, number long, piece long, text string")
    pieces = F.array_sort(F.collect_list(F.struct("piece", "text")))
    crossing = (
        cut.filter("piece is not null")
        .groupBy("file", "split", "number")
        .agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"))
    )
    whole = cut.filter("piece is null").select("file", "split", "number", "text")
    return whole.unionByName(crossing).withColumn("text", F.regexp_replace("text", "\r$", ""))


def _header(records: DataFrame) -> list[str]:
    """Column names of the first file; fails where another file has other ones."""
    headers = [r["text"] for r in records.filter("split = 0 and number = 1").select("text").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers}")
    return next(csv.reader(headers)) if headers else []


def split_bulk_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a bulk export, every column text, and what is no row: (file, reason, body).

    A record with more or fewer cells than the header is malformed; its text is kept as it stands. Empty lines are skipped. Without ``columns``
    the names come from the header.
    """
    records = csv_records(spark, path)
    names = list(columns or _header(records))
    ddl = ", ".join(f"{quote(c)} string" for c in [*names, CORRUPT])
    body = records.filter("not (split = 0 and number = 1) and trim(text) != ''")
    parsed = body.select("file", "text", F.from_csv("text", ddl, {"escape": '"', "columnNameOfCorruptRecord": CORRUPT}).alias("_row"))
    bad = F.col(f"_row.{CORRUPT}").isNotNull()
    rows = parsed.filter(~bad).select(*[_bulk_cell(F.col(f"_row.{quote(c)}")).alias(c) for c in names])
    return rows, parsed.filter(bad).select("file", F.lit("malformed csv").alias("reason"), F.col("text").alias("body"))


def read_bulk_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a bulk export with a header; every column is text, blanks are NULL, JSON in cells is compact."""
    return split_bulk_csv(spark, path, columns)[0]


__all__ = ["CORRUPT", "csv_records", "read_bulk_csv", "split_bulk_csv"]
