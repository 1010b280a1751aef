"""Which windows of time a table has been read for: a ledger, what it covers, what is missing.

The ledger is a table with a row for each window that was read to its end: ``scope`` columns, ``low`` and ``high`` (half open).
Windows may overlap, repeat and come in any order. They are merged as islands: a window begins a new one where it starts
after everything before it has ended. All of it is one window function per scope; a scope's windows are as many as the runs that read it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.operators.flatten import at


def islands(ledger: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Stretches without a gap: scope, low, high. Windows that only touch are one stretch; empty windows are none."""
    names = [f"`{c}`" for c in scope]
    ordered = Window.partitionBy(*names).orderBy("low", "high")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    sound = ledger.filter("low < high").select(*names, "low", "high")
    starts = sound.withColumn("_new", F.when(F.col("low") <= F.max("high").over(before), 0).otherwise(1))
    numbered = starts.withColumn("_island", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*names, "_island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_island")


def missing_windows(ledger: DataFrame, low, high, scope: Sequence[str] = (), scopes: DataFrame | None = None) -> DataFrame:
    """What of [low, high) no window covers: scope, low, high. ``scopes`` names scopes that may have no window yet."""
    kind = ledger.schema["low"].dataType
    names = [f"`{c}`" for c in scope]
    ends = [F.lit(v).cast(kind) for v in (low, high)]
    everything = scopes.select(*names).distinct() if scopes is not None else ledger.select(*names).distinct() if scope else ledger.sparkSession.range(1).select()
    # an empty stretch at the end closes the last gap of each scope
    closing = everything.select(*names, ends[1].alias("low"), ends[1].alias("high"))
    inside = islands(ledger, scope).filter((F.col("high") > ends[0]) & (F.col("low") < ends[1]))
    ordered = Window.partitionBy(*names).orderBy("low", "high")
    since = F.coalesce(F.lag("high").over(ordered), ends[0])
    gaps = inside.select(*names, "low", "high").unionByName(closing).select(*names, since.alias("_from"), F.col("low").alias("_to"))
    return gaps.filter("_from < _to").select(*names, F.col("_from").alias("low"), F.col("_to").alias("high"))


def covered(column: str, windows: Iterable[tuple]) -> Column:
    """Does the time lie in one of the windows? Comparisons of the bare column, which reach the scan."""
    return reduce(Column.__or__, [(at(column) >= F.lit(low)) & (at(column) < F.lit(high)) for low, high in windows], F.lit(False))


class WindowLedger:
    """The ledger of one table as files: a window is entered when its rows are written."""

    def __init__(self, spark: SparkSession, folder: str, scope: Sequence[str] = ()):
        self.spark, self.folder, self.scope = spark, folder.rstrip("/"), tuple(scope)

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self) -> DataFrame:
        columns = ", ".join([*(f"`{c}` string" for c in self.scope), "low timestamp_ntz", "high timestamp_ntz", "batch string"])
        return self.spark.read.schema(columns).parquet(f"{self.folder}/ledger") if self._exists("ledger") else self.spark.createDataFrame([], columns)

    def append(self, rows: DataFrame, low: datetime, high: datetime, **scope: str) -> str:
        """Write a window's rows, then enter it. A batch that no entry names was not finished and is never read."""
        batch = uuid.uuid4().hex
        rows.write.parquet(f"{self.folder}/rows/batch={batch}")
        entry = [F.lit(scope[c]).alias(c) for c in self.scope]
        bounds = [F.lit(str(v)).cast("timestamp_ntz").alias(n) for n, v in (("low", low), ("high", high))]
        self.spark.range(1).select(*entry, *bounds, F.lit(batch).alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")
        return batch

    def rows(self) -> DataFrame | None:
        """Rows of all finished windows, with ``batch``; rows on overlaps come once for each window."""
        if not self._exists("ledger"):
            return None
        finished = self.read().select("batch")
        return self.spark.read.parquet(f"{self.folder}/rows").join(finished, "batch", "left_semi")


def backfill(
    ledger: WindowLedger,
    fetch: Callable[[datetime, datetime], DataFrame],
    low: datetime,
    high: datetime,
    days: int = 30,
    most: int | None = None,
    **scope: str,
) -> list[tuple[datetime, datetime]]:
    """Read what of [low, high) is missing, in steps of at most ``days``, and enter each step when its rows are written.

    A stopped run goes on where windows are missing, whatever order they were read in. ``most`` bounds the steps of a run. Nothing is merged here:
    the appended rows of all steps are merged once, by key, when the caller commits ``ledger.rows()``.
    """
    entries = ledger.read()
    for c, v in scope.items():
        entries = entries.filter(at(c) == v)
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("low", "high")]
    gaps = sorted(tuple(map(datetime.fromisoformat, r)) for r in missing_windows(entries, str(low), str(high)).select(*text).collect())
    steps = []
    for start, end in gaps:
        while start < end:
            steps.append((start, min(end, start + timedelta(days=days))))
            start = steps[-1][1]
    for start, end in steps[:most]:
        ledger.append(fetch(start, end), start, end, **scope)
    return steps[:most]
