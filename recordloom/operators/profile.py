"""Counts, shares and samples over the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.union, counts)


def run_summary(changes: DataFrame, table: str = "table", op: str = "op") -> DataFrame:
    """Changes per table and kind."""
    return changes.groupBy(table, op).agg(F.count("*").alias("rows"))


def max_value(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.max(column).alias(f"max_{column}"))


def distinct_dims(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values of each column."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def status_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per status. The total is a scalar subquery over the counts, whose shuffle is reused."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(column, "rows", (F.col("rows") / total).alias("share"))


def ordered_read(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*order)


def cap(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """At most ``n`` rows of an entity that is capped by design, in a given order."""
    return df.orderBy(*order).limit(n)


def report_sample(
    df: DataFrame, columns: Sequence[str], order: Sequence[Column | str], n: int, where: Column | str | None = None
) -> DataFrame:
    """Projection, filter, order and limit, as in a spot check."""
    rows = df.filter(where) if where is not None else df
    return rows.select(*columns).orderBy(*order).limit(n)
