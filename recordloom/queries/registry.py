"""Register of the named queries, and how nested inputs are made from the flat tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.store import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ELEMENTS_PER_DOCUMENT = 200


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def nest(
    df: DataFrame,
    keys: Sequence[str],
    element: Column,
    name: str,
    per_document: int = ELEMENTS_PER_DOCUMENT,
    part_as: str | None = None,
) -> DataFrame:
    """Rows of a key to documents with an array, the way an interface pages a long list.

    Each key is split into as many documents as its own rows need, so no array grows without bound and small keys
    stay whole. The split is by file and row number, which spreads equal rows as well and is the same again when a
    task is repeated. Rows per key are counted before the shuffle; only keys that need several documents, of which there are few, are joined back.
    These keys are written down first: their size is known then, and where it is small the rows are not shuffled to meet them.
    ``part_as`` names a column for the number of the document within its key.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    held = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count("*").alias("_held")).filter(F.col("_held") > per_document)
    held = stage(held)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    rows = df.withColumn("_place", place).join(held, same, "left")
    parts = F.coalesce(F.ceil(F.col("_held") / per_document), F.lit(1))
    rows = rows.withColumn("_part", F.pmod("_place", parts))
    group = [*keys, "_part"]
    # collecting lists does not shrink anything, so rows are shuffled once and grouped after it
    documents = rows.repartition(*[F.col(c) for c in group]).groupBy(*group).agg(F.collect_list(element).alias(name))
    return documents.withColumnRenamed("_part", part_as) if part_as else documents.drop("_part")


def iso(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def cents(c: Column | str) -> Column:
    """Money as a whole number of hundredths: sums are exact in any order."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")
