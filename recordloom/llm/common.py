"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.store import checkpoint_dir, cut_lineage

# White space and words of the corpus contracts.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

FILE, ROW = "_rl_file", "_rl_row"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def split_words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts give none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write rows as Parquet into the shared folder and read them back: lineage ends, columns can be pruned."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/recordloom-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(df: DataFrame) -> DataFrame:
    """Add a key of the row that is the same at every evaluation: its file (hashed) and its number in it.

    Rows that do not come straight from files are staged first. Equal rows get different places.
    """
    try:
        return df.select(
            "*", F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)
        )
    except AnalysisException:
        return with_place(stage(df))


__all__ = [
    "FILE", "LOWER", "ROW", "SPACE_RUN", "UPPER", "WORD", "ascii_lower", "cut_lineage", "free_name", "let", "split_words", "stage", "table",
    "with_place",
]
