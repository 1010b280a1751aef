"""Keys: made up, composed, required."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.scalars import all_not_null
from recordloom.spec import quote


def hash_key(columns: Sequence[Column | str], prefix: str = "gen-") -> Column:
    """Deterministic key of a row without an id: prefix and MD5 of the parts joined with ``_``.

    Missing parts count as empty text, so that the number of parts is always the same.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.md5(text))


def parent_index_key(parent: Column | str, pos: Column | str) -> Column:
    """``<parent>__<position>``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (parent, pos)]
    return F.concat_ws("__", *[p.cast("string") for p in parts])


def composite_key(text: str) -> list[str]:
    """Columns of a key written as ``a|b``."""
    return [part.strip() for part in text.split("|") if part.strip()]


def _known(df: DataFrame, pk: Sequence[str]) -> list[Column]:
    there = set(df.columns)
    return [F.nullif(F.col(quote(c)).cast("string"), F.lit("")) if c in there else F.lit(None).cast("string") for c in pk]


def key_reason(df: DataFrame, pk: Sequence[str]) -> Column:
    """Which key columns a row lacks, as a reason to refuse it; NULL for a row that has all.

    Empty text counts as lacking, and so does a column that the whole batch is without.
    """
    known = _known(df, pk)
    missing = F.concat_ws(", ", *[F.when(k.isNull(), F.lit(c)) for k, c in zip(known, pk, strict=True)])
    return F.when(~all_not_null(known), F.concat(F.lit("missing key: "), missing))


def require_key(df: DataFrame, pk: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that have all key columns and rejects that lack one, with ``reject_reason``."""
    has_all = all_not_null(_known(df, pk))
    return df.filter(has_all), df.filter(~has_all).withColumn("reject_reason", key_reason(df, pk))
