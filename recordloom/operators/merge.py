"""Upserts, deletes and snapshot reconciliation.

Spark has no arrival order, so a delta carries sequence columns (run, page, position) and the
latest row per key is taken by them. Keys meet by equi-joins that adaptive execution may
broadcast or split when one key is skewed; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import at
from recordloom.operators.keys import key_reason, require_key  # noqa: F401  (part of this module as well)
from recordloom.spec import TableSpec, ddl_of, quote
from recordloom.store import BUCKET, TableStore, bucket_of

# Statuses that mean a record is gone.
DELETED_STATUSES = ("DELETED", "VOIDED", "ARCHIVED")

OP = "_op"


def latest_per_key(df: DataFrame, pk: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The row with the highest sequence per key.

    ``row_number() = 1`` is pushed below the shuffle as a group limit: each task sends at most
    one row per key, so a key with a third of all rows costs no more than any other.
    """
    w = Window.partitionBy(*map(at, pk)).orderBy(*[at(c).desc_nulls_last() for c in seq])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _once_per_key(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """The rows, each key at most once, or a failure that names the key columns."""
    second = F.row_number().over(Window.partitionBy(*map(at, pk)).orderBy(*map(at, pk))) > 1
    failure = F.raise_error(F.lit(f"two rows of one key ({', '.join(pk)}) and no order between them")).cast("boolean")
    return df.withColumn("_second", second).filter(F.when(F.col("_second"), failure).otherwise(F.lit(True))).drop("_second")


def dedupe_run(df: DataFrame, pk: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The first row met per key in a run."""
    w = Window.partitionBy(*map(at, pk)).orderBy(*[at(c).asc_nulls_last() for c in seq])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(target: DataFrame, delta: DataFrame, pk: Sequence[str], seq: Sequence[str] = ()) -> DataFrame:
    """Target with the delta's latest rows put in by key. The delta may have new columns and lack old ones.

    Without ``seq`` the delta must hold each key once; a key that it repeats fails the job, since nothing says which row is later.
    """
    rows = latest_per_key(delta, pk, seq) if seq else _once_per_key(delta, pk)
    rows = rows.drop(*[c for c in seq if c not in target.columns and c not in pk])
    kept = target.join(rows.select(*map(at, pk)), list(pk), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def fold_sparse(delta: DataFrame, pk: Sequence[str], seq: Sequence[str] = (), present: str = "present") -> DataFrame:
    """One row per key with ``_set``: {column number: slot}, the last value of each column that some row sets.

    Changes are unpivoted to (key, column, order, slot); a slot has a field for each type among the columns, so that values keep their
    type, and number -1 stands for the key itself. The last change of a key and column is a group limit below the shuffle, so a hot
    key sends no more than one change per column and task, and what is left of a key is put together by hash aggregation.
    """
    columns = [c for c in delta.columns if c not in (*pk, *seq, present)]
    types = {c: ddl_of(delta.schema[c].dataType) for c in columns}
    kinds = list(dict.fromkeys(types.values()))
    names, order = [quote(c) for c in pk], [quote(c) for c in seq]

    def change(number: int, c: str | None) -> Column:
        slot = F.struct(*[(at(c) if c and types[c] == k else F.lit(None).cast(k)).alias(f"s{i}") for i, k in enumerate(kinds)])
        return F.struct(F.lit(number).alias("c"), slot.alias("s"))

    changes = [change(-1, None), *(F.when(F.array_contains(present, c), change(i, c)) for i, c in enumerate(columns))]
    long = delta.select(*names, *order, F.explode(F.filter(F.array(*changes), lambda x: x.isNotNull())).alias("_x"))
    last = latest_per_key(long.select(*names, *order, F.col("_x.c").alias("_c"), F.col("_x.s").alias("_s")), [*pk, "_c"], seq or ["_c"])
    return last.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_c", "_s"))).alias("_set"))


def upsert_sparse(
    target: DataFrame,
    delta: DataFrame,
    pk: Sequence[str],
    seq: Sequence[str] = (),
    present: str = "present",
) -> DataFrame:
    """Merge where a column that a row does not set keeps its stored value.

    Several delta rows of one key are folded first: per column the last row that sets it wins. A row that sets nothing still brings its key.
    """
    columns = [c for c in delta.columns if c not in (*pk, *seq, present)]
    kinds = list(dict.fromkeys(ddl_of(delta.schema[c].dataType) for c in columns))
    folded = fold_sparse(delta, pk, seq, present)
    joined = target.join(folded, list(pk), "full_outer")
    stored = [c for c in target.columns if c not in pk]
    out = [at(c) for c in pk]
    for c in [*stored, *[c for c in columns if c not in stored]]:
        old = at(c) if c in stored else F.lit(None)
        if c not in columns:
            out.append(old.alias(c))
        else:
            number = columns.index(c)
            new = F.col("_set")[number][f"s{kinds.index(ddl_of(delta.schema[c].dataType))}"]
            out.append(F.when(F.coalesce(F.map_contains_key("_set", F.lit(number)), F.lit(False)), new).otherwise(old).alias(c))
    return joined.select(*out)


def tombstone_flag(delta: DataFrame, flag: str = "deleted") -> DataFrame:
    """Mark rows whose flag is true as deletes (``_op`` ``D``), the others as upserts (``U``)."""
    return delta.withColumn(OP, F.when(F.coalesce(F.col(flag).cast("boolean"), F.lit(False)), "D").otherwise("U"))


def tombstone_status(delta: DataFrame, status: str, statuses: Sequence[str] = DELETED_STATUSES) -> DataFrame:
    """Mark rows whose status says that the record is gone as deletes."""
    return delta.withColumn(OP, F.when(F.col(status).isin(*statuses), "D").otherwise("U"))


def with_op(delta: DataFrame, spec: TableSpec) -> DataFrame:
    """Delta with the kind of each change, from the table's flag or status, or as it is marked already; upserts otherwise."""
    if spec.delete_flag and spec.delete_flag in delta.columns:
        return tombstone_flag(delta, spec.delete_flag)
    if spec.status_column and spec.status_column in delta.columns:
        return tombstone_status(delta, spec.status_column, spec.delete_statuses or DELETED_STATUSES)
    return delta if OP in delta.columns else delta.withColumn(OP, F.lit("U"))


def apply_changes(target: DataFrame, changes: DataFrame, pk: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Target after an ordered stream of upserts and deletes; per key the last change decides."""
    last = latest_per_key(changes, pk, seq)
    kept = target.join(last.select(*map(at, pk)), list(pk), "left_anti")
    rows = last.filter(F.col(OP) == "U").drop(OP, *[c for c in seq if c not in target.columns and c not in pk])
    return kept.unionByName(rows, allowMissingColumns=True)


def cascade_delete(children: DataFrame, parents_gone: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose parent was not deleted (``{child column: parent column}``)."""
    gone = parents_gone.select(*[at(p).alias(c) for c, p in on.items()]).distinct()
    return children.join(gone, list(on), "left_anti")


def route_delete_feed(
    feed: DataFrame, routing: Mapping[str, str], item_type: str = "item_type", item_id: str = "item_id"
) -> DataFrame:
    """Feed rows with the table they belong to; unknown types and missing ids are ignored.

    The routing is a fixed list of names, so it is a literal map and needs no join.
    """
    pairs = [F.lit(x) for pair in routing.items() for x in pair]
    table = F.create_map(*pairs)[F.col(item_type)] if pairs else F.lit(None).cast("string")
    return (
        feed.withColumn("table", table)
        .withColumn("id", F.nullif(F.col(item_id).cast("string"), F.lit("")))
        .filter("table is not null and id is not null")
    )


def apply_delete_feed(target: DataFrame, routed: DataFrame, table: str, id_column: str = "id") -> DataFrame:
    """Rows of one table that the feed does not name. Ids are compared as text."""
    gone = routed.filter(F.col("table") == table).select(F.col("id").alias("_gone")).distinct()
    return target.join(gone, F.col(id_column).cast("string") == F.col("_gone"), "left_anti")


def reconcile_snapshot(
    previous: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    scope: Sequence[str] = (),
    complete: DataFrame | None = None,
    within: Column | None = None,
) -> DataFrame:
    """Keys that were there before and are missing now: the hard deletes.

    Ids of different type are compared as text. With ``complete`` (scope columns and a ``complete`` flag, see
    ``snapshot_complete``) only scopes whose list was read to its end are compared; without a scope, all lists must have been. ``within``
    restricts the comparison to what the read could have returned at all, such as its window.
    """
    before = previous.filter(within) if within is not None else previous
    if complete is not None:
        whole = complete.filter("complete")
        if scope:
            before = before.join(whole.select(*scope), list(scope), "left_semi")
        else:
            # one list that was not read to its end, or none at all: nothing may count as missing
            short = complete.filter(~F.coalesce(F.col("complete"), F.lit(False)))
            before = before.filter(whole.exists() & ~short.exists())
    names = list(dict.fromkeys([*scope, *key]))

    same = {c for c in names if before.schema[c].dataType == current.schema[c].dataType}

    def key_of(c: str) -> Column:
        return at(c) if c in same else at(c).cast("string")

    now = current.select(*[key_of(c).alias(f"_k_{c}") for c in names]).distinct()
    for c in names:
        now = now.filter(at(f"_k_{c}").isNotNull())
    keyed = before.withColumns({f"_k_{c}": key_of(c) for c in names})
    missing = keyed.join(now, [f"_k_{c}" for c in names], "left_anti")
    return missing.select(*map(at, names))


def drop_keys(target: DataFrame, gone: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Target without the given keys."""
    return target.join(gone.select(*map(at, pk)), list(pk), "left_anti")


def active_rows(df: DataFrame, deleted: str = "deleted") -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(F.col(deleted).isNull())


def reject_log(rejects: DataFrame, table: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Rejected rows as ``table, reason, fields`` with each field written as ``name:type=value``."""
    names = [c for c in (columns or rejects.columns) if c != "reject_reason"]
    types = {f.name: f.dataType for f in rejects.schema.fields}

    def shown(c: str) -> Column:
        value = F.to_json(at(c)) if isinstance(types[c], (T.StructType, T.ArrayType, T.MapType, T.VariantType)) else at(c).cast("string")
        return F.concat(F.lit(f"{c}:{types[c].simpleString()}="), F.coalesce(value, F.lit("null")))

    return rejects.select(
        F.lit(table).alias("table"), F.col("reject_reason").alias("reason"), F.concat_ws(", ", *[shown(c) for c in names]).alias("fields")
    )


# ---- committing ----------------------------------------------------------------------------


def commit(
    store: TableStore,
    spec: TableSpec,
    delta: DataFrame,
    seq: Sequence[str],
    state: dict | None = None,
    buckets: int = 16,
) -> int:
    """Merge a delta into a stored table and advance its state in the same step.

    Only the buckets that the delta touches are read and rewritten. The list of touched
    buckets is at most ``buckets`` numbers, whatever the delta's size. Returns their number.
    Rows that lack a key column are kept beside the table, with their reason (``store.rejects``).
    The delta is evaluated once, when it is written down; that list, the rejects and the merge read it from there.
    """
    delta = with_op(delta, spec).withColumn("reject_reason", key_reason(delta, spec.pk))
    landed, lacking, folder = store.land(spec.name, delta, F.col("reject_reason").isNotNull())
    rejected = None
    if lacking:
        rejected = store.set_aside(spec.name, reject_log(landed.filter("reject_reason is not null").drop(OP), spec.name))
    good = landed.filter("reject_reason is null").drop("reject_reason")
    n = store.buckets(spec.name, buckets)
    first_load = not store.exists(spec.name)
    touched = None
    if first_load:
        columns = [c for c in good.columns if c not in (OP, "present") and (c not in seq or c in spec.pk)]
        base = good.select(*map(at, columns)).limit(0)
    else:
        touched = [r[0] for r in good.select(bucket_of(spec.pk, n).alias(BUCKET)).distinct().collect()]
        base = store.read(spec.name, only=touched)
    if touched == []:
        if state or rejected:
            store.write(spec.name, base, spec.pk, n, touched, state, rejected)
    else:
        if spec.sparse and "present" in good.columns:
            deletes = latest_per_key(good, spec.pk, seq).filter(F.col(OP) == "D")
            merged = upsert_sparse(base, good.drop(OP), spec.pk, seq)
            merged = drop_keys(merged, deletes, spec.pk)
        else:
            merged = apply_changes(base, good.drop("present"), spec.pk, seq)
        store.write(spec.name, merged, spec.pk, n, touched, state, rejected)
    store.remove(folder)
    return n if first_load else len(touched)
