"""References between tables: what is missing, what belongs together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.merge import dedupe_run
from recordloom.operators.shred import label_join
from recordloom.spec import quote
from recordloom.store import cut_lineage

__all__ = [
    "Recovery",
    "Reference",
    "bridge_join",
    "complete_references",
    "id_difference",
    "id_union",
    "label_join",
    "multi_pass_union",
    "orphan_report",
    "orphans",
    "recover_orphans",
    "references",
    "scope_filter",
    "scope_override",
]


@dataclass(frozen=True)
class Reference:
    """A column that holds ids of another table."""

    table: str
    column: str
    target: str


def references(tables: Mapping[str, DataFrame], refs: Sequence[Reference], target: str) -> DataFrame:
    """Distinct ids that the given columns point to. Distinct works before the shuffle, so hot ids collapse early."""
    ids = [
        tables[r.table].select(F.col(r.column).alias("id")).filter("id is not null").distinct()
        for r in refs
        if r.target == target and r.table in tables and r.column in tables[r.table].columns
    ]
    if not ids:
        raise ValueError(f"no reference to {target}")
    return reduce(DataFrame.union, ids).distinct()


def orphans(child: DataFrame, fk: str, parent: DataFrame, id_column: str) -> DataFrame:
    """Distinct ids that are referenced and not present; NULL references are ignored."""
    wanted = child.select(F.col(fk).alias("id")).filter("id is not null").distinct()
    return wanted.join(parent.select(F.col(id_column).alias("id")), "id", "left_anti")


def orphan_report(
    tables: Mapping[str, DataFrame], refs: Sequence[Reference], ids: Mapping[str, str]
) -> DataFrame:
    """Number of unresolved ids per referring column; columns without any are not listed.

    ``ids`` names the id column of each target table.
    """
    pieces = [
        orphans(tables[r.table], r.column, tables[r.target], ids[r.target]).select(
            F.lit(r.table).alias("table"), F.lit(r.column).alias("column"), F.lit(r.target).alias("target")
        )
        for r in refs
    ]
    return reduce(DataFrame.union, pieces).groupBy("table", "column", "target").agg(F.count("*").alias("unresolved"))


@dataclass
class Recovery:
    """What a recovery brought: rows, ids that were found and that were not, per target; whether nothing is left to look up."""

    rows: dict[str, DataFrame]
    found: dict[str, DataFrame]
    not_found: dict[str, DataFrame]
    converged: bool
    rounds: int


def _pointed(df: DataFrame, refs: Sequence[Reference]) -> DataFrame | None:
    """(target, id) that the rows of one table point to, from one scan; ids as text, since targets differ in type."""
    there = [r for r in refs if r.column in df.columns]
    if not there:
        return None
    pairs = F.array(*[F.struct(F.lit(r.target).alias("target"), F.col(quote(r.column)).cast("string").alias("id")) for r in there])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter("id is not null").distinct()


def complete_references(
    tables: Mapping[str, DataFrame],
    details: Mapping[str, DataFrame],
    refs: Sequence[Reference],
    ids: Mapping[str, str],
    resolved: Mapping[str, DataFrame] | None = None,
    max_rounds: int | None = None,
    in_order: bool = False,
) -> Recovery:
    """Look up referenced records that are missing, and what those refer to, until there is nothing new.

    Only the frontier is searched in a round: the ids that rows of the last round point to and that were neither present nor
    looked up before. So the referring tables are scanned once, however long the chains are, and an id is looked up once.
    ``resolved`` holds ids of earlier runs that are not to be looked up. With ``max_rounds`` longer chains stay open; ``converged`` tells.
    A round looks up one hop of every target; with ``in_order`` what a target brings is looked up in the same round by the targets listed after it.
    """
    targets = [t for t in details if any(r.target == t for r in refs)]
    wanted = [r for r in refs if r.target in targets]

    def stacked(frames: Mapping[str, DataFrame], column: Callable[[str, DataFrame], str]) -> DataFrame | None:
        parts = [f.select(F.lit(t).alias("target"), F.col(quote(column(t, f))).cast("string").alias("id")) for t, f in frames.items()]
        return reduce(DataFrame.union, parts) if parts else None

    def frontier_of(rows: Mapping[str, DataFrame], *known: DataFrame | None) -> DataFrame:
        pointed = [p for n, df in rows.items() if (p := _pointed(df, [r for r in wanted if r.table == n])) is not None]
        if not pointed:
            raise ValueError(f"no reference to {', '.join(targets)}")
        out = reduce(DataFrame.union, pointed).distinct()
        for k in known:
            out = out if k is None else out.join(k, ["target", "id"], "left_anti")
        return cut_lineage(out)

    present = stacked({t: tables[t] for t in targets if t in tables}, lambda t, _: ids[t])
    before = stacked({t: f for t, f in (resolved or {}).items() if t in targets}, lambda _, f: f.columns[0])
    frontier = frontier_of({n: df for n, df in tables.items() if any(r.table == n for r in wanted)}, present, before)
    tried: list[DataFrame] = []
    parts: dict[str, list[DataFrame]] = {}
    rounds, waiting = 0, [] if frontier.isEmpty() else [frontier]
    while waiting and (max_rounds is None or rounds < max_rounds):
        rounds += 1
        current, waiting = waiting, []
        for i, t in enumerate(targets):
            own = reduce(DataFrame.union, current).filter(F.col("target") == t)
            tried.append(own)
            detail = details[t]
            rows = cut_lineage(detail.join(own.select(F.col("id").alias("_id")), F.col(quote(ids[t])).cast("string") == F.col("_id"), "left_semi"))
            if rows.isEmpty():
                continue
            parts.setdefault(t, []).append(rows)
            if not any(r.table == t and r.column in rows.columns for r in wanted):
                continue
            fresh = frontier_of({t: rows}, present, before, reduce(DataFrame.union, [*tried, *current, *waiting]))
            if fresh.isEmpty():
                continue
            # what a later target of this round can still look up, and what has to wait
            later = F.col("target").isin(targets[i + 1 :]) if in_order and targets[i + 1 :] else F.lit(False)
            current = [*current, fresh.filter(later)]
            rest = fresh.filter(~later)
            if not rest.isEmpty():
                waiting.append(rest)

    rows = {t: reduce(DataFrame.unionByName, p) for t, p in parts.items()}
    looked_up = reduce(DataFrame.union, tried) if tried else frontier.limit(0)
    open_ids = bool(waiting)
    found, not_found = {}, {}
    for t in targets:
        kind = details[t].schema[ids[t]].dataType
        mine = looked_up.filter(F.col("target") == t).select("id")
        if t in rows:
            got = rows[t].select(F.col(quote(ids[t])).cast("string").alias("id"))
            mine = mine.join(got, "id", "left_anti")
            found[t] = got.select(F.col("id").cast(kind).alias("id")).distinct()
        not_found[t] = mine.select(F.col("id").try_cast(kind).alias("id"))
    return Recovery(rows, found, not_found, not open_ids, rounds)


def recover_orphans(
    tables: Mapping[str, DataFrame],
    details: Mapping[str, DataFrame],
    refs: Sequence[Reference],
    ids: Mapping[str, str],
    resolved: Mapping[str, DataFrame] | None = None,
    max_iterations: int | None = None,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Recovered rows and resolved ids (found or not, those given as well) per target, from ``complete_references``."""
    out = complete_references(tables, details, refs, ids, resolved, max_iterations, in_order=True)
    done = {}
    for t, missed in out.not_found.items():
        parts = [*([resolved[t]] if resolved and t in resolved else []), missed, *([out.found[t]] if t in out.found else [])]
        if t in out.found or (resolved and t in resolved) or not missed.isEmpty():
            done[t] = reduce(DataFrame.union, parts)
    return out.rows, done


def scope_filter(df: DataFrame, column: str, allowed: Sequence | DataFrame) -> DataFrame:
    """Rows of the allowed scopes; rows without a scope stay, and an empty list allows all."""
    blank = F.col(column).isNull() | (F.col(column).cast("string") == "")
    if isinstance(allowed, DataFrame):
        names = allowed.select(F.col(allowed.columns[0]).cast("string").alias("_scope")).distinct().withColumn("_allowed", F.lit(True))
        flagged = df.join(names, F.col(column).cast("string") == F.col("_scope"), "left")
        return flagged.filter(blank | F.col("_allowed") | ~allowed.exists()).drop("_scope", "_allowed")
    if not allowed:
        return df
    return df.filter(blank | F.col(column).cast("string").isin(*[str(a) for a in allowed]))


def multi_pass_union(passes: Mapping[str, DataFrame], tag: str, pk: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One entity read in several passes; the first pass (and in it the first row) that has a key wins."""
    tagged = [
        df.withColumns({tag: F.lit(name), "_pass": F.lit(i)}) for i, (name, df) in enumerate(passes.items())
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return dedupe_run(union, pk, ["_pass", *seq]).drop("_pass")


def scope_override(general: DataFrame, specific: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows of the general scope, replaced by rows of the specific scope with the same key."""
    rest = general.join(specific.select(*pk), list(pk), "left_anti")
    return rest.unionByName(specific, allowMissingColumns=True)


def bridge_join(a: DataFrame, bridge: DataFrame, b: DataFrame, on_a: str, on_b: str) -> DataFrame:
    """Report join over a bridge table; adaptive execution picks broadcast or sort-merge by measured size."""
    return bridge.join(a, on_a).join(b, on_b)


def id_difference(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` that are not in ``b``."""
    return a.select(*key).distinct().join(b.select(*key), list(key), "left_anti")


def id_union(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of both."""
    return a.select(*key).union(b.select(*key)).distinct()
