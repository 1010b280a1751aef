"""What to read again, and how far a run has come."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.flatten import at
from recordloom.spec import Policy, TableSpec


def _like(df: DataFrame, column: str, value) -> Column:
    """The value in the type of the column: the column itself stays bare, so the filter is pushed down."""
    lit = value if isinstance(value, Column) else F.lit(str(value) if isinstance(value, (date, datetime)) else value)
    return lit.cast(df.schema[column].dataType)


def since(df: DataFrame, column: str, cursor, inclusive: bool = True) -> DataFrame:
    """Rows from the cursor on. Inclusive reads the boundary again, which a merge by key makes harmless."""
    if cursor is None:
        return df
    value = _like(df, column, cursor)
    return df.filter(F.col(column) >= value if inclusive else F.col(column) > value)


def parsed_time(c: Column | str) -> Column:
    """Cursor values as timestamps; text that is no time is NULL, so it can never be the maximum."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("timestamp")


def advance_cursor(df: DataFrame, columns: Sequence[str], floor: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Highest time over the first known of ``columns`` per row, per scope ``by``; never below ``floor``."""
    seen = F.max(F.coalesce(*[parsed_time(c) for c in columns]))
    value = F.greatest(seen, F.lit(floor).cast("timestamp")) if floor else seen
    return df.groupBy(*by).agg(value.alias("cursor"))


def initial_hold(cursor, new_cursor, complete: bool):
    """Cursor to store: the first full load keeps none until it is complete."""
    if cursor is None and not complete:
        return None
    return max((c for c in (cursor, new_cursor) if c is not None), default=None)


def two_phase(df: DataFrame, column: str, cursor, backfill_done: bool, limit_to=None) -> tuple[DataFrame, bool]:
    """Backfill walks up from the cursor (to ``limit_to`` when a run is bounded), steady state reads what is newer.

    Both are the same range filter, because files are sorted by nobody and pruned by statistics.
    Returns the rows and whether the backfill is finished after them.
    """
    rows = since(df, column, cursor, inclusive=False)
    if backfill_done or limit_to is None:
        return rows, True
    return rows.filter(F.col(column) <= _like(df, column, limit_to)), False


def trailing_window(df: DataFrame, column: str, as_of, days: int, future_days: int | None = None) -> DataFrame:
    """Rows of the last ``days`` days (by date), whatever the cursor; optionally up to some days ahead."""
    anchor = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    rows = df.filter(F.col(column) >= F.date_sub(anchor, days))
    if future_days is not None:
        rows = rows.filter(F.col(column) < F.date_add(anchor, future_days + 1))
    return rows


def append_only_by_id(df: DataFrame, id_column: str, max_id: int | None) -> DataFrame:
    """Rows above the highest id seen; an id that is no number is kept."""
    if max_id is None:
        return df
    number = F.col(id_column).try_cast("bigint")
    return df.filter(number.isNull() | (number > max_id))


def offset_cursor(df: DataFrame, number: str, offset) -> DataFrame:
    """Rows after a position in a numbered feed."""
    return since(df, number, offset, inclusive=False)


def full_refresh_due(last: Column | str, as_of: Column | str, days: int = 7, whole_days: bool = True) -> Column:
    """Never refreshed, or at least ``days`` whole days ago; without ``whole_days`` strictly more than that in seconds."""
    then = (F.col(last) if isinstance(last, str) else last).cast("timestamp")
    now = (F.col(as_of) if isinstance(as_of, str) else as_of).cast("timestamp")
    elapsed = F.unix_micros(now) - F.unix_micros(then)
    limit = F.lit(days * 86_400_000_000)
    due = F.floor(elapsed / F.lit(86_400_000_000)) >= days if whole_days else elapsed > limit
    return then.isNull() | due


def changed_parents_children(
    children: DataFrame, fk: str, changed: DataFrame, pending: DataFrame | None = None
) -> DataFrame:
    """Children of the parents that changed in this run or were left over from an earlier one."""
    wanted = changed.select(F.col(changed.columns[0]).alias(fk))
    if pending is not None:
        wanted = wanted.union(pending.select(F.col(pending.columns[0]).alias(fk)))
    return children.join(wanted.distinct(), fk, "left_semi")


def replace_children(target: DataFrame, children: DataFrame, fk: str, parents: DataFrame) -> DataFrame:
    """Target in which the children of the given parents are exactly ``children``."""
    ids = parents.select(F.col(parents.columns[0]).alias(fk)).distinct()
    return target.join(ids, fk, "left_anti").unionByName(children, allowMissingColumns=True)


def skip_unchanged(rows: DataFrame, fk: str, parents: DataFrame, id_column: str, updated: str, last_sync) -> DataFrame:
    """Sub-resources of parents updated after the last run; all of them when there was none."""
    if last_sync is None:
        return rows
    changed = parents.filter(F.col(updated) > _like(parents, updated, last_sync)).select(F.col(id_column).alias(fk)).distinct()
    return rows.join(changed, fk, "left_semi")


def windows_between(start: datetime, end: datetime, days: int = 30) -> list[tuple[datetime, datetime]]:
    """Stitched run windows: each begins where the last ended, the last one ends at ``end``."""
    out = []
    low = start
    while low < end - timedelta(days=days):
        out.append((low, low + timedelta(days=days)))
        low += timedelta(days=days)
    return [*out, (low, end)]


def stitch_windows(
    df: DataFrame, column: str, start: datetime, end: datetime, run: Callable[[DataFrame, datetime], None], days: int = 30
) -> datetime:
    """Backfill in bounded steps: ``run`` gets the rows of each window and the cursor to store with them.

    Rows on a shared boundary come twice and the merge by key drops the second. A stopped run
    resumes at the last stored end.
    """
    done = start
    for low, high in windows_between(start, end, days):
        run(df.filter(F.col(column).between(_like(df, column, low), _like(df, column, high))), high)
        done = high
    return done


def scoped_since(
    df: DataFrame, cursors: DataFrame, scope: Sequence[str], column: str, cursor: str = "cursor", inclusive: bool = True
) -> DataFrame:
    """Rows from the cursor of their own scope on; scopes without a cursor are read whole. One job for all scopes."""
    joined = df.join(cursors.select(*scope, F.col(cursor).alias("_cursor")), list(scope), "left")
    newer = F.col(column) >= F.col("_cursor") if inclusive else F.col(column) > F.col("_cursor")
    return joined.filter(F.col("_cursor").isNull() | newer).drop("_cursor")


def recent_snapshot(df: DataFrame, column: str, as_of, minutes: int) -> DataFrame:
    """Rows of the last ``minutes`` minutes."""
    return df.filter(F.col(column) >= _like(df, column, as_of) - F.make_dt_interval(mins=F.lit(minutes)))


def window_keyed_history(df: DataFrame, from_date: date | str, to_date: date | str) -> DataFrame:
    """Window bounds as columns, to be part of the key, so that snapshots of other windows stay."""
    return df.withColumns(
        {"from_date": F.lit(str(from_date)), "to_date": F.lit(str(to_date))}
    )


def cursor_time(df: DataFrame, column: str) -> Column:
    """Values of a cursor column as times: typed ones as they are, text in ISO form or as ``01-Jan-2025 00:00:00``."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.coalesce(parsed_time(at(column)), F.try_to_timestamp(at(column), F.lit("dd-MMM-yyyy HH:mm:ss")))
    return parsed_time(at(column))


def _reach(df: DataFrame, column: str, cursor: str) -> Column:
    """A comparison of the bare column that no row from the cursor on fails, so that a scan can skip what it rules out.

    ISO text sorts by its date; two days leave room for offsets. What does not begin with a digit is let through.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return at(column) >= F.lit(cursor).cast(kind)
    if isinstance(kind, T.DateType):
        return at(column) >= F.lit(cursor).cast("timestamp").cast("date")
    if isinstance(kind, T.StringType):
        day = date.fromisoformat(cursor[:10]) - timedelta(days=2)
        return (at(column) >= F.lit(day.isoformat())) | (at(column) < F.lit("0"))
    return F.lit(True)


def modified_since(df: DataFrame, columns: Sequence[str], cursor, landed: str | None = None) -> DataFrame:
    """Rows whose first known time among ``columns`` is the cursor or later.

    Beside the exact condition stand comparisons of bare columns, joined with OR, which reach the scan as range filters. Their text form
    holds for ISO times with years of four digits. With ``landed``, the day on which a row was landed and by which the table
    is partitioned, days before the cursor's are not read: a row is not landed before it is modified (a day is left for zones).
    """
    cursor = str(cursor)
    moment = F.lit(cursor).cast("timestamp")
    kinds = [df.schema[c].dataType for c in columns]
    if all(isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds):
        # exact on bare columns alone: a column counts where those before it are null
        known = F.lit(False)
        for i, c in enumerate(columns):
            mine = _reach(df, c, cursor)
            for earlier in columns[:i]:
                mine = at(earlier).isNull() & mine
            known = mine if i == 0 else known | mine
        rows = df.filter(known)
    else:
        reach = reduce(Column.__or__, [_reach(df, c, cursor) for c in columns])
        rows = df.filter(reach).filter(F.coalesce(*[cursor_time(df, c) for c in columns]) >= moment)
    return rows if landed is None else rows.filter(_landed_since(df, landed, date.fromisoformat(cursor[:10]) - timedelta(days=1)))


def _landed_since(df: DataFrame, landed: str, day: date) -> Column:
    return at(landed) >= F.lit(day.isoformat()).cast(df.schema[landed].dataType)


def read_scopes(df: DataFrame, due: DataFrame, scope: str) -> DataFrame:
    """Rows of the scopes that are due. On a table partitioned by ``scope`` only their partitions are read (dynamic pruning)."""
    wanted = due.select(F.col(due.columns[0]).cast(df.schema[scope].dataType).alias(scope)).distinct()
    return df.join(wanted, scope, "left_semi")


def read_by_policy(df: DataFrame, spec: TableSpec, state: Mapping, as_of=None, landed: str | None = None) -> DataFrame:
    """The part of a landed table that its policy asks for; ``landed`` names the day by which the table is partitioned, if any.

    A window without a column of its own goes by the day of landing, or is read whole where there is none.
    """
    if spec.policy is Policy.WINDOW:
        column = spec.cursor[0] if spec.cursor else landed
        if column is None:
            return df
        if not isinstance(df.schema[column].dataType, T.StringType):
            return trailing_window(df, column, as_of, spec.window_days, spec.future_days)
        timed = df.withColumn("_window_time", cursor_time(df, column))
        return trailing_window(timed, "_window_time", as_of, spec.window_days, spec.future_days).drop("_window_time")
    if spec.policy in (Policy.MODIFIED, Policy.CREATED) and spec.cursor and state.get("cursor"):
        return modified_since(df, spec.cursor, state["cursor"], landed)
    if spec.policy is Policy.MAX_ID and spec.cursor:
        return append_only_by_id(df, spec.cursor[0], state.get("max_id"))
    return df


def state_for_version(state: Mapping, version: str) -> dict:
    """The stored state, or a fresh one when it was written by another version of the job."""
    return dict(state) if state.get("version") == version else {"version": version}


def partial_run(steps: Mapping[str, Callable[[], object]], stop_on: type[BaseException] | tuple = ()) -> dict[str, str]:
    """Run independent table jobs: one that fails does not hold up the others.

    An exception of ``stop_on`` (such as a used-up quota) ends the run; what is left is
    reported as pending for the next one. Each job commits by itself.
    """
    outcome = {name: "pending" for name in steps}
    for name, step in steps.items():
        try:
            step()
            outcome[name] = "done"
        except Exception as error:  # noqa: BLE001 - reported per table
            if stop_on and isinstance(error, stop_on):
                break
            outcome[name] = f"failed: {error}"
    return outcome
