"""Landed files as a stream: each micro-batch is merged by key and commits its state with its rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recordloom.operators.flatten import at
from recordloom.operators.merge import commit
from recordloom.spec import TableSpec
from recordloom.store import TableStore


def stream_merge(
    changes: DataFrame,
    store: TableStore,
    spec: TableSpec,
    seq: Sequence[str],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 16,
) -> StreamingQuery:
    """Merge everything that has landed and stop (``availableNow``).

    A batch that was committed before a failure is recognised by its number in the table's
    state and not merged again, so a restart gives the same table.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if store.state(spec.name).get("batch_id", -1) >= batch_id:
            return
        rows = transform(batch) if transform else batch
        commit(store, spec, rows, seq, {"batch_id": batch_id}, buckets)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_dedupe(changes: DataFrame, time: str, days: int, pk: Sequence[str]) -> DataFrame:
    """Streaming form of the trailing window: later than ``days`` is dropped, repeats inside it are too."""
    return changes.withWatermark(time, f"{days} days").dropDuplicatesWithinWatermark(list(pk))


def trailing_stream(
    changes: DataFrame,
    store: TableStore,
    spec: TableSpec,
    time: str,
    days: int,
    seq: Sequence[str],
    checkpoint: str,
    buckets: int = 16,
) -> StreamingQuery:
    """Stream of a trailing window: repeats inside it are dropped in state, what is later than it is refused.

    The watermark holds ``days`` back from the latest time seen; ``window_dedupe`` keeps keys no longer than that, so its state stays
    bounded. ``late_rows`` names what the watermark shut out once the stream has stopped.
    """
    return stream_merge(window_dedupe(changes, time, days, spec.pk), store, spec, seq, checkpoint, buckets=buckets)


def late_rows(landed: DataFrame, store: TableStore, spec: TableSpec) -> DataFrame:
    """Landed rows whose key is not in the table: those that came later than the window allowed.

    Rows of a key are repeats of each other; a late repeat of an accepted row is nothing lost and not listed. Rows without a
    key are among the table's own rejects.
    """
    keyed = landed
    for c in spec.pk:
        keyed = keyed.filter(at(c).isNotNull())
    return keyed.join(store.read(spec.name).select(*map(at, spec.pk)), list(spec.pk), "left_anti")
