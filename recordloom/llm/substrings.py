"""Removal of repeated passages: every byte of a string of ``SPAN`` bytes that starts anywhere else as well.

A suffix array of the whole corpus would be one task's work, so the corpus is cut to what can repeat. In every
window of ``SPAN`` bytes the gram of ``GRAM`` bytes with the smallest hash is its anchor. The choice looks at the window
alone: two equal strings of ``SPAN`` bytes have equal anchors at equal places. So

1. anchors of all texts are hashed, together with the context that windows around them can reach, and counted. An
   anchor that occurs once has no repeated window and is gone after one aggregation.
2. If all occurrences of an anchor have the same context, all of it repeats. Else one occurrence of each different
   context is fetched.
3. Contexts of one anchor are compared by a suffix array, built by linear grouping (``suffix.py``). Its symbols are not bytes but
   the blocks between the places where any two contexts part, so that a context is a few symbols, and its repeated
   runs are whole blocks. Runs of ``SPAN`` bytes or more are covered. An anchor with more than ``MOST`` different contexts
   does not come to one task: the bytes that ``STRIDE`` neighbouring windows share, and all that they cover, are hashed and
   counted. If the former are unique, none of the windows repeats; if the latter repeat, all do; else they are counted one by one.
4. Covered stretches go back to all occurrences of their context, and are cut out of the texts, once, at the end.

Defined results: a null text is empty; texts shorter than ``SPAN`` bytes lose nothing; overlapping occurrences, also
within a text, count; equal rows are different texts and lose everything that is long enough; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, stage, table, with_place
from recordloom.llm.grams import BYTE, STEP, U, mix, pieces
from recordloom.llm.suffix import common, suffix_array

SPAN = 200
GRAM = 32
REACH = SPAN - GRAM  # bytes that a window can go beyond its anchor on either side
MOST = 256
#: Symbols of contexts that are sorted together.
BATCH_SYMBOLS = 50_000

#: Bytes that are hashed together: arrays of so many numbers stay in a processor's cache.
CHUNK = 1 << 16
#: Neighbouring windows that are tried together before they are hashed one by one.
STRIDE = 24
#: Rows of a batch that are worked on together.
SLICE = 500
PLACE_BITS = U(20)
PLACE = (U(1) << PLACE_BITS) - U(1)
INVERSE = U(pow(int(STEP), -1, 2**64))

OCCURRENCE = f"anchor long, context long, {FILE} long, {ROW} long, pos long"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each place, by doubling."""
    h, width = BYTE[data], 1
    while width < GRAM:
        h = mix(h[:-width] * STEP + h[width:]) if width == GRAM // 2 else h[:-width] * (STEP + U(2 * width)) + (h[width:] ^ (h[width:] >> U(29)))
        width *= 2
    return h


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    out, have = h, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, gram hashes) of the anchors of all windows that lie in one text, in order."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    inside = np.arange(len(data)) + SPAN <= ends
    places, hashes = [], []
    for at in range(0, max(0, len(data) - SPAN + 1), CHUNK):
        part = data[at : at + CHUNK + SPAN - 1]
        if len(part) < SPAN:
            break
        h = gram_hashes(part)
        marked = (h & ~PLACE) | np.arange(len(h), dtype=U)
        least = window_minima(marked, SPAN - GRAM + 1)[inside[at : at + len(part) - SPAN + 1]]
        chosen = np.unique((least & PLACE).astype(np.int64))
        places.append(chosen + at)
        hashes.append(h[chosen])
    if not places:
        return np.empty(0, np.int64), np.empty(0, U)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


@lru_cache(maxsize=4)
def powers_of(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``STEP`` and of its inverse, from 0 on; ``count`` is a power of two, so that few are kept."""
    powers, inverses = np.full(count + 1, STEP), np.full(count + 1, INVERSE)
    powers[0] = inverses[0] = U(1)
    return np.cumprod(powers), np.cumprod(inverses)


def context_hashes(data: np.ndarray, low: np.ndarray, places: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of bytes low..high around each place, and of where the place is in it."""
    base, top = int(low.min()), int(high.max())
    part = BYTE[data[base:top]]
    powers, inverses = powers_of(1 << len(part).bit_length())
    sums = np.zeros(len(part) + 1, U)
    np.cumsum(part * powers[: len(part)], out=sums[1:])
    a, b = low - base, high - base
    return mix(mix((sums[b] - sums[a]) * inverses[a]) + (places - low).astype(U) * STEP + (high - places).astype(U))


def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        file, row = batch.column(FILE).to_numpy(), batch.column(ROW).to_numpy()
        for first, data, offsets in pieces(batch.column("text"), 4 * CHUNK):
            place, h = anchors(data, offsets)
            if not len(place):
                continue
            text = np.searchsorted(offsets, place, "right") - 1
            low, high = np.maximum(place - REACH, offsets[text]), np.minimum(place + SPAN, offsets[text + 1])
            # a very long text in stretches, so that memory stays bounded
            stretches = np.split(np.arange(len(place)), np.flatnonzero(np.diff(low // (4 * CHUNK))) + 1)
            context = np.concatenate([context_hashes(data, low[k], place[k], high[k]) for k in stretches])
            columns = [h.view(np.int64), context.view(np.int64), file[first + text], row[first + text], place - offsets[text]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "context", FILE, ROW, "pos"])


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes before and from the anchor on, for the wanted contexts of each text."""
    for batch in sliced(batches):
        out: dict[str, list] = {"anchor": [], "context": [], "n": [], "many": [], "before": [], "after": []}
        for i in range(batch.num_rows):
            data = batch.column("text")[i].as_py().encode()
            for w in batch.column("wanted")[i].as_py():
                p = w["pos"]
                out["before"].append(data[max(0, p - REACH) : p])
                out["after"].append(data[p : p + SPAN])
                for k in ("anchor", "context", "n", "many"):
                    out[k].append(w[k])
        types = {"anchor": pa.int64(), "context": pa.int64(), "n": pa.int64(), "many": pa.bool_(), "before": pa.binary(), "after": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], list(types))


def meeting(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    return low


def reaches(sides: list[bytes]) -> tuple[list[int], list[int]]:
    """How far each side agrees with the one it agrees with most, and all places where neighbours in order part."""
    order = sorted(range(len(sides)), key=lambda i: sides[i])
    best, parts = [0] * len(sides), set()
    for a, b in zip(order[:-1], order[1:], strict=True):
        m = meeting(sides[a], sides[b])
        parts.add(m)
        best[a], best[b] = max(best[a], m), max(best[b], m)
    return best, sorted(parts - {0})


class Sorter:
    """Contexts of several anchors as one text of blocks, until it is large enough to be sorted."""

    def __init__(self) -> None:
        self.symbols: list[int] = []
        self.stretch: list[tuple[int, int]] = []  # bytes from the anchor on that a symbol stands for
        self.owner: list[int] = []
        self.keys: list[tuple[int, int]] = []
        self.covered: list[list[tuple[int, int]]] = []
        self.found: dict[int, list[tuple[int, int]]] = {}
        self.names: dict[tuple, int] = {}
        self.twins: list[tuple[int, int]] = []

    def add(self, anchor: int, contexts: list[tuple[int, int, bytes, bytes]]) -> None:
        """Contexts (hash, occurrences, before, from the anchor on) of one anchor."""
        left = [c[2][::-1] for c in contexts]
        right = [c[3] for c in contexts]
        far_left, _ = reaches(left)
        far_right, _ = reaches(right)
        seen: dict[tuple[bytes, bytes], int] = {}
        trimmed: list[int | None] = []
        for (context, n, before, after), i in zip(contexts, range(len(contexts)), strict=True):
            self.keys.append((anchor, context))
            # a context that occurs again is repeated as a whole
            self.covered.append([(-len(before), len(after))] if n > 1 and len(before) + len(after) >= SPAN else [])
            trimmed.append(None)
            if far_left[i] + far_right[i] >= SPAN:
                a, b = left[i][: far_left[i]], right[i][: far_right[i]]
                twin = seen.get((a, b))
                if twin is None:
                    seen[a, b] = len(self.keys) - 1
                    trimmed[-1] = len(self.keys) - 1
                else:
                    # equal after trimming: both are repeated as far as they were not trimmed
                    for k in (twin, len(self.keys) - 1):
                        self.covered[k].append((-far_left[i], far_right[i]))
                    trimmed[-1] = len(self.keys) - 1
        if len(seen) < 2:
            return
        # only contexts that agree with another over a window are sorted, and only where these part
        _, cuts_left = reaches([a for a, _ in seen])
        _, cuts_right = reaches([b for _, b in seen])
        members: dict[tuple[bytes, bytes], int] = {}
        for i, key in enumerate(trimmed):
            if key is None:
                continue
            a, b = left[i][: far_left[i]], right[i][: far_right[i]]
            if (a, b) in members:
                continue
            members[a, b] = key
            lefts = [*sorted({0, len(a), *[c for c in cuts_left if c < len(a)]})]
            rights = [*sorted({0, len(b), *[c for c in cuts_right if c < len(b)]})]
            blocks = [(-hi, -lo, a[lo:hi]) for lo, hi in zip(lefts[:-1], lefts[1:], strict=True)][::-1]
            blocks += [(lo, hi, b[lo:hi]) for lo, hi in zip(rights[:-1], rights[1:], strict=True)]
            for lo, hi, text in blocks:
                self.symbols.append(self.names.setdefault((anchor, lo, text), len(self.names)))
                self.stretch.append((lo, hi))
                self.owner.append(key)
            # nothing equals the mark between two contexts
            self.symbols.append(-len(self.symbols) - 1)
            self.stretch.append((0, 0))
            self.owner.append(-1)
        # contexts equal to a member after trimming share what the array finds for it
        for i, key in enumerate(trimmed):
            if key is not None:
                other = members[left[i][: far_left[i]], right[i][: far_right[i]]]
                if other != key:
                    self.twins.append((key, other))

    def finish(self) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """(anchor, context, covered stretches) of the contexts that have any."""
        order, symbols, stretch, owner = suffix_array(self.symbols), self.symbols, self.stretch, self.owner
        for a, b in zip(order[:-1], order[1:], strict=True):
            # marks and blocks of other anchors or places have symbols of their own
            if symbols[a] != symbols[b]:
                continue
            run = common(symbols, a, b)
            low, high = stretch[a][0], stretch[a + run - 1][1]
            if high - low >= SPAN:
                # equal symbols stand for the same stretch
                self.found.setdefault(owner[a], []).append((low, high))
                self.found.setdefault(owner[b], []).append((low, high))
        shared = dict(self.twins)
        for k, ((anchor, context), stretches) in enumerate(zip(self.keys, self.covered, strict=True)):
            stretches = stretches + self.found.get(shared.get(k, k), [])
            if stretches:
                yield anchor, context, stretches


HASHES = "anchor long, context long, n long, low int, hash long"
STRIDES = f"{HASHES}, first int, end int, whole long"
COVER = "anchor long, context long, low int, high int"


def cover_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["anchor", "context", "low", "high"])


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered stretches of contexts that come sorted by anchor."""
    sorter, group, anchor = Sorter(), [], None

    def drain() -> pa.RecordBatch:
        return cover_batch([(a, c, lo, hi) for a, c, stretches in sorter.finish() for lo, hi in merged(stretches)])

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("anchor", "context", "n", "before", "after")]
        for a, context, n, before, after in zip(*columns, strict=True):
            if a != anchor and group:
                sorter.add(anchor, group)
                group = []
                if len(sorter.symbols) >= BATCH_SYMBOLS or len(sorter.keys) >= BATCH_SYMBOLS:
                    yield drain()
                    sorter = Sorter()
            anchor = a
            group.append((context, n, before, after))
    if group:
        sorter.add(anchor, group)
    yield drain()


def laid(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of a batch one behind the other: bytes, where each anchor is, bytes before it, bytes from it on."""
    before, after = batch.column("before").to_pylist(), batch.column("after").to_pylist()
    data = np.frombuffer(b"".join(side for both in zip(before, after, strict=True) for side in both), np.uint8)
    n_before, n_after = (np.array([len(x) for x in sides], np.int64) for sides in (before, after))
    return data, np.cumsum(n_before + n_after) - n_after, n_before, n_after


def hashed(data: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the bytes low..high from the anchor on."""
    return context_hashes(data, anchor + low, anchor + low, anchor + high).view(np.int64)


def strides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the windows of a stride share (``hash``) and cover (``whole``, from ``first`` to ``end``)."""
    grid = np.arange(-REACH, 1, STRIDE)
    for batch in sliced(batches):
        data, anchor, n_before, n_after = laid(batch)
        # a stride counts if any of its windows is whole
        row, at = np.nonzero((grid + STRIDE > -n_before[:, None]) & (np.maximum(grid, -n_before[:, None]) + SPAN <= n_after[:, None]))
        if not len(row):
            continue
        low = grid[at]
        first, end = np.maximum(low, -n_before[row]), np.minimum(low + STRIDE - 1 + SPAN, n_after[row])
        shared, whole = hashed(data, anchor[row], low + STRIDE - 1, low + SPAN), hashed(data, anchor[row], first, end)
        # the shared bytes end with the text at the latest
        columns = [batch.column(k).to_numpy()[row] for k in ("anchor", "context", "n")]
        columns += [low.astype(np.int32), shared, first.astype(np.int32), end.astype(np.int32), whole ^ mix((end - low).astype(U)).view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "context", "n", "low", "hash", "first", "end", "whole"])


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each window of the strides ``lows``."""
    for batch in sliced(batches):
        data, anchor, n_before, n_after = laid(batch)
        lows = batch.column("lows")
        start = (lows.flatten().to_numpy()[:, None] + np.arange(STRIDE)[None, :]).ravel()
        row = np.repeat(np.arange(batch.num_rows), lows.value_lengths().to_numpy() * STRIDE)
        inside = (start >= -n_before[row]) & (start <= 0) & (start + SPAN <= n_after[row])
        row, start = row[inside], start[inside]
        if len(row):
            h = hashed(data, anchor[row], start, start + SPAN)
            columns = [batch.column(k).to_numpy()[row] for k in ("anchor", "context", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, start.astype(np.int32), h)], ["anchor", "context", "n", "low", "hash"])


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(stretches):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def joined(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches without overlap and not touching, in order."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.ones(len(low), bool)
    first[1:] = low[1:] > high[:-1]
    return low[first], high[np.flatnonzero(np.append(first[1:], True))]


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        out: list[tuple] = []
        texts, ids, covered = batch.column("text"), batch.column("doc_id"), batch.column("covered")
        parts = covered.flatten()
        lows, highs = (parts.field(k).to_numpy() for k in ("low", "high"))
        ends = np.cumsum(covered.value_lengths().fill_null(0).to_numpy())
        for i in range(batch.num_rows):
            data = (texts[i].as_py() or "").encode()
            here = slice(ends[i - 1] if i else 0, ends[i])
            low, high = joined(lows[here], highs[here]) if here.stop > here.start else (lows[:0], highs[:0])
            edges = zip([0, *high.tolist()], [*low.tolist(), len(data)], strict=True)
            rest = b"".join(data[a:b] for a, b in edges)
            out.append((ids[i].as_py(), len(data), len(data) - len(rest), len(low), hashlib.sha256(rest).hexdigest(), rest))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], NAMES)


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
REST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def repeated(placed: DataFrame, most: int = MOST) -> DataFrame:
    """(place, covered): the stretches of each text that repeat, as byte offsets; texts without any are left out."""
    texts = placed.select(FILE, ROW, "text").filter(F.octet_length("text") >= SPAN)
    found = texts.mapInArrow(occurrences, OCCURRENCE)
    # staged, so that the join below can split the occurrences of a frequent anchor
    again = stage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("all"), F.min("context").alias("c0"), F.max("context").alias("c1")).filter("all > 1"))
    held = stage(found.join(again.select("anchor", (F.col("c0") != F.col("c1")).alias("mixed")), "anchor"))
    kinds = held.filter("mixed").groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(FILE, ROW, "pos")).alias("at"))
    kinds = stage(kinds)
    many = kinds.groupBy("anchor").count().select("anchor", (F.col("count") > most).alias("many"))
    wanted = (
        kinds.join(many, "anchor").groupBy(f"at.{FILE}", f"at.{ROW}")
        .agg(F.collect_list(F.struct("anchor", "context", "n", "many", F.col("at.pos").alias("pos"))).alias("wanted"))
    )
    contexts = stage(
        texts.join(wanted, [FILE, ROW]).select("text", "wanted").mapInArrow(fetch, "anchor long, context long, n long, many boolean, before binary, after binary")
    )
    few = contexts.filter("not many").repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(compare, COVER)

    def again_in(hashes: DataFrame, name: str) -> DataFrame:
        found = hashes.groupBy("anchor", "low", name).agg(F.sum("n").alias("all"), F.min("context").alias("one"))
        return found.filter("all > 1").drop("all")

    crowded = contexts.filter("many")
    tried = stage(crowded.mapInArrow(strides, STRIDES))
    alive = stage(tried.join(again_in(tried, "hash").drop("one"), ["anchor", "low", "hash"]))
    judged = alive.join(again_in(alive, "whole").withColumn("done", F.lit(True)), ["anchor", "low", "whole"], "left")
    done = judged.filter("done").select("anchor", "context", F.col("first").alias("low"), F.col("end").alias("high"))
    # of contexts with the same whole one goes on, since windows of others may equal its windows
    open_ = judged.filter("done is null or context = one").groupBy("anchor", "context").agg(F.collect_list("low").alias("lows"))
    each = stage(crowded.join(open_, ["anchor", "context"]).select("anchor", "context", "n", "before", "after", "lows").mapInArrow(windows, HASHES))
    found_ = each.join(again_in(each, "hash").drop("one"), ["anchor", "low", "hash"]).groupBy("anchor", "context").agg(F.sort_array(F.collect_list("low")).alias("lows"))
    # neighbouring windows become one stretch
    begins = F.filter("lows", lambda x, i: (i == 0) | (F.get(F.col("lows"), i - 1) != x - 1))
    ends = F.filter("lows", lambda x, i: (i == F.size("lows") - 1) | (F.get(F.col("lows"), i + 1) != x + 1))
    joined = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("low"), (b + SPAN).alias("high")))
    hot = done.unionByName(found_.select("anchor", "context", F.inline(joined)))
    # staged, so that the join below can split the occurrences of a frequent context
    stretches = stage(few.unionByName(hot).groupBy("anchor", "context").agg(F.collect_list(F.struct("low", "high")).alias("parts")))
    whole = held.filter("not mixed").select(FILE, ROW, F.array(F.struct((F.col("pos") - REACH).alias("low"), (F.col("pos") + SPAN).alias("high"))).alias("parts"))
    partly = held.filter("mixed").join(stretches, ["anchor", "context"]).select(
        FILE, ROW, F.transform("parts", lambda p: F.struct((F.col("pos") + p["low"]).alias("low"), (F.col("pos") + p["high"]).alias("high"))).alias("parts")
    )
    return whole.unionByName(partly).groupBy(FILE, ROW).agg(F.flatten(F.collect_list("parts")).alias("covered"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """Per text: bytes, removed bytes, removed runs, hash of what is left, and what is left."""
    placed = with_place(df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")))
    covered = repeated(placed, most)
    # stretches of contexts that end with their text are shorter than a window's reach
    size = F.octet_length("text").cast("long")
    clipped = F.filter(
        F.transform("covered", lambda c: F.struct(F.greatest(c["low"], F.lit(0).cast("long")).alias("low"), F.least(c["high"], size).alias("high"))),
        lambda c: c["high"] - c["low"] >= SPAN,
    )
    return placed.join(covered, [FILE, ROW], "left").select("doc_id", "text", clipped.alias("covered")).mapInArrow(cut, REST)


def op8(spark, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents")).drop("kept")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (
  SELECT r, i, count(*) OVER (PARTITION BY k) AS found
  FROM (SELECT r, i, md5(substring(h, 2 * i + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200))),
gaps AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 200, -1) AS opens FROM starts WHERE found > 1),
spans AS (
  SELECT r, min(i) AS low, max(i) + 200 AS high
  FROM (SELECT r, i, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS s FROM gaps) GROUP BY r, s),
pieces AS (SELECT r, low, high, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS since FROM spans),
cuts AS (
  SELECT r, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last, string_agg(substring(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS head
  FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cuts USING (r)
"""
