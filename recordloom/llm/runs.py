"""Periodic runs of words: stretches that repeat a phrase several times in a row.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length of at least
``least`` words and ``times`` periods that no neighbouring word extends. Each text is searched by itself, so nothing is shuffled.

Squares come from a suffix automaton whose tree of suffix links is a link-cut tree. When word i is appended, the path from
the state of prefix i to the root is accessed. It consists of segments coloured by the position p at which they were last
accessed; the lowest state of a segment, of length m, says that the m words before i and p are the same and no more. With
q = i - p <= m they hold a square of period q, which begins m words before p + 1; later words extend it as long as they meet
the same beginning and period. The access joins the segments to one path and recolours it, n log n segments in all.

Automata in Python are dear, so only regions that can hold a run get one. In a run every gram of ``GRAM`` words behind the first
period stood q words before. Stretches of such grams, T long, allow periods of (T + GRAM - 1) / (times - 1) at most;
grams whose last occurrence is farther are cut off, and the parts are looked at again. This is a necessary condition: a region
reaches one period before its stretch, so it holds its runs whole, and touching regions are one. A region takes about 1 kB
of memory per word.

Odd input: a null text has no words, no run and an empty collapsed text, as has a text of white space. Words are cut at
``[\\x20\\x09-\\x0D]``; other characters, upper case and accents count as they are. Repeated rows give repeated results, an empty
table gives none. Columns of the input are kept; the new one takes the next free name.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import free_name, let, split_words, table

LEAST, TIMES = 6, 4
GRAM = 3
#: Rounds of cutting regions; fewer rounds leave larger regions and the same runs.
CUTS = 24

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("strongest", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
)
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN), ("collapsed", pa.string())])


def automaton(symbols: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states, and the state of each prefix."""
    steps, link, length = [{}], [-1], [0]
    last, states = 0, []
    for c in symbols:
        new = len(link)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in steps[p]:
            steps[p][c] = new
            p = link[p]
        if p != -1:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                steps.append(steps[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
        states.append(new)
    return link, length, states


class Paths:
    """Preferred paths of a rooted tree as splay trees, each with one colour."""

    def __init__(self, parent: list[int]):
        self.up = parent[:]
        self.left = [-1] * len(parent)
        self.right = [-1] * len(parent)
        self.colour = [-1] * len(parent)

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree; the root holds the colour."""
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if p == -1 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g != -1 and (left[g] == p or right[g] == p)
            turns = ((p, g), (x, p)) if inner and (left[g] == p) == (left[p] == x) else ((x, p), (x, g)) if inner else ((x, p),)
            for low, high in turns:
                above = up[high]
                if left[high] == low:
                    child = left[high] = right[low]
                    right[low] = high
                else:
                    child = right[high] = left[low]
                    left[low] = high
                if child != -1:
                    up[child] = high
                up[low], up[high] = above, low
                if above != -1 and left[above] == high:
                    left[above] = low
                elif above != -1 and right[above] == high:
                    right[above] = low
                else:
                    colour[low] = colour[high]

    def access(self, v: int, colour: int) -> Iterator[tuple[int, int]]:
        """(colour, lowest state) of the segments from ``v`` to the root, which then are one path of the new colour."""
        x, below = v, -1
        while x != -1:
            self.splay(x)
            if self.colour[x] != -1:
                yield self.colour[x], x
            if self.right[x] != -1:
                self.colour[self.right[x]] = self.colour[x]
            self.right[x] = below
            below, x = x, self.up[x]
        self.splay(v)
        self.colour[v] = colour


def repeats(symbols: list, least: int, times: int) -> dict[tuple[int, int], int]:
    """{(start, period): end} of the runs of a sequence."""
    link, length, states = automaton(symbols)
    paths, found = Paths(link), {}
    for i, v in enumerate(states):
        for p, x in paths.access(v, i):
            q, m = i - p, length[x]
            if m >= (times - 1) * q and m + q >= least:
                found[p - m + 1, q] = i
    return found


def stretches(mask: np.ndarray) -> np.ndarray:
    """(first, length) of the stretches of true entries."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
    return np.stack([edges[::2], edges[1::2] - edges[::2]], axis=1)


def regions(ids: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Ranges of words, apart from each other, that hold every run whole."""
    shortest = min(max(least - q, (times - 1) * q) for q in range(1, least + 2))
    gram = max(1, min(GRAM, shortest))
    n = len(ids) - gram + 1
    if n <= 0:
        return []
    codes = ids[:n].astype(np.int64)
    size = int(ids.max()) + 1
    for k in range(1, gram):
        if size ** 2 * (int(codes.max()) + 1) >= 2**62:
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes * size + ids[k : k + n]
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    back = np.full(n, n + least, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    good, enough = back <= n, shortest - gram + 1
    for _ in range(CUTS):
        if not good.any():
            return []
        spans = stretches(good)
        most = np.where(spans[:, 1] >= enough, (spans[:, 1] + gram - 1) // (times - 1), 0)
        places = np.flatnonzero(good)
        far = back[places] > np.repeat(most, spans[:, 1])
        if not far.any():
            break
        good[places[far]] = False
    out: list[tuple[int, int]] = []
    for first, span in stretches(good).tolist():
        if span < enough:
            continue
        begin, end = max(0, first - (span + gram - 1) // (times - 1)), first + span + gram - 1
        while out and out[-1][1] >= begin:
            begin = min(begin, out.pop()[0])
        out.append((begin, end))
    return out


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start and period."""
    if times < 2:
        raise ValueError("a run has two periods at least")
    if len(words) < max(least, times):
        return []
    numbers: dict = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == len(words):
        return []
    out = []
    for begin, end in regions(ids, least, times):
        out += [(begin + start, last - start + 1, q) for (start, q), last in repeats(ids[begin:end].tolist(), least, times).items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words: list, found: list[tuple[int, int, int]]) -> list:
    """Words that stand in no run behind its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth).tolist()) if d == 0]


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES, out: str = "found") -> DataFrame:
    """All rows and columns, with a struct ``out``: n_words, runs, the strongest run and the text without repeated periods."""
    at, out = df.columns.index(text), free_name(df, out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for body in batch.column(at).cast(pa.large_binary()):
                words = (body.as_py() or b"").split()
                found = runs_of(words, least, times)
                best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                made.append(
                    {
                        "n_words": len(words),
                        "runs": [dict(zip(("start", "length", "period"), r)) for r in found],
                        "strongest": best and dict(zip(("start", "length", "period"), best)),
                        "collapsed": b" ".join(kept(words, found)).decode("utf-8", "replace"),
                    }
                )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, _FOUND)], schema=pa.schema([*batch.schema, pa.field(out, _FOUND)]))

    return df.mapInArrow(task, T.StructType([*df.schema.fields, T.StructField(out, FOUND)]))


def made_periodic(doc_id: Column, text: Column) -> Column:
    """Text of the contract: with h = crc32(doc_id) and h % 10 = 0, words from a on repeat the first p of them. Null ids stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return F.array_join(
            F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " "
        )

    return F.when(h % 10 == 0, let(split_words(text), repeated)).otherwise(text)


def op12(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    f = F.col("found")
    line = F.transform(f["runs"], lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = f["strongest"]
    return find_runs(docs).select(
        "doc_id",
        F.size(f["runs"]).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(f["collapsed"].cast("binary"), 256).alias("collapsed_sha256"),
    )
