"""Benchmark decontamination: which documents contain which test items.

An item is contained in a document if the document has at least ``CONTAINED`` of the item's shingles of five words.
Items are short and documents may be long, so similarity of the whole sets is near zero; containment is
estimated instead, with MinHash sketches whose size follows the document. Documents are partitioned by size
(powers of two of their shingles), and each partition has its own number of bins, ``BINS_PER_SHINGLE`` for each
shingle of its largest document. A sketch keeps the minimum of one hash in every bin that is not empty, so in
all partitions alike most of a document's shingles survive as minima of their bins. An item is sketched once per
partition; its bins that agree with a document's, over its own, estimate the containment. Documents whose estimate
reaches ``ESTIMATE`` of the containment asked for are verified on the full shingle sets.

About a fifth of a document's shingles are no minimum, so an item of few shingles could be missed. Items of fewer than
``FEW`` shingles are therefore not sketched: all their shingles are looked up in the document's, and none is missed. For
the others the estimate would have to be off by about ten standard deviations at ``CONTAINED``.

The items' sketches are looked up by every task. They are sent in blocks of at most ``BLOCK_BYTES`` of item text, one
scan of the documents for each block, so what a task holds does not grow with the benchmark. Nothing is shuffled
and each document is read where it lies.

Defined results: null or empty texts, and items with fewer words than a shingle, meet nothing; long texts are read
whole; a repeated document gives its rows again; equal items are separate items; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, table, with_place
from recordloom.llm.grams import U, mix, shingle_lists

WIDTH = 5
CONTAINED = 0.8
#: Of the containment asked for, the share of an item's bins that must agree before it is verified; far below what a contained item shows.
ESTIMATE = 0.25
#: Items of fewer shingles are looked up whole.
FEW = 64
BINS_PER_SHINGLE = 2
BLOCK_BYTES = 4 * 1024 * 1024

SCHEMA = "doc_id long, item_id long, n_shingles int, n_shared int"


def partition_of(n: int) -> int:
    """Size class of a set of n shingles: the power of two at or above it."""
    return max(3, int(n - 1).bit_length())


def sketch(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bin minima of distinct hashes under size class ``size``, each mixed with its bin's number; one per bin that is not empty."""
    bins = U(BINS_PER_SHINGLE << size)
    order = mix(hashes + U(size))
    at = order % bins
    rank = np.lexsort((order, at))
    at, order = at[rank], order[rank]
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    return order[first]


class Lookup:
    """Sorted hashes of several items and whose they are."""

    def __init__(self, hashes: dict[int, np.ndarray], items: int):
        values = np.concatenate(list(hashes.values())) if hashes else np.empty(0, U)
        owner = np.repeat(np.array(list(hashes), int), [len(h) for h in hashes.values()])
        order = np.argsort(values, kind="stable")
        self.values, self.owner, self.count = values[order], owner[order], np.zeros(items, int)
        for item, h in hashes.items():
            self.count[item] = len(h)

    def reached(self, mine: np.ndarray, share: float) -> np.ndarray:
        """Items of whose hashes at least ``share``, and one, are among ``mine``."""
        left, right = np.searchsorted(self.values, mine, "left"), np.searchsorted(self.values, mine, "right")
        hit = np.flatnonzero(right > left)
        if not len(hit):
            return np.empty(0, int)
        owners = np.concatenate([self.owner[left[i] : right[i]] for i in hit])
        agree = np.bincount(owners, minlength=len(self.count))
        return np.flatnonzero((agree > 0) & (agree >= share * self.count))


class Items:
    """A block of items: small ones by all their shingles, the others by sketches for each size class, made when the class is first met."""

    def __init__(self, rows: list[tuple[int, str]], contained: float):
        self.ids, self.sets, self.contained = [], [], contained
        for i, shingles, words in shingle_lists(pa.array([t for _, t in rows], pa.string()), WIDTH):
            if words >= WIDTH:
                self.ids.append(rows[i][0])
                self.sets.append(np.unique(shingles))
        self.few = Lookup({i: s for i, s in enumerate(self.sets) if len(s) < FEW}, len(self.sets))
        self.many = {i: s for i, s in enumerate(self.sets) if len(s) >= FEW}
        self.classes: dict[int, Lookup] = {}

    def index(self, size: int) -> Lookup:
        """Bin minima of the larger items."""
        if size not in self.classes:
            self.classes[size] = Lookup({i: sketch(s, size) for i, s in self.many.items()}, len(self.sets))
        return self.classes[size]

    def candidates(self, document: np.ndarray) -> np.ndarray:
        """Items whose containment in a document's distinct shingles, or its estimate, is high enough to verify."""
        found = self.few.reached(document, self.contained)
        if not self.many:
            return found
        size = partition_of(len(document))
        return np.concatenate([found, self.index(size).reached(sketch(document, size), ESTIMATE * self.contained)])


def searcher(rows: list[tuple[int, str]], contained: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows, contained)
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("doc_id")
            for row, shingles, words in shingle_lists(batch.column("text"), WIDTH):
                if words < WIDTH or not items.sets:
                    continue
                document = np.unique(shingles)
                for item in items.candidates(document):
                    wanted = items.sets[item]
                    shared = len(np.intersect1d(wanted, document, assume_unique=True))
                    if shared >= contained * len(wanted):
                        out.append((ids[row].as_py(), items.ids[item], len(wanted), shared))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "n_shingles", "n_shared"]
            )

    return search


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in runs of about ``block_bytes`` of text; only one run at a time is on the driver."""
    rows = items.selectExpr(f"cast(`{item_col}` as long) as item_id", f"`{text_col}` as text").filter("text is not null")
    block: list[tuple[int, str]] = []
    held = 0
    for r in rows.toLocalIterator():
        if block and held + len(r["text"]) > block_bytes:
            yield block
            block, held = [], 0
        block.append((r["item_id"], r["text"]))
        held += len(r["text"])
    if block:
        yield block


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", contained: float = CONTAINED, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item that it contains: ids, the item's shingles and how many of them it has."""
    chosen = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for block in item_blocks(items, item_col, item_text, block_bytes):
        out = out.unionByName(chosen.mapInArrow(searcher(block, contained), SCHEMA))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", contained: float = CONTAINED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    placed = with_place(docs)
    # a place number instead of the document's id, which may be null or repeated
    numbered = placed.withColumn("_rl_key", F.xxhash64(FILE, ROW))
    leaks = find_leaks(numbered, items, "_rl_key", text_col, "item_id", "text", contained, block_bytes)
    names = [f"`{c}`" for c in docs.columns]
    return numbered.join(leaks.select(F.col("doc_id").alias("_rl_key")).distinct(), "_rl_key", "left_anti").select(*names)


def op2(spark, sf: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return leaks.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), d AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)
), v AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM benchmark
), b AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 4) AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM v)
), n AS (
  SELECT item_id, count(*) AS n FROM b GROUP BY item_id
), m AS (
  SELECT doc_id, item_id, count(*) AS k FROM d JOIN b USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n::INTEGER AS n_shingles, k::INTEGER AS n_shared, k / n AS containment
FROM m JOIN n USING (item_id) WHERE k >= 0.8 * n
"""
