"""Near duplicates: MinHash bands propose, odd sketches judge, full shingle sets confirm.

Texts with equal shingle sets are one node, so groups of exact copies are gone after one aggregation. A node has
``BANDS`` band values of ``ROWS`` MinHash values each, and an odd sketch: the minima of ``BINS`` bins (one MinHash
permutation cut into bins) folded into a bitmap of ``BITS`` parities. The population count of the XOR of two
bitmaps estimates how many minima differ, which is most precise where similarities are high.

Nodes that share a band value form a bucket. Not all pairs of a bucket are looked up, let alone written:

1. In each bucket (in parts of ``PART`` nodes, if it is larger) the spanning forest of largest estimates is
   grown, one sketch against the rest at a time, and its edges, fewer than nodes, are confirmed on the full sets.
2. Components follow. In buckets that still hold several components, pairs from different components are
   compared, in blocks of parts: nodes outside the bucket's largest component with each other and with that one.
   Pairs that may be links by their estimate are confirmed; the others cannot be but for an error of the estimate
   of more than five standard deviations. Buckets with more than ``CROWD`` nodes outside the largest component (pages of one
   template, say, all below the threshold) are dealt again by shingles: with the shingles of each set in order of
   frequency, rare ones first, linked sets have one in common among the first ``n - ceil(n * threshold) + 1``. What the
   template gives stands behind these, so its pages do not meet; no link is lost by it. Any order that is the same for all sets will
   do: shingles are counted by ``SLOTS`` hash slots, so that each task orders its sets alone and only these first ones leave it.
3. Components of all confirmed links give the result. A link that no forest needed joins nothing new.

With 20 bands of 4 rows a pair of similarity 0.85 is missed with probability 4e-7, one of 0.8 with 3e-5. A set of n shingles
resembles an unequal one by n / (n + 1) at most; where that is below the threshold, it can only be linked to equal ones and has no bands.

Defined results: null and empty texts have empty sets and are linked with nothing, each its own component; very
long texts are hashed whole; equal rows and rows with equal ids share a component; a null id is never
the smallest and its row not kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, cut_lineage, stage, table, with_place
from recordloom.llm.components import components
from recordloom.llm.grams import STEP, U, mix, shingle_lists

BANDS, ROWS = 20, 4
BINS, BITS = 2048, 2048
#: Standard deviations that an estimate may lie below the similarity of a link, and what the parities may add.
SIGMAS, PARITY = 5, 0.015
PART = 1024
#: Nodes outside the largest component beyond which a bucket is dealt again.
CROWD = 64
#: Hash slots by which shingles are counted; two sets that meet by several shingles name their pair once if two of ``HEAD`` agree.
SLOTS, HEAD = 2**20, 64

_numbers = np.random.default_rng(3)
FACTORS = _numbers.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * U(2) + U(1)
SHIFTS = _numbers.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

SKETCHED = f"{FILE} long, {ROW} long, doc_id long, n int, sig binary, bands array<long>, odd binary, minima int"


def band_values(shingles: np.ndarray) -> np.ndarray:
    low = np.full(len(FACTORS), np.iinfo(np.uint64).max, U)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None] * FACTORS[None, :] + SHIFTS[None, :]
        low = np.minimum(low, part.min(axis=0))
    rows = low.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=U)
    for j in range(ROWS):
        out = mix(out * STEP + rows[:, j])
    return out.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> tuple[bytes, int]:
    """Parity bitmap of the bin minima and their number; shingles are distinct."""
    order = mix(shingles ^ STEP)
    bins = (order % U(BINS)).astype(np.int64)
    low = np.full(BINS, np.iinfo(np.uint64).max, U)
    np.minimum.at(low, bins, order)
    filled = np.flatnonzero(np.bincount(bins, minlength=BINS))
    places = (mix(low[filled] + filled.astype(U)) % U(BITS)).astype(np.int64)
    parity = np.bincount(places, minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes(), len(filled)


def sketcher(width: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sigs, bands, odds, minima = [], [], [], [], []
            for _, runs, _ in shingle_lists(batch.column("text"), width):
                s = np.unique(runs)
                n.append(len(s))
                if not len(s):
                    sigs.append(None), bands.append(None), odds.append(None), minima.append(0)
                    continue
                # two independent sums of a set of 64-bit hashes, with its size, stand for the set
                sums = np.array([np.add.reduce(mix(s)), np.add.reduce(mix(s * STEP + U(1))) + U(len(s))], U)
                odd, filled = odd_sketch(s)
                sigs.append(sums.tobytes())
                bands.append(band_values(s) if 100 * len(s) >= percent * (len(s) + 1) else None)
                odds.append(odd)
                minima.append(filled)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(FILE), batch.column(ROW), batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(sigs, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(odds, pa.binary()), pa.array(minima, pa.int32()),
                ],
                [FILE, ROW, "doc_id", "n", "sig", "bands", "odd", "minima"],
            )

    return run


class Sketches:
    """Odd sketches of a group of nodes, and the test of pairs for a similarity of ``link``."""

    def __init__(self, group: pa.Table, link: float):
        self.odd = np.frombuffer(b"".join(group.column("odd").to_pylist()), dtype=np.uint64).reshape(group.num_rows, BITS // 64)
        self.minima, self.n = group.column("minima").to_numpy().astype(float), group.column("n").to_numpy().astype(float)
        self.link = link

    def excess(self, one: int, others: np.ndarray) -> np.ndarray:
        """Shared minima of one node with others, over those that a linked pair has at least; less than 0: no link.

        The XOR's population count gives how many minima differ, and so how many are shared. A pair of similarity s shares a
        share s of the bins that its union fills. The slack is that of sampling the union without replacement.
        """
        differ = np.bitwise_count(self.odd[others] ^ self.odd[one]).sum(axis=1)
        apart = -BITS / 2 * np.log(np.maximum(1 - 2 * differ / BITS, 1e-3))
        shared = (self.minima[others] + self.minima[one] - apart) / 2
        fewest, largest = np.minimum(self.minima[others], self.minima[one]), np.maximum(self.n[others], self.n[one])
        spread = np.sqrt(self.link * (1 - self.link) / fewest * np.maximum(0, 1 - fewest / largest))
        low = self.link - PARITY - SIGMAS * spread
        filled = BINS * (1 - np.exp(-(self.n[others] + self.n[one]) / (1 + low) / BINS))
        return shared / (low * filled) - 1


def forest(sketches: Sketches) -> list[tuple[int, int]]:
    """Edges of a spanning forest of largest estimates among possible links: memory for one row of estimates, not for pairs."""
    rest = np.arange(1, len(sketches.n))
    best, parent = sketches.excess(0, rest), np.zeros(len(rest), int)
    edges = []
    while len(rest):
        k = int(np.argmax(best))
        node = int(rest[k])
        if best[k] >= 0:
            edges.append((int(parent[k]), node))
        keep = np.arange(len(rest)) != k
        rest, best, parent = rest[keep], best[keep], parent[keep]
        if len(rest):
            again = sketches.excess(node, rest)
            better = again > best
            best, parent = np.where(better, again, best), np.where(better, node, parent)
    return edges


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that come sorted by ``keys``; a group may go over several batches."""
    open_: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if open_ and key != at:
                yield pa.Table.from_batches(open_)
                open_ = []
            at = key
            open_.append(batch.slice(a, b - a))
    if open_:
        yield pa.Table.from_batches(open_)


def pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = ([min(p) for p in pairs], [max(p) for p in pairs])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def forests(link: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "part"]):
            sigs = group.column("sig").to_pylist()
            yield pair_batch([(sigs[i], sigs[j]) for i, j in forest(Sketches(group, link))])

    return run


def padded(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of at most ``HEAD`` numbers as rows of a matrix, and which of its places they fill."""
    rows = lists.to_pylist()
    there = np.arange(HEAD) < np.array([len(r) for r in rows])[:, None]
    out = np.zeros(there.shape, np.int64)
    out[there] = np.concatenate([np.array(r, np.int64) for r in rows])
    return out, there


def crossings(link: float, banded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of different components in a block; ``side`` 0 rows are compared with each other (if the block is square) and with side 1.

    A pair that meets in several buckets of bands is named in the one of its first common band, one that meets by several shingles by the
    smallest of those that both have among their ``HEAD`` smallest, or by each if there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "block"]):
            sigs, sketches = group.column("sig").to_pylist(), Sketches(group, link)
            numbers: dict[bytes, int] = {}
            labels = np.array([numbers.setdefault(x, len(numbers)) for x in group.column("label").to_pylist()])
            bands = np.array(group.column("bands").to_pylist(), np.int64) if banded else None
            heads, there = (None, None) if banded else padded(group.column("heads"))
            key, side, square = group.column("key")[0].as_py(), group.column("side").to_numpy(), group.column("square")[0].as_py()
            pairs = []
            for i in np.flatnonzero(side == 0):
                others = np.flatnonzero((labels != labels[i]) & ((side == 1) | (square & (np.arange(len(side)) > i))))
                if len(others):
                    near = others[sketches.excess(int(i), others) >= 0]
                    if banded:
                        near = near[bands[i][np.argmax(bands[near] == bands[i], axis=1)] == key]
                    elif len(near):
                        same = there[near] & np.isin(heads[near], heads[i][there[i]])
                        first = heads[near, np.argmax(same, axis=1)]
                        near = near[~same.any(axis=1) | (first == key)]
                    pairs += [(sigs[i], sigs[j]) for j in near]
            yield pair_batch(pairs)

    return run


def confirmer(width: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = zip(shingle_lists(batch.column("text_a"), width), shingle_lists(batch.column("text_b"), width), strict=True)
            last, known = None, np.empty(0, U)
            for i, ((_, left, _), (_, right, _)) in enumerate(sides):
                a = batch.column("a")[i].as_py()
                if a != last:
                    last, known = a, np.unique(left)
                right = np.unique(right)
                both = len(np.intersect1d(known, right, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(known) + len(right) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def divided(labelled: DataFrame) -> DataFrame:
    """(key, main, mains, held) of the buckets of ``labelled`` (key, sig, label) that hold several components."""
    sizes = labelled.groupBy("key", "label").count()
    return sizes.groupBy("key").agg(
        F.max_by("label", F.struct("count", "label")).alias("main"), F.max("count").alias("mains"), F.sum("count").alias("held"), F.count(F.lit(1)).alias("parts")
    ).filter("parts > 1").drop("parts")


def across(labelled: DataFrame, split: DataFrame, sketches: DataFrame, percent: int, banded: bool) -> DataFrame:
    """Possible links (a, b) between the components of each bucket; no task holds more than two parts of one."""
    rest = labelled.join(split, "key").withColumn("others", F.col("held") - F.col("mains"))
    small, large = F.ceil(F.col("others") / PART), F.ceil(F.col("mains") / PART)
    h = F.xxhash64("sig")
    # others: rows of a square of parts, and of a rectangle against the parts of the main component
    own = F.pmod(h, small)
    outside = F.concat(
        F.transform(F.sequence(F.lit(0).cast("long"), small - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), F.when(j < own, 1).otherwise(0).alias("side"), (own == j).alias("square"), F.lit(0).alias("kind"))),
        F.transform(F.sequence(F.lit(0).cast("long"), large - 1), lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(0).alias("side"), F.lit(False).alias("square"), F.lit(1).alias("kind"))),
    )
    inside = F.transform(F.sequence(F.lit(0).cast("long"), small - 1), lambda i: F.struct(i.alias("i"), F.pmod(h, large).alias("j"), F.lit(1).alias("side"), F.lit(False).alias("square"), F.lit(1).alias("kind")))
    blocks = rest.select("key", "sig", "label", F.explode(F.when(F.col("label") == F.col("main"), inside).otherwise(outside)).alias("b"))
    flat = blocks.select(
        "key", F.xxhash64("b.i", "b.j", "b.kind").alias("block"), "sig", "label", F.col("b.side").alias("side"), F.col("b.square").alias("square")
    )
    columns = ["odd", "minima", "n", "bands" if banded else "heads"]
    withs = flat.join(sketches.select("sig", *columns), "sig").select("key", "block", "sig", "label", "side", "square", *columns)
    ready = withs.repartition("key", "block").sortWithinPartitions("key", "block", "side", "sig")
    return ready.mapInArrow(crossings(percent / 100, banded), "a binary, b binary")


def shingler(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(runs).view(np.int64) for _, runs, _ in shingle_lists(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(sets, pa.list_(pa.int64()))], ["sig", "shingles"])

    return run


def slots_of(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles.view(U) ^ STEP) % U(SLOTS)).astype(np.int64)


def slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(SLOTS, np.int64)
    for batch in batches:
        held += np.bincount(slots_of(batch.column("shingles").flatten().to_numpy(zero_copy_only=False)), minlength=SLOTS)
    slots = np.flatnonzero(held)
    for at in range(0, len(slots), 65536):
        part = slots[at : at + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(held[part])], ["slot", "held"])


def rarest(held: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first ``n - ceil(n * percent / 100) + 1`` shingles of each set, sorted by value, without those that no other set has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                shingles = batch.column("shingles")[i].values.to_numpy(zero_copy_only=False)
                often = held[slots_of(shingles)]
                first = np.lexsort((shingles, often))[: len(shingles) + -len(shingles) * percent // 100 + 1]
                out.append(np.sort(shingles[first[often[first] > 1]]))
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(out, pa.list_(pa.int64()))], ["sig", "keys"])

    return run


def rare_shingles(asked: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(sig, keys): the shingles by which linked sets of ``asked`` (sig) must meet, the rare ones.

    Shingles are ordered by the count of their slot, then by value. A slot's count is that of a shingle or more, so a shingle
    whose slot counts one is in one set only. Counts of slots above one, ``SLOTS`` at most, go to all tasks.
    """
    sets = stage(texts.join(asked, "sig", "left_semi").select("sig", "text").mapInArrow(shingler(width), "sig binary, shingles array<long>"))
    counts = sets.select("shingles").mapInArrow(slot_counts, "slot int, held long").groupBy("slot").agg(F.sum("held").alias("held"))
    often = counts.filter("held > 1").toArrow()
    held = np.ones(SLOTS, np.int32)
    held[often.column("slot").to_numpy()] = np.minimum(often.column("held").to_numpy(), np.iinfo(np.int32).max)
    return stage(sets.mapInArrow(rarest(held, percent), "sig binary, keys array<long>"))


def duplicate_links(nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between nodes, enough to join all that are linked.

    ``nodes`` has sig, bands, odd, minima; ``texts`` gives sig and one text for the nodes that ``members`` names.
    """
    banded = nodes.filter("bands is not null").select("sig", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").count().filter("count > 1").withColumnRenamed("count", "held")
    members = stage(banded.join(shared, "key"))
    asked = members.select("sig").distinct()
    sketches = stage(nodes.select("sig", "odd", "minima", "n", "bands").join(asked, "sig", "left_semi"))
    wanted = stage(texts(asked))

    def confirm(pairs: DataFrame) -> DataFrame:
        left = pairs.distinct().join(wanted.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a")
        both = left.join(wanted.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")
        return cut_lineage(both.select("a", "b", "text_a", "text_b").mapInArrow(confirmer(width, percent), "a binary, b binary"))

    part = F.pmod(F.xxhash64("sig"), F.ceil(F.col("held") / PART)).alias("part")
    first = members.select("key", part, "sig").join(sketches, "sig").select("key", "part", "sig", "odd", "minima", "n")
    dealt = first.repartition("key", "part").sortWithinPartitions("key", "part", "sig")
    links = confirm(dealt.mapInArrow(forests(percent / 100), "a binary, b binary"))

    labelled = members.join(components(links), members["sig"] == F.col("node"), "left").select(
        "key", members["sig"], F.coalesce("label", members["sig"]).alias("label")
    )
    split = stage(divided(labelled))
    if split.isEmpty():
        return links
    crowded = F.col("held") - F.col("mains") > CROWD
    found = links.unionByName(confirm(across(labelled, split.filter(~crowded), sketches, percent, True)))
    again = split.filter(crowded)
    if not again.isEmpty():
        nodes_again = labelled.join(again.select("key"), "key", "left_semi").select("sig", "label").distinct()
        rare = rare_shingles(nodes_again.select("sig"), wanted, width, percent)
        dealt_again = stage(rare.select("sig", F.explode("keys").alias("key")).join(nodes_again, "sig"))
        headed = sketches.join(rare.select("sig", F.slice("keys", 1, HEAD).alias("heads")), "sig")
        found = found.unionByName(confirm(across(dealt_again, divided(dealt_again), headed, percent, False)))
    return found


def near_duplicates(placed: DataFrame, width: int, percent: int) -> DataFrame:
    """(place, doc_id, n, component): ``placed`` has the place columns, doc_id and text. The component is the smallest doc_id in it."""
    sketched = stage(placed.select(FILE, ROW, "doc_id", "text").mapInArrow(sketcher(width, percent), SKETCHED))
    nodes = stage(
        sketched.filter("sig is not null").groupBy("sig").agg(
            F.min(F.struct(FILE, ROW)).alias("at"), F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("odd").alias("odd"),
            F.first("minima").alias("minima"), F.first("n").alias("n"),
        )
    )

    def texts(asked: DataFrame) -> DataFrame:
        where = nodes.join(asked, "sig", "left_semi").select("sig", f"at.{FILE}", f"at.{ROW}")
        return placed.select(FILE, ROW, "text").join(where, [FILE, ROW]).select("sig", "text")

    labels = components(duplicate_links(nodes, texts, width, percent))
    named = nodes.select("sig", "least").join(labels, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("label", "sig").alias("label"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    of_sig = named.select("sig", "label").join(smallest, "label").select("sig", "component")
    return sketched.select(FILE, ROW, "doc_id", "n", "sig").join(of_sig, "sig", "left").select(
        FILE, ROW, "doc_id", "n", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component")
    )


def op3(spark, sf: str) -> DataFrame:
    placed = with_place(table(spark, sf, "documents").select("doc_id", "text"))
    return near_duplicates(placed, 3, 85).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the first of those with the smallest id.

    Texts without words stand for themselves.
    """
    names = [f"`{c}`" for c in df.columns]
    placed = with_place(df)
    plain = placed.select(FILE, ROW, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = near_duplicates(plain, width, percent)
    # rows without an id of their own group fall back on their place
    candidates = found.filter("n > 0 and (component is null or doc_id = component)")
    one = candidates.groupBy("component", F.when(F.col("component").isNull(), F.struct(FILE, ROW))).agg(F.min(F.struct(FILE, ROW)).alias("at"))
    kept = one.select(f"at.{FILE}", f"at.{ROW}").unionByName(found.filter("n = 0").select(FILE, ROW))
    return placed.join(kept, [FILE, ROW], "left_semi").select(*names)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT r, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)
  UNION ALL SELECT r, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 2),
sizes AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS (
  SELECT p.a, p.b FROM (SELECT x.r AS a, y.r AS b, count(*) AS both FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r) p
  JOIN sizes m ON m.r = p.a JOIN sizes n ON n.r = p.b WHERE 100 * p.both >= 85 * (m.n + n.n - p.both)),
reach AS (SELECT r, r AS seen FROM d UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.seen = links.a),
least AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.seen GROUP BY reach.r)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, least.component_id, coalesce(d.doc_id = least.component_id, false) AS kept
FROM d JOIN least ON least.r = d.r LEFT JOIN sizes ON sizes.r = d.r
"""
