"""Scores of texts under a context-tree weighting model of bytes, learnt from a part of them.

A text is its UTF-8 bytes with A-Z lower-cased, ended by byte 255, which no text holds. A byte is eight binary decisions; each has a
tree of contexts, the bytes before it up to ``depth`` (before the text stand zeros). A node holds how often its decision was
0 and 1 in the training texts and the Krichevsky-Trofimov estimate of these counts, P_e. A node weighs its own estimate and its children
alike, P_w = (P_e + product of the children's P_w) / 2; at full depth P_w = P_e. So all depths are mixed. Counts do not
depend on order, so the model of a corpus is a few aggregations: binary counts of grams at full depth, then one level
after the other up to the root, then down again, where each node hands on how much weight its path has given out and
how much is left. A decision in context s has the probability sum over the path of (weight * its estimate).

Texts must meet their probabilities without a broadcast of the model and without a row for each byte. They are dealt to chunks of
about ``chunk_bytes``; a chunk lists its distinct grams and words, these lists meet the model and the counts in
equal-key joins, and a chunk's texts then meet the chunk's part of the model. A part has no more entries than the chunk has bytes. A text
longer than a chunk is a chunk by itself and is worked on in slices.

Odd input: a null text is empty; an empty one has one token, its end, and the probability of an immediate end. Texts whose
``train`` flag is null are not learnt from. Without any training text all decisions have probability 1/2. Repeated rows are learnt
as often as they stand there; an empty table gives no rows. Scores are finite. Columns of the input are kept; the new one takes the next free name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import FILE, ROW, free_name, stage, table, with_place

DEPTH = 4
CHUNK_BYTES = 24 * 2**20
#: Grams of a chunk are made and looked up in slices of about this many bytes.
SLICE_BYTES = 2 * 2**20
#: Blocks of grams for the two deepest levels have about this many rows.
BLOCK_ROWS = 2**18
#: At most 2^this slots for looking up a chunk's grams.
SLOT_BITS = 22
END = 255

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Columns added to rows: the number of their chunk, whether they are learnt from.
CHUNK, LEARN = "_rl_chunk", "_rl_learn"
LISTS = f"{CHUNK} long, gram long, word binary, n long"
FOUND = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("logs", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def slices(bodies: list[bytes], depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, grams, where each text's grams begin) of runs of texts; the grams of a byte hold its context and itself."""
    at = 0
    while at < len(bodies):
        end, size = at, 0
        while end < len(bodies) and (end == at or size + len(bodies[end]) <= SLICE_BYTES):
            size += len(bodies[end])
            end += 1
        part = bodies[at:end]
        joined = np.frombuffer(b"".join(bytes(depth) + b + bytes([END]) for b in part), np.uint8)
        lengths = np.array([len(b) + 1 for b in part])
        starts = np.concatenate([[0], np.cumsum(lengths + depth)[:-1]])
        for grams, begins, first in cut(joined, starts, lengths, depth):
            yield at + first, grams, begins
        at = end


def cut(joined: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Grams of padded texts; a single long text in parts."""
    if len(starts) == 1:
        for a in range(0, int(lengths[0]), SLICE_BYTES):
            n = min(SLICE_BYTES, int(lengths[0]) - a)
            yield windows(joined[a : a + n + depth], depth), np.zeros(1, np.int64), 0
    elif len(starts):
        all_grams = windows(joined, depth)
        keep = np.ones(len(all_grams), bool)
        # windows that begin in one text's padding and end in the next's are none
        for k in range(depth):
            keep[starts[1:] - 1 - k] = False
        yield all_grams[keep], np.concatenate([[0], np.cumsum(lengths)[:-1]]), 0


def windows(data: np.ndarray, depth: int) -> np.ndarray:
    n = len(data) - depth
    out = data[:n].astype(np.int64)
    for k in range(1, depth + 1):
        out <<= 8
        out |= data[k : k + n]
    return out


def lowered(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of texts with A-Z lower-cased; null is empty."""
    return [(b or b"").translate(LOWER) for b in column.cast(pa.large_binary()).to_pylist()]


def dealt(at: int, chunk_bytes: int):
    """Put the number of its chunk in place of each row's own; a chunk is a run of rows of one task, named by its first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = None, 0
        for batch in batches:
            chunks = []
            lengths = pc.fill_null(pc.binary_length(batch.column(at).cast(pa.large_binary())), 0).to_pylist()
            for place, length in zip(batch.column(batch.num_columns - 2).to_pylist(), lengths):
                if chunk is None or size + length > chunk_bytes:
                    chunk, size = place, 0
                size += length
                chunks.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(chunks, pa.int64()), batch.column(batch.num_columns - 1)], names=batch.schema.names)

    return task


def chunked(df: DataFrame, text: str, train: Column, chunk_bytes: int) -> DataFrame:
    """Rows with chunk and training flag, written once, so that later passes agree on chunks."""
    rows = with_place(df).select(*df.columns, F.xxhash64(FILE, ROW).alias(CHUNK), F.coalesce(train, F.lit(False)).alias(LEARN))
    return stage(rows.mapInArrow(dealt(df.columns.index(text), chunk_bytes), rows.schema), "zstd")


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of several sorted lists with the sums of their counts."""
    values, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)


def grams_of(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for _, grams, _ in slices(bodies, depth):
        parts.append(np.unique(grams, return_counts=True))
        if len(parts) == 8:
            parts = [counted(parts)]
    return counted(parts) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))


def listing(depth: int):
    """Per chunk: its distinct grams and words, with their counts in training texts, which may be 0."""

    def lists(chunk: int, bodies: list[bytes], learn: list[bool]) -> Iterator[pa.RecordBatch]:
        own = [b for b, x in zip(bodies, learn) if x]
        other = [b for b, x in zip(bodies, learn) if not x]
        grams, n = grams_of(own, depth)
        unseen = np.setdiff1d(grams_of(other, depth)[0], grams, assume_unique=True)
        grams, n = np.concatenate([grams, unseen]), np.concatenate([n, np.zeros(len(unseen), np.int64)])
        words = Counter()
        for body in own:
            words.update(body.split())
        for body in other:
            words.update(dict.fromkeys(body.split(), 0))
        size, more = len(grams), len(words)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size + more, chunk, np.int64)),
                pa.concat_arrays([pa.array(grams), pa.nulls(more, pa.int64())]),
                pa.concat_arrays([pa.nulls(size, pa.binary()), pa.array(list(words), pa.binary())]),
                pa.concat_arrays([pa.array(n), pa.array(list(words.values()), pa.int64())]),
            ],
            names=[CHUNK, "gram", "word", "n"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, bodies, learn = None, [], []
        for batch in batches:
            for c, body, x in zip(batch.column(0).to_pylist(), lowered(batch.column(1)), batch.column(2).to_pylist()):
                if c != chunk:
                    if bodies:
                        yield from lists(chunk, bodies, learn)
                    chunk, bodies, learn = c, [], []
                bodies.append(body)
                learn.append(x)
        if bodies:
            yield from lists(chunk, bodies, learn)

    return task


def log_gamma(x, log):
    """Logarithm of the gamma function for x > 0: Stirling's series behind eight steps of the recurrence.

    ``log`` is numpy's or Spark's; the product of eight factors stays finite up to counts of about 1e38.
    """
    y = x + 8.0
    product = x
    for k in range(1, 8):
        product = product * (x + float(k))
    s = 1.0 / (y * y)
    series = (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s * (1 / 1188 - s * (691 / 360360)))))) / y
    return (y - 0.5) * log(y) - y + float(0.5 * np.log(2 * np.pi)) + series - log(product)


def own_estimate(zeros, ones, log=np.log):
    """log P_e of nodes; rounding leaves about 1e-16 for a node without counts."""
    return log_gamma(zeros + 0.5, log) + log_gamma(ones + 0.5, log) - log_gamma(zeros + ones + 1.0, log) - float(np.log(np.pi))


def log_mean(a: Column, b: Column) -> Column:
    """log((e^a + e^b) / 2)."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) - float(np.log(2))


def mask(depth: int) -> int:
    """Bits of a key in a context of ``depth`` bytes; a key is the context and the bits so far behind a leading 1."""
    return (1 << (8 * (depth + 1))) - 1


class Branch:
    """Nodes of the contexts of a block of grams, from full depth up to ``tail`` bytes; a tail's grams are all in one block."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, depth: int, tail: int):
        symbol, context = grams & 255, grams >> 8 << 8
        keys = np.stack([context | (1 << k) | (symbol >> (8 - k)) for k in range(8)])
        self.bits = np.stack([(symbol >> (7 - k)) & 1 for k in range(8)])
        self.keys, place = np.unique(keys, return_inverse=True)
        self.place = place.reshape(keys.shape)
        ones = np.bincount(self.place.ravel(), (self.bits * n).ravel(), len(self.keys))
        zeros = np.bincount(self.place.ravel(), ((1 - self.bits) * n).ravel(), len(self.keys))
        own = own_estimate(zeros, ones)
        weighted, below = own, np.full(len(own), -np.inf)
        #: Of each level: zeros, ones, own estimate, that of the children together, and the children's places.
        self.levels = [(zeros, ones, own, below, None)]
        for d in range(depth - 1, tail - 1, -1):
            self.keys, up = np.unique(self.keys & mask(d), return_inverse=True)
            zeros, ones, below = (np.bincount(up, x, len(self.keys)) for x in (zeros, ones, weighted))
            own = own_estimate(zeros, ones)
            weighted = np.logaddexp(own, below) - np.log(2)
            self.levels.append((zeros, ones, own, below, up))

    def logs(self, given: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte; ``given`` and ``rest`` belong to the nodes of the tails."""
        for zeros, ones, own, below, up in self.levels[::-1]:
            given = given + rest * (ones + 0.5) / (zeros + ones + 1) / (1 + np.exp(np.minimum(below - own, 700)))
            if up is not None:
                rest = rest / (1 + np.exp(np.minimum(own - below, 700)))
                given, rest = given[up], rest[up]
        p = given[self.place]
        return np.log10(np.where(self.bits == 1, p, 1 - p)).sum(axis=0)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in runs of whole tails (the first column, sorted)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= BLOCK_ROWS:
            rows = pa.Table.from_batches(held)
            tails = rows.column(0).to_numpy()
            end = int(np.searchsorted(tails, tails[-1]))
            if end:
                yield rows.slice(0, end)
            held, size = rows.slice(end).combine_chunks().to_batches(), size - end
    if size:
        yield pa.Table.from_batches(held)


def upwards(depth: int, tail: int):
    """Nodes of the tails, for blocks of (tail, gram, n)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            b = Branch(rows["gram"].to_numpy(), rows["n"].to_numpy(), depth, tail)
            zeros, ones, own, below, _ = b.levels[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (b.keys, zeros, ones, own, below)], names=["key", "zeros", "ones", "own", "below"])

    return task


def downwards(depth: int, tail: int):
    """(gram, value) for blocks of (tail, gram, n) and, where gram is null, of (tail, key, given, rest) of the tails' nodes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            at = rows.filter(pc.is_null(rows["gram"]))
            rows = rows.filter(pc.is_valid(rows["gram"]))
            if not len(rows):
                continue
            b = Branch(rows["gram"].to_numpy(), rows["n"].to_numpy(), depth, tail)
            order = np.argsort(at["key"].to_numpy())
            order = order[np.searchsorted(at["key"].to_numpy()[order], b.keys)]
            logs = b.logs(at["given"].to_numpy()[order], at["rest"].to_numpy()[order])
            yield pa.RecordBatch.from_arrays([pa.array(rows["gram"].to_numpy()), pa.array(logs)], names=["gram", "value"])

    return task


def probabilities(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, log10 probability of its last byte in the context of the others) for (gram, n) with counts of the training texts.

    The two deepest levels of contexts are worked out in blocks that hold whole tails (a tail's contexts are 2^16 at most), the
    others, of which there are few, by aggregations and joins.
    """
    tail = max(0, depth - 2)
    tails = grams.select(F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * tail)) - 1)).alias("tail"), "gram", "n")
    dealt_out = tails.repartition("tail").sortWithinPartitions("tail")
    nodes = "key long, zeros double, ones double, own double, below double"
    levels = [stage(dealt_out.mapInArrow(upwards(depth, tail), nodes))]
    zeros, ones, own, below = (F.col(c) for c in ("zeros", "ones", "own", "below"))
    for d in range(tail - 1, -1, -1):
        key = F.col("key").bitwiseAND(F.lit(mask(d)))
        level = levels[-1].groupBy(key.alias("key")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(log_mean(own, below)).alias("below"))
        levels.append(stage(level.withColumn("own", own_estimate(zeros, ones, F.log))))
    # given: probability of a 1 from the nodes above; rest: weight that is left for this node and those below
    path = levels[tail].withColumn("given", F.lit(0.0)).withColumn("rest", F.lit(1.0))
    for d in range(tail):
        one = (ones + 0.5) / (zeros + ones + 1.0)
        above = path.select(
            F.col("key").alias("up"),
            (F.col("given") + F.col("rest") * one / (1.0 + F.exp(below - own))).alias("given"),
            (F.col("rest") / (1.0 + F.exp(own - below))).alias("rest"),
        )
        child = levels[tail - 1 - d].withColumn("up", F.col("key").bitwiseAND(F.lit(mask(d))))
        path = stage(child.join(above, "up").drop("up"))
    tops = path.select(F.shiftright("key", 8).alias("tail"), F.lit(None).cast("long").alias("gram"), F.lit(None).cast("long").alias("n"), "key", "given", "rest")
    none = F.lit(None)
    both = tails.select("*", none.cast("long").alias("key"), none.cast("double").alias("given"), none.cast("double").alias("rest")).unionByName(tops)
    return both.repartition("tail").sortWithinPartitions("tail").mapInArrow(downwards(depth, tail), "gram long, value double")


def finder(keys: np.ndarray, values: np.ndarray):
    """Values of keys that are all there: by hash, and by search for those whose slot another key took."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    bits = int(min(SLOT_BITS, max(8, np.ceil(np.log2(4 * max(1, len(keys)))))))

    def slots(x: np.ndarray) -> np.ndarray:
        return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    owner = np.zeros(1 << bits, np.int32)
    owner[slots(keys)] = np.arange(len(keys), dtype=np.int32)

    def find(x: np.ndarray) -> np.ndarray:
        place = owner[slots(x)].astype(np.int64)
        lost = np.flatnonzero(keys[place] != x)
        place[lost] = np.searchsorted(keys, x[lost])
        return values[place]

    return find


def scored(depth: int, names: list[str], at: int, ends: int):
    """Scores of a chunk's texts from the chunk's part of model and counts."""
    end = (ends > 0, float(np.log10(ends + 1)))

    def task(texts: pa.Table, part: pa.Table) -> pa.Table:
        grams = part.filter(pc.is_valid(part["gram"]))
        find = finder(grams["gram"].to_numpy(), grams["value"].to_numpy())
        words = part.filter(pc.is_valid(part["word"]))
        known = dict(zip(words["word"].to_pylist(), words["value"].to_pylist()))
        bodies = lowered(texts[names[at]].combine_chunks())
        score = np.zeros(len(bodies))
        for first, found, begins in slices(bodies, depth):
            score[first : first + len(begins)] += np.add.reduceat(find(found), begins)
        sizes, hits, sums = [], [], []
        for body in bodies:
            tokens = body.split()
            logs = [x for x in map(known.get, tokens) if x is not None]
            sizes.append(len(tokens) + 1)
            hits.append(len(logs) + end[0])
            sums.append(sum(logs) + end[1])
        made = pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), pa.array(sums, pa.float64()), pa.array(score)], names=["n_tokens", "n_known", "logs", "score"]
        )
        return pa.Table.from_arrays([*(texts[n].combine_chunks() for n in names[:-1]), made], names=names)

    return task


def score_texts(
    df: DataFrame, train: Column, text: str = "text", depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES, out: str = "scores"
) -> DataFrame:
    """All rows and columns, with a struct ``out``: n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    ``train`` marks the rows to learn from. ``depth`` is 1 to 6 bytes.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth is 1 to 6 bytes")
    out = free_name(df, out)
    rows = chunked(df, text, train, chunk_bytes)
    lists = stage(rows.select(CHUNK, text, LEARN).mapInArrow(listing(depth), LISTS), "zstd")
    gram_lists, word_lists = lists.filter("gram is not null"), lists.filter("word is not null")
    grams = stage(gram_lists.groupBy("gram").agg(F.sum("n").alias("n")))
    words = stage(word_lists.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"), "zstd")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = rows.filter(LEARN).count()
    tokens, kinds = totals["n"] + ends, totals["v"] + (ends > 0)
    part = (
        gram_lists.select(CHUNK, "gram")
        .join(probabilities(grams, depth), "gram")
        .select(CHUNK, "gram", F.lit(None).cast("binary").alias("word"), "value")
        .unionByName(
            word_lists.select(CHUNK, "word")
            .join(words, "word")
            .select(CHUNK, F.lit(None).cast("long").alias("gram"), "word", F.log10(F.col("n") + 1).alias("value"))
        )
    )
    schema = T.StructType([*df.schema.fields, T.StructField(out, FOUND)])
    met = rows.groupBy(CHUNK).cogroup(part.groupBy(CHUNK)).applyInArrow(scored(depth, schema.names, df.columns.index(text), ends), schema)
    found = F.col(f"`{out}`")
    base = found["logs"] - found["n_tokens"] * float(np.log10(tokens + kinds + 1))
    return met.withColumn(
        out,
        F.struct(
            found["n_tokens"].alias("n_tokens"), found["n_known"].alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
            base.alias("base_score"), found["score"].alias("score"),
        ),
    )


def held_out(doc_id: Column) -> Column:
    """Rows that are not learnt from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op13(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return score_texts(docs, ~held_out(F.col("doc_id"))).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "scores.*")
