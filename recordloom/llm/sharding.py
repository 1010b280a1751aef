"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows, in the order of their input partitions, form blocks of ``BLOCK_ROWS``. The matrix says how many
rows each block sends to each shard; under a uniform shuffle its law is multivariate hypergeometric with the
block sizes and shard sizes as margins. It is drawn by halving: the whole input's row of the matrix is the
shard sizes, and the row of a range of blocks is split between its halves by exact draws, so that each level
is one projection and no draw waits for a neighbour's. Then each block permutes its rows and cuts them up by its
row of the matrix, the pieces are exchanged, and each shard permutes what it got.

Draws and permutations come from hashes of seed and position: a task that is run again gives the same rows.
No group grows with the input: blocks hold ``BLOCK_ROWS`` rows and shards are permuted in slices of about
``SLICE_ROWS``; only the offsets of slices and of input partitions are summed up in order.

Defined results: equal rows, null ids and null texts are rows like any other; an empty table gives no
rows; with fewer rows than shards some shards stay empty; columns of the table are carried, not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, cut_lineage, let, table, with_place

SHARDS = 40
SEED = 6
BLOCK_ROWS = 8192
SLICE_ROWS = 4096
LEVELS_AT_ONCE = 3


def uniform(*parts: Column) -> Column:
    """Number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def hypergeometric(u: Column, population: Column, marked: Column, drawn: Column) -> Column:
    """Marked ones among ``drawn`` of ``population``, by inversion from the mode outwards.

    Weights relative to the mode's follow from ratios of neighbours, so no factorials are needed. Beyond
    twelve standard deviations, where weights are below 1e-30 of the sum, they are not summed.
    """

    def draw(s: Column) -> Column:
        big, good, n, chance = s["whole"].cast("double"), s["good"].cast("double"), s["drawn"].cast("double"), s["u"]
        low, high = F.greatest(F.lit(0.0), n - (big - good)), F.least(n, good)
        mode = F.least(high, F.greatest(low, F.floor((n + 1) * (good + 1) / (big + 2)).cast("double")))
        spread = F.sqrt(n * (good / big) * (1 - good / big) * (big - n) / F.greatest(F.lit(1.0), big - 1))
        reach = F.ceil(12 * spread + 20).cast("double")
        bounds = F.struct(
            mode.alias("mode"), F.greatest(low, mode - reach).alias("a"), F.least(high, mode + reach).alias("b"),
            big.alias("whole"), good.alias("good"), n.alias("drawn"), chance.alias("u"),
        )
        return F.when((big <= 0) | (n <= 0) | (good <= 0), F.lit(0)).otherwise(let(bounds, invert)).cast("long")

    def invert(s: Column) -> Column:
        def rise(k: Column) -> Column:
            return (s["good"] - k) * (s["drawn"] - k) / ((k + 1) * (s["whole"] - s["good"] - s["drawn"] + k + 1))

        def ups() -> Column:
            return F.when(s["b"] > s["mode"], F.sequence(s["mode"].cast("long"), (s["b"] - 1).cast("long"))).otherwise(
                F.array().cast("array<bigint>")
            )

        def downs() -> Column:
            return F.when(s["mode"] > s["a"], F.sequence((s["mode"] - 1).cast("long"), s["a"].cast("long"), F.lit(-1).cast("long"))).otherwise(
                F.array().cast("array<bigint>")
            )

        def walk(start: Column, steps: Column, step) -> Column:
            return F.aggregate(steps, start, step)

        one = F.lit(1.0)
        both = F.struct(
            walk(
                F.struct(one.alias("w"), F.lit(0.0).alias("sum")), ups(),
                lambda a, k: let(a["w"] * rise(k.cast("double")), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))),
            )["sum"].alias("up"),
            walk(
                F.struct(one.alias("w"), F.lit(0.0).alias("sum")), downs(),
                lambda a, k: let(a["w"] / rise(k.cast("double")), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))),
            )["sum"].alias("down"),
        )

        def find(t: Column) -> Column:
            goal = s["u"] * (1 + t["up"] + t["down"])
            start = F.struct(one.alias("w"), one.alias("sum"), F.when(goal < 1, s["mode"]).alias("at"))

            def seek(a: Column, w: Column, at: Column) -> Column:
                total = a["sum"] + w
                return F.struct(
                    w.alias("w"), total.alias("sum"), F.when(a["at"].isNull() & (goal < total), at).otherwise(a["at"]).alias("at")
                )

            def onwards(up: Column) -> Column:
                again = F.struct(one.alias("w"), up["sum"].alias("sum"), up["at"].alias("at"))
                down = walk(again, downs(), lambda a, k: let(a["w"] / rise(k.cast("double")), lambda w: seek(a, w, k.cast("double"))))
                return F.coalesce(down["at"], s["mode"])

            up = walk(start, ups(), lambda a, k: let(a["w"] * rise(k.cast("double")), lambda w: seek(a, w, k.cast("double") + 1)))
            return let(up, onwards)

        return let(both, find)

    return let(F.struct(population.alias("whole"), marked.alias("good"), drawn.alias("drawn"), u.alias("u")), draw)


def split_counts(counts: Column, drawn: Column, total: Column, node: Column, seed: int) -> Column:
    """How many of ``drawn`` rows go to each shard, if ``total`` rows have ``counts`` in all."""

    def take(a: Column, k: Column) -> Column:
        chance = uniform(F.lit(seed), node, F.size(a["got"]))
        got = hypergeometric(chance, a["whole"], k, a["drawn"])
        return let(
            got,
            lambda g: F.struct(F.concat(a["got"], F.array(g)).alias("got"), (a["drawn"] - g).alias("drawn"), (a["whole"] - k).alias("whole")),
        )

    start = F.struct(F.array().cast("array<bigint>").alias("got"), drawn.alias("drawn"), total.alias("whole"))
    return F.aggregate(counts, start, take)["got"]


def communication_matrix(spark, rows: int, shards: int, seed: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, counts): how many rows each block sends to each shard. Margins are exact."""
    blocks = max(1, math.ceil(rows / block_rows))
    depth = max(0, math.ceil(math.log2(blocks)))
    sizes = [rows // shards + (1 if j < rows % shards else 0) for j in range(shards)]
    root = F.array(*[F.lit(s).cast("long") for s in sizes])
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("node"), root.alias("counts"))
    for level in range(1, depth + 1):
        span = block_rows * 2 ** (depth - level)

        def held(node: Column, span: int = span) -> Column:
            return F.greatest(F.lit(0).cast("long"), F.least(F.lit(span).cast("long"), F.lit(rows).cast("long") - node * span))

        left, right = F.col("node") * 2, F.col("node") * 2 + 1
        drawn = split_counts(F.col("counts"), held(left), held(left) + held(right), left + F.lit(2**level), seed)
        halves = nodes.withColumn("left", drawn)
        rest = F.zip_with("counts", "left", lambda a, b: a - b)
        nodes = halves.select(
            F.inline(F.array(F.struct(left.alias("node"), F.col("left").alias("counts")), F.struct(right.alias("node"), rest.alias("counts"))))
        ).filter(F.col("node") * span < rows)
        if level % LEVELS_AT_ONCE == 0:
            nodes = cut_lineage(nodes.repartition("node"))
    return nodes.withColumnRenamed("node", "block")


def assign_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The columns of ``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    names = [F.col(f"_rl.`{c}`") for c in rows.columns]
    placed = cut_lineage(rows.select(F.struct("*").alias("_rl"), F.monotonically_increasing_id().alias("_at")))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    # one row per input partition: few enough to be summed up in order
    parts = placed.groupBy(part.alias("_part")).count()
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut_lineage(parts.select("_part", "count", F.coalesce(before, F.lit(0)).alias("_before")))
    total = offsets.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    numbered = placed.withColumn("_part", part).join(offsets.drop("count"), "_part")
    ordinal = (F.col("_before") + within).alias("_n")
    rows_in = numbered.select("_rl", ordinal).withColumn("block", F.floor(F.col("_n") / block_rows).cast("long"))
    matrix = communication_matrix(spark, total, shards, seed, block_rows)
    ends = F.transform(
        F.sequence(F.lit(1), F.size("counts")), lambda i: F.aggregate(F.slice("counts", 1, i), F.lit(0).cast("long"), lambda a, x: a + x)
    )
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "_n"), "_n")
    permuted = rows_in.withColumn("_pos", F.row_number().over(local) - 1)
    sent = permuted.join(matrix.select("block", ends.alias("_ends")), "block")
    slices = max(1, math.ceil(total / shards / SLICE_ROWS))
    key = F.xxhash64(F.lit(seed + 2), F.col("_n"))
    exchanged = cut_lineage(
        sent.select(
            "_rl", "_n", F.size(F.filter("_ends", lambda e: e <= F.col("_pos"))).alias("shard"), key.alias("_key"),
            F.pmod(F.xxhash64(F.lit(seed + 3), F.col("_n")), F.lit(slices)).alias("_slice"),
        )
    )
    held = exchanged.groupBy("shard", "_slice").count()
    ahead = F.sum("count").over(Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("shard", "_slice", F.coalesce(ahead, F.lit(0)).alias("_start"))
    again = Window.partitionBy("shard", "_slice").orderBy("_key", "_n")
    ranked = exchanged.withColumn("_rank", F.row_number().over(again) - 1)
    return ranked.join(starts, ["shard", "_slice"]).select(*names, "shard", (F.col("_start") + F.col("_rank")).alias("slot"))


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of a table with ``shard`` and ``slot``; only places move through the draws, texts once at the end.

    A column of the table that has one of these names, in any case, stays with underscores at its end.
    """
    placed = with_place(df)
    assigned = assign_shards(placed.select(FILE, ROW), shards, seed)
    kept, taken = [], {c.lower() for c in df.columns} | {"shard", "slot"}
    for c in df.columns:
        name = c
        if c.lower() in ("shard", "slot"):
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        kept.append(F.col(f"`{c}`").alias(name))
    return placed.join(assigned.withColumnsRenamed({"shard": "_rl_shard", "slot": "_rl_slot"}), [FILE, ROW]).select(
        *kept, F.col("_rl_shard").cast("int").alias("shard"), F.col("_rl_slot").cast("long").alias("slot")
    )


def op6(spark, sf: str) -> DataFrame:
    """A null text has no bytes (size 16) and a null checksum."""
    docs = table(spark, sf, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
