"""Mixing sources to target weights by entropy balancing.

Each document gets a rate between 0 and 2: the rates closest in entropy to "each document once" whose words
add up to the target of each source. The dual of that problem is convex with one multiplier per source, and
its solution tilts rates exponentially in a document's size, ``2 / (1 + exp(-multiplier * size))``. Newton
iterations find the multipliers of all sources together: each is one aggregation over the table of
(source, size, documents), which is aggregated once before and is all that the iterations read.

Rates become copies by running sums in classes of sizes (powers of two), and what that rounding left is made up by a bounded
number of sizes of each class, from the largest to the smallest; a source therefore misses its target by about half of its
smallest documents, unless a large document is more than they can make up for. Documents of one size share the
copies by a hash of their key. A group of equal size with very many documents is dealt in salted parts, with
the share of each part rounded on its own.

A source of W words has fewer than sqrt(2 W) different sizes, whatever its number of documents; no array holds them: they are
rows, summed up class by class in windows that can spill. The table of sources is ranked by range partitions, not in one task.

Defined results: a null or empty text has size 0 and no words are taken of it; a null source is a source of its
own, last in order; equal rows are separate documents; an empty table gives no rows. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, cut_lineage, split_words, table, with_place

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SALT_ROWS = 2048
TOLERANCE = 1e-6
MAX_NEWTON = 200
#: Sizes of each class of a source that make up for what rounding the others left.
MAKERS = 16

KEY = ["_src", "_none"]


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``_rank``, the place of a source by code point from 0, null last."""
    order = [F.col("_none"), F.col("_src")]
    dealt = cut_lineage(sources.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    held = dealt.groupBy("_pid").count()
    ahead = F.sum("count").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("_pid", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    rank = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1 + F.col("_ahead")
    return dealt.join(starts, "_pid").withColumn("_rank", rank).drop("_pid", "_ahead")


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add ``target``: shares by weight, none above ``most`` times the source's words.

    A common level per unit of weight is raised until nothing is in excess; each step is one aggregation.
    """
    order = F.array(*[F.lit(float(w)) for w in weights])
    weighed = cut_lineage(ranked(sources).withColumn("_w", F.get(order, F.pmod("_rank", F.lit(len(weights))).cast("int"))))
    cap = F.col("source_size") * most
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = 0.0, -1
    while True:
        stops = F.col("_w") * level >= cap
        a = weighed.agg(
            F.count_if(stops).alias("n"), F.sum(F.when(stops, cap).otherwise(0)).alias("cap"), F.sum(F.when(~stops, F.col("_w"))).alias("w")
        ).first()
        if a["n"] == full or not a["w"]:
            break
        full, level = a["n"], (share * total - a["cap"]) / a["w"]
    if total == 0:
        return weighed.withColumn("target", F.lit(0.0))
    return weighed.withColumn("target", F.least(cap.cast("double"), F.col("_w") * F.lit(level)))


def rate(multiplier: Column, z: Column, most: int) -> Column:
    tilt = F.exp(-F.greatest(F.lit(-600.0), F.least(F.lit(600.0), multiplier * z)))
    return most / (1 + (most - 1) * tilt)


def solve(histogram: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """Newton iterations for the multiplier of each source; bisection where a step leaves what is known to bracket it."""
    inner = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * most)
    state = cut_lineage(
        targets.select(
            *KEY, "source_size", "target", "_scale", inner.alias("_open"), F.lit(0.0).alias("_l"),
            F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"),
        )
    )
    for _ in range(MAX_NEWTON):
        z = F.col("size") / F.col("_scale")
        r = rate(F.col("_l"), z, most)
        words = F.col("n") * F.col("size") * r
        sums = histogram.join(state.filter("_open"), KEY).groupBy(*KEY).agg(F.sum(words).alias("_f"), F.sum(words * z * (1 - r / most)).alias("_g"))
        gap = F.col("_f") - F.col("target")
        done = F.abs(gap) <= F.lit(0.25) + F.col("target") * TOLERANCE
        lo = F.when(gap < 0, F.col("_l")).otherwise(F.col("_lo"))
        hi = F.when(gap > 0, F.col("_l")).otherwise(F.col("_hi"))
        near = 4 * (F.abs(F.col("_l")) + 1)
        step = F.greatest(-near, F.least(near, gap / F.greatest(F.col("_g"), F.lit(1e-300))))
        newton = F.col("_l") - step
        inside = (newton > lo) & (newton < hi)
        half = F.when((lo > float("-inf")) & (hi < float("inf")), (lo + hi) / 2).otherwise(F.col("_l") - F.signum(gap) * near)
        moved = state.join(sums, KEY, "left")
        state = cut_lineage(
            moved.select(
                *KEY, "source_size", "target", "_scale", (F.col("_open") & ~F.coalesce(done, F.lit(True))).alias("_open"),
                F.when(~F.col("_open") | F.coalesce(done, F.lit(True)), F.col("_l")).otherwise(F.when(inside, newton).otherwise(half)).alias("_l"),
                F.when(F.col("_open"), lo).otherwise(F.col("_lo")).alias("_lo"), F.when(F.col("_open"), hi).otherwise(F.col("_hi")).alias("_hi"),
            )
        )
        if state.filter("_open").isEmpty():
            break
    return state


def rounded(rated: DataFrame, most: int = MOST, makers: int = MAKERS) -> DataFrame:
    """Add ``_copies``, whole copies of each (source, size), to rows with n, rate, source_size and target.

    Sizes of a source fall into classes by their binary length. In each class the ``makers`` sizes with most documents
    wait; copies of the others are differences of rounded running sums, so a class is off by at most half of its largest
    document. What that left is made up by the waiting sizes of all classes, from the largest to the smallest.
    """
    kind = F.length(F.bin("size")).cast("int")
    classed = rated.withColumn("_class", kind)
    front = Window.partitionBy(*KEY, "_class").orderBy(F.desc("n"), F.desc("size"))
    # Spark limits the rank ahead of the shuffle
    waiting = cut_lineage(classed.withColumn("_at", F.row_number().over(front)).filter(F.col("_at") <= makers).drop("_at"))
    others = classed.join(waiting.select(*KEY, "size"), [*KEY, "size"], "left_anti")
    run = Window.partitionBy(*KEY, "_class").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.col("n") * F.col("rate")).over(run)
    summed = others.withColumn("_upto", upto)
    before = F.coalesce(F.lag("_upto").over(Window.partitionBy(*KEY, "_class").orderBy(F.desc("size"))), F.lit(0.0))
    dealt = cut_lineage(
        summed.withColumn("_copies", (F.round("_upto") - F.round(before)).cast("long")).withColumn(
            "_copies", F.when(F.col("size") > 0, F.least(F.col("n") * most, "_copies")).otherwise(F.lit(0).cast("long"))
        )
    )
    left = dealt.groupBy(*KEY).agg(F.sum(F.col("size") * (F.col("n") * F.col("rate") - F.col("_copies"))).alias("_due"))
    groups = waiting.groupBy(*KEY, "source_size", "target").agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("_sizes"))

    def fold(a: Column, g: Column) -> Column:
        due = a["due"] + g["n"] * g["size"] * g["rate"]
        want = F.when(g["size"] > 0, F.round(due / g["size"])).otherwise(F.lit(0.0)).cast("long")
        copies = F.greatest(F.lit(0).cast("long"), F.least(g["n"] * most, want))
        return F.struct((due - copies * g["size"]).alias("due"), F.concat(a["copies"], F.array(copies)).alias("copies"))

    # a rounded due: sums of doubles depend on their order in the last digits
    start = F.struct(F.round(F.coalesce("_due", F.lit(0.0)), 3).alias("due"), F.array().cast("array<bigint>").alias("copies"))
    folded = groups.join(left, KEY, "left").withColumn("_copies", F.aggregate("_sizes", start, fold)["copies"])
    made = folded.select(
        *KEY, "source_size", "target",
        F.inline(F.zip_with("_sizes", "_copies", lambda s, c: F.struct(s["size"].alias("size"), s["n"].alias("n"), s["rate"].alias("rate"), c.alias("_copies")))),
    )
    return made.unionByName(dealt.select(*made.columns))


def mix(docs: DataFrame, key: list[str], weights=WEIGHTS, share: float = SHARE, most: int = MOST, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``docs`` has the key columns, ``source`` and ``size``; the result adds source_size, target, rate, copies and taken."""
    rows = cut_lineage(
        docs.select(*key, "source", "size", F.coalesce("source", F.lit("")).alias("_src"), F.col("source").isNull().alias("_none"))
    )
    histogram = cut_lineage(rows.groupBy(*KEY, "size").agg(F.count(F.lit(1)).alias("n")))
    sources = histogram.groupBy(*KEY).agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.greatest(F.lit(1), F.max("size")).cast("double").alias("_scale")
    )
    state = solve(histogram, source_targets(sources, weights, share, most), most)
    r = F.when(F.col("target") <= 0, 0.0).when(F.col("target") >= F.col("source_size") * most, float(most)).otherwise(
        # sums of doubles depend on their order in the last digits; copies must not
        rate(F.round("_l", 6), F.col("size") / F.col("_scale"), most)
    )
    rated = histogram.join(state, KEY).withColumn("rate", r)
    plan = rounded(cut_lineage(rated), most)
    drawn = F.xxhash64(F.lit(1), *key)
    salt = F.pmod(F.xxhash64(F.lit(2), *key), F.ceil(F.col("n") / salt_rows))
    dealt = rows.join(plan, [*KEY, "size"]).withColumns({"_h": drawn, "_salt": salt})
    dealt = dealt.repartition(*KEY, "size", "_salt")
    part = Window.partitionBy(*KEY, "size", "_salt")
    each = F.floor(F.col("_copies") / F.col("n"))
    over = (F.col("_copies") - each * F.col("n")) * F.count(F.lit(1)).over(part) / F.col("n")
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(3), *KEY, "size", "_salt"), 11) / F.lit(float(2**53))
    whole = F.when(F.col("n") <= salt_rows, F.round(over)).otherwise(F.floor(over + chance))
    copies = each + F.when(F.row_number().over(part.orderBy("_h", *key)) <= whole, 1).otherwise(0)
    return dealt.withColumn("copies", copies.cast("int")).select(
        *key, "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate"
    )


def word_count(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def op1(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def mix_rows(df: DataFrame, source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The rows of the mix: each row of ``df`` as often as it is taken, with the columns it had."""
    placed = with_place(df)
    narrow = placed.select(FILE, ROW, F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    copies = mix(narrow, [FILE, ROW], **options).filter("copies > 0").select(FILE, ROW, F.col("copies").alias("_rl_copies"))
    taken = placed.join(copies, [FILE, ROW])
    names = [f"`{c}`" for c in df.columns]
    return taken.select(*names, F.explode(F.array_repeat(F.lit(1), F.col("_rl_copies"))).alias("_rl_copy")).select(*names)

