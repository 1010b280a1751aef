"""License scan by diagonal voting.

Every run of ``K`` words of every text is hashed and joined to the positions where the same run stands in a
template. A hit at word ``p`` of the text and ``q`` of the template votes for diagonal ``p - q``. Votes are summed
per text, template and diagonal; diagonals that lie close together and follow each other are merged, since an
inserted or dropped word shifts the rest of a license to a neighbouring diagonal. A merged span becomes a
label if enough of the template's words stand in it in order: all equal words along its diagonals count, also single
ones between changed words, each word once. Hits are verified word by word before they vote, so that hashes only select.

The templates are a list of fixed size and are broadcast; a list beyond ``MAX_BROADCAST`` runs is joined as it comes.
Only hits are shuffled.

Defined results: null and empty texts have no words, no labels and score 0; long texts are scanned whole;
equal rows give equal rows, null ids too, since hits meet their text by its place; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.common import FILE, ROW, ascii_lower, cut_lineage, let, table, with_place

# Fixed value: what separates words here.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

K = 3
NEAR = 8  # words that may be inserted or missing between two diagonals of one span
COVERED = 0.8  # of the template's words
MAX_BROADCAST = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Phrases of the contract, then openings and notices of common licenses.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    ),
    Template("gpl", "gnu general public license"),
    Template("gpl", "general public license version 3"),
    Template("gpl", "general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("all-rights-reserved", "all rights reserved"),
)


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def template_runs(spark: SparkSession, templates: tuple[Template, ...], k: int = K) -> DataFrame:
    """(hash, w0.., template, label, base, length, q): every run of k words of every template."""
    rows = []
    for number, t in enumerate(templates):
        if len(t.words) < k:
            raise ValueError(f"template shorter than {k} words: {t.text}")
        rows += [(number, t.label, t.base, len(t.words), q, t.words[q : q + k]) for q in range(len(t.words) - k + 1)]
    runs = spark.createDataFrame(rows, "template int, label string, base boolean, length int, q int, run array<string>")
    runs = runs.withColumn("hash", F.xxhash64(*[F.col("run")[i] for i in range(k)]))
    return F.broadcast(runs) if len(rows) <= MAX_BROADCAST else runs


def template_words(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    words = spark.createDataFrame([(number, t.words) for number, t in enumerate(templates)], "template int, wanted array<string>")
    return F.broadcast(words) if sum(len(t.words) for t in templates) <= MAX_BROADCAST else words


def hits(docs: DataFrame, templates: tuple[Template, ...], k: int = K) -> DataFrame:
    """One row per verified meeting of a text's run with a template's; ``docs`` has the place columns and ``words``."""
    def rolling(words: Column) -> Column:
        hashed = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[words[i + j] for j in range(k)]))
        return F.when(F.size(words) >= k, hashed)

    runs = let(F.col("words"), rolling)
    rolled = docs.select(FILE, ROW, "words", F.posexplode(runs).alias("p", "hash"))
    met = rolled.join(template_runs(docs.sparkSession, templates, k), "hash").join(template_words(docs.sparkSession, templates), "template")
    same = F.lit(True)
    for j in range(k):
        same = same & (F.get("words", F.col("p") + j) == F.col("run")[j])
    # all hits of a diagonal have the same words in common, so only those at the start of equal words name them
    before = F.get("words", F.col("p") - 1) == F.get("wanted", F.col("q") - 1)
    alike = F.transform("wanted", lambda w, i: F.coalesce(F.get("words", F.col("p") - F.col("q") + i) == w, F.lit(False)))
    return met.filter(same).select(FILE, ROW, "template", "label", "base", "length", "p", "q", F.when(F.coalesce(before, F.lit(False)), None).otherwise(alike).alias("alike"))


def words_in_order(diagonals: Column, length: Column, k: int) -> Column:
    """How many words of the template a span has in order; ``diagonals`` has (first, diagonal, q_first, q_last, alike) in order of first.

    From one diagonal to the next there is one place to change over, the one that keeps most words. Before it words count on the one
    diagonal, behind it on the next, there without the template's words that the text lacks.
    """

    def count(alike: Column, start: Column, end: Column) -> Column:
        return F.size(F.filter(F.slice(alike, start + 1, F.greatest(end - start, F.lit(0))), lambda x: x))

    def step(a: Column, b: Column) -> Column:
        lacking = F.greatest(a["diagonal"] - b["diagonal"], F.lit(0))
        least = F.greatest(a["start"], a["q_last"] + 1)
        places = F.transform(
            F.sequence(least, F.greatest(least, b["q_first"] + k - 1)),
            lambda s: F.struct((count(a["alike"], a["start"], s) + count(b["alike"], s + lacking, length)).alias("kept"), s.alias("at")),
        )
        return let(
            F.array_max(places)["at"],
            lambda s: F.struct(
                (a["n"] + count(a["alike"], a["start"], s)).alias("n"), b["diagonal"].alias("diagonal"), b["q_last"].alias("q_last"),
                b["alike"].alias("alike"), (s + lacking).alias("start"),
            ),
        )

    one = diagonals[0]
    none = F.struct(F.lit(0).alias("n"), one["diagonal"].alias("diagonal"), one["q_last"].alias("q_last"), one["alike"].alias("alike"), F.lit(0).alias("start"))
    rest = F.slice(diagonals, F.lit(2), F.size(diagonals))
    return F.aggregate(rest, none, step, lambda a: a["n"] + count(a["alike"], a["start"], length))


def spans(found: DataFrame, k: int = K, near: int = NEAR) -> DataFrame:
    """Diagonals with votes, neighbours merged: (place, label, base, length, first, last, covered, whole)."""
    each = [FILE, ROW, "template", "label", "base", "length"]
    # a long text may meet a template often on one diagonal only once: p - q fixes the place of the template's start
    diagonals = found.groupBy(*each, (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.min("p").alias("first"), F.max("p").alias("last_run"), F.min("q").alias("q_first"), F.max("q").alias("q_last"),
        F.first("alike", ignorenulls=True).alias("alike"),
    )
    order = Window.partitionBy(*each).orderBy("first", "diagonal")
    joins = (
        (F.col("diagonal") - F.lag("diagonal").over(order)).between(-near, near)
        & (F.col("q_first") > F.lag("q_last").over(order))
        & (F.col("first") - F.lag("last_run").over(order) <= near + k)
    )
    runs = diagonals.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    grouped = runs.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = grouped.groupBy(*each, "_span").agg(
        F.min("first").alias("first"), F.max("last_run").alias("last_run"), F.count(F.lit(1)).alias("diagonals"),
        F.sort_array(F.collect_list(F.struct("first", "diagonal", "q_first", "q_last", "alike"))).alias("along"),
    ).withColumn("covered", words_in_order(F.col("along"), F.col("length"), k))
    return merged.select(
        FILE, ROW, "label", "base", "first", (F.col("last_run") + k).alias("end"),
        ((F.col("diagonals") == 1) & (F.col("covered") == F.col("length"))).alias("whole"),
        (F.col("covered") / F.col("length")).alias("share"),
    )


def scan_licenses(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, covered: float = COVERED
) -> DataFrame:
    """Per text: words, exact places of base phrases, their first and last start, labels, score and the method's spans.

    The score is the largest share of a template that some span covers, 0 without hits.
    """
    placed = with_place(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    docs = placed.select(FILE, ROW, "doc_id", license_words(F.col("text")).alias("words"))
    found = spans(hits(docs, templates))
    exact = F.col("base") & F.col("whole")
    said = F.col("whole") | (~F.col("base") & (F.col("share") >= covered))
    per_text = cut_lineage(
        found.groupBy(FILE, ROW).agg(
            F.count_if(exact).alias("n_base"), F.min(F.when(exact, F.col("first"))).alias("first_word"), F.max(F.when(exact, F.col("first"))).alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set(F.when(said, F.col("label")))), ",").alias("labels"),
            F.max("share").alias("score"),
            F.sort_array(F.collect_list(F.when(said, F.struct("first", "end", "label", "share")))).alias("spans"),
        )
    )
    counts = docs.select(FILE, ROW, "doc_id", F.size("words").cast("long").alias("n_words"))
    return counts.join(per_text, [FILE, ROW], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"),
        F.col("last_word").cast("long"), F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )


def op5(spark, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents")).drop("spans")
