"""Quality rules: one table of thresholds, compiled into one projection.

The measures of a text are Column expressions (length, symbols, stop words, lines, repeated
windows), so that a rule set costs one scan: no shuffle, no function of one's own. Measures are
counts; a rule bounds the ratio of two of them.

Defined results: a null or empty text has no words and fails the base rule; very long texts are
measured whole in n log n; equal rows give equal rows; an empty table gives no rows; columns that
the measures are named like are not touched, because only id and text are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import SPACE_RUN, WORD, let, split_words

# Frequent function words of English, German, Spanish and French.
STOP_WORDS = (
    "the of and to in is that for it with as on be at by this are was from or an a have not but they his her she he you we "
    "der die das und zu in den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este "
    "le les et des du est une pour dans qui par sur au il ne pas plus ce avec son ou sont mais comme aux"
).split()

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``low * denominator <= numerator <= high * denominator``; a missing bound holds."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, base = F.col(self.numerator).cast("double"), F.col(self.denominator).cast("double")
        parts = []
        if self.low is not None:
            parts.append(value >= base * F.lit(float(self.low)))
        if self.high is not None:
            parts.append(value <= base * F.lit(float(self.high)))
        out = F.lit(True)
        for p in parts:
            out = out & p
        return out


#: The production thresholds. Ratios, so that a text's length alone decides nothing beyond the base rule.
RULES = (
    Rule("word length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.5),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 0.7),
    Rule("stop words", "n_stop_words", "n_words", 0.01, None),
)

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found at least twice, the first time included.

    Windows are compared by 64-bit hash. Only texts that have equal windows sort them.
    """

    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twice(s: Column) -> Column:
            last = F.size(s) - 1
            equal = F.transform(
                s,
                lambda e, k: F.when(
                    ((k > 0) & (F.get(s, k - 1)["g"] == e["g"])) | ((k < last) & (F.get(s, k + 1)["g"] == e["g"])), e["i"]
                ),
            )
            starts = F.sort_array(F.filter(equal, lambda x: x.isNotNull()))
            return F.aggregate(
                starts,
                F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
            )["n"]

        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(placed, twice)).otherwise(F.lit(0))

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) >= 4, let(grams, covered)).otherwise(F.lit(0)).cast("long")


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text with its counts; see the module for odd texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    # words and lines are bound by ``let``: a filter on the result that Spark pushes down must not split a text once per word
    def of_words(words: Column) -> Column:
        stops = F.filter(words, lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))
        return F.struct(F.size(words).alias("n"), repeat_words(words).alias("repeated"), F.size(stops).alias("stops"))

    def of_lines(found: Column) -> Column:
        return F.struct(F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("twice"))

    counted = df.select(
        F.col(id_col).alias("doc_id"),
        F.length(F.regexp_replace(text, SPACE_RUN, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, of_lines).alias("_l"),
        let(split_words(text), of_words).alias("_w"),
    )
    return counted.select(
        "doc_id",
        F.col("_w.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_l.twice").cast("long").alias("n_dup_lines"),
        F.col("_w.repeated").alias("n_repeat_words"),
        F.col("_l.n").cast("long").alias("n_lines"),
        F.col("_w.stops").cast("long").alias("n_stop_words"),
    )


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``failed_rules`` (names in table order) to measured texts."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    names = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))
    verdict = F.lit(True)
    for r in rules:
        verdict = verdict & r.holds()
    return measured.withColumns({"base_failed": base, "kept": ~base & verdict, "failed_rules": F.array_join(names, ",")})


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    return judge(measures(df, id_col, text_col), rules)


def keep_good(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes, with all their columns.

    The measures travel inside one struct, so no column of the table can clash with them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    measured = measures(df.select(row.alias("_row"), F.col(text_col).alias("text")), "_row", "text")
    return judge(measured, rules).filter("kept").select("doc_id.*")


def op4(spark, sf: str) -> DataFrame:
    from recordloom.llm.common import table

    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(table(spark, sf, "documents").select("doc_id", "text")).select(*columns, "failed_rules")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS found
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM windows, range(3) AS ks(k) WHERE found > 1 GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
    len(list_filter(ws, lambda w: list_contains(string_split('STOPS', ' '), lower(w))))::BIGINT AS n_stop_words
  FROM d LEFT JOIN repeated USING (r)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 'word length' END,
      CASE WHEN n_symbols > 0.5::DOUBLE * n_words THEN 'symbols' END,
      CASE WHEN n_dup_lines > 0.7::DOUBLE * n_lines THEN 'repeated lines' END,
      CASE WHEN n_stop_words < 0.01::DOUBLE * n_words THEN 'stop words' END) AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM v
""".replace("STOPS", " ".join(sorted(set(STOP_WORDS))))
