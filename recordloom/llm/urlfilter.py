"""URL rules as a cascade of Bloom filters: exact membership without a join.

Each url offers keys: a host suffix with as many labels as some rule has, followed by a path prefix
as long as some rule's. The distinct keys of the corpus are the universe. Level one of a cascade
encodes the listed keys; the universe keys that it passes wrongly are encoded by level two, the
listed keys that level two passes wrongly by level three, and so on until nothing is left over. A key
of the universe is listed if the first level that refuses it has an even number. Levels shrink
geometrically, so a cascade takes some bits per *listed* key and grows with the list, not with the corpus.

The bits are aggregated by Spark and reach the urls as a scalar subquery. Their size is known before:
a list whose filters would pass ``max_bytes`` is applied by an equal-key join of the keys instead.

Defined results: a null url, or one without ``://``, has empty host and path and meets no rule. Among
the rules that fit, the longest (host and path together, then host) wins. A url that meets none gets the
default verdict. Repeated rows stay; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import ascii_lower, cut_lineage, table


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str


# The rules of the contract.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)

DEFAULT = "allow"
HASHES = 4
MAX_BYTES = 16 * 1024 * 1024


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Every key of the url that some rule could be, longest first.

    Only label counts and path lengths that occur among the rules are offered, so a long url has no more
    keys than a short one. A host has no slash and a rule's path begins with one: keys are not ambiguous.
    """
    keys = []
    for labels in sorted({r.host.count(".") + 1 for r in rules}):
        suffix = F.substring_index(host, ".", -labels)
        enough = F.length(host) - F.length(F.replace(host, F.lit("."))) >= labels - 1
        for length in sorted({len(r.path) for r in rules if r.host.count(".") + 1 == labels}):
            fits = enough & (F.length(path) >= length) & (suffix != "")
            keys.append(F.when(fits, F.struct(F.length(suffix).alias("h"), F.concat(suffix, F.substring(path, 1, length)).alias("key"))))
    by_length = F.array_compact(F.array(*keys))
    ranked = F.transform(by_length, lambda k: F.struct(F.length(k["key"]).alias("n"), k["h"].alias("h"), k["key"].alias("key")))
    return F.transform(F.sort_array(ranked, asc=False), lambda k: k["key"])


def bit_places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + h), key), F.lit(bits)) for h in range(HASHES)]


def bit_words(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the filter's bits as an array of longs; ``bits`` is a multiple of 64."""
    places = keys.select(F.explode(F.array(*bit_places(F.col("key"), level, bits))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))).alias("set")
    )
    # an entry for each word, also for those without a bit
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("set"))
    filled = words.unionByName(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    pairs = filled.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("pairs"))
    return cut_lineage(pairs.select(F.transform("pairs", lambda p: p["set"]).alias("words")))


def passes(key: Column, level: int, bits: int, words: Column) -> Column:
    """Whether a filter passes the key."""
    out = F.lit(True)
    for place in bit_places(key, level, bits):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        out = out & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
    return out


@dataclass(frozen=True)
class Level:
    bits: int
    words: DataFrame


class Cascade:
    """Exact membership of a list within a universe of keys."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES):
        """Both frames have one column ``key``; keys of the universe are distinct.

        ``fits`` is false if the filters would take more than ``max_bytes``; then none is built.
        """
        self.levels: list[Level] = []
        inside = cut_lineage(listed.select("key").distinct().join(universe, "key", "left_semi"))
        others = universe.join(inside, "key", "left_anti")
        n_in, n_out = inside.count(), universe.count()
        # the first level lets through about as many others as there are listed keys
        self.fits = (n_in * 2 * max(8.0, 1.5 * math.log2(max(2.0, n_out / max(1, n_in))))) / 8 <= max_bytes
        include, exclude, number = inside, others, n_in
        rate = max(1, n_in) / max(2.0, math.sqrt(2) * n_out)
        while self.fits and number:
            per_key = max(2.0, 1.5 * math.log2(1 / min(0.5, rate)))
            bits = max(64, 64 * math.ceil(number * per_key / 64))
            level = Level(bits, bit_words(include, len(self.levels), bits))
            found = exclude.filter(passes(F.col("key"), len(self.levels), bits, level.words.scalar()))
            wrong = cut_lineage(found)
            self.levels.append(level)
            include, exclude, number, rate = wrong, include, wrong.count(), 0.25

    def contains(self, key: Column) -> Column:
        """For keys of the universe only; levels are asked in order and the first refusal decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels) - 1, -1, -1):
            level = self.levels[number]
            out = F.when(~passes(key, number, level.bits, level.words.scalar()), F.lit(number % 2 == 1)).otherwise(out)
        return out


def filter_urls(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[UrlRule, ...] = RULES,
    default: str = DEFAULT,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """id, host, path, the longest rule that fits (or null) and the verdict."""
    spark: SparkSession = df.sparkSession
    host, path = host_and_path(F.col(url_col))
    parsed = df.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = parsed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = cut_lineage(keyed.select(F.explode("keys").alias("key")).distinct())
    lists = {
        v: spark.createDataFrame([(r.host + r.path,) for r in rules if r.verdict == v], "key string")
        for v in sorted({r.verdict for r in rules})
    }
    cascades = {v: Cascade(keys, universe, max_bytes) for v, keys in lists.items()}
    if not all(c.fits for c in cascades.values()):
        return by_join(keyed, lists, default)

    def verdict(key: Column) -> Column:
        out = F.lit(None).cast("string")
        for v, cascade in cascades.items():
            out = F.when(cascade.contains(key), F.lit(v)).otherwise(out)
        return out

    # a url has a few keys whatever its length, so they are asked one after the other, longest first
    tries = range(len({(r.host.count("."), len(r.path)) for r in rules}))
    judged = keyed.withColumns({f"_v{i}": verdict(F.get("keys", F.lit(i))) for i in tries})
    met = F.coalesce(
        *[F.when(F.col(f"_v{i}").isNotNull(), F.struct(F.get("keys", F.lit(i)).alias("rule"), F.col(f"_v{i}").alias("verdict"))) for i in tries]
    )
    best = judged.select("page_id", "host", "path", met.alias("m"))
    return best.select(
        "page_id", "host", "path", F.col("m.rule").alias("rule"), F.coalesce(F.col("m.verdict"), F.lit(default)).alias("verdict")
    )


def by_join(keyed: DataFrame, lists: dict[str, DataFrame], default: str) -> DataFrame:
    """The same for lists too long for filters: keys are joined with the list, the longest match per url is kept."""
    listed = None
    for v, keys in lists.items():
        part = keys.select("key", F.lit(v).alias("verdict"))
        listed = part if listed is None else listed.unionByName(part)
    # distinct (host, path) first: urls of one place are judged once
    places = keyed.groupBy("host", "path").agg(F.first("keys").alias("keys"))
    tried = places.select("host", "path", F.posexplode("keys").alias("rank", "key"))
    best = tried.join(listed, "key").groupBy("host", "path").agg(F.min(F.struct("rank", "key", "verdict")).alias("m"))
    return keyed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("m.key").alias("rule"), F.coalesce(F.col("m.verdict"), F.lit(default)).alias("verdict")
    )


def op7(spark, sf: str) -> DataFrame:
    return filter_urls(table(spark, sf, "pages"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, url, instr(url, '://') AS place FROM pages
), r AS (
  SELECT page_id, CASE WHEN place > 0 THEN substr(url, place + 3) ELSE '' END AS rest FROM u
), p AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r
), q AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM p
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
         ('block', 'com', '/de/')
), m AS (
  SELECT q.page_id, max(struct_pack(n := length(h) + length(p), h := length(h), rule := h || p, verdict := verdict)) AS best
  FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY q.page_id
)
SELECT q.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM q LEFT JOIN m USING (page_id)
"""
