"""URL rules by a cascade of Bloom filters.

A rule is a host and a path prefix; its key is both joined. Every key that any URL
of the corpus could match is the key universe. The first filter holds the listed
keys, the second the universe's other keys that the first lets through, the third
the listed keys that the second lets through, and so on until none is left: over
that universe membership is exact, and asking needs no join."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Bits of one level at most (8 MB); a longer list is asked by a join instead.
MAX_BITS = 1 << 26
ALLOW, BLOCK = "allow", "block"
#: (host, path prefix, verdict) of the registered query.
RULES = (
    ("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK),
)


def host(url: str = "url") -> Column:
    return F.translate(_after_scheme(url, r"^[^/?#]*"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str = "url") -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def _after_scheme(url: str, pattern: str) -> Column:
    return F.regexp_extract(_rest(url), pattern, 0)


def candidates(host_col: str, path_col: str, lengths: list[int]) -> Column:
    """Keys that a URL may match, the longest first (of equals the longer host):
    every host suffix at a label border with every path prefix of a listed length."""
    labels = F.split(F.col(host_col), r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: F.length(path_col) >= n)
    keys = F.flatten(
        F.transform(hosts, lambda h: F.transform(fits, lambda n: F.struct(
            (-F.length(h) - n).alias("order"), (-F.length(h)).alias("host"), F.concat(h, F.substring(F.col(path_col), F.lit(1), n)).alias("key")
        )))
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    a = F.xxhash64(key, F.lit(2 * level)).bitwiseAND(F.lit(0x7FFFFFFF))
    b = F.xxhash64(key, F.lit(2 * level + 1)).bitwiseAND(F.lit(0x7FFFFFFF))
    return [(a + b * i) % bits for i in range(hashes)]


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    bits: int
    hashes: int
    number: int

    def lets_through(self, key: Column) -> Column:
        """The words travel as one constant array, folded before execution."""
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        out = F.lit(True)
        for p in _positions(key, self.number, self.bits, self.hashes):
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            out = out & (F.getbit(word, (p % 64).cast("int")) == 1)
        return out


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * hashes / math.log(2)))
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("p"))
    # shiftleft of a long by 63 is the sign bit, so every bit of a word is used
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
    held = {r.w: r.v for r in words.collect()}  # at most bits / 64 rows, see MAX_BITS
    return Level(tuple(held.get(i, 0) for i in range((bits + 63) // 64)), bits, hashes, number)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def member(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that stops it
        is of even number."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(~level.lets_through(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def build(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> Cascade | None:
    """The cascade of ``listed`` (distinct ``key``) over ``universe`` (distinct
    ``key``); None if a level would exceed ``max_bits``.

    The first level's rate is set so that about as many other keys pass as are
    listed; so all levels grow with the list, and with the universe only as its
    logarithm. An empty list gives a cascade without levels."""
    others = stored(universe.join(listed, "key", "left_anti"), "others")
    n, m = listed.count(), others.count()
    sides, sizes, levels = [listed, others], [n, m], []
    while sizes[0]:
        rate = min(0.5, math.sqrt(0.5) * sizes[0] / sizes[1]) if not levels and sizes[1] else 0.5
        if sizes[0] * max(1, math.ceil(math.log2(1 / rate))) / math.log(2) > max_bits:
            return None
        level = _level(sides[0], sizes[0], rate, len(levels))
        levels.append(level)
        through = stored(sides[1].where(level.lets_through(F.col("key"))), "through") if sizes[1] else sides[1]
        sides, sizes = [through, sides[0]], [through.count() if sizes[1] else 0, sizes[0]]
    return Cascade(tuple(levels))


def judge(
    spark: SparkSession, pages: DataFrame, rules=RULES, default: str = ALLOW, url: str = "url", id_col: str = "page_id",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per page: id, host, path, rule (the key that fits, else null), verdict
    (the rule's, else ``default``: the cascade does not list the URL).

    A rule fits its host and all subdomains if the path starts with the rule's; the
    longest rule wins. A null URL or one without ``://`` has an empty host and path
    and fits none. Repeated rows and null ids are judged like any other; extra
    columns are ignored; an empty table gives no rows. Lists past ``max_bits`` are
    asked by a join on the key, with the same result."""
    verdict_of = {h.lower() + p: v for h, p, v in rules}
    lengths = sorted({len(p) for _, p, _ in rules}) or [1 << 30]
    own = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    asked = own.withColumn("keys", candidates("host", "path", lengths))
    universe = stored(asked.select(F.explode("keys").alias("key")).distinct(), "universe")
    # the lists are literals of the plan
    listed = {
        v: spark.range(1).select(F.explode(F.array(*[F.lit(k) for k, x in verdict_of.items() if x == v]).cast("array<string>")).alias("key"))
        for v in (ALLOW, BLOCK)
    }
    held = {v: build(t, universe, max_bits) for v, t in listed.items()}
    if any(c is None for c in held.values()):
        return _judge_by_join(asked, listed, default)
    fits = F.filter("keys", lambda k: held[ALLOW].member(k) | held[BLOCK].member(k))
    first = asked.withColumn("rule", F.get(fits, F.lit(0)))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(held[BLOCK].member(F.col("rule")), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return first.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def _judge_by_join(asked: DataFrame, listed: dict[str, DataFrame], default: str) -> DataFrame:
    rules = None
    for v, t in listed.items():
        t = t.withColumn("verdict", F.lit(v))
        rules = t if rules is None else rules.unionByName(t)
    one = asked.select("host", "path", "keys").distinct().select("host", "path", F.posexplode("keys").alias("at", "key"))
    best = one.join(rules, "key").groupBy("host", "path").agg(F.min(F.struct("at", "key", "verdict")).alias("best"))
    found = asked.join(best, ["host", "path"], "left")
    return found.select("page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
