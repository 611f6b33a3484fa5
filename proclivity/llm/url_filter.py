"""URL rules by a cascade of Bloom filters.

Level 1 encodes the listed keys. Level 2 encodes those keys of the corpus that level 1 holds wrongly, level 3 the
listed keys that level 2 holds wrongly, and so on until no error is left. The corpus's complete set of keys
was tested while building, so the depth at which a key first falls out tells exactly whether it is listed: an
even level (or the end of an odd number of levels) means listed. Lookups read a few bits of one small array; the
corpus is never joined with the list.

All work is DataFrame expressions. Building scans the urls twice (a count of distinct keys sizes level 1, then
the wrongly held keys are taken out); later levels look at these few keys only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, let

#: Bits of one level at most (16 MB). A list that needs more is an error, not a worse filter.
MAX_BITS = 1 << 27
#: Error rate of the levels after the first: 1/2 gives the smallest filters, less gives fewer levels (and jobs).
LATER_RATE = 1 / 16


@dataclass
class Level:
    bits: int
    hashes: int
    data: bytes  # bit i is bit i % 8 of byte i // 8


@dataclass
class Cascade:
    """Levels over one universe of keys; exact for each key of that universe."""

    levels: list[Level]

    def holds(self, key: Column) -> Column:
        """Whether ``key`` is listed. Stops at the first level that does not hold it."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            level = self.levels[depth]
            inside = _holds(level.data, key, depth, level.bits, level.hashes)
            answer = F.when(~inside, F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


def _positions(key: Column, depth: int, bits: int, hashes: int) -> list[Column]:
    """Bit positions of a key at a level: double hashing with salts of the level."""
    a = F.pmod(F.xxhash64(F.lit(f"a{depth}"), key), F.lit(bits))
    b = F.pmod(F.xxhash64(F.lit(f"b{depth}"), key), F.lit(bits))
    return [F.pmod(a + b * i, F.lit(bits)) for i in range(hashes)]


def _holds(data: bytes, key: Column, depth: int, bits: int, hashes: int) -> Column:
    table, found = F.lit(bytearray(data)), F.lit(True)
    for at in _positions(key, depth, bits, hashes):
        byte = F.substr(table, F.shiftright(at, 3).cast("int") + 1, F.lit(1))
        found = found & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1)
    return found


def _size(keys: int, rate: float) -> tuple[int, int]:
    bits = max(64, math.ceil(keys * math.log2(1 / rate) / math.log(2)))
    if bits > MAX_BITS:
        raise ValueError(f"{keys} keys need {bits} bits; at most {MAX_BITS} are sent to executors")
    return bits, max(1, round(math.log2(1 / rate)))


def _level(keys: DataFrame, depth: int, count: int, rate: float) -> Level:
    bits, hashes = _size(count, rate)
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), depth, bits, hashes))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
    words = at.select(F.shiftright("at", 6).alias("i"), one.alias("w")).groupBy("i").agg(F.bit_or("w").alias("w"))
    table = np.zeros((bits + 63) // 64, dtype="<i8")
    rows = words.toArrow()  # MAX_BITS / 64 words at most
    table[rows.column("i").to_numpy()] = rows.column("w").to_numpy()
    return Level(bits, hashes, table.tobytes())


def build_cascade(ws: Workspace, listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade that is exact on every key of ``universe`` and ``listed`` (frames with a column ``key``).

    The first level's error rate is the published optimum for the ratio of listed to other keys, later ones
    use ``LATER_RATE``. Repeated keys count once, null keys are left out. An empty list holds nothing.
    """
    listed = ws.write(listed.where("key is not null").select("key").distinct(), "listed")
    n = listed.count()
    if n == 0:
        return Cascade([])
    others = universe.agg(F.approx_count_distinct("key")).first()[0]
    first = min(0.5, math.sqrt(2) * n / max(1, others))
    levels = [_level(listed, 0, n, first)]

    def wrongly(keys: DataFrame, level: Level, depth: int) -> DataFrame:
        return keys.where(_holds(level.data, F.col("key"), depth, level.bits, level.hashes))

    # The universe is tested as it streams by; only keys that pass level 1 are made distinct.
    passed = wrongly(universe.where("key is not null").select("key"), levels[0], 0).distinct()
    inside, outside = listed, ws.write(passed.join(listed, "key", "left_anti"), "wrong-0")
    while (count := outside.count()) > 0:
        depth = len(levels)
        levels.append(_level(outside, depth, count, LATER_RATE))
        inside, outside = outside, ws.write(wrongly(inside, levels[-1], depth), f"wrong-{depth}")
    return Cascade(levels)


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All (host or parent domain) + (prefix of the path) a rule could be listed as, as an array.

    ``lengths`` are the lengths of rule paths; a host and a path never join to the same text as another pair
    since a rule's path is empty or starts with '/', which no host contains.
    """
    domains = let(
        F.split(host, r"\.", -1),
        lambda labels: F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        ),
    )
    fitting = F.filter(F.lit(lengths), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substr(path, F.lit(1), n))
    return let(prefixes, lambda ps: F.flatten(F.transform(domains, lambda d: F.transform(ps, lambda p: F.concat(d, p)))))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) of each page.

    ``rules`` has (host, path, verdict): verdict 'allow' or 'block', path empty or starting with '/'. A rule fits its
    host and all subdomains if the url's path starts with the rule's. The longest fitting rule (host and path
    together, then the longer host) decides; a page without one is allowed. A rule given with both verdicts
    blocks. Null urls have an empty host and path. Extra columns of ``pages`` are not looked at.
    """
    spark = pages.sparkSession
    ws = Workspace(spark, "urls")
    listed = ws.write(
        rules.select(
            F.concat(F.lower("host"), F.coalesce("path", F.lit(""))).alias("key"),
            F.length(F.coalesce("path", F.lit(""))).alias("length"),
            (F.col("verdict") == "block").alias("block"),
        ).where("key is not null"),
        "rules",
    )
    # Bounded by the longest rule path, whatever the number of rules.
    lengths = sorted(r.length for r in listed.select("length").distinct().collect())
    host, path = parse_url(F.col(url))
    parsed = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")
    universe = parsed.select(F.explode(keys).alias("key"))
    listed_keys = build_cascade(ws, listed.select("key"), universe)
    blocked_keys = build_cascade(ws, listed.where("block").select("key"), listed.select("key"))
    fits = F.filter(keys, listed_keys.holds)
    # Fitting rules are compared by length; of equal lengths the one found first has the longer host.
    longest = F.aggregate(
        fits,
        F.lit(None).cast("string"),
        lambda best, k: F.when(best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best),
    )
    ruled = parsed.withColumn("rule", longest)
    verdict = F.when(F.col("rule").isNotNull() & blocked_keys.holds(F.col("rule")), "block").otherwise("allow")
    return ruled.withColumn("verdict", verdict)
