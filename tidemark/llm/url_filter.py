"""URL filters: rules on host and path, and a Bloom filter cascade for listed hosts.

Cascade.  Level 1 is a Bloom filter of the listed keys.  The keys of the
complete universe that it takes for listed by mistake go into level 2, the
listed keys that level 2 takes for mistakes into level 3, and so on until a
level makes no mistake.  A key of the universe is then judged exactly by the
first level that doesn't hold it, with hashes and bit tests alone: no join.

A level is an array of 64-bit words, built by an aggregation over set bits and
read into expressions by a scalar subquery.  All levels together take about
1.5 log2(universe / listed) bits for each listed key.  That is reckoned before
they are built: over LARGEST bits (tens of millions of listed keys) the verdicts
come from a shuffled join with the listed keys instead.

Defined results: a null url, or one without ``://``, has an empty host and path;
no rule fits it, it is no key, and its verdict is ``allow``.  Repeated rows are
judged alike and stay.  Rules are tried from the longest; of equally long ones
the first in the alphabet wins.  No listed key, or an empty table: nothing is listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import lower_ascii

#: Bits of all levels that a task may be given.
LARGEST = 1 << 29


@dataclass(frozen=True)
class Rule:
    host: str
    path: str  # without its leading slash
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}/{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(f"/{self.path}")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def matched(rules: Iterable[Rule], host: Column, path: Column, what: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        found = F.when(r.fits(host, path), F.lit(getattr(r, what))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    words: DataFrame  # one row, one array of 64-bit words
    bits: int
    hashes: int
    number: int

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        test = F.lit(True)
        for place in places(key, self):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            shifted = F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int"))
            bit = shifted.bitwiseAND(F.lit(1).cast("long"))
            test = test & (bit == 1)
        return test


def places(key: Column, level: Level) -> list[Column]:
    """Bit numbers of a key; every level has its own hashes."""
    return [
        F.pmod(F.xxhash64(key, F.lit(level.number), F.lit(j)), F.lit(level.bits).cast("long"))
        for j in range(level.hashes)
    ]


def shape(number: int, n: int, others: int) -> tuple[int, int]:
    """Bits and hashes of a level of ``n`` keys that is asked about ``others``."""
    p = min(0.5, n / (math.sqrt(2) * others)) if number == 1 and others else 0.5
    bits = math.ceil(max(n, 1) * math.log(1 / p) / math.log(2) ** 2)
    return max(256, -(-bits // 64) * 64), max(1, round(math.log2(1 / p)))


def build(number: int, keys: DataFrame, n: int, others: int) -> Level:
    """The Bloom filter of ``keys`` (one column, ``key``)."""
    bits, hashes = shape(number, n, others)
    bare = Level(keys, bits, hashes, number)
    set_ = keys.select(F.explode(F.array(*places(F.col("key"), bare))).alias("place"))
    filled = set_.groupBy(F.shiftright("place", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("word")
    )
    whole = keys.sparkSession.range(bits // 64).join(filled, "id", "left")
    # One row of a size that was checked: the level itself.
    row = whole.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word")))).alias("w"))
    return Level(stage(row.select(F.col("w.word").alias("words")), "bloom"), bits, hashes, number)


class Cascade:
    """Exact membership of the keys of a universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.holds(key), out).otherwise(F.lit(level.number % 2 == 0))
        return F.coalesce(out, F.lit(False))


def cascade(universe: DataFrame, largest: int = LARGEST) -> Cascade | None:
    """``universe``: distinct ``key``, and ``listed``.  None where the levels would be too large."""
    sides = {True: universe.where("listed").select("key"), False: universe.where("not listed").select("key")}
    count = dict(universe.groupBy("listed").count().collect())  # two rows
    n, others = count.get(True, 0), count.get(False, 0)
    if not n:
        return Cascade([])
    # Later levels add less than as much as three bits for each listed key.
    if shape(1, n, others)[0] + 3 * n > largest:
        return None
    inside, outside = sides[True], sides[False]
    levels: list[Level] = []
    while n:
        level = build(len(levels) + 1, inside, n, others)
        levels.append(level)
        wrong = stage(outside.where(level.holds(F.col("key"))), "false-positives")
        inside, outside, others = wrong, inside, n
        n = wrong.count()
    return Cascade(levels)


def spam_hosts(pages: DataFrame, url: str = "url", html: str = "html", share: float = 0.1) -> DataFrame:
    """(key, listed): every host, listed if ``share`` of its pages have a title of symbol junk."""
    host, _ = parts(F.col(url))
    junk = F.coalesce(F.col(html), F.lit("")).rlike(r"(?i)<title>[^<]*[#*$%&|]{3}")
    seen = pages.select(host.alias("key"), junk.cast("double").alias("junk")).where("key != ''")
    hosts = seen.groupBy("key").agg(F.avg("junk").alias("junk"))
    return stage(hosts.select("key", (F.col("junk") >= share).alias("listed")), "hosts")


def judge(pages: DataFrame, rules: Iterable[Rule], universe: DataFrame, url: str = "url", largest: int = LARGEST) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``listed``; columns of these names are replaced."""
    rules = list(rules)
    host, path = parts(F.col(f"`{url}`"))
    named = pages.withColumns({"host": host, "path": path})
    found = cascade(universe, largest)
    if found is not None:
        named = named.withColumn("listed", found.holds(F.col("host")) & (F.col("host") != ""))
    else:
        listed = universe.where("listed").select(F.col("key").alias("__key"), F.lit(True).alias("__listed"))
        named = named.drop("listed").join(listed, F.col("host") == F.col("__key"), "left")
        named = named.withColumn("listed", F.coalesce("__listed", F.lit(False))).drop("__key", "__listed")
    h, p = F.col("host"), F.col("path")
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return named.withColumns(
        {
            "rule": matched(rules, h, p, "text"),
            "verdict": F.coalesce(matched(rules, h, p, "verdict"), by_list),
        }
    )
