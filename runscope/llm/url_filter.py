"""URL filters: allow and block rules by host and path, and a Bloom filter cascade for all that no rule decides.

Cascade: level 1 is a Bloom filter of the listed keys, level 2 one of the unlisted keys of the corpus that level 1 lets through,
level 3 one of the listed keys that level 2 lets through, and so on until a level lets nothing wrong through. The first level that a
key misses tells whether it is listed, exactly for every key of the corpus, and no row meets the list. Keys are dealt by a hash to as
many parts as keep each part's filters within `part_bytes` a level, each part with all levels of its own keys. Filters reach the rows as
scalar subqueries, TOGETHER parts at once at most; a larger cascade judges the rows of one group of parts after the other. No row is
shuffled, however many parts there are.

All of it is DataFrame functions: hosts and paths, the bits of each level (bit_or of 64-bit words) and the lookups (getbit).

Defined cases: a null url or one without `://` has an empty host and path; the empty key is a key like any other; a listed key that
is null or not in the corpus is passed over, as is a repeated one; other columns are carried along, one named judged is replaced; empty
tables give empty results. Of rules of equal length the one named first wins.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.llm.shared import discard, landed

#: Parts whose filters a task holds at once.
TOGETHER = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """verdict (allow or block) for a host with all its subdomains, where the url's path begins with path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? # or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule's text, rule's verdict) of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter in parts: its number, bits and hash functions in each part, and a table (_part, words) with a row for each part."""

    number: int
    bits: int
    hashes: int
    words: DataFrame

    def of_row(self, first: int, parts: int) -> Column:
        """The words of a row's part (_part), which is one of the TOGETHER from first on."""
        if parts == 1:
            return self.words.select("words").scalar()
        own = self.words.filter(F.col("_part").between(first, first + TOGETHER - 1))
        every = own.agg(F.transform(F.array_sort(F.collect_list(F.struct("_part", "words"))), lambda x: x["words"]).alias("words"))
        return F.get(every.scalar(), F.col("_part") - first)

    def holds(self, key: Column, words: Column) -> Column:
        out = F.lit(True)
        for place in places(key, self.number, self.bits, self.hashes):
            out = out & (F.getbit(F.element_at(words, (F.shiftright(place, 6) + 1).cast("int")), place.bitwiseAND(63).cast("int")) == 1)
        return out


def places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """The bits of a key; each level hashes anew."""
    return [F.pmod(F.xxhash64(F.lit(level), F.lit(j), key), F.lit(bits)) for j in range(hashes)]


def part_of(key: Column, parts: int) -> Column:
    """The part of the filters that a key is looked up in."""
    return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)).cast("int")


def build_level(keys: DataFrame, number: int, most: int, rate: float, parts: int) -> Level:
    """A Bloom filter of the keys (key, _part) with about this rate of false positives; most: keys in the fullest part."""
    bits = 64 * max(1, math.ceil(-most * math.log(rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / most * math.log(2)))
    place = keys.select("_part", F.explode(F.array(*places(F.col("key"), number, bits, hashes))).alias("place"))
    set_bits = place.select("_part", F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bits"))
    size = bits // 64
    every = keys.sparkSession.range(parts * size).select((F.col("id") / size).cast("int").alias("_part"), (F.col("id") % size).alias("word"), F.lit(0).cast("long").alias("bits"))
    # one row for each word of a part, whatever the number of keys; a part's words are bounded by part_bytes
    dense = set_bits.unionByName(every).groupBy("_part", "word").agg(F.bit_or("bits").alias("bits"))
    words = dense.groupBy("_part").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
    return Level(number, bits, hashes, landed(words, "bloom-level"))


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]
    parts: int

    def with_listed(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """rows with a column `name`: whether their key, a key of the corpus, is listed: by the first level that it misses, an even one if it is.

        Filters reach the rows as scalar subqueries, TOGETHER parts of them at a time, and never by a join. Rows of more parts are judged
        a group of parts after the other, each written before the next filters are read. A column named _part is taken.
        """
        out = []
        for own, column in grouped(rows.withColumn("_part", part_of(F.col(key), self.parts)), self.levels, self.parts):
            listed = F.lit(len(self.levels) % 2 == 1)
            for level in reversed(self.levels):
                listed = F.when(level.holds(F.col(key), column(level)), listed).otherwise(F.lit(level.number % 2 == 0))
            judged = own.withColumn(name, listed).drop("_part")
            out.append(judged if self.parts <= TOGETHER else landed(judged, "url-judged"))
        return reduce(DataFrame.unionByName, out)


def grouped(rows: DataFrame, levels: list[Level], parts: int) -> Iterator[tuple[DataFrame, Callable[[Level], Column]]]:
    """For each TOGETHER parts, the rows (with _part) of those, and a function that gives a level's words for a row."""
    for first in range(0, parts, TOGETHER):
        own = rows if parts <= TOGETHER else rows.filter(F.col("_part").between(first, first + TOGETHER - 1))
        yield own, lambda level, first=first: level.of_row(first, parts)


def build_cascade(keys: DataFrame, part_bytes: int = 1 << 20, later_rate: float = 1 / 32) -> Cascade:
    """Cascade for keys (key, listed: boolean), each key once; in as many parts as keep the first level's, the largest, at part_bytes."""
    counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    n, rest = counts.get(True, 0), counts.get(False, 0)
    rate = min(0.5, max(1e-6, n / rest)) if rest else 0.5
    parts = max(1, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 8 / part_bytes))
    keys = keys.withColumn("_part", part_of(F.col("key"), parts))
    members, others = keys.filter("listed").drop("listed"), keys.filter("not listed").drop("listed")
    levels: list[Level] = []
    passed: list[DataFrame] = []
    while True:
        most = members.groupBy("_part").count().agg(F.max("count")).first()[0]
        if not most:
            for table in passed:
                discard(table)
            return Cascade(levels, parts)
        level = build_level(members, len(levels) + 1, most, rate, parts)
        levels.append(level)
        # a part that no longer has members has a level of zeros, which lets nothing through
        through = landed(passing(others, level, parts), "url-passed")
        passed.append(through)
        members, others, rate = through, members, later_rate


def passing(keys: DataFrame, level: Level, parts: int) -> DataFrame:
    """The keys (key, _part) that a level lets through."""
    return reduce(DataFrame.unionByName, [own.filter(level.holds(F.col("key"), column(level))) for own, column in grouped(keys, [level], parts)])


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, by: str = "host", url: str = "url", part_bytes: int = 1 << 20) -> DataFrame:
    """pages with a struct column `judged`: host, path, rule, verdict. listed: a table of keys (key) to block; by: what a key is, `host` or `page` (host and path).

    A rule decides where one fits; else a listed key is blocked and any other allowed.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.struct("*").alias("page"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.col("host") if by == "host" else F.concat("host", "path"))
    known = listed.select(F.col("key").cast("string").alias("key")).filter("key is not null").distinct().withColumn("listed", F.lit(True))
    keys = rows.select("key").distinct().join(known, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))
    keys = landed(keys, "url-keys")
    cascade = build_cascade(keys, part_bytes)
    discard(keys)
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    judged = F.struct("host", "path", rule.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"))
    kept = [F.col("page")[c].alias(c) for c in pages.columns if c != "judged"]
    return cascade.with_listed(rows, "key", "listed").select(*kept, judged.alias("judged"))
