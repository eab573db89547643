"""URL filters: rules for hosts and paths, and a Bloom filter cascade for listed keys.

Level 1 of the cascade encodes the listed keys. Level 2 encodes the unlisted keys that
level 1 takes for listed, level 3 the listed keys that level 2 takes for false, and so on
until a level makes no mistake. The levels are built over all keys of the corpus, so for
these the answer is exact: the first level without a key decides.

Everything is DataFrame functions. A level is one array of longs that each task holds;
the keys are cut into shards so that a level never exceeds ``MAX_LEVEL_BITS``, and a
row is looked up in its own shard's levels. There is no join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.shared import has_bit, land, pack_slots

#: Fixed values of the rules: (host, path prefix, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Sites whose pages make up the list: the name before the public suffix.
LISTED_SITES = ("spam-farm", "cheap-pills", "casino", "free-money")

#: Proven bound of what a task holds for one level: 8 MiB.
MAX_LEVEL_BITS = 1 << 26
#: False positives of every level after the first.
RATE = 1 / 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lowered) and path; both empty for null and for a text without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        text = F.when(fits, F.lit(site + start)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def listed_site(host: Column, sites=LISTED_SITES) -> Column:
    """Whether a host belongs to one of the sites, under any suffix and subdomain."""
    return F.arrays_overlap(F.split(host, r"\."), F.array(*(F.lit(s) for s in sites)))


class Cascade:
    """Levels of one shard: (array of longs as a scalar column, bits, hash functions)."""

    def __init__(self, levels: list[tuple[Column, int, int]]) -> None:
        self.levels = levels

    def contains(self, k1: Column, k2: Column) -> Column:
        """Whether the key is listed. The first level without it decides: an odd one says no."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i, (words, bits, n_hashes) in reversed(list(enumerate(self.levels))):
            answer = F.when(in_level(k1, k2, i, words, bits, n_hashes), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def slots(k1: Column, k2: Column, level: int, bits: int, n_hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(k1, k2, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(n_hashes)]


def in_level(k1: Column, k2: Column, level: int, words: Column, bits: int, n_hashes: int) -> Column:
    return reduce(
        lambda a, b: a & b, (has_bit(words, s) for s in slots(k1, k2, level, bits, n_hashes))
    )


def size_of(n: int, rate: float) -> tuple[int, int]:
    """Bits (whole longs) and hash functions of a filter for ``n`` keys."""
    n_hashes = max(1, round(-math.log2(rate)))
    return max(64, 64 * math.ceil(n * n_hashes / math.log(2) / 64)), n_hashes


def first_rate(n_listed: int, n_other: int) -> float:
    """The rate of level 1 that keeps the whole cascade small."""
    return min(0.5, max(2.0**-20, n_listed / (math.sqrt(2) * max(1, n_other))))


def shards_for(n_listed: int, n_other: int) -> int:
    """Shards so that the largest level stays within ``MAX_LEVEL_BITS``, with room for chance."""
    small = min(n_listed, n_other) + 1
    bits = max(size_of(n_listed, first_rate(n_listed, n_other))[0], size_of(small, RATE)[0])
    return max(1, math.ceil(1.25 * bits / MAX_LEVEL_BITS))


def build(keys: DataFrame) -> Cascade:
    """The cascade over ``keys``: distinct (k1, k2, listed). Each level is written before it is used."""
    counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    inside, outside = counts.get(True, 0), counts.get(False, 0)
    levels: list[tuple[Column, int, int]] = []
    alive, side = keys, True
    while inside:
        bits, n_hashes = size_of(inside, RATE if levels else first_rate(inside, outside))
        depth = len(levels)
        places = F.explode(F.array(*slots(F.col("k1"), F.col("k2"), depth, bits, n_hashes)))
        marked = alive.where(F.col("listed") == side).select(places.alias("slot"))
        words = land(pack_slots(marked, bits), "level").scalar()
        levels.append((words, bits, n_hashes))
        # Keys of this side stay, of the other side those that the level takes for this side.
        wrong = in_level(F.col("k1"), F.col("k2"), depth, words, bits, n_hashes)
        alive = land(alive.where((F.col("listed") == side) | wrong), "alive")
        side = not side
        inside = alive.where(F.col("listed") == side).count()
        outside = 0
        if depth > 200:
            raise ValueError("keys of both sides hash alike")
    return Cascade(levels)


def judge(pages: DataFrame, listed: Column | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (columns page_id and url).

    A key is host and path. ``listed`` says of columns host and path whether a key is on the list
    (by default: its site is one of ``LISTED_SITES``). A url that no rule fits is blocked if the
    cascade contains its key. Null urls and urls without ``://`` have the empty key. Repeated rows
    and null ids stay; extra columns are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    k1, k2 = F.xxhash64("host", F.lit("/"), "path"), F.xxhash64("path", F.lit(" "), "host")
    on_list = listed_site(F.col("host")) if listed is None else listed
    universe = split.select(k1.alias("k1"), k2.alias("k2"), F.coalesce(on_list, F.lit(False)).alias("listed"))
    keys = land(universe.distinct(), "keys")
    counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    n_shards = shards_for(counts.get(True, 0), counts.get(False, 0))
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    keyed = split.withColumns({"k1": k1, "k2": k2})
    answers = []
    for shard in range(n_shards):
        mine = F.pmod(F.col("k1"), F.lit(n_shards)) == shard
        cascade = build(keys.where(mine) if n_shards > 1 else keys)
        rows = keyed.where(mine) if n_shards > 1 else keyed
        method = F.when(cascade.contains(F.col("k1"), F.col("k2")), "block").otherwise("allow")
        answers.append(rows.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict")))
    return reduce(DataFrame.unionAll, answers)
