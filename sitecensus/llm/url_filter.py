"""URL rules by a Bloom filter cascade.

Level 1 encodes the listed keys. Level 2 encodes the keys of the corpus that level 1 takes by mistake, level 3
the listed keys that level 2 takes, and so on until a level makes no mistake over the corpus's complete key
universe. Membership of any key of that universe is then exact, from bitmaps alone and without a join: the
first level that refuses a key tells on which side it is. The bitmaps are literals in the plan, so a row is
judged where it is read.

A key is a host suffix followed by a path prefix. Only suffixes of as many labels, and prefixes of as many
characters, as occur in the rules are keys; so a URL has a bounded number of them.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bit_of, checkpointed, power_of_two, spare_name

#: (host, path prefix, verdict)
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
BLOCK_BITS = 32768


@dataclass(frozen=True)
class Level:
    bitmap: bytes
    bits: int
    hashes: int
    seed: int

    def holds(self, key: Column) -> Column:
        # one literal a level, however many hashes it has
        return F.forall(F.array(*_positions(key, self.bits, self.hashes, self.seed)), lambda position: bit_of(F.lit(self.bitmap), position))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            found = F.when(self.levels[i - 1].holds(key), found).otherwise(F.lit(i % 2 == 0))
        return found


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + j)), F.lit(bits)) for j in range(hashes)]


def _level(keys: DataFrame, n: int, rate: float, seed: int, min_bits: int, max_bytes: int) -> Level:
    """A filter of the n keys with about that rate of false positives; its size is bounded by max_bytes."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(min_bits, power_of_two(n * hashes * 1.44))
    if bits // 8 > max_bytes:
        raise ValueError(f"a filter of {n} keys has {bits // 8} bytes; max_bytes is {max_bytes}")
    slots = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed))).alias("slot"))
    parts = (
        slots.groupBy(F.floor(F.col("slot") / BLOCK_BITS).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("slot") % BLOCK_BITS).alias("bits"))
        .collect()  # one bitmap: max_bytes at most
    )
    bitmap = bytearray(max(bits // 8, BLOCK_BITS // 8))
    for part in parts:
        bitmap[part.block * BLOCK_BITS // 8 : (part.block + 1) * BLOCK_BITS // 8] = part.bits
    return Level(bytes(bitmap[: max(1, bits // 8)]), bits, hashes, seed)


def build_cascade(
    listed: DataFrame, universe: DataFrame, universe_size: int, min_bits: int = 1024, max_bytes: int = 64 << 20, max_levels: int = 40, first_rate: float | None = None
) -> Cascade:
    """Cascade of the keys of ``listed`` (column key, distinct) over those of ``universe`` (column key).

    universe_size: number of keys of the universe, or more; it sets the first level's rate, so that about as
    many mistakes are left as keys are listed. Null keys are ignored. The universe is read once and never
    shuffled: only what level 1 takes by mistake is.
    """
    listed = listed.where(F.col("key").isNotNull())
    n = listed.count()
    if not n:
        return Cascade(())
    rate = first_rate or min(0.5, max(1e-6, n / max(universe_size, 1) * math.sqrt(0.5)))
    level = _level(listed, n, rate, 1, min_bits, max_bytes)
    levels, held = [level], listed
    mistaken = checkpointed(universe.where(level.holds(F.col("key"))).select("key").distinct().join(listed, "key", "left_anti"))
    while count := mistaken.count():
        if len(levels) == max_levels:
            raise ValueError(f"{count} keys are left after {max_levels} levels")
        level = _level(mistaken, count, 0.5, len(levels) + 1, min_bits, max_bytes)
        levels.append(level)
        held, mistaken = mistaken, checkpointed(held.where(level.holds(F.col("key"))))
    return Cascade(tuple(levels))


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host (A-Z lower-cased) and path; both are empty if the url is null or has no ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def url_keys(host: Column, path: Column, label_counts: list[int], path_lengths: list[int]) -> Column:
    """Array of a URL's keys: every host suffix of so many labels with every path prefix of so many characters."""
    labels = F.split(host, r"\.")
    keys = []
    for n in label_counts:
        suffix = F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), "."))
        keys += [F.when(F.length(path) >= m, F.concat(suffix, F.substring(path, 1, m))) for m in path_lengths]
    return F.array_compact(F.array(*keys))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow", **cascade) -> DataFrame:
    """pages with host, path, rule and verdict.

    A rule fits its host and all subdomains, if the path starts with the rule's; the longest wins, and its
    verdict is the url's. Without a rule, ``rule`` is null and the verdict ``default``. A rule that is listed
    with both verdicts blocks. Null urls and urls without ``://`` have an empty host and path, which no rule
    fits. Other columns of pages are kept, unless they have one of the four names. No rules: all default.
    """
    spark = pages.sparkSession
    judged = with_host_and_path(pages.drop("host", "path", "rule", "verdict"), url_col)
    if not rules:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    label_counts = sorted({len(h.split(".")) for h, _, _ in rules})
    path_lengths = sorted({len(p) for _, p, _ in rules})
    keys = url_keys(F.col("host"), F.col("path"), label_counts, path_lengths)
    universe = judged.select(F.explode(keys).alias("key"))
    size = pages.count() * len(label_counts) * len(path_lengths)
    by = {}
    for verdict in ("block", "allow"):
        listed = sorted({h + p for h, p, v in rules if v == verdict})
        by[verdict] = build_cascade(_keys(spark, listed), universe, size, **cascade)
    verdict = lambda k: F.when(by["block"].holds(k), "block").when(by["allow"].holds(k), "allow")
    fits = F.filter(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"), verdict(k).alias("verdict"))), lambda x: x.verdict.isNotNull())
    fit = spare_name(judged.columns, "fit")
    return (
        judged.withColumn(fit, F.array_max(fits))
        .withColumns({"rule": F.col(fit)["key"], "verdict": F.coalesce(F.col(fit)["verdict"], F.lit(default))})
        .drop(fit)
    )


def _keys(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(keys)), "array<string>")).alias("key"))
