"""URL rules by a cascade of Bloom filters.

A rule blocks or allows a host, all its subdomains and the paths that start with the rule's. A URL's candidate keys are
the ends of its host with the starts of its path, for the label counts and path lengths that the rules have. The
longest candidate that is listed decides.

Whether a key is listed is asked of filters alone. The first filter holds all listed keys. Some keys of the corpus that
are not listed pass it by chance: exactly these are found and go into a second filter. The listed keys that pass that
one go into a third, and so on until nobody passes wrongly. The first filter that does not hold a key then tells which
side the key is on, without error for every key of the corpus, and without a join.

Everything runs as DataFrame expressions. A filter is a literal array of longs; its size follows from the number of
rules, which is checked against ``most_bits``. The corpus' keys themselves never come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name

#: A filter of this many bits is 16 MB, for some ten million rules.
MOST_BITS = 1 << 27
#: Levels halve what is left, so a cascade has some log2(rules) of them.
MOST_LEVELS = 200
BLOCK, ALLOW = "block", "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies behind the first ``://`` up to ``/``, ``?`` or ``#``, A to Z lower-cased, and then up to ``?`` or ``#``.

    Both are empty if the URL is null or has no ``://``.
    """
    known = F.coalesce(url, F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        F.translate(F.regexp_extract(known, pattern, 1), letters, letters.lower()),
        F.regexp_extract(known, pattern, 2),
    )


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Keys a rule of the given shapes (labels, path length) would have to fit the URL, longest first."""
    keys = [
        F.when(
            (labels(host) >= n) & (F.length(path) >= length),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, length)),
        )
        for n, length in shapes
    ]
    held = F.array_distinct(F.array_compact(F.array(*keys)))
    return F.array_sort(held, lambda a, b: F.length(b) - F.length(a))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` in longs, probed at ``hashes`` places that ``seed`` decides."""

    seed: int
    size: int
    hashes: int
    bits: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        longs = F.split(F.lit(",".join(map(str, self.bits))), ",").cast("array<long>")
        return reduce(lambda a, b: a & b, (
            F.getbit(F.get(longs, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1
            for at in places(key, self.seed, self.size, self.hashes)))


def places(key: Column, seed: int, size: int, hashes: int) -> list[Column]:
    """Bits of a key. ``size`` is a power of two, so that the step, made odd, reaches all of them."""
    first, step = F.xxhash64(F.lit(2 * seed), key), F.xxhash64(F.lit(2 * seed + 1), key).bitwiseOR(F.lit(1).cast("long"))
    mask = F.lit(size - 1).cast("long")
    return [
        (first.bitwiseAND(mask) + F.lit(k).cast("long") * step.bitwiseAND(mask)).bitwiseAND(mask)
        for k in range(hashes)
    ]


def filter_of(keys: DataFrame, n: int, error: float, seed: int, most_bits: int = MOST_BITS) -> Level:
    """The filter of the ``n`` keys (column ``key``) that others pass with about the given probability."""
    hashes = max(1, round(-math.log2(error)))
    size = 64
    while size < n * hashes / math.log(2):
        size *= 2
    if size > most_bits:
        raise ValueError(f"a filter of {n} rules takes {size} bits, over the bound of {most_bits}; raise most_bits")
    spots = keys.select(F.explode(F.array(*places(F.col("key"), seed, size, hashes))).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
    words = spots.groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    bits = [0] * (size // 64)
    for word, held in words:
        bits[word] = held
    return Level(seed, size, hashes, tuple(bits))


@dataclass(frozen=True)
class Cascade:
    """Tells listed keys from all others of the universe it was built over."""

    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        listed = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            listed = F.when(~self.levels[k].holds(key), F.lit(k % 2 == 1)).otherwise(listed)
        return listed


def cascade(
    listed: DataFrame, universe: DataFrame, keys: int, most_bits: int = MOST_BITS, first_seed: int = 0,
) -> Cascade:
    """The cascade of the distinct ``listed`` keys against all other keys of ``universe`` (columns ``key``).

    ``universe`` may repeat keys and has about ``keys`` distinct ones; only those that pass the first filter are shuffled. The first filter lets through
    some 0.7 wrong keys per listed one, the others half of what they meet, which makes the sum smallest.
    """
    inside = cut(listed.select("key").distinct())
    n = inside.count()
    if not n:
        return Cascade(())
    error = min(0.5, max(2.0**-40, n * math.sqrt(0.5) / max(1, keys)))
    levels = [filter_of(inside, n, error, first_seed, most_bits)]
    passing = universe.where(levels[0].holds(F.col("key"))).select("key").distinct()
    outside = cut(passing.join(inside, "key", "left_anti"))
    while n := outside.count():  # they pass the last filter and belong to the other side
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("keys that pass every filter: their hashes are equal")
        levels.append(filter_of(outside, n, 0.5, first_seed + len(levels), most_bits))
        inside, outside = outside, cut(inside.where(levels[-1].holds(F.col("key"))))
    return Cascade(tuple(levels))


def judged(
    urls: DataFrame, rules: DataFrame, url: str = "url", host: str = "host", path: str = "path",
    rule: str = "rule", verdict: str = "verdict", otherwise: str = ALLOW, most_bits: int = MOST_BITS,
) -> DataFrame:
    """Adds host, path, the longest rule that fits (its host and path in one, or null) and its verdict.

    ``rules`` has ``host``, ``path`` and ``verdict`` (block or allow). Of equally long rules that fit, the one with the
    longer host decides; a key on both lists is blocked; rules with a null, or that no URL could have (a path without ``/`` in
    front), are left out, and empty tables of either are fine. A URL that no rule fits gets ``otherwise``: the filters know that none of its keys is listed. Null and
    odd URLs have the empty host and path. Rows neither vanish nor multiply; columns with the names of the new ones
    are replaced, other columns stay.
    """
    new = {name.lower() for name in (host, path, rule, verdict)}
    cols = [c for c in urls.columns if c.lower() not in new]
    known = rules.select("host", "path", "verdict").dropna().where(
        F.col("verdict").isin(BLOCK, ALLOW) & ~F.col("host").rlike("[/?#]") & F.col("path").rlike(r"\A(/|\z)"))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    known = cut(known.select(F.translate("host", letters, letters.lower()).alias("host"), "path", "verdict").distinct())
    shapes = [tuple(r) for r in known.select(
        labels(F.col("host")).alias("labels"), F.length("path").alias("length")).distinct().orderBy(
        F.desc("labels"), F.desc("length")).collect()]
    found_host, found_path = host_and_path(F.col(url))
    if not shapes:
        return urls.select(
            *cols, found_host.alias(host), found_path.alias(path), F.lit(None).cast("string").alias(rule),
            F.lit(otherwise).alias(verdict))

    h, p, keys = (free_name(urls, name) for name in ("url_host", "url_path", "url_keys"))
    parsed = urls.select(*cols, found_host.alias(h), found_path.alias(p)).withColumn(
        keys, candidates(F.col(h), F.col(p), shapes))
    universe = parsed.select(F.explode(keys).alias("key"))
    listed = known.select(F.concat("host", "path").alias("key"), "verdict")
    blocked = listed.where(F.col("verdict") == BLOCK).select("key")
    allowed = listed.where(F.col("verdict") == ALLOW).select("key").join(blocked, "key", "left_anti")
    everything = universe.union(listed.select("key"))
    size = everything.agg(F.approx_count_distinct("key")).first()[0]
    to_block = cascade(blocked, everything, size, most_bits)
    to_allow = cascade(allowed, everything, size, most_bits, first_seed=MOST_LEVELS)

    verdicts = F.transform(F.col(keys), lambda key: F.struct(
        key.alias("key"),
        F.when(to_block.lists(key), F.lit(BLOCK)).when(to_allow.lists(key), F.lit(ALLOW)).alias("verdict")))
    first = F.get(F.filter(verdicts, lambda v: v["verdict"].isNotNull()), F.lit(0))
    decided = free_name(urls, "url_rule")
    return parsed.withColumn(decided, first).select(
        *cols, F.col(h).alias(host), F.col(p).alias(path), F.col(f"{decided}.key").alias(rule),
        F.coalesce(F.col(f"{decided}.verdict"), F.lit(otherwise)).alias(verdict))
