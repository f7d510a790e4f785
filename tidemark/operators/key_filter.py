"""A Bloom filter of a batch's keys in built-in functions, which thins a large table before it is shuffled.

It only ever lets too many rows through, so an exact join has to follow.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
CHUNK = 1024
#: The filter is part of a task's code; at most 8 MB.
MOST_BITS = 1 << 26
#: With fewer bits for a key, over a sixth of all other rows would pass.
LEAST_BITS_PER_KEY = 4


def filter_bits(rows: int) -> int | None:
    """Size of the filter for that many keys, a power of two; None if the largest one would let too much through."""
    if rows * LEAST_BITS_PER_KEY > MOST_BITS:
        return None
    return min(MOST_BITS, 1 << max(CHUNK * 64 - 1, rows * BITS_PER_KEY).bit_length())


def _places(value: Column, bits: int) -> list[Column]:
    """The four bits that stand for a value, two from each hash."""
    hashes = (F.xxhash64(value), F.xxhash64(value, F.lit("again")))
    mask = F.lit(bits - 1).cast("long")
    return [p for h in hashes for p in (h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def key_filter(keys: DataFrame, value: Column, rows: int) -> Callable[[Column], Column] | None:
    """A function from a column to whether its value may be among ``value`` of ``keys``; None for too many rows.

    Words of 64 bits are set on the map side, put together in chunks, and handed on as a scalar subquery that runs
    when the plan does: nothing runs while it is built. ``rows`` only decides how many pass in vain. NULL is a value.
    """
    bits = filter_bits(rows)
    if bits is None:
        return None
    place = F.col("_place")
    words = (
        keys.select(F.explode(F.array(*_places(value, bits))).alias("_place"))
        .groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(_bit(place)).alias("_bits"))
    )
    every = keys.sparkSession.range(bits // 64, numPartitions=max(1, math.ceil(bits / 64 / CHUNK / 64)))
    dense = every.join(words, F.col("id") == F.col("_word"), "left").select(
        "id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))
    chunks = _in_order(dense.groupBy(F.shiftright("id", int(math.log2(CHUNK))).alias("_chunk")), "id", "_bits")
    whole = _in_order(chunks.groupBy(), "_chunk", "_held").select("_held")

    def may_be_among(column: Column) -> Column:
        held = whole.scalar()
        test = F.lit(True)
        for p in _places(column, bits):
            word = F.shiftright(p, 6)
            chunk = F.get(held, F.shiftright(word, int(math.log2(CHUNK))).cast("int"))
            own = F.get(chunk, word.bitwiseAND(F.lit(CHUNK - 1).cast("long")).cast("int"))
            test = test & (own.bitwiseAND(_bit(p)) != 0)
        return test

    return may_be_among


def _in_order(groups, number: str, value: str) -> DataFrame:
    """Each group's values as one array, in order of their numbers."""
    gathered = F.sort_array(F.collect_list(F.struct(number, value)))
    return groups.agg(F.transform(gathered, lambda x: x[value]).alias("_held"))
