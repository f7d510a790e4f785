"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint has 64 bits; two documents are linked when their fingerprints differ in at most ``radius``
bits. If two points are at most ``radius`` apart, some point lies within half the radius of both. So every fingerprint
emits all points (variants) within half the radius of itself, variants are shuffled, and those that two fingerprints
emitted reveal a pair.

On whole fingerprints that is 2081 variants each for a radius of 4. With ``parts=2`` the same is done for each half of
the fingerprint: a pair at most 4 apart is at most 2 apart in one half, so the 33 variants within one bit of each half
are enough to make it meet, 66 rows in place of 2081. A shared half-variant is only a candidate and is verified on
whole fingerprints. A bucket with more than ``bucket`` fingerprints is not compared within itself: its members emit
all variants of their whole fingerprint instead. There a shared variant is within half the radius of each member, so
members are links by construction, and geometry bounds a bucket at 2081 fingerprints. Both ways are exact.

Copies of one fingerprint are one row throughout; only links between different fingerprints are ever made, and at most
one fewer than a bucket has members.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name

BITS = 64
SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bit i is set if over half of the shingles' hashes have it set; zero without words.

    Words are runs between ASCII white space, A to Z lower-cased. Fewer words than ``shingle`` are one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    shingles = max(1, len(words) - shingle + 1)
    starts, ends = starts[:shingles], ends[len(words) - shingles :]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, shingles, HASHES_AT_ONCE):
        pieces = [joined[a:b] for a, b in zip(
            starts[k : k + HASHES_AT_ONCE].tolist(), ends[k : k + HASHES_AT_ONCE].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), "<u8", len(pieces))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > shingles, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4, name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint as a signed long; null and empty texts get zero."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(name, of(F.col(text)))


def ball(bits: int, radius: int) -> list[int]:
    """All masks of ``bits`` bits with at most ``radius`` set."""
    return [sum(1 << b for b in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _part_variants(prints: DataFrame, radius: int, parts: int) -> DataFrame:
    """One row per fingerprint, part and variant of that part."""
    edges = [BITS * k // parts for k in range(parts + 1)]
    reach = (radius // parts + 1) // 2

    def variants(k: int) -> Column:
        width, low = edges[k + 1] - edges[k], edges[k]
        part = F.col("fp").bitwiseAND(F.lit(_signed(((1 << width) - 1) << low)))
        masks = F.array(*(F.lit(_signed(m << low)) for m in ball(width, reach)))
        return F.transform(masks, lambda m: F.struct(
            F.lit(k).cast("byte").alias("part"), part.bitwiseXOR(m).alias("variant")))

    keys = [variants(k) for k in range(parts)]
    return prints.select("fp", F.explode(F.concat(*keys)).alias("key")).select("key.part", "key.variant", "fp")


def _whole_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links of fingerprints that share a variant within half the radius: each to the smallest of the variant.

    For an odd radius one side must reach further, so shared variants of the larger half are verified.
    """
    reach = (radius + 1) // 2
    masks = np.array(ball(BITS, reach), np.uint64)

    def emit(batches):
        for batch in batches:
            for k in range(0, len(batch), 64):
                own = batch["fp"].to_numpy()[k : k + 64].astype(np.int64).view(np.uint64)
                yield pd.DataFrame({
                    "variant": (own[:, None] ^ masks[None, :]).ravel().view(np.int64),
                    "fp": np.repeat(own.view(np.int64), len(masks)),
                })

    buckets = (
        prints.select("fp").mapInPandas(emit, "variant long, fp long")
        .groupBy("variant").agg(F.collect_list("fp").alias("members"))
    )
    return _verified(buckets, radius)


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (smaller, larger) that join exactly what links within the radius join among ``members``."""
    own = np.unique(members.astype(np.int64)).view(np.uint64)
    left = np.arange(len(own))
    links = []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            k = reached.pop()
            near = np.bitwise_count(own[left] ^ own[k]) <= radius
            links += [(int(own[k].view(np.int64)), int(x)) for x in own[left[near]].view(np.int64)]
            reached += left[near].tolist()
            left = left[~near]
    return [(min(x), max(x)) for x in links]


def _verified(buckets: DataFrame, radius: int) -> DataFrame:
    @F.pandas_udf("array<struct<a:long,b:long>>")
    def verify(members: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in forest(np.asarray(m), radius)] for m in members])

    return (
        buckets.where(F.size("members") > 1)
        .select(F.explode(verify("members")).alias("link")).select("link.a", "link.b").distinct()
    )


def ball_links(prints: DataFrame, radius: int = 4, parts: int = 2, bucket: int = 1024) -> DataFrame:
    """Links (a, b), a < b, that connect distinct fingerprints (column ``fp``) as all pairs within ``radius`` would.

    ``parts=1`` is the method on whole fingerprints alone. ``bucket`` bounds what one task compares at a time; larger
    buckets take the way over whole fingerprints, which needs no bound.
    """
    if parts == 1:
        return _whole_links(prints, radius)
    keys = _part_variants(prints, radius, parts)
    shared = cut(keys.groupBy("part", "variant").agg(F.count("*").alias("n")).where("n > 1"))
    small = (
        keys.join(shared.where(F.col("n") <= bucket).select("part", "variant"), ["part", "variant"])
        .groupBy("part", "variant").agg(F.collect_list("fp").alias("members"))
    )
    links = _verified(small, radius)
    large = shared.where(F.col("n") > bucket).select("part", "variant")
    if large.isEmpty():
        return links
    return links.union(_whole_links(keys.join(large, ["part", "variant"]).select("fp").distinct(), radius)).distinct()


def _apart(one_each: DataFrame, *columns: str) -> DataFrame:
    """Rows of one a key, written in another partitioning than the key's.

    A join on the key then reads both sides from shuffles of their own, which is what adaptive execution needs to split
    a key that holds a third of the other side's rows.
    """
    return cut(one_each.repartition(*columns))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node reachable.

    Alternates two steps until nothing changes: link each node's larger neighbours to the smallest one, then each
    node's smaller ones and itself. The number of rounds grows with the logarithm of the longest chain.
    """
    def rewired(edges: DataFrame, small: bool) -> DataFrame:
        both = edges if small else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        side = both.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = side.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = _apart(least, "u", "m")
        met = side.join(least, "u")
        if small:
            pairs = met.select("m", F.col("v").alias("x")).union(least.select("m", F.col("u").alias("x")))
        else:
            pairs = met.where("v > u").select("m", F.col("v").alias("x"))
        return pairs.where("m <> x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = state(edges)
    while True:
        edges = cut(rewired(rewired(edges, small=False), small=True))
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    shingle: int = 4, radius: int = 4, parts: int = 2, bucket: int = 1024,
) -> DataFrame:
    """One row per document: id, fingerprint (long), component_id (smallest id reachable) and text_hash.

    Texts without words (null, empty, white space) have fingerprint zero and are linked like any other. Repeated rows
    come back repeated; null ids belong to components but never name one that has another id. Extra columns are
    ignored. An empty table gives an empty result.
    """
    slim = cut(
        with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("body")), "body", shingle, "fp")
        .select("id", "fp", F.xxhash64("body").alias("text_hash"))
    )
    prints = cut(slim.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(ball_links(prints.select("fp"), radius, parts, bucket))
    rooted = cut(
        prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    named = _apart(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root", "component_id")
    known = cut(rooted.join(named, "root").select("fp", "root", "component_id"))
    return slim.join(known, "fp").select(
        F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **method) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id stays.

    Among rows with that id the one with the smallest text hash stays, and of identical rows one. A component of null
    ids alone keeps one row too. Columns and their names are as they came.
    """
    found = near_duplicates(docs, id_col, text, **method)
    first = F.min(F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), "text_hash"))
    kept = found.groupBy("root").agg(first.alias("first")).select(
        F.col("first.id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    key, row = free_name(docs, "row_hash"), free_name(docs, "row_place")
    hashed = docs.withColumn(key, F.xxhash64(F.col(text)))
    stays = hashed.join(kept, (hashed[key] == kept.kept_hash) & hashed[id_col].eqNullSafe(kept.kept_id), "left_semi")
    return (
        stays.withColumn(row, F.row_number().over(Window.partitionBy(key, id_col).orderBy(F.lit(0))))
        .where(F.col(row) == 1).select(*docs.columns)
    )
