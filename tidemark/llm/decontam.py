"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (a run of ``least`` tokens) are compared: again and again the longest
match of still unmarked tokens is marked as a tile, down to matches of ``least`` tokens. Tiles may stand in another
order in the document than in the item, so moved passages are found. The share of an item's tokens under tiles is its
coverage.

Seeds are found by running Karp-Rabin: a polynomial hash of every window of a document, from prefix sums, looked up
among the hashes of the benchmark's windows. The benchmark is the stated query set. It is cut into blocks of at most
``block_tokens`` tokens, the size of what a task holds, and every block is run against all documents, so no document's
seeds are shuffled and no pair of rows is made before a document is known to hold enough of an item's seeds to reach
the threshold.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

LEAST = 5
THRESHOLD = 0.5
BLOCK_TOKENS = 1_000_000
WORD = re.compile(r"\w+")
#: Beyond ASCII, what is no part of a word; within ASCII a table turns it into spaces, which is much faster.
OTHER = re.compile(r"[^\w\x00-\x7f]")
SPACED = bytes(c if c > 127 or WORD.match(chr(c)) else 32 for c in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)
FOUND = "item_id long, item_tokens long, matched_tokens long, coverage double, tiles long, longest long"


def tokens(text: str | None) -> list[bytes]:
    """Runs of letters, digits and underscores, lower-cased, in UTF-8."""
    low = (text or "").lower()
    if not low.isascii() and OTHER.search(low):
        return [w.encode() for w in WORD.findall(low)]
    return low.encode().translate(SPACED).split()


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` ids, each from the one before (modulo 2**64)."""
    if len(ids) < width:
        return np.zeros(0, np.uint64)
    powers = np.multiply.accumulate(np.full(width, BASE))
    out = np.zeros(len(ids) - width + 1, np.uint64)
    for k in range(width):
        out += ids[k : k + len(out)].astype(np.uint64) * powers[k]
    return out


def tile(doc: np.ndarray, item: np.ndarray, at: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in document, place in item, length), longest first, ties to the smaller places.

    ``at``: rows (place in document, place in item) where windows of ``least`` tokens are equal.
    """
    at = at[np.lexsort((at[:, 0], at[:, 0] - at[:, 1]))]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at[:, 0]) != 1) | (np.diff(at[:, 0] - at[:, 1]) != 0)
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(at))) + least - 1
    heap = [(-int(n), int(i), int(j)) for n, (i, j) in zip(lengths, at[starts], strict=True)]
    heapq.heapify(heap)
    used_doc, used_item, out = np.zeros(len(doc), bool), np.zeros(len(item), bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = ~(used_doc[i : i + n] | used_item[j : j + n])
        if free.all():
            used_doc[i : i + n] = used_item[j : j + n] = True
            out.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (a - b, i + a, j + a))
    return out


class Block:
    """Some benchmark items with their vocabulary and seeds, as sent to the tasks."""

    def __init__(self, items: list[tuple[int, list[bytes]]], least: int = LEAST, threshold: float = THRESHOLD):
        self.least, self.threshold = least, threshold
        self.names = [name for name, _ in items]
        words = sorted({w for _, own in items for w in own})
        self.vocabulary = {w: k + 1 for k, w in enumerate(words)}
        self.items = [np.array([self.vocabulary[w] for w in own], np.int64) for _, own in items]
        self.seeds = {}
        # An item with fewer tokens than a seed is a seed itself.
        for width in sorted({min(least, len(own)) for own in self.items}):
            of = [k for k, own in enumerate(self.items) if min(least, len(own)) == width]
            hashes = [window_hashes(self.items[k], width) for k in of]
            flat = np.concatenate(hashes)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(of, [len(h) for h in hashes])[order]
            place = np.concatenate([np.arange(len(h)) for h in hashes])[order]
            self.seeds[width] = flat[order], owner, place

    def found(self, text: str | None) -> list[tuple]:
        """A row as in FOUND for every item whose coverage reaches the threshold."""
        words = tokens(text)
        ids = np.array(list(map(self.vocabulary.get, words, repeat(0))), np.int64)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        out = []
        for width, (flat, owner, place) in self.seeds.items():
            at = np.flatnonzero(known[width:] - known[:-width] == width)
            hashes = window_hashes(ids, width)[at]
            low = np.searchsorted(flat, hashes)
            hit = flat[np.minimum(low, len(flat) - 1)] == hashes
            at, low, hashes = at[hit], low[hit], hashes[hit]
            if not len(at):
                continue
            n = np.searchsorted(flat, hashes, "right") - low
            docs = np.repeat(at, n)
            entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            order = np.argsort(owner[entry], kind="stable")
            docs, entry = docs[order], entry[order]
            cuts = np.flatnonzero(np.diff(owner[entry])) + 1
            for own_docs, own in zip(np.split(docs, cuts), np.split(entry, cuts), strict=True):
                k = int(owner[own[0]])
                item = self.items[k]
                covered = np.zeros(len(item) + 1, np.int64)
                np.add.at(covered, place[own], 1)
                np.add.at(covered, place[own] + width, -1)
                if (np.cumsum(covered)[:-1] > 0).mean() < self.threshold:  # tiles cannot cover more than seeds do
                    continue
                at = np.stack([own_docs, place[own]], 1)
                same = np.all([ids[at[:, 0] + s] == item[at[:, 1] + s] for s in range(width)], 0)
                tiles = tile(ids, item, at[same], width)
                matched = sum(t[2] for t in tiles)
                if tiles and matched >= self.threshold * len(item):
                    out.append((self.names[k], len(item), matched, matched / len(item), len(tiles), tiles[0][2]))
        return sorted(out)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           least: int = LEAST, threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS) -> Iterator[Block]:
    """The benchmark, read row by row, in blocks of at most ``block_tokens`` tokens (one item at least)."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id), F.col(text)).toLocalIterator():
        own = tokens(row[1])
        if not own or row[0] is None:
            continue
        if held and size + len(own) > block_tokens:
            yield Block(held, least, threshold)
            held, size = [], 0
        held.append((row[0], own))
        size += len(own)
    if held:
        yield Block(held, least, threshold)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    least: int = LEAST, threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS, name: str = "found",
) -> DataFrame:
    """The documents of which some item's coverage reaches ``threshold``, with those items as an array of structs.

    ``found`` has item_id, item_tokens, matched_tokens, coverage, tiles and longest. Whole texts are compared; null and
    empty ones match nothing, nor do items without a token or without an id. An item shorter than ``least`` tokens must
    occur in one piece. Repeated rows come back repeated; with several blocks a document has a row for each that
    matches. Nothing comes back for an empty table.
    """
    name = free_name(docs, name)
    context = docs.sparkSession.sparkContext

    def against(block: Block) -> DataFrame:
        shared = context.broadcast(block)

        @F.pandas_udf(f"array<struct<{', '.join(':'.join(f.split()) for f in FOUND.split(', '))}>>")
        def of(texts: pd.Series) -> pd.Series:
            names = [f.split()[0] for f in FOUND.split(", ")]
            return pd.Series([[dict(zip(names, row, strict=True)) for row in shared.value.found(t)] for t in texts])

        return docs.withColumn(name, of(F.col(text))).where(F.size(name) > 0)

    parts = [against(b) for b in blocks(benchmark, item_id, item_text, least, threshold, block_tokens)]
    if not parts:
        kind = f"array<struct<{', '.join(':'.join(f.split()) for f in FOUND.split(', '))}>>"
        return docs.where("false").withColumn(name, F.lit(None).cast(kind))
    return reduce(DataFrame.unionAll, parts)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **method) -> DataFrame:
    """The documents that ``contaminated`` does not return, rows and columns as they came."""
    rest, name = docs, free_name(docs, "found")
    context = docs.sparkSession.sparkContext

    def clean_of(block: Block):
        shared = context.broadcast(block)

        @F.pandas_udf("boolean")
        def clean(texts: pd.Series) -> pd.Series:
            return pd.Series([not shared.value.found(t) for t in texts], dtype=bool)

        return clean

    for block in blocks(benchmark, **method):
        rest = rest.withColumn(name, clean_of(block)(F.col(text))).where(F.col(name)).select(*docs.columns)
    return rest
