"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is at least ``times``
periods and ``least`` words long and that no neighbouring word extends.

1. *Re-Pair.* The most frequent pair of neighbouring symbols becomes a new nonterminal until no pair occurs twice. What
   is left is the start rule.
2. *Crossing runs.* Every run lies in some nonterminal, or in the start rule, whose parts' boundary it crosses. So each
   nonterminal's boundary is looked at once, at its first place, and so is each boundary of the start rule. A run long
   enough repeats a window of words behind or before the boundary one period away; only the distances to the other
   places of that window are tried as periods, and each is extended word by word.
3. *Places.* A nonterminal's runs are moved to all its places in the derivation, parents before their parts. Only rules
   that have runs below them are followed.
4. *Maximal intervals.* Stretches of one period that share a period's length are one. The run as a whole is found at
   the lowest rule that holds it, so what is merged is maximal. Of equal stretches the smallest period stays.

A text is one task's work: memory is proportional to its words.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

Run = tuple[int, int, int]  # start, end, period

RUNS = "array<struct<start:long,length:long,period:long>>"
COMPARED_AT_ONCE = 32
#: Odd, so that powers of it have an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15


@dataclass
class Grammar:
    """Rule k makes nonterminal ``terminals + k`` of two symbols; ``first`` is the first word it stands for."""

    terminals: int
    left: list[int]
    right: list[int]
    first: list[int]
    size: list[int]
    alive: bytearray  # per word: does a symbol of the start rule begin here
    symbol: list[int]

    def length(self, symbol: int) -> int:
        return 1 if symbol < self.terminals else self.size[symbol - self.terminals]


def repeated_pairs(ids: np.ndarray, terminals: int) -> dict[tuple[int, int], list[int]]:
    """Places, ascending, of every pair of neighbours that occurs more than once."""
    codes = ids[:-1].astype(np.int64) * terminals + ids[1:]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    edges = np.flatnonzero(np.diff(ordered)) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(codes)]))
    many = ends - starts > 1
    return {
        divmod(int(ordered[a]), terminals): order[a:b].tolist()
        for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True)
    }


def re_pair(ids: np.ndarray, terminals: int) -> Grammar:
    """Replaces the most frequent pair, ties to the one that comes first, until none occurs twice without overlap.

    A pair's places only ever become fewer once it is there, so its count in the heap is an upper bound: it is counted
    anew when it comes to the top and goes back if it is less.
    """
    n = len(ids)
    symbol, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    made = Grammar(terminals, [], [], [], [], bytearray(b"\x01") * n, symbol)
    if n < 2:
        return made
    places = repeated_pairs(ids, terminals)
    heap = [(-len(p), p[0], pair) for pair, p in places.items()]
    heapq.heapify(heap)
    while heap:
        claimed, _, pair = heapq.heappop(heap)
        a, b = pair
        found, taken = [], -1
        for i in places[pair]:
            if i != taken and symbol[i] == a:
                j = after[i]
                if j < n and symbol[j] == b:
                    found.append(i)
                    taken = j
        if len(found) < 2:
            del places[pair]
            continue
        if len(found) < -claimed:
            places[pair] = found
            heapq.heappush(heap, (-len(found), found[0], pair))
            continue
        del places[pair]
        new = terminals + len(made.left)
        made.left.append(a)
        made.right.append(b)
        made.first.append(found[0])
        made.size.append(made.length(a) + made.length(b))
        fresh: dict[tuple[int, int], list[int]] = {}
        for i in found:
            j = after[i]
            r, left = after[j], before[i]
            symbol[i], symbol[j], after[i], made.alive[j] = new, -1, r, 0
            if r < n:
                before[r] = i
                fresh.setdefault((new, symbol[r]), []).append(i)
            if left >= 0:
                fresh.setdefault((symbol[left], new), []).append(left)
        for pair, p in fresh.items():
            if len(p) > 1:
                places[pair] = p
                heapq.heappush(heap, (-len(p), p[0], pair))
    return made


class Windows:
    """Where each window of ``width`` words occurs again; equal windows have equal hashes, others may by chance."""

    def __init__(self, ids: np.ndarray, width: int):
        self.width = width
        n = len(ids) - width + 1
        self.again = np.zeros(max(n, 0), bool)
        if n < 2:
            return
        with np.errstate(over="ignore"):
            values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            values ^= values >> np.uint64(32)
            hashes = np.zeros(n, np.uint64)
            for k in range(width):
                hashes = hashes * np.uint64(BASE) + values[k : k + n]
        self.order = np.argsort(hashes, kind="stable")
        ordered = hashes[self.order]
        edge = np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))
        starts = np.flatnonzero(edge)
        group = np.cumsum(edge[:-1]) - 1
        self.group = np.empty(n, np.int64)
        self.group[self.order] = group
        self.starts = starts
        self.again = (np.diff(starts) > 1)[self.group]

    def others(self, at: int, low: int, high: int) -> np.ndarray:
        """Places of the window at ``at`` that lie within words ``low`` to ``high``, itself included."""
        g = self.group[at]
        same = self.order[self.starts[g] : self.starts[g + 1]]
        return same[np.searchsorted(same, low) : np.searchsorted(same, high - self.width, side="right")]


def agreeing(ids: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many words from i and from j on agree, at most ``most``, forwards (step 1) or backwards (-1)."""
    done, size = 0, COMPARED_AT_ONCE
    while done < most:
        size = min(size, most - done)
        if step > 0:
            differ = ids[i + done : i + done + size] != ids[j + done : j + done + size]
        else:
            differ = (ids[i - done - size + 1 : i - done + 1] != ids[j - done - size + 1 : j - done + 1])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done += size
        size *= 2
    return done


def crossing(
    ids: np.ndarray, windows: Windows, boundary: int, low: int, high: int, least: int, times: int,
) -> list[Run]:
    """Stretches within ``low`` to ``high`` that hold the words on both sides of the boundary and are long enough."""
    periods: dict[int, int] = {}
    for at in (boundary - 1, boundary - windows.width + 1):
        if low <= at and at + windows.width <= high and windows.again[at]:
            for other in windows.others(at, low, high).tolist():
                q = abs(other - at)
                if 0 < q <= (high - low) // times:
                    periods.setdefault(q, min(at, other))
    found: list[Run] = []
    for q in sorted(periods):
        if any(q % p == 0 and q <= e - s for s, e, p in found):
            continue  # the same stretch
        u = periods[q]
        start = u - agreeing(ids, u - 1, u + q - 1, u - low, -1)
        end = u + q + agreeing(ids, u, u + q, high - u - q, 1)
        if end - start >= max(least, times * q) and start < boundary < end:
            found.append((start, end, q))
    return found


def merged(stretches: set[Run]) -> list[Run]:
    """Maximal stretches with their smallest period, by start, then period."""
    whole: dict[tuple[int, int], int] = {}
    by_period: dict[int, list[tuple[int, int]]] = {}
    for s, e, q in stretches:
        by_period.setdefault(q, []).append((s, e))
    for q in sorted(by_period):
        joined: list[list[int]] = []
        for s, e in sorted(by_period[q]):
            if joined and s <= joined[-1][1] - q:
                joined[-1][1] = max(joined[-1][1], e)
            else:
                joined.append([s, e])
        for s, e in joined:
            whole.setdefault((s, e), q)
    return sorted(((s, e, q) for (s, e), q in whole.items()), key=lambda r: (r[0], r[2]))


def window_width(least: int, times: int) -> int:
    """The widest window across a boundary that every long enough run repeats one period away, within itself.

    A window of w words inside a run of length n and period q has a copy at distance q unless n <= 2q + w - 2. One of
    the two windows tried at a boundary lies in the run if w - 1 is at most half the run.
    """
    spare = min(max(least, times * q) - 2 * q for q in range(1, least + 1))
    return max(2, min(spare + 1, least // 2 + 1))


def find_runs(words: Sequence, least: int = 24, times: int = 3) -> list[Run]:
    """All runs (start, end, period) of a sequence, by start, then period; ``times`` is at least 3."""
    if times < 3:
        raise ValueError("runs of fewer than three periods need not repeat a window")
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    grammar = re_pair(ids, len(numbers))
    n = len(ids)
    windows = Windows(ids, window_width(least, times))
    if n < least or not windows.again.any():
        return []
    repeats = np.zeros(n + 1, bool)  # per boundary: does a window across it occur again
    m = len(windows.again)
    repeats[1 : m + 1] |= windows.again
    repeats[windows.width - 1 : windows.width - 1 + m] |= windows.again

    found: set[Run] = set()
    begins = np.flatnonzero(np.frombuffer(grammar.alive, np.uint8))
    for boundary in begins[1:][repeats[begins[1:]]].tolist():
        found.update(crossing(ids, windows, boundary, 0, n, least, times))

    inner: dict[int, list[Run]] = {}  # of rules, from their own first word on
    for k, size in enumerate(grammar.size):
        if size >= least:
            first = grammar.first[k]
            boundary = first + grammar.length(grammar.left[k])
            if repeats[boundary]:
                own = crossing(ids, windows, boundary, first, first + size, least, times)
                if own:
                    inner[k] = [(s - first, e - first, q) for s, e, q in own]
    if inner:
        found |= placed(grammar, begins, inner)
    return merged(found)


def placed(grammar: Grammar, begins: np.ndarray, inner: dict[int, list[Run]]) -> set[Run]:
    """The rules' own runs at every place of the derivation."""
    rules, terminals = len(grammar.left), grammar.terminals
    wanted = [False] * rules
    for k in range(rules):  # parts are older than their rule
        wanted[k] = k in inner or any(
            s >= terminals and wanted[s - terminals] for s in (grammar.left[k], grammar.right[k]))
    at: list[list[int]] = [[] for _ in range(rules)]
    for i in begins.tolist():
        k = grammar.symbol[i] - terminals
        if k >= 0 and wanted[k]:
            at[k].append(i)
    found: set[Run] = set()
    for k in range(rules - 1, -1, -1):
        if not at[k]:
            continue
        for s, e, q in inner.get(k, ()):
            found.update((i + s, i + e, q) for i in at[k])
        shift = grammar.length(grammar.left[k])
        for part, by in ((grammar.left[k], 0), (grammar.right[k], shift)):
            if part >= terminals and wanted[part - terminals]:
                at[part - terminals] += [i + by for i in at[k]]
        at[k] = []
    return found


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words joined by one space, without those behind the first period of any run that holds them."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for s, e, q in runs:
        depth[s + q] += 1
        depth[e] -= 1
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)


def runs_of(text: Column, least: int = 24, times: int = 3) -> Column:
    """A struct of ``runs`` (start, length, period, by start, then period) and the ``collapsed`` text.

    Words are what lies between ASCII white space, numbered from 0. Null texts have no words, no runs and the empty
    collapsed text.
    """

    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def of(texts: pd.Series) -> pd.DataFrame:
        runs, kept = [], []
        for t in texts:
            words = (t or "").encode().split()
            found = find_runs(words, least, times)
            runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in found])
            kept.append(collapsed(words, found).decode())
        return pd.DataFrame({"runs": runs, "collapsed": pd.Series(kept, dtype=object)})

    return of(text)


def with_runs(
    docs: DataFrame, text: str = "text", runs: str = "runs", collapsed_text: str = "collapsed",
    least: int = 24, times: int = 3,
) -> DataFrame:
    """Adds every text's runs and its collapsed text; columns of these names are replaced.

    Rows neither vanish nor multiply, repeated rows stay repeated, and an empty table stays empty. Texts are taken
    whole; a null or empty text has an empty list of runs and the empty collapsed text.
    """
    cols = [c for c in docs.columns if c.lower() not in (runs.lower(), collapsed_text.lower())]
    both = free_name(docs, "of_runs")
    return docs.select(*cols, runs_of(F.col(text), least, times).alias(both)).select(
        *cols, F.col(f"{both}.runs").alias(runs), F.col(f"{both}.collapsed").alias(collapsed_text))
