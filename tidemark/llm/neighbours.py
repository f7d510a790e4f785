"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to a few dimensions by a Gaussian matrix. For two vectors at distance d, the squared projected
distance divided by d squared has a chi-square distribution with as many degrees of freedom as dimensions. So if
vectors are verified in the order of projected distance, the search may stop at projected distance r once r squared
exceeds the ``confidence`` quantile times the squared distance of the k-th nearest found: any nearer vector would have
been met with that probability.

Nearness is the inner product. One more coordinate gives all vectors the same length, and queries are scaled to it;
then the largest inner product is the smallest Euclidean distance.

The projected vectors are indexed by a kd-tree. Its splits are fitted to a bounded sample, every row is then sent down
the tree, and a leaf with more rows than a task should hold is dealt out by hash. A query first visits its nearest
leaf, and with the k-th distance from there all leaves that the stopping test does not rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

SEED = 7
AT_ONCE = 128
FOUND = "query_id long, vec_id long, score double"


def chi_square_cdf(x: float, dims: int) -> float:
    """For an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(dims // 2))


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dims) < p else (low, middle)
    return high


@dataclass
class Tree:
    """Node k splits ``axis[k]`` at ``value[k]`` into nodes 2k + 1 and 2k + 2; an axis of -1 is a leaf."""

    axis: np.ndarray
    value: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, leaf: int) -> Tree:
        """Splits the widest axis at its median until a leaf has at most ``leaf`` sample points or all are equal."""
        axis, value = {}, {}

        def split(node: int, points: np.ndarray) -> None:
            spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
            at = int(np.argmax(spread))
            if len(points) <= leaf or spread[at] == 0:
                axis[node] = -1
                return
            middle = float(np.median(points[:, at]))
            left = points[:, at] < middle
            if not left.any():
                middle = float(points[points[:, at] > middle, at].min())
                left = points[:, at] < middle
            axis[node], value[node] = at, middle
            split(2 * node + 1, points[left])
            split(2 * node + 2, points[~left])

        split(0, sample)
        size = max(axis) + 1
        out = cls(np.full(size, -1, np.int64), np.zeros(size))
        for k, a in axis.items():
            out.axis[k], out.value[k] = a, value.get(k, 0.0)
        return out

    def leaves(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        while len(rows):
            axes = self.axis[at[rows]]
            rows, axes = rows[axes >= 0], axes[axes >= 0]
            right = points[rows, axes] >= self.value[at[rows]]
            at[rows] = 2 * at[rows] + 1 + right
        return at


@dataclass
class Projection:
    matrix: np.ndarray  # one row more than the vectors have coordinates
    longest: float

    def of_rows(self, vectors: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.column_stack([vectors, extra]) @ self.matrix

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        return (vectors * (self.longest / length)[:, None]) @ self.matrix[:-1]


def _matrix(cells: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(c, np.float64) for c in cells]) if len(cells) else np.zeros((0, 0))


def _usable(rows: DataFrame, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, v in double precision."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = rows.select(F.col("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    return good


def _top(scores: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, k: int):
    """The k best (id, score), scores summed coordinate by coordinate so that equal vectors score equally."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least - 1e-9 * max(1.0, abs(least)))
        ids, vectors = ids[near], vectors[near]
    exact = np.zeros(len(ids))
    for j in range(len(query)):
        exact += vectors[:, j] * query[j]
    order = np.lexsort((ids, -exact))[:k]
    return ids[order], exact[order]


def verify(ids: np.ndarray, vectors: np.ndarray, far: np.ndarray, query_id: int, query: np.ndarray, bound: float,
           k: int, longest: float, quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of a block for a query: rows in order of projected distance until the stopping test holds.

    ``far`` holds the rows' squared projected distances. ``bound`` is the k-th best score known so far from elsewhere;
    -inf if there is none. Rows below it are left out, as they cannot be among the k best.
    """
    scale = longest / math.sqrt(float(query @ query))

    def reach() -> float:
        return math.inf if bound == -math.inf else quantile * max(0.0, 2 * longest**2 - 2 * bound * scale)

    left = np.flatnonzero((far <= reach()) & (ids != query_id))
    order = left[np.argsort(far[left], kind="stable")]
    scores = np.zeros(0)
    while len(scores) < len(order) and far[order[len(scores)]] <= reach():
        more = order[len(scores) : len(scores) + max(AT_ONCE, len(scores))]
        scores = np.concatenate([scores, vectors[more] @ query])
        if len(scores) >= k:
            bound = max(bound, float(np.partition(scores, len(scores) - k)[len(scores) - k]))
    kept = np.flatnonzero(scores >= bound - 1e-9 * max(1.0, abs(bound))) if bound > -math.inf else np.arange(len(scores))
    seen = order[kept]
    return _top(scores[kept], ids[seen], vectors[seen], query, k)


def nearest(
    rows: DataFrame, queries: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 20,
    dims: int = 24, confidence: float = 0.9, block_rows: int = 4096, sample_rows: int = 65536, most_leaves: int = 4096,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for every row that ``queries`` marks.

    Candidates are all rows but those with the query's id. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do null ids and vectors of another length than most have (ties: the longer). Ties go
    to the smaller id; repeated rows are candidates of their own, a repeated query id is one query (its smallest
    vector). With fewer candidates than k all come back; an empty table gives an empty result. Other columns are
    ignored.

    ``sample_rows`` bounds the sample the tree is fitted to; every row is indexed. A task holds some
    ``block_rows`` rows of a leaf at a time, past which the queries that visit them stream.
    """
    spark = rows.sparkSession
    marked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector"),
                         F.coalesce(queries, F.lit(False)).alias("asks"))
    lengths = (
        _usable(marked, "vector").groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.desc("size")).limit(1).collect())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not lengths:
        return empty
    width, total = lengths[0]["size"], lengths[0]["n"]
    points = _usable(marked, "vector").where(F.size("v") == width)
    asking = _usable(marked.where("asks"), "vector").where(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    longest = math.sqrt(points.agg(F.max(squares)).first()[0])
    generator = np.random.default_rng(seed)
    projection = Projection(generator.standard_normal((width + 1, dims)), longest)
    quantile = chi_square_quantile(confidence, dims)

    share = max(1, math.ceil(total / sample_rows))
    sample = points.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(share)) == 0).limit(2 * sample_rows)
    sampled = projection.of_rows(_matrix(sample.select("v").toPandas()["v"]).reshape(-1, width))
    leaf = max(block_rows // share, len(sampled) // most_leaves, 1)
    tree = Tree.fit(sampled, leaf)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            at = projection.of_rows(_matrix(batch["v"]))
            frame = pd.DataFrame(at).assign(leaf=tree.leaves(at))
            by_leaf = frame.groupby("leaf")
            low, high = by_leaf.min(), by_leaf.max()
            n = by_leaf.size()
            for j in range(dims):
                yield pd.DataFrame({"leaf": low.index, "axis": j, "low": low[j], "high": high[j], "n": n})

    boxes = (
        points.select("v").mapInPandas(describe, "leaf long, axis int, low double, high double, n long")
        .groupBy("leaf", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .toPandas().sort_values(["leaf", "axis"])
    )  # one row for each leaf and axis
    leaves = boxes["leaf"].to_numpy()[::dims]
    low = boxes["low"].to_numpy().reshape(-1, dims)
    high = boxes["high"].to_numpy().reshape(-1, dims)
    parts = np.maximum(1, -(-boxes["n"].to_numpy()[::dims] // block_rows))

    @F.pandas_udf("struct<leaf:long,parts:long>")
    def placed(v: pd.Series) -> pd.DataFrame:
        own = np.searchsorted(leaves, tree.leaves(projection.of_rows(_matrix(v)))) if len(v) else np.zeros(0, int)
        return pd.DataFrame({"leaf": own, "parts": parts[own]})

    hashed = F.xxhash64(F.lit(seed + 1), "id")
    blocks = points.withColumn("at", placed("v")).select(
        F.col("at.leaf").alias("leaf"), F.pmod(hashed, F.col("at.parts")).alias("part"), F.lit(False).alias("asks"), "id",
        "v", F.lit(0.0).alias("bound"))

    def visits(first: bool):
        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), AT_ONCE):
                    own = batch.iloc[start : start + AT_ONCE]
                    vectors = _matrix(own["v"])
                    at = projection.of_queries(vectors)
                    away = np.zeros((len(own), len(leaves)))
                    for j in range(dims):
                        x = at[:, j, None]
                        away += np.maximum(0, np.maximum(low[:, j] - x, x - high[:, j])) ** 2
                    nearest_leaf = np.argmin(away, axis=1)
                    if first:
                        chosen = np.zeros_like(away, bool)
                        chosen[np.arange(len(own)), nearest_leaf] = True
                    else:
                        scale = longest / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                        reach = quantile * np.maximum(0, 2 * longest**2 - 2 * own["bound"].to_numpy() * scale)
                        chosen = away <= reach[:, None]
                        chosen[np.arange(len(own)), nearest_leaf] = False
                    q, leaf_at = np.nonzero(chosen)
                    n = parts[leaf_at]
                    q, leaf_at = np.repeat(q, n), np.repeat(leaf_at, n)
                    part = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
                    yield pd.DataFrame({
                        "leaf": leaf_at, "part": part, "asks": True, "id": own["id"].to_numpy()[q],
                        "v": pd.Series([vectors[j] for j in q], dtype=object), "bound": own["bound"].to_numpy()[q]})

        return route

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches come block by block, and within a block its rows before the queries that visit it."""
        block, held, ready = None, [], None
        for batch in batches:
            place = batch[["leaf", "part"]].to_numpy()
            asks = batch["asks"].to_numpy()
            new = (place[1:] != place[:-1]).any(1) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1), len(batch)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if start == stop:
                    continue
                own = batch.iloc[start:stop]
                if block != tuple(place[start]):
                    block, held, ready = tuple(place[start]), [], None
                ids, vectors = own["id"].to_numpy(), _matrix(own["v"])
                if not asks[start]:
                    held.append((ids, vectors))
                    continue
                if not held:
                    continue
                if ready is None:
                    rows_ids, rows_vectors = (np.concatenate(part) for part in zip(*held, strict=True))
                    order = np.argsort(rows_ids, kind="stable")
                    rows_ids, rows_vectors = rows_ids[order], rows_vectors[order]
                    at = projection.of_rows(rows_vectors)
                    ready = rows_ids, rows_vectors, at, (at * at).sum(1)
                rows_ids, rows_vectors, at, squares_at = ready
                bounds = own["bound"].to_numpy()
                for k0 in range(0, len(ids), AT_ONCE):
                    asked = slice(k0, k0 + AT_ONCE)
                    from_query = projection.of_queries(vectors[asked])
                    far = squares_at - 2 * (from_query @ at.T) + (from_query * from_query).sum(1)[:, None]
                    found = [
                        verify(rows_ids, rows_vectors, far[i], name, q, bound, k, longest, quantile)
                        for i, (name, q, bound) in enumerate(zip(ids[asked], vectors[asked], bounds[asked], strict=True))]
                    yield pd.DataFrame({
                        "query_id": np.repeat(ids[asked], [len(f[0]) for f in found]),
                        "vec_id": np.concatenate([f[0] for f in found]), "score": np.concatenate([f[1] for f in found])})

    def visit(asks: DataFrame, first: bool) -> DataFrame:
        routed = asks.mapInPandas(
            visits(first), "leaf long, part long, asks boolean, id long, v array<double>, bound double")
        met = blocks.unionAll(routed).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "asks")
        return cut(met.mapInPandas(compare, FOUND))

    none = F.lit(float("-inf"))
    near = visit(asking.select("id", "v", none.alias("bound")), first=True)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    bounds = near.withColumn("place", place).where(F.col("place") == k).select(
        F.col("query_id").alias("id"), F.col("score").alias("known"))
    further = visit(
        asking.join(bounds, "id", "left").select("id", "v", F.coalesce("known", none).alias("bound")), first=False)
    return (
        near.unionAll(further).withColumn("rank", place.cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
