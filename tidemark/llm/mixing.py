"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, normalised. One exponent makes the weights
proportional to the shares (1) or equal (0). It is bisected until the weights have the target entropy, or until no
source is repeated more often than the limit. The weights times the token budget are each source's own budget, which
is met by whole permutations of its documents (epochs), dealt in blocks, and a part of one more.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, numbered

SEED = 20260101
#: Parts of a source by the order of its documents; only one of them is summed row by row.
CELLS_LOG2 = 12
BLOCK_ROWS = 4096
PLACES = ("mix_epoch", "mix_block", "mix_place")
WAYS = 16
WHITE = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Number of runs between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WHITE)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Goal:
    """One of the two: an entropy in nats, or how often a source may be repeated at most.

    ``budget`` is in tokens. Without one it is the smallest that holds each source once, so no document is left out.
    """

    max_repetition: float | None = None
    entropy: float | None = None
    budget: int | None = None

    def __post_init__(self):
        if (self.max_repetition is None) == (self.entropy is None):
            raise ValueError("give either max_repetition or entropy")


def solve_exponent(sources: DataFrame, goal: Goal, rounds: int = 10) -> tuple[float, float, float]:
    """(exponent, sum of shares to its power, budget) for a table of positive ``tokens`` per source.

    Each round is one aggregation that tries the points dividing the bracket into sixteen; the driver gets their sums,
    whatever the number of sources. Entropy falls and the most repeated source is repeated less as the exponent grows;
    a target out of reach gives the nearest end of 0 to 64 (entropy) or 0 to 1 (repetition).
    """
    total, least, most, n = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count("*")).first()
    if not n:
        return 1.0, 1.0, float(goal.budget or 0)
    share = F.col("tokens") / F.lit(float(total))
    low_share, high_share = least / total, most / total

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        found = sources.agg(*(
            f for e in exponents for f in (F.sum(F.pow(share, F.lit(e))), F.sum(F.pow(share, F.lit(e)) * F.log(share)))
        )).first()
        return [(found[2 * k], found[2 * k + 1]) for k in range(len(exponents))]

    def budget(e: float, s: float) -> float:
        # Weight by tokens is largest or smallest where the share is.
        return float(goal.budget or total * s / min(low_share ** (e - 1), high_share ** (e - 1)))

    def above(e: float, s: float, logs: float) -> bool:
        """True if the exponent must grow."""
        if goal.entropy is not None:
            return math.log(s) - e * logs / s > goal.entropy
        repeated = budget(e, s) / (total * s) * max(low_share ** (e - 1), high_share ** (e - 1))
        return repeated > goal.max_repetition * (1 + 1e-12)

    low, high = 0.0, 64.0 if goal.entropy is not None else 1.0
    for _ in range(rounds):
        points = [low + (high - low) * k / WAYS for k in range(WAYS + 1)]
        grows = [above(e, *found) for e, found in zip(points, sums(points), strict=True)]
        first = next((k for k, g in enumerate(grows) if not g), WAYS)
        low, high = points[max(first - 1, 0)], points[first]
        if low == high:
            break
    ((s, _),) = sums([high])
    return high, s, budget(high, s)


def mixture(docs: DataFrame, goal: Goal, id_col: str = "doc_id", source: str = "source", text: str = "text",
            seed: int = SEED) -> DataFrame:
    """One row per source: its tokens, rows, weight, budget, whole epochs, and the last key of the begun epoch.

    A null source is a source. A source without tokens has weight 0 and one epoch, so its documents are kept.
    """
    own = cut(_keyed(docs.select(
        F.col(source).alias("source"), _key(id_col, text, seed).alias("mix_key"),
        token_count(F.col(text)).alias("mix_tokens"))))
    cells = cut(own.groupBy("source", "cell").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("rows")))
    sources = cells.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))
    exponent, s, budget = solve_exponent(cut(sources.where("tokens > 0").select("tokens")), goal)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent)) / s)
    plan = (
        sources.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
        .withColumn("exponent", F.lit(exponent))
        .withColumn("budget", (F.col("weight") * F.lit(budget) + 1e-6).cast("long"))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-6))
                    .otherwise(1).cast("int"))
        .withColumn("rest", F.greatest(F.lit(0), F.col("budget") - F.col("epochs") * F.col("tokens")))
    )
    # The begun epoch ends in the cell that the rest of the budget reaches, and there at a document.
    upto = Window.partitionBy("source").orderBy("cell")
    c, p = cells.alias("c"), plan.alias("p")
    same = F.col("c.source").eqNullSafe(F.col("p.source"))
    ends = (
        c.withColumn("upto", F.sum("tokens").over(upto)).join(p, same)
        .where("upto > p.rest").groupBy(F.col("p.source").alias("source"))
        .agg(F.min(F.struct("cell", (F.col("p.rest") - F.col("upto") + F.col("c.tokens")).alias("left"))).alias("end"))
        .select("source", "end.cell", "end.left")
    )
    e, o = ends.alias("e"), own.alias("o")
    summed = F.sum("mix_tokens").over(
        Window.partitionBy("o.source").orderBy("mix_key").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = (
        o.join(e, F.col("o.source").eqNullSafe(F.col("e.source")) & (F.col("o.cell") == F.col("e.cell")))
        .withColumn("summed", summed).groupBy(F.col("o.source").alias("source"))
        .agg(F.max(F.when(F.col("summed") <= F.col("left"), F.col("mix_key"))).alias("key"),
             F.max("o.cell").alias("cell"))
        .select("source", F.coalesce("key", F.when(
            F.col("cell") > -(1 << CELLS_LOG2 - 1), F.shiftleft("cell", 64 - CELLS_LOG2) - 1)).alias("last_key"))
    )
    x = last.alias("x")
    return cut(
        p.join(x, F.col("p.source").eqNullSafe(F.col("x.source")), "left")
        .select("p.*", F.when(F.col("p.rest") > 0, F.col("last_key")).alias("last_key"))
    )


def _key(id_col: str, text: str, seed: int) -> Column:
    """A document's place in the order of the begun epoch; equal rows share it and stay together."""
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.xxhash64(F.col(text)))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("cell", F.shiftright("mix_key", 64 - CELLS_LOG2))


def mixed(docs: DataFrame, goal: Goal, id_col: str = "doc_id", source: str = "source", text: str = "text",
          seed: int = SEED, columns: list[str] | None = None, places: bool = True) -> DataFrame:
    """The documents as often as the mixture takes them.

    Returns ``columns`` (all by default) and, with ``places``, mix_epoch, mix_block and mix_place: reading a source by
    these three gives a new permutation of its documents in each epoch. A block holds some 4096 rows of one source and
    epoch, dealt by hash, so a source of any size spreads over many tasks. The begun epoch takes documents in the order
    of their keys while its budget lasts; rows equal in id and text are taken or left together, but dealt to blocks
    each by itself, by its place in the input, so that copies spread however many they are. Null texts and texts
    without words count no token. Texts are never cut, and not shuffled unless places are asked for. Columns that are
    called like one of the three places are replaced by it; any other extra column stays as it is.
    """
    columns = [c for c in columns or docs.columns if not places or c.lower() not in PLACES]
    docs, own = numbered(docs)
    id_col, source, text = own[id_col], own[source], own[text]
    columns = [F.col(own[c]).alias(c) for c in columns]
    plan = mixture(docs, goal, id_col, source, text, seed).select(
        F.col("source").alias("p_source"), F.col("rows").alias("p_rows"), F.col("epochs").alias("p_epochs"),
        F.col("last_key").alias("p_last"))
    key, epoch = "mix_key", "mix_epoch"
    keyed = docs.withColumn(key, _key(id_col, text, seed))
    if places:
        keyed = keyed.withColumn("copy", F.monotonically_increasing_id())
    joined = keyed.join(plan, keyed[source].eqNullSafe(plan.p_source))
    copies = F.col("p_epochs") + F.when(F.col(key) <= F.col("p_last"), 1).otherwise(0)
    taken = joined.where(copies > 0).withColumn(epoch, F.explode(F.sequence(F.lit(0), copies - 1)))
    if not places:
        return taken.select(*columns)
    order = F.when(F.col(epoch) < F.col("p_epochs"), F.xxhash64(F.lit(seed), epoch, key)).otherwise(F.col(key))
    blocks = F.ceil(F.col("p_rows") / BLOCK_ROWS)
    placed = (
        taken.withColumn("mix_order", order)
        .withColumn("mix_block", F.pmod(F.xxhash64("mix_order", "copy"), blocks).cast("int"))
    )
    within = Window.partitionBy(source, epoch, "mix_block").orderBy("mix_order", "copy")
    return placed.withColumn("mix_place", F.row_number().over(within)).select(
        *columns, F.col(epoch).alias("mix_epoch"), "mix_block", "mix_place")
