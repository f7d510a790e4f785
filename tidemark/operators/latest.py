"""The newest version of each key, and the facts built from it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import date_from_key
from tidemark.schemas import DATE_KEYS


def newest_per_key(
    df: DataFrame, key: str, ts: str = "update_ts", tie_break: Sequence[str] = (), dealt_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the one with the highest ``ts``; ``tie_break`` columns, highest first, settle equal stamps.
    ``dealt_by`` names columns that follow from the key: rows that are already dealt by them are not shuffled again.

    Written as row number = 1, which Spark also applies before the shuffle: every map task sends at most one row
    per key, however many versions a hot key has.
    """
    newest_first = W.partitionBy(*dealt_by, key).orderBy(*(F.col(c).desc() for c in (ts, *tie_break)))
    return df.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") == 1).drop("_rank")


def sales_fact(
    history: DataFrame, tie_break: Sequence[str] = (), complete: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The newest version of each order line, its date keys turned into dates.

    ``complete`` adds columns that follow from others once the newest versions are chosen, so that they are not
    shuffled.
    """
    newest = newest_per_key(history, "salesorderlinekey", tie_break=tie_break)
    if complete is not None:
        newest = complete(newest)
    return newest.withColumns({c: date_from_key(F.col(c)) for c in DATE_KEYS})
