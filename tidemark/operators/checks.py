"""Checks that stand in for key constraints, and a report on facts a mart would lose."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.pit_join import RANGE, pit_join


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of their rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a required column is NULL."""
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def key_report(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, duplicated keys and rows with a NULL in the key: one row, one pass over the key columns.

    ``by`` names columns that follow from the key; there is one row for each of their values then.
    """
    any_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))
    return (
        df.groupBy(*by, *key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count_if((F.col("_n") > 1) & ~any_null).alias("n_duplicate_keys"),
            F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("n_null_keys"),
        )
    )


def unmatched_facts(
    fact: DataFrame,
    dims: Mapping[str, tuple[DataFrame, str]],
    calendar: DataFrame,
    orders: DataFrame,
    date_col: str = "orderdatekey",
    order_key: str = "salesorderlinekey",
) -> DataFrame:
    """Per dimension, how many facts have no row in it and would drop out of the mart.

    ``dims`` maps a name to a type-2 dimension and its key. All dimensions are looked up in one pass over the fact.
    """
    keys = [order_key, date_col, *(key for _, key in dims.values())]
    flagged = fact.select(*dict.fromkeys(keys))
    # Distinct days, so broadcast: even the whole range of dates is under four million.
    date = F.col("date").cast("date")
    dates = calendar.where(F.col("date") == date).select(date.alias("_date"), F.lit(True).alias("_in_calendar"))
    flagged = flagged.join(F.broadcast(dates.distinct()), F.col(date_col) == F.col("_date"), "left").drop("_date")
    lines = orders.select(order_key).distinct().withColumn("_in_orders", F.lit(True))
    flagged = flagged.join(lines, order_key, "left")
    names = {"calendar": "_in_calendar", "orders": "_in_orders"}
    for name, (dim, key) in dims.items():
        names[name] = f"_in_{name}"
        ranges = dim.select(key, *RANGE, F.lit(True).alias(names[name]))
        flagged = pit_join(flagged, ranges, key, date_col, how="left")
    counts = flagged.agg(*(F.count_if(F.col(flag).isNull()).alias(flag) for flag in names.values()))
    rows = F.array(*(F.struct(F.lit(n).alias("dimension"), F.col(c).alias("n_unmatched")) for n, c in names.items()))
    return counts.select(F.inline(rows))
