"""Type-1 tables: append what is missing, or overwrite what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_missing(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have; existing rows are never updated."""
    return source.join(target.select(key), key, "left_anti").select(*source.columns)


def upsert(
    target: DataFrame, source: DataFrame, key: str, hit: str | None = None, newer: str | None = None
) -> DataFrame:
    """The target with every source row overwriting its key's row or added to it; other rows are kept.

    ``source`` must be unique by ``key``. ``hit`` names an extra column, true for rows that come from the source and
    NULL otherwise. With ``newer``, the name of a stamp, a row is only overwritten by one with a later stamp.

    A full outer join reads and computes each side once and uses the partitioning both sides may already have by key,
    where an anti join plus union would compute the source twice.
    """
    columns = target.columns
    source = source.select(*(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    merged = target.join(source, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    if newer is not None:
        later = F.coalesce(F.col(f"_new_{newer}") > F.col(newer), F.lit(True))
        merged = merged.withColumn("_hit", F.when(F.col("_hit") & later, True))
    rows = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return merged.select(*rows, *([F.col("_hit").alias(hit)] if hit else []))
