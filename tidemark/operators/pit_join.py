"""Point-in-time join: each fact with the dimension version that was valid on its date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bounds import SMALL_KEY_LIST

RANGE = ("valid_from", "valid_to")

# Keys with more versions than this are matched month by month.
DENSE_VERSIONS = 64


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    date_col: str,
    how: str = "inner",
    dense_versions: int = DENSE_VERSIONS,
    most_dense: int = SMALL_KEY_LIST,
) -> DataFrame:
    """``fact`` plus the attributes of the ``dim`` rows with the same key and ``date_col`` in their closed range.

    ``dim`` has the key, ``valid_from``, ``valid_to`` and the attributes to add; these must not share names with
    ``fact``. ``how`` is ``inner`` or ``left``. The dimension is not hinted as small: Spark broadcasts it if its size
    allows it, and otherwise splits a hot fact key at run time.

    The range is a residual condition of the key join, so each fact is compared with every version of its key.
    That is fine while keys have few versions, and hopeless for a hot key with thousands. So the versions of dense
    keys are spread over the months they cover, and their facts join on key and month: a fact then meets the versions
    of one month only, and the key's rows spread over many partitions.

    Which keys are dense is decided within the plan, and no job runs before it does: a narrow aggregate over the
    dimension lists them with the months of their first and last change, as hashes. At most ``most_dense`` are listed,
    those with the most versions, so that the list has a proven size and is broadcast to both sides; any further keys,
    each with fewer versions, are joined plainly. Two keys with one hash share their months, which are only a way to
    deal rows: any months do, as long as both sides use the same.
    """
    attributes = [c for c in dim.columns if c != key and c not in RANGE]
    shared = set(attributes) & set(fact.columns)
    if shared:
        raise ValueError(f"rename before joining, columns on both sides: {sorted(shared)}")

    # Without the empty ranges of days with several versions, which match nothing.
    versions = dim.where(F.col("valid_from") <= F.col("valid_to")).withColumnRenamed(key, "_dim_key")
    dense = _dense_keys(versions, dense_versions, most_dense)
    plain = F.col("_lo").isNull()
    slots = F.when(plain, F.array(F.lit(0))).otherwise(
        F.sequence(_slot(F.col("valid_from")), _slot(F.col("valid_to"))))
    dealt = _with_bounds(versions, F.col("_dim_key"), dense).withColumn("_dim_slot", F.explode(slots)).drop("_lo", "_hi")
    fact_slot = F.when(plain, F.lit(0)).otherwise(_slot(F.col(date_col)))
    # Equal keys of two types have different hashes; what does not fit the dimension's type equals none of its keys.
    alike = F.col(key).try_cast(versions.schema["_dim_key"].dataType)
    placed = _with_bounds(fact, alike, dense).select(*fact.columns, fact_slot.alias("_slot"))
    matches = (
        (F.col(key) == F.col("_dim_key"))
        & (F.col("_slot") == F.col("_dim_slot"))
        & F.col(date_col).between(F.col("valid_from"), F.col("valid_to"))
    )
    return placed.join(dealt, matches, how).select(*fact.columns, *attributes)


def _with_bounds(df: DataFrame, key: Column, dense: DataFrame) -> DataFrame:
    """Every row with ``_lo`` and ``_hi`` of its key, NULL if that is not dense."""
    return df.join(F.broadcast(dense), F.xxhash64(key) == F.col("_dense_key"), "left").drop("_dense_key")


def _month(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def _slot(date: Column) -> Column:
    """A date's month, moved into the months between the key's first and last change.

    Moving is monotonic, so a date inside a range stays inside the moved range, and the open ends of the first and
    the last version take one slot instead of centuries.
    """
    return F.greatest(F.col("_lo"), F.least(_month(date), F.col("_hi")))


def _dense_keys(versions: DataFrame, limit: int, most: int) -> DataFrame:
    return (
        versions.where(F.col("_dim_key").isNotNull())
        .groupBy(F.xxhash64("_dim_key").alias("_dense_key"))
        .agg(
            F.count(F.lit(1)).alias("_versions"),
            _month(F.min("valid_to")).alias("_lo"),
            _month(F.max("valid_from")).alias("_hi"),
        )
        .where(F.col("_versions") > limit)
        .orderBy(F.desc("_versions"), "_dense_key")
        .limit(most)
        .select("_dense_key", F.col("_lo"), F.greatest("_lo", "_hi").alias("_hi"))
    )
