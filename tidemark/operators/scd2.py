"""Type-2 dimensions: validity ranges from the load stamps of each key's versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import is_current
from tidemark.schemas import CEILING, FLOOR


def scd2_ranges(
    history: DataFrame,
    key: str,
    ts: str = "update_ts",
    floor: str = FLOOR,
    ceiling: str = CEILING,
    as_of: dt.date | str | None = None,
    dealt: bool = False,
) -> DataFrame:
    """History rows with ``valid_from``, ``valid_to`` and, given ``as_of``, ``is_valid``.

    The first version of a key starts at ``floor``, the others on the day of their stamp; each ends the day before
    the next one's, the last at ``ceiling``. Of several versions on one day all but the last get an empty range.

    Ranges depend on a version's neighbours only through their days. So the versions are first reduced to one row
    per key and day (partial aggregation, before any shuffle), the window runs over those days, and the result is
    joined back on key and day. No task ever holds all versions of a key, only its days, and the join is one that
    adaptive execution can split where a single day of a key is hot. ``key`` and ``ts`` must not be NULL and
    unique together, as checked before a table is published.

    ``dealt`` says that ``history`` is dealt by ``key`` already, so that a task holds all versions of a key in any case.
    Ranges are then found where the versions lie, and nothing is shuffled for them.
    """
    if dealt:
        ranged = _ranges_in_place(history, key, ts, floor, ceiling)
        return ranged if as_of is None else with_current_flag(ranged, as_of)
    by_key = W.partitionBy(key).orderBy("_day")
    day = F.col(ts).cast("date")
    days = (
        history.groupBy(key, day.alias("_day"))
        .agg(F.min(ts).alias("_opens"), F.max(ts).alias("_closes"))
        .select(
            key,
            "_day",
            "_closes",
            F.when(F.lag("_day").over(by_key).isNull(), F.col("_opens")).alias("_first"),
            F.lead("_day").over(by_key).alias("_next_day"),
        )
    )
    valid_from = F.when(F.col(ts) == F.col("_first"), F.lit(floor).cast("date")).otherwise(F.col("_day"))
    valid_to = (
        F.when(F.col(ts) < F.col("_closes"), F.date_sub("_day", 1))
        .when(F.col("_next_day").isNotNull(), F.date_sub("_next_day", 1))
        .otherwise(F.lit(ceiling).cast("date"))
    )
    ranged = (
        history.withColumn("_day", day)
        .join(days, [key, "_day"], "left")
        .select(*history.columns, valid_from.alias("valid_from"), valid_to.alias("valid_to"))
    )
    return ranged if as_of is None else with_current_flag(ranged, as_of)


def _ranges_in_place(history: DataFrame, key: str, ts: str, floor: str, ceiling: str) -> DataFrame:
    """The same ranges from each version's next later stamp; versions with equal stamps share it."""
    newest_first = W.partitionBy(key).orderBy(F.desc(ts))
    whole_key = newest_first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    stamp, known = F.col(ts), F.col(key).isNotNull() & F.col(ts).isNotNull()
    seen = history.withColumns({"_opens": F.min(ts).over(whole_key), "_before": F.lag(ts).over(newest_first)})
    later = F.when(F.col("_before") != stamp, F.col("_before"))
    seen = seen.withColumn("_next", F.min(later).over(newest_first))
    valid_from = F.when(known & (stamp == F.col("_opens")), F.lit(floor).cast("date")).otherwise(stamp.cast("date"))
    next_day = F.when(known, F.col("_next").cast("date"))
    valid_to = F.coalesce(F.date_sub(next_day, 1), F.lit(ceiling).cast("date"))
    return seen.select(*history.columns, valid_from.alias("valid_from"), valid_to.alias("valid_to"))


def with_current_flag(ranged: DataFrame, as_of: dt.date | str) -> DataFrame:
    today = F.lit(as_of).cast("date")
    return ranged.withColumn("is_valid", is_current(today, F.col("valid_from"), F.col("valid_to")))


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_valid") == 1)
