"""Change capture: which staged rows are not in the history yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bounds import is_small_key_list
from tidemark.operators.key_filter import key_filter

ANY, LATEST = "any", "latest"


def new_or_changed(
    staging: DataFrame,
    history: DataFrame,
    compare: Sequence[str] | None = None,
    null_defaults: Mapping[str, object] | None = None,
    ts: str = "update_ts",
    key: str | None = None,
    staged_rows: int | None = None,
    against: str = ANY,
    distinct: bool = False,
) -> DataFrame:
    """Staged rows whose compared columns equal those of no history row, each distinct row once.

    Comparison is by plain equality, so a NULL never equals anything and its row is captured on every load;
    ``null_defaults`` names columns where NULL stands for a value instead. Any earlier version counts, not only
    the newest: a return to old values is not captured.

    With ``against="latest"`` only the version of each ``key`` with the highest stamp counts, so that a return to
    old values is captured as well. The newest version is the greatest struct of stamp and compared columns, one row
    per key and map task before the shuffle; of versions with equal stamps the one with the greatest values counts.

    Copies are collapsed before the join, so a large group of copies shrinks on the map side. Joining on all
    compared columns also spreads the versions of a hot key over all partitions. On the history's side, rows with a
    NULL are dropped before the shuffle, and others captured by all columns are distinct already; a history compared
    by fewer columns may repeat them and is reduced to distinct values first.

    With ``key`` and a known, small ``staged_rows`` the history is first reduced to the staged keys by a
    broadcast semi join, and an incremental load does not shuffle the whole history. For more rows, or keys of
    text, a Bloom filter of the staged keys (some 8 MB at most, up to 16 million rows) thins it before its shuffle.

    ``distinct`` says that no staged row has a copy, so that there are none to collapse and the rows are shuffled for
    the join alone.
    """
    attributes = [c for c in staging.columns if c != ts]
    compare = list(compare or attributes)
    defaults = null_defaults or {}

    def comparable(name: str) -> Column:
        return F.coalesce(name, F.lit(defaults[name])) if name in defaults else F.col(name)

    if against not in (ANY, LATEST) or against == LATEST and key not in compare:
        raise ValueError("against is 'any', or 'latest' with the name of a compared key")
    names = [f"_seen_{c}" for c in compare]
    seen = history.select(*(comparable(c).alias(f"_seen_{c}") for c in compare), F.col(ts).alias("_seen_at"))
    if against == ANY:
        seen = seen.select(*names)
        if set(compare) != set(attributes):
            seen = seen.distinct()
    if key in compare and is_small_key_list(staging, key, staged_rows):
        staged = staging.select(comparable(key).alias("_staged")).distinct()
        seen = seen.join(F.broadcast(staged), F.col(f"_seen_{key}") == F.col("_staged"), "left_semi")
    elif key in compare and staged_rows is not None:
        may_be_staged = key_filter(staging, comparable(key).cast(seen.schema[f"_seen_{key}"].dataType), staged_rows)
        if may_be_staged is not None:
            seen = seen.where(may_be_staged(F.col(f"_seen_{key}")))
    if against == LATEST:
        newest = F.max(F.struct("_seen_at", *names)).alias("_newest")
        seen = seen.groupBy(F.col(f"_seen_{key}").alias("_newest_of")).agg(newest).select("_newest.*").select(*names)
    equal = reduce(lambda a, b: a & b, (comparable(c) == F.col(f"_seen_{c}") for c in compare))
    batch = distinct_rows(staging, ts, distinct)
    return batch.join(seen, equal, "left_anti").select(*attributes, ts)


def distinct_rows(staging: DataFrame, ts: str = "update_ts", distinct: bool = False) -> DataFrame:
    """Each row once, with its highest stamp; rows known to be ``distinct`` are not shuffled for it.

    Negative zero becomes zero either way, as grouping makes it.
    """
    attributes = [c for c in staging.columns if c != ts]
    if not distinct:
        return staging.groupBy(*attributes).agg(F.max(ts).alias(ts)).select(*attributes, ts)
    zero = {c: (F.col(c) + F.lit(0).cast(kind)).alias(c) for c, kind in staging.dtypes if kind in ("double", "float")}
    return staging.select(*(zero.get(c, F.col(c)) for c in attributes), ts)


def changed_counts(captured: Mapping[str, DataFrame]) -> DataFrame:
    """One row per target table with the number of captured rows; a target without changes counts 0."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows_changed")).select(F.lit(target).alias("table_name"), "rows_changed")
        for target, df in captured.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def counts_as_json(counts: DataFrame) -> DataFrame:
    """All counts as one JSON object ``{table: rows}``; one entry per target table, so the list is short."""
    entries = F.sort_array(F.collect_list(F.struct("table_name", "rows_changed")))
    return counts.agg(F.to_json(F.map_from_entries(entries)).alias("updated_tables"))


def tables_to_refresh(counts: DataFrame, min_changed: int = 2) -> DataFrame:
    """Targets that changed enough to be refreshed. A single changed row is below the default threshold."""
    return counts.where(F.col("rows_changed") >= min_changed)
