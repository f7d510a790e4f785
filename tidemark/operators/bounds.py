"""When a list of keys is proven small enough to be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# With a fixed-size key, at most some tens of megabytes on an executor.
SMALL_KEY_LIST = 1_000_000


def is_small_key_list(df: DataFrame, key: str, rows: int | None) -> bool:
    """True for a known, small number of keys of a type with fixed size; text keys have no such bound."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return rows is not None and rows <= SMALL_KEY_LIST and isinstance(df.schema[key].dataType, fixed)
