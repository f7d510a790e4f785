"""Naming rules for columns and tables: on the driver for names, as an expression for columns of names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every run of other characters becomes one separator.
OTHER_CHARACTERS = "[^a-z0-9]+"
SEPARATOR = "_"


def normalize_name(name: str) -> str:
    return re.sub(OTHER_CHARACTERS, SEPARATOR, name.lower()).strip(SEPARATOR)


def normalize_names(names: Iterable[str]) -> list[str]:
    """Normalized names in order; names that vanish or collide are refused before anything is written."""
    result = [normalize_name(n) for n in names]
    bad = sorted(n for n, times in Counter(result).items() if times > 1 or not n)
    if bad:
        raise ValueError(f"column names empty or not unique after normalizing: {bad}")
    return result


def normalized(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), OTHER_CHARACTERS, SEPARATOR), F.lit(SEPARATOR))


def history_name(sheet: str) -> str:
    return "src_" + normalize_name(sheet)


def staging_name(sheet: str) -> str:
    return history_name(sheet) + "_temp"
