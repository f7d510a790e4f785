"""Ranges of a whole-number key, by which large tables are cut into parts that can be replaced alone."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Catalogs and plans bear that many partitions; keys beyond the last range all belong to it.
MOST_PARTS = 10_000
PART = "key_part"


@dataclass(frozen=True)
class KeyRanges:
    """Part k holds the keys from ``base + k * size`` up to the next part; the outer parts are open.

    Business keys are dealt in sequence, so that a load of new lines, or a change from some day on, touches few parts.
    """

    key: str
    base: int
    size: int

    @classmethod
    def over(cls, key: str, low: int | None, high: int | None, rows: int, rows_per_part: int) -> KeyRanges:
        """Ranges with about that many rows, given the lowest and highest key and the number of rows there are."""
        if low is None or high is None:
            return cls(key, 0, 1 << 62)
        parts = min(MOST_PARTS // 10, max(1, math.ceil(rows / rows_per_part)))  # leaves room to grow
        return cls(key, low, max(1, math.ceil((high - low + 1) / parts)))

    def part(self) -> Column:
        """The number of the key's part; monotonous in the key, NULL for a NULL key."""
        place = F.floor((F.col(self.key).cast("double") - F.lit(float(self.base))) / F.lit(float(self.size)))
        number = F.greatest(F.lit(0).cast("double"), F.least(F.lit(MOST_PARTS - 1).cast("double"), place))
        return F.when(F.col(self.key).isNotNull(), number.cast("int")).alias(PART)
