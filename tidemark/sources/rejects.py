"""Delimited sheets whose bad rows are set aside, with file, line and reason, while the others are loaded."""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import normalize_names
from tidemark.sources.sheets import MISSING_TEXTS, fitted

REJECTED_COLUMNS = ("source_file", "source_line", "record", "problem")


@dataclass(frozen=True)
class CheckedSheet:
    """``accepted`` has the sheet's columns as text; ``rejected`` has ``REJECTED_COLUMNS``, one row per bad line."""

    accepted: DataFrame
    rejected: DataFrame


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> CheckedSheet:
    """A CSV sheet, or a folder of its files, cut into rows that fit and rows that do not.

    A row is bad if it has too many or too few cells, or a cell that does not fit the type that ``schema`` has for
    the column of that normalized name. All bad cells are named, joined by "; ". Columns without such a type are text;
    a cell with a text that means "no value" is NULL and fits. Quotes in a quoted cell are doubled, and a cell cannot
    hold a line break. Lines without text are skipped but counted, and a line that repeats the header is one. Files
    are split among tasks like any text.

    Line numbers count from 1 in each file. A bad line knows its place within its split of the file; the lines of
    earlier splits are added from one count per split, so no task has to read a whole file.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("record"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
    ).withColumn("_id", F.monotonically_increasing_id())
    first = lines.where(F.col("_split") == 0).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    names = next(csv.reader([first["record"]], delimiter=sep))
    cells = [f"c{k}" for k in range(len(names))]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed", "escape": '"', "sep": sep}
    row = F.from_csv("record", ", ".join(f"{c} string" for c in [*cells, "malformed"]), options)
    is_row = (F.col("record") != first["record"]) & F.col("record").rlike("[^\\x00-\\x20]")
    parsed = lines.where(is_row).withColumn("_row", row).select(
        "record", "source_file", "_split", "_id", F.col("_row.malformed").isNotNull().alias("_malformed"),
        *(F.when(~F.col(f"_row.{c}").isin(*MISSING_TEXTS), F.col(f"_row.{c}")).alias(c) for c in cells),
    )
    kinds = {f.name: f.dataType for f in schema}
    misfits = [_misfit(F.col(c), name, kinds[own])
               for c, name, own in zip(cells, names, normalize_names(names)) if own in kinds]
    problem = F.when(F.col("_malformed"), f"not {len(names)} cells").otherwise(
        F.nullif(F.concat_ws("; ", F.array(*misfits).cast("array<string>")), F.lit("")))
    checked = parsed.withColumn("problem", problem)
    return CheckedSheet(
        checked.where(F.col("problem").isNull()).select(*(F.col(c).alias(name) for c, name in zip(cells, names))),
        _with_line(checked.where(F.col("problem").isNotNull()), lines),
    )


def _misfit(value: Column, name: str, kind: T.DataType) -> Column:
    """What is wrong with a cell, NULL if nothing is."""
    _, good, wanted = fitted(value, T.StringType(), kind)
    return F.when(value.isNotNull() & ~F.coalesce(good, F.lit(False)), f"{name} is not {wanted}")


def _with_line(bad: DataFrame, lines: DataFrame) -> DataFrame:
    """Bad rows with their lines' numbers: lines of earlier splits, then the place within the own split."""
    earlier = F.sum("_lines").over(
        W.partitionBy("_of").orderBy("_from").rowsBetween(W.unboundedPreceding, -1))
    splits = lines.groupBy(F.col("source_file").alias("_of"), F.col("_split").alias("_from")).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"),
    ).select("_of", "_from", (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_add"))
    own = (F.col("source_file") == F.col("_of")) & (F.col("_split") == F.col("_from"))
    return bad.join(splits, own).withColumn("source_line", F.col("_id") + F.col("_add")).select(*REJECTED_COLUMNS)
