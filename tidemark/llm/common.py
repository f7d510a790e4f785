"""Helpers the operators share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows as written to the shared checkpoint folder: lineage ends here, and a lost executor repeats nothing."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def in_fold(key: str, folds: int, fold: int) -> Column:
    """True where the CRC-32 of the key's text leaves ``fold``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == fold


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under names of their own, which no helper column has, and which name each column got.

    An operator that works on these and gives them their names back at the end bears any extra columns.
    """
    names = {c: f"own_column_{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def ship(spark: SparkSession) -> None:
    """Sends this library's modules to the Python workers, once per application, where it is not installed there."""
    context = spark.sparkContext
    if any(Path(f).name == "tidemark-modules.zip" for f in context.listFiles):
        return
    root = Path(__file__).resolve().parents[2]
    made = Path(tempfile.mkdtemp()) / "tidemark-modules"
    context.addPyFile(shutil.make_archive(str(made), "zip", root, "tidemark"))
