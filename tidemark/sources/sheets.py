"""Reading the sheets of one load and bringing them into the shape of the history tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import normalize_names
from tidemark.schemas import TS

# Cell texts that mean "no value".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
TEXT_FORMATS = ("csv", "json")


def read_sheet(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """One exported sheet; the header row of a CSV file names its columns.

    Without a schema, CSV columns stay text and are cast when they are compared with the history, which saves a pass
    over the data for guessing types (``inferSchema=True`` asks for it). In text formats some texts mean NULL. Quotes
    in a quoted CSV cell are doubled, and a row with too many or too few cells fails its sheet when it is read. Cells
    with line breaks need ``multiLine=True``, which keeps a file from being split among tasks.
    """
    strict = {"header": True, "escape": '"', "mode": "FAILFAST"} if fmt == "csv" else {}
    reader = spark.read.format(fmt).options(**strict | options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return missing_as_null(df) if fmt in TEXT_FORMATS else df


def missing_as_null(df: DataFrame) -> DataFrame:
    return df.select(*(
        F.when(~_quoted(f.name).isin(*MISSING_TEXTS), _quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else _quoted(f.name)
        for f in df.schema
    ))


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def stamp(df: DataFrame, load_ts: dt.datetime, ts: str = TS) -> DataFrame:
    """One load time for the whole batch, passed in so that a replay gives the same rows."""
    return df.withColumn(ts, F.lit(load_ts).cast("timestamp_ntz"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name and type. NaN becomes NULL; a value that does not fit fails."""
    return df.select(*(_converted(df.schema[f.name], f.dataType).alias(f.name) for f in schema))


def fitted(value: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column, str]:
    """A value that is not NULL in the type ``target``, whether it fits that type, and what the type asks for."""
    if isinstance(target, T.LongType) and not isinstance(source, T.IntegralType):
        number = value.try_cast(T.DecimalType(38, 10))
        whole = number.try_cast("long")
        return whole, number == whole, "a whole number"
    converted = value.try_cast(target)
    return converted, converted.isNotNull(), f"a {target.simpleString()}"


def _converted(source: T.StructField, target: T.DataType) -> Column:
    value = _quoted(source.name)
    if isinstance(source.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    if target == source.dataType:
        return value
    converted, good, wanted = fitted(value, source.dataType, target)
    error = F.raise_error(F.concat(F.lit(f"{source.name} is not {wanted}: "), value.cast("string")))
    return F.when(value.isNull() | good, converted).otherwise(error.cast(target))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
