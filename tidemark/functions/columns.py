"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def integral_quotient(value: Column, divisor: int) -> Column:
    """Integer division that truncates and stays exact for any long."""
    return F.call_function("div", value, F.lit(divisor))


def date_from_key(key: Column) -> Column:
    """A YYYYMMDD number as a date: NULL stays NULL, anything that is no date fails.

    Arithmetic instead of text parsing: three keys per fact row make this a hot expression.
    """
    key = key.cast("long")
    date = F.make_date(
        integral_quotient(key, 10000).cast("int"),
        (integral_quotient(key, 100) % 100).cast("int"),
        (key % 100).cast("int"),
    )
    error = F.raise_error(F.concat(F.lit("not a YYYYMMDD date key: "), key.cast("string"))).cast("date")
    return F.when(key.isNotNull(), F.coalesce(F.when(key.between(10000101, 99991231), date), error))


def key_from_date(date: Column) -> Column:
    """The YYYYMMDD number of a date."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("long")


def year_quarter(date: Column) -> Column:
    return F.concat(F.date_format(date, "yyyy"), F.lit("-Q"), F.quarter(date).cast("string"))


def first_applicable(preferred: Column, fallback: Column, not_applicable: str) -> Column:
    """``preferred`` unless it is the not-applicable label or NULL, else ``fallback``."""
    return F.when(preferred != not_applicable, preferred).otherwise(fallback)


def is_current(as_of: Column, valid_from: Column, valid_to: Column) -> Column:
    return F.when(as_of.between(valid_from, valid_to), 1).otherwise(0).cast("int")


def order_number(line_key: Column) -> Column:
    """The order's number as text; the last three digits of a line key count its lines."""
    return integral_quotient(line_key, 1000).cast("string")
