import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.columns import date_from_key, key_from_date, year_quarter
from tidemark.operators.labels import newest_order_labels
from tidemark.operators.latest import newest_per_key


LABELS = ("channel string, salesorderlinekey bigint, sales_order string, sales_order_line string, "
          "update_ts timestamp_ntz")


def at(day):
    return dt.datetime(2025, 1, day)


def test_newest_per_key_and_tie_break(make):
    versions = [(1, "a", at(1)), (1, "b", at(2)), (2, "c", at(3)), (2, "d", at(3))]
    df = make(versions, "k bigint, v string, update_ts timestamp_ntz")
    assert sorted(tuple(r)[:2] for r in newest_per_key(df, "k", tie_break=["v"]).collect()) == [(1, "b"), (2, "d")]


def test_labels_are_validated_before_the_newest_is_taken(make):
    labels = make(
        [
            ("web", 43659001, "SO43659", "SO43659 - 1", at(1)),
            ("web", 43659001, "SO99999", "SO99999 - 1", at(2)),
            ("web", 43660001, "SO43659", "SO43659 - 1", at(1)),
            ("web", 43661001, None, "SO43661 - 1", at(1)),
            ("web", 43662001, "SO43662", "SO43662 - 1", at(1)),
            ("web", 43662001, "SO43662", "SO43662 - 2", at(5)),
        ],
        LABELS,
    )
    rows = newest_order_labels(labels).collect()
    kept = sorted((r.salesorderlinekey, r.sales_order_line, r.update_ts.day) for r in rows)
    assert kept == [(43659001, "SO43659 - 1", 1), (43662001, "SO43662 - 2", 5)]


def test_short_number_inside_a_longer_label_is_valid(make):
    labels = make([("web", 5001, "SO15", "SO15 - 1", at(1))], LABELS)
    assert newest_order_labels(labels).count() == 1


def test_date_keys(make):
    df = make([(20200131,), (None,), (20000229,)], "k bigint").select(date_from_key(F.col("k")).alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2020, 1, 31), None, dt.date(2000, 2, 29)]
    doubles = make([(20200131.0,)], "k double").select(date_from_key(F.col("k")).alias("d"))
    assert doubles.first().d == dt.date(2020, 1, 31)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [20201341, 20210229, 2020131, 0, 120200131])
def test_bad_date_key_fails_in_any_session(make, spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            make([(bad,)], "k bigint").select(date_from_key(F.col("k"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_date_labels(make):
    df = make([(dt.date(2019, 5, 2),)], "d date").select(year_quarter(F.col("d")), key_from_date(F.col("d")))
    assert tuple(df.first()) == ("2019-Q2", 20190502)
