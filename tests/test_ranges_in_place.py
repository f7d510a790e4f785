"""ranges are found where the versions of a key lie already; the ranges stay the same."""

import datetime as dt
import random
import re

import pytest

from tidemark.operators.scd2 import scd2_ranges
from workload.inputs import Tables
from workload.queries import EARLY_FLOOR, QUERIES, dimensions

SCHEMA = "k bigint, update_ts timestamp_ntz, v bigint"


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def seen(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def large(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("seed", range(3))
def test_ranges_in_place_are_those_of_the_join(make, seed):
    """Among them equal stamps, several on a day, missing keys and stamps, and a key with most of the rows."""
    rng = random.Random(seed)
    start = dt.datetime(1999, 12, 1)
    rows = [
        (rng.choice([7, 7, 7, None, rng.randrange(20)]),
         None if rng.random() < 0.03 else start + dt.timedelta(hours=6 * rng.randrange(400)), n) for n in range(900)]
    history = make(rows, SCHEMA)
    dealt = history.repartition("k")
    for options in ({}, {"floor": "1900-01-01", "as_of": "2000-01-10"}):
        ranged = scd2_ranges(dealt, "k", dealt=True, **options)
        assert ranged.columns == scd2_ranges(history, "k", **options).columns
        assert seen(ranged) == seen(scd2_ranges(history, "k", **options))


def test_versions_that_are_dealt_are_not_shuffled_again(make, large):
    dealt = make([(1, dt.datetime(2025, 1, 1), 1)], SCHEMA).repartition("k")
    assert plan(scd2_ranges(dealt, "k", dealt=True)).count("Exchange") == 1
    assert plan(scd2_ranges(dealt, "k")).count("Exchange") > 1


def test_versions_of_parts_and_customers_are_not_dealt_by_day(spark, folder, large):
    text = plan(QUERIES["sales_mart"](spark, folder))
    for key in ("productkey", "customerkey"):
        assert f"hashpartitioning({key}, _slot" in text and f"hashpartitioning({key}, _day" not in text
    t = Tables(spark, folder)
    dealt, spread = (dimensions(t, EARLY_FLOOR, dealt) for dealt in (True, False))
    for name in ("product", "customer"):
        assert seen(dealt[name]) == seen(spread[name])


def test_shuffles_are_compressed_well(spark):
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"
