"""One key holds far more than a third of the rows: its joins must be split, and nothing may be lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import new_or_changed
from tidemark.operators.latest import newest_per_key
from tidemark.operators.pit_join import pit_join
from tidemark.operators.scd2 import scd2_ranges

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
ROWS = 40_000


@pytest.fixture
def skewed(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark.range(0, ROWS, 1, 16).select(
        "id",
        F.when(F.col("id") % 4 != 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.xxhash64("id").cast("string").alias("text"),
    )
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def collected(df):
    """The rows and the plan as it was finally run."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_fact_key_is_split(skewed):
    facts = skewed.withColumn("d", F.lit(dt.date(2020, 1, 1)))
    dim = skewed.where((F.col("id") % 4 == 0) | (F.col("id") == 1)).select(
        "k", F.lit(dt.date(2000, 1, 1)).alias("valid_from"), F.lit(dt.date(3000, 1, 1)).alias("valid_to"),
        F.lit(1).alias("v"),
    )
    rows, plan = collected(pit_join(facts, dim, "k", "d"))
    assert len(rows) == ROWS and "skew=true" in plan


def test_hot_fact_key_with_many_versions_is_matched_by_month(skewed):
    first = F.lit(dt.date(2010, 1, 1))
    day = F.date_add(first, (F.col("id") / 10).cast("int"))
    facts = skewed.withColumn("d", day)
    dim = scd2_ranges(
        skewed.sparkSession.range(3000).select(
            F.lit(-1).cast("long").alias("k"), F.date_add(first, F.col("id").cast("int")).cast("timestamp_ntz")
            .alias("update_ts"), F.col("id").alias("v")
        ), "k",
    ).drop("update_ts")
    rows, plan = collected(pit_join(facts, dim, "k", "d"))
    hot = [r for r in rows if r.k == -1]
    assert len(rows) == len(hot) == ROWS * 3 // 4
    assert all(r.v == min((r.d - dt.date(2010, 1, 1)).days, 2999) for r in hot)
    assert "_slot" in plan and "_dim_slot" in plan


def test_hot_key_beyond_the_list_of_dense_keys_is_split(skewed):
    """Keys that the bounded list leaves out are joined plainly, and adaptive execution splits the hot one."""
    facts = skewed.withColumn("d", F.lit(dt.date(2020, 1, 1)))
    days = F.explode(F.sequence(F.lit(0), F.lit(3)))
    dim = skewed.where((F.col("id") % 4 == 0) | (F.col("id") == 1)).select("k", days.alias("n")).select(
        "k",
        F.date_add(F.lit(dt.date(2019, 12, 30)), F.col("n")).alias("valid_from"),
        F.date_add(F.lit(dt.date(2019, 12, 30)), F.col("n")).alias("valid_to"),
        F.col("n").alias("v"),
    )
    rows, plan = collected(pit_join(facts, dim, "k", "d", dense_versions=3, most_dense=0))
    assert len(rows) == ROWS and {r.v for r in rows} == {2}
    assert "skew=true" in plan


def test_hot_day_of_a_hot_key_is_split(skewed):
    """All versions of the hot key fall on one day, so even key and day is one group."""
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") / 1000).cast("timestamp_ntz")
    versions = skewed.withColumn("update_ts", stamp)
    rows, plan = collected(scd2_ranges(versions, "k"))
    hot = [r for r in rows if r.k == -1]
    assert len(rows) == ROWS and "skew=true" in plan
    assert sum(r.valid_to == dt.date(3000, 1, 1) for r in hot) == 1
    assert sum(r.valid_from == dt.date(2000, 1, 1) for r in hot) == 1


def test_hot_key_sends_one_row_per_map_task(skewed):
    versions = skewed.withColumn("update_ts", F.timestamp_seconds("id").cast("timestamp_ntz"))
    newest = newest_per_key(versions, "k")
    rows, plan = collected(newest)
    assert len(rows) == ROWS // 4 + 1
    assert next(r for r in rows if r.k == -1).id == ROWS - 1
    assert plan.count("WindowGroupLimit") >= 2


def test_group_of_copies_collapses_and_versions_of_a_hot_key_spread(skewed):
    staged = skewed.select("k", F.when(F.col("id") % 2 == 0, "copy").otherwise(F.col("text")).alias("text"))
    staged = staged.withColumn("update_ts", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz"))
    history = staged.where((F.col("k") == -1) & (F.col("text") != "copy"))
    rows = new_or_changed(staged, history).collect()
    expected = {(r.k, r.text) for r in staged.collect()} - {(r.k, r.text) for r in history.collect()}
    assert {(r.k, r.text) for r in rows} == expected and len(rows) == len(expected)
