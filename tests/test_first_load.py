"""A load shuffles whole rows no oftener than it must; what it adds stays the same."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import new_or_changed
from tidemark.plans.refresh import live_mart
from tidemark.plans.upload import captured
from tidemark.schemas import PRODUCT, TERRITORY
from tidemark.sources.sheets import stamp
from tidemark.sources.store import KeyCheckFailed, Store

FIRST, SECOND = dt.datetime(2025, 1, 1, 8), dt.datetime(2025, 2, 1, 8)


@pytest.fixture
def store(spark):
    return Store(spark, f"first_{uuid.uuid4().hex}").create()


@pytest.fixture
def product(make):
    def rows(*costs):
        return make(
            [(key, f"P{key}", "p", cost, color, 1.0, "m", "s", "c") for key, cost, color in costs],
            PRODUCT.columns.replace(" bigint", " long"))
    return rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stage(store, df, at):
    return store.stage(PRODUCT.staging_table, stamp(df, at))


def capture(store, rows):
    return captured(store, PRODUCT, rows)


def seen(df):
    return sorted((r.productkey, str(r.standard_cost), str(r.color)) for r in df.collect())


def test_a_first_load_of_unique_keys_is_not_shuffled(store, product):
    """whole rows were shuffled twice, once to collapse copies and once to meet an empty history."""
    rows = stage(store, product((1, -0.0, None), (2, 2.0, "red"), (3, float("nan"), "")), FIRST)
    batch = capture(store, rows)
    assert "Exchange" not in plan(batch)
    assert batch.schema.names == PRODUCT.history_schema.names
    assert seen(batch) == [(1, "0.0", "None"), (2, "2.0", "red"), (3, "None", "")]  # as grouping makes them


def test_copies_of_a_first_load_are_collapsed(store, product):
    rows = stage(store, product((1, 1.0, "a"), (1, 1.0, "a"), (2, 0.0, None), (2, -0.0, None)), FIRST)
    assert store.append_history(PRODUCT, capture(store, rows)) == 2
    rows = stage(store, product((None, 1.0, "a"), (None, 1.0, "a")), SECOND)
    with pytest.raises(KeyCheckFailed):
        store.append_history(PRODUCT, capture(store, rows))


def test_a_later_load_of_unique_keys_is_shuffled_for_the_join_alone(store, product):
    """it was shuffled to collapse copies first."""
    rows = stage(store, product((1, 1.0, None), (2, 2.0, "red"), (3, 3.0, "")), FIRST)
    assert store.append_history(PRODUCT, capture(store, rows)) == 3
    rows = stage(store, product((1, 1.0, ""), (2, 2.5, "red"), (3, 3.0, None), (4, 1.0, None)), SECOND)
    batch = capture(store, rows)
    assert "HashAggregate(keys=[productkey" not in plan(batch).replace("#", "").partition("BroadcastExchange")[0]
    assert seen(batch) == [(2, "2.5", "red"), (4, "1.0", "None")]
    assert store.append_history(PRODUCT, batch) == 2


def test_unique_rows_are_captured_as_others_are(make):
    staged = make([(1, None, 1.0, FIRST), (2, "a", -0.0, FIRST), (3, "b", 1.0, FIRST)],
                  "k long, c string, v double, update_ts timestamp_ntz")
    history = make([(1, "", 1.0, FIRST), (2, "a", 0.0, FIRST)], "k long, c string, v double, update_ts timestamp_ntz")
    for defaults in ({}, {"c": ""}):
        old = new_or_changed(staged, history, null_defaults=defaults).collect()
        assert sorted(new_or_changed(staged, history, null_defaults=defaults, distinct=True).collect(), key=str) == \
            sorted(old, key=str)


def test_lines_that_no_range_covers_are_left_out_before_shuffles(store):
    """lines before the dimensions' first day were shuffled to them in vain."""
    text = live_mart(store)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("min(valid_from") >= 4 and text.count("max(valid_to") >= 4


def test_files_are_compressed_well(store, make):
    df = make([(1, "r", "c", "g")], "salesterritorykey long, region string, country string, `group` string")
    store.append_history(TERRITORY, stamp(df, FIRST))
    files = list(Path(store.folder.removeprefix("file:")).rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_known_keys_are_still_refused(store, make):
    df = make([(1, "r", "c", "g")], "salesterritorykey long, region string, country string, `group` string")
    store.append_history(TERRITORY, stamp(df, FIRST))
    store.append_history(TERRITORY, stamp(df, SECOND))
    with pytest.raises(KeyCheckFailed):
        store.append_history(TERRITORY, stamp(df.withColumn("region", F.lit("x")), FIRST))
