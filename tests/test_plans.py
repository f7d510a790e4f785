"""Physical plans: what shuffles, what is pushed down, what never happens."""

import re

import pytest

from tidemark.operators.changes import new_or_changed
from tidemark.operators.latest import newest_per_key, sales_fact
from tidemark.operators.scd2 import scd2_ranges
from tidemark.operators.upsert import append_missing, upsert
from workload import inputs as i
from workload.inputs import Tables
from workload.queries import QUERIES, new_store


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture
def t(spark, folder):
    return Tables(spark, folder)


@pytest.fixture
def large(spark):
    """As if nothing were small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


FULL_RUNS = ("audit_log", "incremental_mart", "stored_mart", "stored_reseller_dim")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(FULL_RUNS)))
def test_no_query_pairs_everything_with_everything(spark, folder, large, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_scd2_window_sees_days_only(t, large):
    text = plan(scd2_ranges(i.event_history(t), "user_id"))
    assert text.count("Window ") == 1
    below = text[text.index("Window "):]
    assert "partial_min" in below and "partial_max" in below and "event_type" not in below
    assert text.count("Exchange hashpartitioning") == 4


def test_newest_is_limited_before_the_shuffle(t):
    text = plan(newest_per_key(i.order_label_history(t), "salesorderlinekey", tie_break=i.LABEL_TIE_BREAK))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1


def test_capture_is_an_anti_join_after_partial_aggregation(t, large):
    labels = i.order_label_history(t)
    text = plan(new_or_changed(labels, labels))
    assert "LeftAnti" in text and text.count("Exchange") == 2
    assert text.count("HashAggregate") == 2


def test_capture_by_key_reduces_a_repetitive_history_first(t, large):
    dates = i.order_dates(t)
    text = plan(new_or_changed(dates, dates, compare=["datekey"]))
    history = text[text.rindex("Exchange"):]
    assert "LeftAnti" in text and "HashAggregate" in history and "o_orderdate" in history


def test_small_batch_thins_the_history_before_its_shuffle(t, large):
    labels = i.order_label_history(t)
    text = plan(new_or_changed(labels, labels, key="salesorderlinekey", staged_rows=10))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_the_latest_versions_are_reduced_before_their_shuffle(t, large):
    labels = i.order_label_history(t)
    text = plan(new_or_changed(labels, labels, key="salesorderlinekey", against="latest"))
    assert "LeftAnti" in text and "partial_max(struct(_seen_at" in text


def test_append_missing_is_an_anti_join(t):
    days = i.calendar(t)
    assert "LeftAnti" in plan(append_missing(days, days, "datekey"))


def test_upsert_adds_no_shuffle_to_computed_sides(t, large):
    labels = i.order_label_history(t)
    newest = newest_per_key(labels, "salesorderlinekey")
    text = plan(upsert(newest, newest, "salesorderlinekey"))
    assert "FullOuter" in text and text.count("Exchange") == 2


def test_tables_bucketed_by_line_key_join_without_a_shuffle(spark, t, large):
    store = new_store(t)
    history = i.sales_history(t)
    store.publish("fct_sales_data", sales_fact(history, i.SALES_TIE_BREAK), ["salesorderlinekey"], "salesorderlinekey")
    labels = newest_per_key(i.order_label_history(t), "salesorderlinekey", tie_break=i.LABEL_TIE_BREAK)
    store.publish("dim_sales_order_data", labels, ["salesorderlinekey"], "salesorderlinekey")
    joined = store.table("fct_sales_data").join(store.table("dim_sales_order_data"), "salesorderlinekey")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    # One file per bucket: what the window has shuffled by line key is written as it lies.
    assert len(store.table("fct_sales_data").inputFiles()) == 8


def test_cohorts_read_only_what_they_need(spark, folder):
    scans = re.findall(r"ReadSchema: struct<(.*?)>", plan(QUERIES["customer_cohorts"](spark, folder)))
    lines = [s for s in scans if "l_orderkey" in s]
    assert lines and not any("l_comment" in s or "o_totalprice" in s for s in scans)


def test_filters_reach_the_scan(spark, folder):
    text = plan(QUERIES["order_labels_valid"](spark, folder))
    assert "PushedFilters" in text
    assert "struct<l_orderkey:bigint,l_linenumber:int,l_linestatus:string,l_shipdate:timestamp_ntz>" in text
