import datetime as dt

import pytest

from tidemark.operators.changes import counts_as_json, new_or_changed, tables_to_refresh

SCHEMA = "k bigint, a string, c string, update_ts timestamp_ntz"


def at(hour):
    return dt.datetime(2025, 1, 1, hour)


def rows(df):
    return sorted(((r.k, r.a, r.c, r.update_ts.hour) for r in df.collect()), key=str)


def golden(make):
    history = make([(1, "A", "x", at(1)), (2, "B", None, at(1))], SCHEMA)
    staging = make(
        [(1, "A", "x", at(9)), (2, "B", None, at(9)), (3, "C", "y", at(9)), (3, "C", "y", at(8)), (1, "A2", "x", at(9))],
        SCHEMA,
    )
    return staging, history


def test_null_never_equals_and_copies_collapse(make):
    staging, history = golden(make)
    assert rows(new_or_changed(staging, history)) == [(1, "A2", "x", 9), (2, "B", None, 9), (3, "C", "y", 9)]


def test_null_default_makes_null_equal(make):
    staging, history = golden(make)
    assert rows(new_or_changed(staging, history, null_defaults={"c": ""})) == [(1, "A2", "x", 9), (3, "C", "y", 9)]


def test_null_and_its_default_stay_two_rows(make):
    staging = make([(1, "A", None, at(9)), (1, "A", "", at(9))], SCHEMA)
    nothing = make([], SCHEMA)
    assert rows(new_or_changed(staging, nothing, null_defaults={"c": ""})) == [(1, "A", "", 9), (1, "A", None, 9)]


def test_null_rows_group_together(make):
    staging = make([(2, "B", None, at(7)), (2, "B", None, at(9))], SCHEMA)
    assert rows(new_or_changed(staging, make([], SCHEMA))) == [(2, "B", None, 9)]


def test_return_to_an_old_value_is_not_captured(make):
    history = make([(1, "A", "x", at(1)), (1, "B", "x", at(2))], SCHEMA)
    assert rows(new_or_changed(make([(1, "A", "x", at(9))], SCHEMA), history)) == []


def test_second_run_captures_nothing_without_nulls(make):
    staging = make([(1, "A", "x", at(9)), (3, "C", "y", at(9))], SCHEMA)
    history = make([(1, "A", "z", at(1))], SCHEMA)
    captured = new_or_changed(staging, history)
    assert captured.count() == 2
    assert rows(new_or_changed(staging, history.unionByName(captured))) == []


def test_by_key_ignores_other_columns(make):
    history = make([(1, "A", "x", at(1))], SCHEMA)
    staging = make([(1, "other", "z", at(9)), (2, "B", "y", at(9))], SCHEMA)
    assert rows(new_or_changed(staging, history, compare=["k"])) == [(2, "B", "y", 9)]


def test_thinning_the_history_changes_nothing(make):
    staging, history = golden(make)
    for defaults in ({}, {"c": ""}):
        plain = new_or_changed(staging, history, null_defaults=defaults)
        small = new_or_changed(staging, history, null_defaults=defaults, key="k", staged_rows=5)
        large = new_or_changed(staging, history, null_defaults=defaults, key="k", staged_rows=10**9)
        assert rows(small) == rows(plain) == rows(large)


def test_thinning_keeps_rows_without_a_key(make):
    staging = make([(None, "A", "x", at(9)), (1, "A", "x", at(9))], SCHEMA)
    history = make([(1, "A", "x", at(1))], SCHEMA)
    assert rows(new_or_changed(staging, history, key="k", staged_rows=2)) == [(None, "A", "x", 9)]


def test_thinning_follows_the_default_of_the_key(make):
    staging = make([(None, "A", "x", at(9)), (2, "A", "x", at(9))], SCHEMA)
    history = make([(0, "A", "x", at(1))], SCHEMA)
    options = {"null_defaults": {"k": 0}, "key": "k"}
    assert rows(new_or_changed(staging, history, staged_rows=2, **options)) == [(2, "A", "x", 9)]


def test_threshold_and_json(make):
    counts = make([("dim_date_data", 0), ("fct_sales_data", 1), ("dim_product_data", 2)],
                  "table_name string, rows_changed bigint")
    assert [r.table_name for r in tables_to_refresh(counts).collect()] == ["dim_product_data"]
    assert counts_as_json(counts).first()[0] == '{"dim_date_data":0,"dim_product_data":2,"fct_sales_data":1}'


def test_return_to_an_old_value_is_captured_against_the_latest(make):
    history = make([(1, "A", "x", at(1)), (1, "B", "x", at(2)), (2, "A", None, at(1)), (2, "A", "y", at(0)),
                    (3, "C", "z", at(5)), (3, "D", "z", at(4)), (None, "A", "x", at(1))], SCHEMA)
    staging = make([(1, "A", "x", at(9)), (1, "B", "x", at(9)), (2, "A", "y", at(9)), (2, "A", None, at(8)),
                    (3, "C", "z", at(9)), (4, "E", "z", at(9)), (None, "A", "x", at(9))], SCHEMA)
    for rows_staged in (None, 7):
        options = {"key": "k", "staged_rows": rows_staged, "against": "latest"}
        got = rows(new_or_changed(staging, history, **options))
        assert got == [(1, "A", "x", 9), (2, "A", "y", 9), (2, "A", None, 8), (4, "E", "z", 9), (None, "A", "x", 9)]
        got = rows(new_or_changed(staging, history, null_defaults={"c": "", "k": 0}, **options))
        assert got == [(1, "A", "x", 9), (2, "A", "y", 9), (4, "E", "z", 9)]
        assert rows(new_or_changed(staging, history.limit(0), **options)) == rows(staging)


def test_against_needs_a_key(make):
    nothing = make([], SCHEMA)
    for options in ({"against": "latest"}, {"against": "latest", "key": "k", "compare": ["a"]}, {"against": "newest"}):
        with pytest.raises(ValueError):
            new_or_changed(nothing, nothing, **options)
