import datetime as dt

from tidemark.operators.checks import duplicate_keys, key_report, null_keys, unmatched_facts

OPEN = (dt.date(2000, 1, 1), dt.date(3000, 1, 1))


def test_duplicates_and_nulls(make):
    df = make([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k bigint, v string")
    assert sorted(tuple(r) for r in duplicate_keys(df, ["k", "v"]).where("k is not null").collect()) == [(1, "a", 2)]
    assert null_keys(df, ["k", "v"]).count() == 2
    assert tuple(key_report(df, ["k", "v"]).first()) == (5, 1, 2)
    assert tuple(key_report(df.limit(0), ["k"]).first()) == (0, 0, 0)


def test_unmatched_facts_counts_every_dimension_in_one_pass(make):
    d = dt.date(2020, 1, 1)
    fact = make([(1, 1, d), (2, 9, d), (3, 1, dt.date(1999, 1, 1)), (4, None, None)],
                "salesorderlinekey bigint, customerkey bigint, orderdatekey date")
    customer = make([(1, *OPEN)], "customerkey bigint, valid_from date, valid_to date")
    calendar = make([(dt.datetime(2020, 1, 1),), (dt.datetime(2020, 1, 1),)], "date timestamp_ntz")
    orders = make([(1,), (2,)], "salesorderlinekey bigint")
    result = unmatched_facts(fact, {"customer": (customer, "customerkey")}, calendar, orders)
    assert {r.dimension: r.n_unmatched for r in result.collect()} == {"calendar": 2, "orders": 2, "customer": 3}
