"""Inputs and the mart shuffle each thing once, and no wider than it must be; the rows stay the same."""

import datetime as dt
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import newest_per_key
from tidemark.operators.scd2 import scd2_ranges
from workload import inputs as i
from workload.inputs import Tables
from workload.queries import QUERIES, products

DAY = dt.datetime(1999, 1, 1)


@pytest.fixture
def large(spark):
    """As if nothing were small enough to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def same(new, old):
    return sorted(map(tuple, new.collect()), key=str) == sorted(map(tuple, old.select(*new.columns).collect()), key=str)


@pytest.fixture
def odd(make):
    """Versions of lines, parts and customers with equal stamps, missing values and repeated orders."""
    def at(n):
        return None if n is None else DAY + dt.timedelta(hours=n)

    lines = [
        # order, part, supplier, line, quantity, price, discount, tax, shipped after hours
        (1, 1, 1, 1, 2.0, 10.0, 0.1, 0.2, 5), (1, 1, 2, 1, 2.0, 10.0, 0.1, 0.2, 5), (1, 1, 2, 1, 2.5, 10.0, 0.1, 0.2, 5),
        (1, 2, 1, 2, 3.0, 9.0, 0.0, 0.0, None), (1, 2, None, 2, 3.0, 9.0, 0.0, 0.0, 30), (1, 2, 2, 2, 3.0, 9.0, 0.0, 0.0, 29),
        (2, 2, 2, 1, 4.0, 8.0, None, 0.3, 80), (2, 2, 2, 1, 4.0, 8.0, 0.5, -0.3, 80), (2, 2, 2, 1, 4.5, 9.0, 0.5, -0.3, 80),
        (2, 3, 1, 1000, 1.0, 7.0, 0.2, None, 7), (3, 3, 2, 0, 1.0, 7.0, 0.2, None, 7), (3, None, 2, 1, 1.0, 7.0, 0.2, 0.1, 7),
        (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, 1), (9, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, 900), (4, 4, 1, 1, 1.0, 1.0, 0.0, 0.0, None),
    ]
    orders = [(1, 1, 0, "1-URGENT"), (1, 2, 9, "5-LOW"), (2, 1, 30, "5-LOW"), (2, 1, 31, "5-LOW"), (3, 2, None, None),
              (4, None, 4, "1-URGENT"), (5, 2, 9, "2-HIGH"), (5, 2, 9, "3-MEDIUM"), (6, 3, None, "1-URGENT")]
    return SimpleNamespace(
        lineitem=make(
            [(*row[:8], "F", at(row[8])) for row in lines],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp_ntz"),
        orders=make([(o, c, at(n), p) for o, c, n, p in orders],
                    "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"),
        supplier=make([(1, 0), (2, 1)], "s_suppkey bigint, s_nationkey int"),
        part=make([(k, f"p{k}", "B", "PROMO", 1, 2.0) for k in (1, 1, 2, 3, 4, 5)],
                  "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        customer=make([(k, f"c{k}", 0, 1.0, "AUTO") for k in (1, 2, 2, 3)],
                      "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        nation=make([(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        region=make([(0, "ASIA")], "r_regionkey int, r_name string"),
    )


def test_newest_parts_and_customers_are_those_of_all_versions(odd):
    parts = newest_per_key(i.described_parts(odd, i.newest_parts(odd)), "productkey")
    assert same(parts, newest_per_key(i.product_history(odd), "productkey"))
    customers = newest_per_key(i.described_customers(odd, i.newest_priorities(odd)), "customerkey").drop(i.TS)
    assert same(customers, newest_per_key(i.customer_history(odd), "customerkey").drop(i.TS))


def test_sheets_reduce_versions_to_the_newest_before_the_shuffle(spark, folder, large):
    sheets = i.sheets(Tables(spark, folder))
    for sheet, column in (("Product_data", "l_shipdate"), ("Customer_data", "o_orderdate")):
        text = plan(sheets[sheet])
        assert f"partial_max(struct({column}" in text and f", {column}, 8)" not in text


def test_newest_lines_are_those_of_the_whole_history(odd):
    lines = i.sales_columns(newest_per_key(i.sales_lines(odd), "salesorderlinekey", tie_break=i.LINE_TIE_BREAK))
    assert same(lines, newest_per_key(i.sales_history(odd), "salesorderlinekey", tie_break=i.SALES_TIE_BREAK))


def test_capture_of_sales_finds_the_newest_lines_once(spark, folder, large):
    df = QUERIES["captured_sales_data"](spark, folder)
    df.collect()
    text = plan(df)
    written = [line for line in text[:text.index("Initial Plan")].splitlines() if "ReusedExchange" not in line]
    for key in ("salesorderlinekey", "l_orderkey"):
        assert sum(f"Exchange hashpartitioning({key}, 8)" in line for line in written) == 1


def test_versions_of_parts_are_dealt_by_part_once(spark, folder, large):
    """For the versions and for their days: the lines, the parts and the join of the two, and nothing else."""
    text = plan(scd2_ranges(i.product_history(Tables(spark, folder)), "productkey"))
    assert len(re.findall(r"Exchange hashpartitioning\((\w+), \d+\)", text)) == 4
    assert text.count("Exchange hashpartitioning") == 6


def test_wide_dimensions_come_last_and_places_are_combined_before(spark, folder, large):
    text = plan(QUERIES["sales_mart"](spark, folder))
    order = [text.index(f"Exchange hashpartitioning({key}, _slot") for key in ("productkey", "resellerkey", "customerkey")]
    assert order == sorted(order)
    above = text[:order[0]]
    assert "city_combined" in above and "_customer_city" not in above and "_reseller_city" not in above


def test_newest_lines_are_found_where_lines_meet_their_orders(spark, folder, large, odd):
    """staged sales were shuffled once more, by line key."""
    assert "salesorderlinekey, 8" not in plan(i.newest_lines(Tables(spark, folder)))
    old = newest_per_key(i.sales_lines(odd), "salesorderlinekey", tie_break=i.LINE_TIE_BREAK)
    assert same(i.newest_lines(odd), old)  # line 1000 of order 2 is line 0 of order 3
    odd.lineitem = odd.lineitem.where("l_linenumber < 1000")
    old = newest_per_key(i.sales_lines(odd), "salesorderlinekey", tie_break=i.LINE_TIE_BREAK)
    assert old.count() == 6 and same(i.newest_lines(odd), old)
    odd.lineitem = odd.lineitem.withColumn("l_linenumber", F.when(F.col("l_linenumber") > 0, F.col("l_linenumber")))
    old = newest_per_key(i.sales_lines(odd), "salesorderlinekey", tie_break=i.LINE_TIE_BREAK)
    assert same(i.newest_lines(odd), old)


def test_ranges_of_products_are_found_on_narrow_rows(spark, folder, large, odd):
    """described versions were shuffled by product and day."""
    text = plan(products(Tables(spark, folder), "1900-01-01"))
    by_day = re.search(r"Exchange hashpartitioning\(productkey, _day.*?FileScan", text, re.S)
    assert by_day and "p_name" not in by_day[0]
    old = scd2_ranges(i.product_history(odd), "productkey", floor="1900-01-01")
    assert same(products(odd, "1900-01-01"), old) and old.count() > 5
