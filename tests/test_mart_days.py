"""what no day of a small dimension covers is left out before shuffles; the rows of the mart stay the same."""

import pytest

from tidemark.plans.mart import sales_mart
from workload.inputs import Tables
from workload.queries import FLOOR, dimensions, fact_sales


@pytest.fixture
def large(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


def test_lines_of_days_that_a_small_dimension_lacks_are_left_out_first(spark, folder, large):
    """Resellers have no range before the floor: older lines and versions were shuffled before they dropped out."""
    t = Tables(spark, folder)
    text = sales_mart(fact_sales(t), **dimensions(t, FLOOR, dealt=True))._jdf.queryExecution().optimizedPlan().toString()
    limited = [line for line in text.splitlines() if "Filter" in line and ">= greatest(scalar-subquery" in line]
    assert any("_rank#" in line for line in limited)
    assert sum("_next#" in line for line in limited) >= 2


def test_mart_of_dimensions_without_a_common_day_is_empty(spark, folder):
    t = Tables(spark, folder)
    dims = dimensions(t, FLOOR)
    none = dims["reseller"].where("resellerkey is null")
    assert sales_mart(fact_sales(t), **dims | {"reseller": none}).isEmpty()
