import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.names import history_name, normalized, normalize_name, staging_name
from tidemark.schemas import DATE, PRODUCT, SALES
from tidemark.sources.sheets import conform, normalize_columns, read_sheet, stamp


def test_names(make):
    cases = {"Sales Order_data": "sales_order_data", "State-Province": "state_province", "  Unit Price (%) ": "unit_price"}
    for name, expected in cases.items():
        assert normalize_name(name) == expected
        assert make([(name,)], "n string").select(normalized(F.col("n"))).first()[0] == expected
    assert history_name("Sales Order_data") == "src_sales_order_data"
    assert staging_name("Sales Order_data") == "src_sales_order_data_temp"


def test_colliding_or_empty_names_are_refused(make):
    for columns in ("`A b` int, `a-B` int", "a int, `%%` int"):
        with pytest.raises(ValueError, match="normalizing"):
            normalize_columns(make([], columns))


def test_csv_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "ProductKey,SKU,Product,Standard Cost,Color,List Price,Model,Subcategory,Category\n"
        "210,FR-1,Frame,868.6342,NA,1431.5,HL,Road,Parts\n"
        "211.0,,Frame,,Red,1431.5,HL,Road,Parts\n"
    )
    sheet = read_sheet(spark, str(tmp_path / "s.csv"))
    staged = stamp(normalize_columns(sheet).withColumnRenamed("standardcost", "standard_cost"), dt.datetime(2025, 1, 1))
    rows = conform(staged, PRODUCT.history_schema).orderBy("productkey").collect()
    assert [f.dataType for f in conform(staged, PRODUCT.history_schema).schema] == [
        f.dataType for f in PRODUCT.history_schema
    ]
    assert (rows[0].productkey, rows[0].color, rows[0].list_price) == (210, None, 1431.5)
    assert (rows[1].productkey, rows[1].sku, rows[1].standard_cost) == (211, None, None)
    assert rows[0].update_ts == dt.datetime(2025, 1, 1)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_formats(spark, make, tmp_path, fmt):
    path = str(tmp_path / "x")
    make([(1, "a", 2.0), (2, "null", float("nan"))], "k bigint, s string, x double").write.format(fmt).save(path)
    df = read_sheet(spark, path, fmt, schema="k bigint, s string, x double").orderBy("k")
    assert [r.s for r in df.collect()] == ["a", None if fmt == "json" else "null"]


def test_nan_becomes_null_and_fractions_are_refused(make):
    columns = ("datekey double, date string, fiscal_year string, fiscal_quarter string, month string, "
               "full_date string, monthkey double")
    good = make([(20200131.0, "2020-01-31 00:00:00", "a", "b", "c", "d", float("nan"))], columns)
    row = conform(good, DATE.schema).first()
    assert (row.datekey, row.date, row.monthkey) == (20200131, dt.datetime(2020, 1, 31), None)
    bad = make([(1.6, "2020-01-31 00:00:00", "a", "b", "c", "d", 1.0)], columns)
    with pytest.raises(PySparkException, match="whole number"):
        conform(bad, DATE.schema).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("column, value", [("datekey", "x1"), ("datekey", "1.5"), ("date", "some day"), ("monthkey", "-")])
def test_values_that_do_not_fit_fail_in_any_session(make, spark, ansi, column, value):
    good = {"datekey": "20200131.0", "date": "2020-01-31", "monthkey": "202001"}
    texts = {f.name: "t" for f in DATE.schema} | good
    columns = ", ".join(f"{c} string" for c in texts)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = conform(make([tuple(texts.values())], columns), DATE.schema).first()
        assert (row.datekey, row.date, row.monthkey) == (20200131, dt.datetime(2020, 1, 31), 202001)
        with pytest.raises(PySparkException):
            conform(make([tuple((texts | {column: value}).values())], columns), DATE.schema).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_missing_column_is_an_error(make):
    with pytest.raises(KeyError):
        conform(make([], "salesorderlinekey bigint"), SALES.schema)
