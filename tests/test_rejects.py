import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans.run import run
from tidemark.schemas import AUDIT_TABLE, TERRITORY, struct
from tidemark.sources.rejects import REJECTED_COLUMNS, read_checked
from tidemark.sources.store import Store
from workload import inputs as i
from workload.inputs import Tables

SCHEMA = struct("product_key bigint, name string, list_price double, sold date")
HEADER = "Product Key,Name,List-Price,Sold,Note"


def found(sheet):
    rows = sheet.rejected.collect()
    return sorted((r.source_file.rsplit("/", 1)[-1], r.source_line, r.record, r.problem) for r in rows)


def test_bad_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        f"{HEADER}\n1,one,1.5,2020-01-31,x\n2,two\n\n3,\"th,r\"\"ee\",NA,,\n4.0,four,2,2020-02-30,y\n"
        "x5,five,cheap,2020-01-01,z\n6,six,1,2020-01-01,n,more\n7.5,seven,1,NULL,\n"
        "99999999999999999999,large,1,,\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n8,eight,8,2020-01-01,NA\nNA,,,,\n")
    sheet = read_checked(spark, str(tmp_path), SCHEMA)
    assert sheet.accepted.columns == HEADER.split(",")
    assert sorted(map(tuple, sheet.accepted.collect()), key=str) == [
        ("1", "one", "1.5", "2020-01-31", "x"), ("3", 'th,r"ee', None, None, None),
        ("8", "eight", "8", "2020-01-01", None), (None, None, None, None, None)]
    assert tuple(sheet.rejected.columns) == REJECTED_COLUMNS
    assert found(sheet) == [
        ("a.csv", 3, "2,two", "not 5 cells"),
        ("a.csv", 6, "4.0,four,2,2020-02-30,y", "Sold is not a date"),
        ("a.csv", 7, "x5,five,cheap,2020-01-01,z", "Product Key is not a whole number; List-Price is not a double"),
        ("a.csv", 8, "6,six,1,2020-01-01,n,more", "not 5 cells"),
        ("a.csv", 9, "7.5,seven,1,NULL,", "Product Key is not a whole number"),
        ("a.csv", 10, "99999999999999999999,large,1,,", "Product Key is not a whole number"),
    ]


def test_lines_are_right_in_files_that_are_split(spark, tmp_path):
    bad = {2, 3, 700, 1999, 4001}
    for name, n in (("a", 2000), ("b", 5000), ("c", 1)):
        lines = [HEADER] + [f"{'?' if k in bad else k},{'w' * (k % 40)},1,2020-01-01,{name}" for k in range(2, n + 1)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        sheet = read_checked(spark, str(tmp_path), SCHEMA)
        assert sheet.accepted.rdd.getNumPartitions() > 8
        rows = found(sheet)
        assert sheet.accepted.count() == 1999 + 4999 - len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[:2] for r in rows] == [(f"{name}.csv", k) for name, n in (("a", 2000), ("b", 5000)) for k in sorted(bad) if k <= n]


def test_nothing_but_a_header_and_nothing_at_all(spark, tmp_path):
    (tmp_path / "h.csv").write_text(HEADER + "\n")
    sheet = read_checked(spark, str(tmp_path / "h.csv"), SCHEMA)
    assert sheet.accepted.count() == sheet.rejected.count() == 0
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_checked(spark, str(tmp_path / "e.csv"), SCHEMA)


def test_without_typed_columns_only_cells_are_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\n1\n")
    sheet = read_checked(spark, str(tmp_path / "t.csv"), SCHEMA, sep=";")
    assert sheet.accepted.collect() == [("1", "2")]
    assert found(sheet) == [("t.csv", 3, "1", "not 2 cells")]


def test_a_run_sets_bad_rows_aside_and_counts_them(spark, folder):
    store = Store(spark, f"rejects_{uuid.uuid4().hex}").create()
    sheets = dict(i.sheets(Tables(spark, folder)))
    path = f"{store.folder}/territories.csv"
    good = sheets[TERRITORY.sheet]
    n = good.count()
    lines = good.select(F.concat_ws(",", *good.columns).alias("line")).collect()
    bad = ["one,two", "x,North,Europe,EU"]
    header = ",".join(good.columns)
    spark.createDataFrame([(header,), *lines, *((b,) for b in bad)], "line string").coalesce(1).write.text(path)
    sheets[TERRITORY.sheet] = (path, "csv")

    result = run(store, sheets, dt.datetime(2025, 1, 1), rejects=True)
    assert result.status == "OK" and result.counts[TERRITORY.target] == n
    aside = store.table(f"{TERRITORY.staging_table}_rejected").orderBy("source_line").collect()
    assert [(r.record, r.source_line) for r in aside] == [(b, n + 2 + k) for k, b in enumerate(bad)]
    audit = store.table(AUDIT_TABLE).where(F.col("procedure_name") == f"reject rows of {TERRITORY.staging_table}")
    assert [r.rows for r in audit.collect()] == [2]

    strict = Store(spark, f"rejects_{uuid.uuid4().hex}").create()
    assert run(strict, sheets, dt.datetime(2025, 1, 1)).status == "ERROR"
