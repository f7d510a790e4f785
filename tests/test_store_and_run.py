import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import sales_fact
from tidemark.operators.upsert import upsert
from tidemark.plans.refresh import live_mart, refresh_changed, refresh_dim, refresh_fact, register_views
from tidemark.plans.run import run
from tidemark.plans.upload import upload_src
from tidemark.schemas import (
    BY_TARGET, CUSTOMER, MART_TABLE, SALES, SALES_ORDER, SHEET_ORDER, TERRITORY, UPLOAD_ORDER,
)
from tidemark.sources.audit import AuditLog
from tidemark.sources.sheets import stamp
from tidemark.sources.store import KeyCheckFailed, Store
from workload import inputs as i
from workload.inputs import Tables

FIRST, SECOND = dt.datetime(2025, 1, 1, 8), dt.datetime(2025, 2, 1, 8)


@pytest.fixture
def store(spark):
    return Store(spark, f"test_{uuid.uuid4().hex}").create()


@pytest.fixture(scope="module")
def sheets(spark, folder):
    """The derived sheets, written once as files."""
    from tidemark.session import shared_dir

    base = f"{shared_dir(spark)}/sheets_{uuid.uuid4().hex}"
    paths = {}
    for name, df in i.sheets(Tables(spark, folder)).items():
        paths[name] = (f"{base}/{name.replace(' ', '_')}", "parquet")
        df.write.parquet(paths[name][0])
    return paths


def territories(make, *rows):
    return make(list(rows), "salesterritorykey bigint, region string, country string, `group` string")


def steps(store):
    return store.table("etl_log").orderBy("order_id").collect()


def test_tables_and_types(store):
    for entity in UPLOAD_ORDER:
        assert store.table(entity.history_table).schema == entity.history_schema
        assert store.table(entity.target).columns == entity.target_schema.names
    assert store.table("dim_sales_territory_data").columns[3] == "group_region"
    assert dict(store.table("fct_sales_data").dtypes)["orderdatekey"] == "date"
    assert store.create().table(CUSTOMER.target).count() == 0


def test_publish_keeps_the_old_content_if_a_check_fails(store, make):
    def dim(*rows):
        df = make([(k, dt.datetime(2025, 1, 1)) for k in rows], "customerkey bigint, update_ts timestamp_ntz")
        return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
                           for c, t in store.table(CUSTOMER.target).dtypes))

    key = CUSTOMER.target_key
    assert store.publish(CUSTOMER.target, dim(1, 2), key) == 2
    for bad in ((1, 1), (1, None)):
        with pytest.raises(KeyCheckFailed):
            store.publish(CUSTOMER.target, dim(*bad), key)
    assert sorted(r.customerkey for r in store.table(CUSTOMER.target).collect()) == [1, 2]
    for n in range(3, 6):
        reader = store.table(CUSTOMER.target)
        assert store.publish(CUSTOMER.target, dim(*range(n)), key) == n
        assert reader.count() == n - 1 or n == 3  # a reader that began before still finds its rows
    assert len(store._notes(CUSTOMER.target)) == 2


def test_history_refuses_a_batch_with_bad_keys_and_stays_as_it_was(store, make):
    good = stamp(territories(make, (1, "a", "b", "c")), FIRST)
    assert store.append_history(TERRITORY, good) == 1
    for rows in (((2, "a", "b", "c"), (2, "x", "b", "c")), ((None, "a", "b", "c"),), ((1, "z", "b", "c"),)):
        with pytest.raises(KeyCheckFailed):
            store.append_history(TERRITORY, stamp(territories(make, *rows), FIRST))
    folder = f"{store.folder}/{TERRITORY.history_table}_loads"
    written = store.spark.read.option("recursiveFileLookup", True).parquet(folder)
    assert written.count() == 1  # refused batches take no space
    assert store.append_history(TERRITORY, stamp(territories(make, (1, "z", "b", "c")), SECOND)) == 1
    assert store.append_history(TERRITORY, good.limit(0)) == 0
    assert store.table(TERRITORY.history_table).count() == 2


def test_full_run_leaves_41_records_and_a_quiet_one_21(store, sheets):
    result = run(store, sheets, FIRST)
    assert (result.status, result.mart_status) == ("OK", "OK")
    assert set(result.refreshed) == set(BY_TARGET) and set(result.refreshed.values()) == {"OK"}
    records = steps(store)
    assert len(records) == 41
    assert [r.order_id for r in records] == list(range(1, 42))
    assert sum(r.status == "STARTED" for r in records) == 8
    assert all(r.status != "ERROR" and len(r.msg) <= 250 and r.duration_sec >= 0 for r in records)
    assert records[-1].rows == result.rows_loaded
    assert store.table(MART_TABLE).count() == live_mart(store).count() > 0

    # Only rows with a NULL among the compared columns are captured again; threshold above their number.
    again = run(store, sheets, SECOND, min_changed=10**6)
    captured = {t: n for t, n in again.counts.items() if n}
    assert set(captured) <= {CUSTOMER.target}
    assert again.refreshed == {} and len(steps(store)) == 41 + 21

    store.spark.catalog.dropTempView("v_sales_datamart")
    register_views(store)
    assert store.spark.table("v_sales_datamart").count() == store.table(MART_TABLE).count()
    assert store.spark.table("v_customer_cohors").columns == ["customerkey", "cohor_y_q"]


def test_sheet_that_cannot_be_staged_leaves_11_records(store, sheets, make):
    broken = sheets | {"Product_data": make([], "`a b` int, `a-b` int")}
    result = run(store, broken, FIRST)
    assert (result.status, result.mart_status, result.counts) == ("ERROR", "OK", {})
    records = steps(store)
    assert len(records) == 11
    failed = [r for r in records if r.status == "ERROR"]
    assert [r.procedure_name for r in failed] == [
        "load src_product_data_temp", "initial_temp_load_all_sheets", "initial_full_load_pipeline"
    ]


def test_missing_sheet_ends_the_run_but_its_records_are_kept(store, sheets):
    missing = {k: v for k, v in sheets.items() if k != "Date_data"}
    with pytest.raises(KeyError):
        run(store, missing, FIRST)
    assert len(steps(store)) == 4


def test_failing_phase_is_isolated_counts_0_and_is_not_refreshed(store, sheets, make):
    doubled = territories(make, (1, "a", "b", "c"), (1, "x", "b", "c"))
    result = run(store, sheets | {"Sales Territory_data": doubled}, FIRST)
    assert result.status == "ERROR" and result.counts[TERRITORY.target] == 0
    assert TERRITORY.target not in result.refreshed and result.refreshed[CUSTOMER.target] == "OK"
    assert store.table(TERRITORY.history_table).count() == 0
    assert store.table(MART_TABLE).count() == 0
    failed = [r for r in steps(store) if r.status == "ERROR"]
    assert failed[0].msg.startswith("upload failed: ") and failed[0].rows == 0


def test_failing_refresh_leaves_the_dimension(store, make):
    audit = AuditLog(store)
    as_of = dt.date(2025, 1, 1)
    store.append_history(TERRITORY, stamp(territories(make, (1, "a", "b", "c")), FIRST))
    assert refresh_dim(store, audit, TERRITORY.target, as_of) == "OK"
    # A second row of the same key and stamp, brought in past the checks.
    path = f"{store.folder}/{TERRITORY.history_table}_loads/x"
    stamp(territories(make, (1, "z", "b", "c")), FIRST).write.parquet(path)
    loads = f"{store.database}.{TERRITORY.history_table}_loads"
    store.spark.sql(f"ALTER TABLE {loads} ADD PARTITION (load_no = 2) LOCATION '{path}'")
    store._note(f"{TERRITORY.history_table}_loads", 2, {"folder": path})
    assert refresh_dim(store, audit, TERRITORY.target, as_of) == "ERROR"
    assert store.table(TERRITORY.target).first().region == "a"
    assert [r[6] for r in audit.records] == ["STARTED", "OK", "OK", "STARTED", "ERROR", "ERROR"]


def test_unsupported_names_are_recorded(store):
    audit = AuditLog(store)
    for name in ("dim_nothing", None, "fct_sales_data"):
        assert refresh_dim(store, audit, name, dt.date(2025, 1, 1)) == "ERROR"
    assert audit.flush() == 9 and audit.flush() == 0
    texts = [r.msg for r in steps(store) if r.status == "ERROR"]
    assert texts[0] == "unsupported table name: dim_nothing" and texts[2] == "unsupported table name: <NULL>"


def test_one_changed_row_is_below_the_threshold(store):
    counts = {"dim_date_data": 0, "fct_sales_data": 1, "dim_product_data": 2}
    assert set(refresh_changed(store, AuditLog(store), counts, FIRST.date())) == {"dim_product_data"}


def test_bad_date_key_fails_the_fact_only(store, sheets, spark, make):
    sales = spark.read.parquet(sheets["Sales_data"][0]).withColumn("duedatekey", F.lit(20201341).cast("long"))
    result = run(store, sheets | {"Sales_data": sales}, FIRST)
    assert result.refreshed["fct_sales_data"] == "ERROR"
    assert store.table("fct_sales_data").count() == 0 and result.refreshed["dim_sales_order_data"] == "OK"


def test_long_messages_are_cut(store):
    audit = AuditLog(store)
    audit.add("step", audit.now(), "ERROR", "x" * 1000)
    audit.flush()
    assert len(steps(store)[0].msg) == 250


def test_upload_counts_staged_rows_itself(store, sheets, spark):
    for entity in SHEET_ORDER:
        store.stage(entity.staging_table, stamp(spark.read.parquet(sheets[entity.sheet][0]), FIRST))
    with AuditLog(store) as audit:
        upload = upload_src(store, audit)
    assert upload.status == "OK" and len(steps(store)) == 9
    assert json.loads(upload.to_json()) == upload.counts
    assert upload.counts["fct_sales_data"] == store.table("src_sales_data").count()
    assert sales_fact(store.table("src_sales_data")).count() == upload.counts["fct_sales_data"]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_refreshing_load_by_load_equals_a_rebuild(store, make):
    """Loads out of order, some pending for several refreshes, keys that return."""
    audit = AuditLog(store)
    rng = random.Random(5)
    columns = "salesorderlinekey bigint, channel string, sales_order string, sales_order_line string"
    sales_columns = [c for c in SALES.attributes if c != SALES.key]
    for number, days in enumerate((40, 10, 70, 71, 20, 300)):
        ts = FIRST + dt.timedelta(days=days)
        keys = rng.sample(range(30), 12)
        store.append_history(TERRITORY, stamp(territories(make, *((k, f"r{number}", "c", "g") for k in keys)), ts))
        labels = [(k * 1000 + 1, f"c{number}", f"SO{k + rng.randrange(2)}", f"SO{k}") for k in keys]
        store.append_history(SALES_ORDER, stamp(make(labels, columns), ts))
        sales = make([(k,) for k in keys], "salesorderlinekey bigint").select(
            "salesorderlinekey",
            *(F.lit(20250101 + number).cast("long").alias(c) if c.endswith("datekey")
              else F.lit(number).cast(SALES.schema[c].dataType).alias(c) for c in sales_columns),
        )
        store.append_history(SALES, stamp(sales, ts))
        if number in (0, 2, 3, 5):
            as_of = ts.date()
            for full in (False, True):
                assert refresh_dim(store, audit, TERRITORY.target, as_of, full) == "OK"
                assert refresh_dim(store, audit, SALES_ORDER.target, as_of, full) == "OK"
                assert refresh_fact(store, audit, full) == "OK"
                now = [content(store.table(e.target)) for e in (TERRITORY, SALES_ORDER, SALES)]
                counts = [r[5] for r in audit.records if r[5] is not None][-3:]
                if not full:
                    incremental = now, counts
            assert incremental == (now, counts)
            assert counts == [len(rows) for rows in now]
            assert store.included(SALES.target) == number + 1


def test_new_loads_are_merged_without_a_shuffle_of_the_fact(store, make, spark):
    audit = AuditLog(store)
    sales = make([(k,) for k in range(100)], "salesorderlinekey bigint").select(
        "salesorderlinekey",
        *(F.lit(20250101 if c.endswith("datekey") else 1).cast(SALES.schema[c].dataType).alias(c)
          for c in SALES.attributes if c != SALES.key),
    )
    store.append_history(SALES, stamp(sales, FIRST))
    assert refresh_fact(store, audit) == "OK"
    store.append_history(SALES, stamp(sales.limit(10).withColumn("unit_price", F.lit(2.0)), SECOND))
    new = sales_fact(store.loads(SALES, store.last_load(SALES), after=store.included(SALES.target)))
    merged = upsert(store.table(SALES.target), new, SALES.key, newer="update_ts")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("PartitionFilters: [isnotnull(load_no") == 1
    assert refresh_fact(store, audit) == "OK"
    assert store.table(SALES.target).where("unit_price = 2").count() == 10
    assert store.table(SALES.target).count() == 100
