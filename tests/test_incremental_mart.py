"""Fact, labels and mart brought up to date part by part equal a rebuild, and leave other parts' files alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.parts import MOST_PARTS, PART, KeyRanges
from tidemark.plans.refresh import live_mart, refresh_dim, refresh_fact, refresh_mart
from tidemark.schemas import (
    CUSTOMER, DATE, MART_TABLE, PRODUCT, RESELLER, SALES, SALES_ORDER, TERRITORY, UPLOAD_ORDER,
)
from tidemark.sources.audit import AuditLog
from tidemark.sources.sheets import stamp
from tidemark.sources.store import KeyCheckFailed, Store

ORDERS = 400
LINES = [n * 1000 + 1 for n in range(ORDERS)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """One warehouse, which the tests load one after the other."""
    folder = tmp_path_factory.mktemp("parts")
    made = Store(spark, f"parts_{folder.name}", str(folder), buckets=2, rows_per_file=4).create()
    first = dt.date(2020, 1, 1)
    for entity, keys in ((SALES, LINES), (SALES_ORDER, LINES), (DATE, days(0, ORDERS - 20)), (CUSTOMER, range(6)),
                         (PRODUCT, range(7)), (RESELLER, range(7)), (TERRITORY, range(7))):
        load(made, entity, keys, first, 1)
    refresh(made, UPLOAD_ORDER)
    return made


def rows_of(entity, spark, keys, day, salt):
    """Plain rows of an entity: key first, other columns from the salt; sales are ordered on a day of their own."""
    def cell(name, kind, key):
        if name == entity.key:
            return key
        if name.endswith("datekey"):
            return int((dt.date(2020, 1, 1) + dt.timedelta(days=key // 1000)).strftime("%Y%m%d"))
        if name in (CUSTOMER.key, PRODUCT.key, RESELLER.key, TERRITORY.key):
            return key // 1000 % 7
        if name in ("sales_order", "sales_order_line"):
            return f"SO{key // 1000}"
        if name == "date":
            return dt.datetime.strptime(str(key), "%Y%m%d")
        return {"bigint": salt, "double": float(salt), "string": f"{name}{salt}"}[kind]

    kinds = {f.name: f.dataType.simpleString() for f in entity.schema}
    data = [tuple(cell(n, k, key) for n, k in kinds.items()) for key in keys]
    return stamp(spark.createDataFrame(data, entity.schema), dt.datetime.combine(day, dt.time(8)))


def load(store, entity, keys, day, salt):
    return store.append_history(entity, rows_of(entity, store.spark, keys, day, salt))


def days(first, last):
    return [int((dt.date(2020, 1, 1) + dt.timedelta(days=n)).strftime("%Y%m%d")) for n in range(first, last)]


def refresh(store, entities):
    audit = AuditLog(store)
    for entity in entities:
        if entity is SALES:
            assert refresh_fact(store, audit) == "OK"
        else:
            assert refresh_dim(store, audit, entity.target, dt.date(2020, 6, 1)) == "OK"
    refresh_mart(store, audit)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(store, name):
    return set(store.table(store._current(name)[1]["snapshot"]).inputFiles())


def as_rebuilt(store):
    stored = content(store.table(MART_TABLE))
    assert stored == content(live_mart(store)) != []
    return stored


def test_a_load_of_one_in_a_hundred_leaves_other_files_alone(store):
    names = (SALES.target, SALES_ORDER.target, MART_TABLE)
    before = {n: files(store, n) for n in names}
    assert len(before[MART_TABLE]) >= 40
    load(store, SALES, LINES[-29:-25], dt.date(2020, 2, 1), 2)
    load(store, SALES_ORDER, LINES[-29:-25], dt.date(2020, 2, 1), 2)
    refresh(store, [SALES, SALES_ORDER])
    for n in names:
        after = files(store, n)
        assert 0 < len(after - before[n]) <= 0.05 * len(before[n]), n
        assert len(before[n] & after) >= 0.95 * len(before[n]), n
    assert sum(r.unit_price == 2.0 for r in store.table(MART_TABLE).collect()) == 4
    as_rebuilt(store)


def test_changed_versions_touch_the_lines_of_their_days(store):
    assert store.table(MART_TABLE).where("customerkey = 6").count() == 0
    before = files(store, MART_TABLE)
    load(store, CUSTOMER, [3], dt.date(2020, 12, 1), 2)  # an old customer, from a late day on
    refresh(store, [CUSTOMER])
    changed = {r[0] for r in store.table(MART_TABLE).where("city_combined = 'city2'").select("orderdatekey").collect()}
    assert changed and min(changed) >= dt.date(2020, 12, 1)
    assert len(files(store, MART_TABLE) - before) < 0.3 * len(before)
    as_rebuilt(store)
    load(store, CUSTOMER, [3], dt.date(2020, 11, 1), 3)  # an earlier stamp than the last
    load(store, CUSTOMER, [6], dt.date(2020, 11, 2), 3)  # a new key, whose lines were lost before
    load(store, DATE, days(ORDERS - 20, ORDERS - 10), dt.date(2020, 11, 2), 3)  # new days bring their lines
    count = store.table(MART_TABLE).count()
    refresh(store, [CUSTOMER, DATE])
    assert store.table(MART_TABLE).where("customerkey = 6").count() > 50
    assert store.table(MART_TABLE).where("customerkey <> 6").count() > count
    as_rebuilt(store)


def test_many_loads_equal_a_rebuild(store):
    rng = random.Random(2)
    for n in range(4, 8):
        day = dt.date(2020, rng.randint(1, 12), 3 + n)
        for entity in rng.sample([SALES, SALES_ORDER, CUSTOMER, PRODUCT, RESELLER, TERRITORY], 2):
            wide = entity in (SALES, SALES_ORDER)
            keys = rng.sample(LINES, 9) + [(ORDERS + 10 * n) * 1000 + 1] if wide else rng.sample(range(9), 2)
            load(store, entity, keys, day, n)
    refresh(store, UPLOAD_ORDER)
    now = as_rebuilt(store)
    before = files(store, MART_TABLE)
    refresh(store, [])  # nothing new
    assert files(store, MART_TABLE) == before
    refresh_mart(store, AuditLog(store), full=True)
    assert not files(store, MART_TABLE) & before and content(store.table(MART_TABLE)) == now


def test_parts_share_files_until_no_version_needs_them(store):
    for n in range(10, 13):
        reader = store.table(SALES.target)
        rows = reader.count()
        load(store, SALES, LINES[:3], dt.date(2020, 12, n), n)
        refresh_fact(store, AuditLog(store))
        assert reader.count() == rows  # a reader that began before still finds its rows
    kept = {f for note in store._notes(SALES.target).values() for f in store._folders(note)}
    path, fs = store._path(store.folder)
    roots = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{SALES.target}__")]
    found = {f"{store.folder}/{r.getName()}/{p.getPath().getName()}" for r in roots for p in fs.listStatus(r)
             if p.getPath().getName().startswith(PART)}
    assert found == kept
    assert len(store._notes(SALES.target)) == 2
    refresh_mart(store, AuditLog(store))
    as_rebuilt(store)


def test_bad_keys_and_foreign_parts_are_refused(store):
    ranges = store.ranges(SALES.target)
    fact = store.table(SALES.target)
    some = store.parts_of(SALES.target, [3])
    assert 0 < some.count() < fact.count()
    for df, only, error in ((some.unionByName(some), [3], KeyCheckFailed), (some, [4], ValueError),
                            (some.withColumn(SALES.key, F.lit(None).cast("long")), [3], KeyCheckFailed)):
        with pytest.raises(error):
            store.publish(SALES.target, df, [SALES.key], bucket_by=SALES.key, ranges=ranges, only=only)
    with pytest.raises(ValueError):
        store.publish(SALES.target, some, [SALES.key], ranges=KeyRanges(SALES.key, 0, 1), only=[3])
    assert content(store.table(SALES.target)) == content(fact)


def test_fact_parts_join_their_labels_without_a_shuffle(store, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = store.table(SALES.target).join(store.table(SALES_ORDER.target), SALES.key)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        pruned = store.parts_of(SALES.target, [1, 2])._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [{PART}" in pruned
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_another_session_of_the_folder_sees_all_parts(store):
    expected = content(store.table(MART_TABLE))
    for name in {t.tableName for t in store.spark.sql(f"SHOW TABLES IN {store.database}").collect()}:
        if name.startswith(f"{MART_TABLE}__"):
            store.spark.sql(f"DROP TABLE {store.database}.{name}")  # its files stay
    again = Store(store.spark, store.database, store.folder.rpartition("/")[0]).create()
    assert content(again.table(MART_TABLE)) == expected


def test_an_unknown_source_makes_a_rebuild(store):
    before = files(store, MART_TABLE)
    store.publish(CUSTOMER.target, store.table(CUSTOMER.target), CUSTOMER.target_key)
    refresh_mart(store, AuditLog(store))
    assert not files(store, MART_TABLE) & before and store.sources(MART_TABLE) == {}
    as_rebuilt(store)


def test_key_ranges(make):
    ranges = KeyRanges.over("k", 100, 1099, 1000, 100)
    assert (ranges.base, ranges.size) == (100, 100)
    rows = make([(k,) for k in (-(2**63), 0, 100, 199, 200, 1099, 1100, 2**63 - 1, None)], "k bigint")
    got = [r[0] for r in rows.select(ranges.part()).collect()]
    assert got == [0, 0, 0, 0, 1, 9, 10, MOST_PARTS - 1, None]
    empty = KeyRanges.over("k", None, None, 0, 10)
    assert {r[0] for r in rows.where("k > 0").select(empty.part()).collect()} <= {0, 1, 2}
