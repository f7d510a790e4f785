"""A warehouse outlives the process that made it, and refuses a writer that comes too late."""

import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import pytest

from tidemark.schemas import AUDIT_TABLE, MART_TABLE, RESELLER, SALES, SALES_ORDER, TERRITORY
from tidemark.sources.sheets import stamp
from tidemark.sources.store import KeyCheckFailed, Store

TERRITORY_COLUMNS = "salesterritorykey bigint, region string, country string, `group` string"

ROOT = Path(__file__).resolve().parent.parent
LOAD = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tidemark.plans.run import run
from tidemark.session import configure
from tidemark.sources.store import Store
from workload import inputs as i
from workload.queries import FIRST_LOAD, SECOND_LOAD, AS_OF
spark = (configure(SparkSession.builder.master("local[4]")).config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
store = Store(spark, {database!r}, {folder!r}).create()
t = i.Tables(spark, {data!r})
if {second}:
    run(store, i.sheets(t), SECOND_LOAD, as_of=AS_OF)
else:
    run(store, i.first_load_sheets(t), FIRST_LOAD)
"""


def test_two_processes_on_one_folder(spark, folder, tmp_path):
    for second in (False, True):
        code = LOAD.format(root=str(ROOT), database="lasting", folder=str(tmp_path), data=folder, second=second)
        subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=300,
                       env=os.environ | {"SPARK_LOCAL_DIRS": str(tmp_path / "local")}, capture_output=True)
    store = Store(spark, "lasting", str(tmp_path)).create()
    from compare import difference, duck

    from workload.oracle import ORACLE

    assert difference(store.table(MART_TABLE), duck(folder), ORACLE["stored_mart"]) is None
    assert store.last_load(RESELLER) == 2
    assert store.table(AUDIT_TABLE).count() > 41


def test_the_slower_of_two_writers_is_refused(spark, tmp_path):
    store = Store(spark, "contested", str(tmp_path)).create()
    rows = store.table(RESELLER.target)
    before = store._current

    def overtaken(name):
        found = before(name)
        store._current = before
        store.publish(RESELLER.target, rows, RESELLER.target_key)
        return found

    store._current = overtaken
    with pytest.raises(FileExistsError):
        store.publish(RESELLER.target, rows, RESELLER.target_key)
    assert store.table(RESELLER.target).count() == 0


def test_buckets_belong_to_the_table(spark, tmp_path):
    with pytest.raises(ValueError):
        Store(spark, "wide", str(tmp_path), buckets=100_001)
    store = Store(spark, "wide", str(tmp_path), buckets=8).create()
    store.publish(SALES.target, store.table(SALES.target), SALES.target_key, bucket_by=SALES.key)
    later = Store(spark, "wide", str(tmp_path), buckets=16)
    later.publish(SALES.target, later.table(SALES.target), SALES.target_key, bucket_by=SALES.key)
    assert later._current(SALES.target)[1]["buckets"] == 8


def test_labels_from_elsewhere_are_merged_with_the_whole_history(spark, tmp_path):
    import datetime as dt

    from tidemark.plans.refresh import refresh_dim
    from tidemark.sources.audit import AuditLog

    store = Store(spark, "labels", str(tmp_path)).create()
    schema = SALES_ORDER.target_schema
    far = dt.datetime(2030, 1, 1)
    names = store.table(SALES_ORDER.target).columns

    def row(key, label, ts):
        cells = {SALES_ORDER.key: key, "update_ts": ts}
        return tuple(cells.get(c, label) for c in names)

    store.publish(SALES_ORDER.target, spark.createDataFrame([row(900100, "SO900 - 1", far)], schema),
                  SALES_ORDER.target_key, bucket_by=SALES_ORDER.key)
    assert store.included(SALES_ORDER.target) == 0
    refresh_dim(store, AuditLog(store), SALES_ORDER.target, far.date())
    assert store.included(SALES_ORDER.target) == 0


def test_one_of_many_writers_gets_a_number(spark, tmp_path):
    stores = [Store(spark, "contended", str(tmp_path)) for _ in range(6)]
    with ThreadPoolExecutor(len(stores)) as pool:
        for number in range(1, 31):
            start = Barrier(len(stores))

            def note(store):
                start.wait()
                try:
                    store._note("numbers", number, {"by": id(store)})
                    return 1
                except FileExistsError:
                    return 0

            assert sum(pool.map(note, stores)) == 1
    assert sorted(stores[0]._notes("numbers")) == list(range(1, 31))
    names = [p.name for p in (tmp_path / "contended" / "_notes" / "numbers").iterdir()]
    assert not any(n.endswith(".new") for n in names)


def test_no_load_is_lost_between_writers_of_one_moment(spark, make, tmp_path):
    import datetime as dt

    stores = [Store(spark, "crowded", str(tmp_path)).create() for _ in range(4)]
    for turn in range(2):
        start = Barrier(len(stores))

        def load(k):
            rows = make([(10 * turn + k, "a", "b", "c")], TERRITORY_COLUMNS)
            start.wait()
            return stores[k].append_history(TERRITORY, stamp(rows, dt.datetime(2025, 1, 1 + turn)))

        with ThreadPoolExecutor(len(stores)) as pool:
            assert list(pool.map(load, range(len(stores)))) == [1] * len(stores)
    assert stores[0].last_load(TERRITORY) == 8
    again = Store(spark, "crowded", str(tmp_path)).create()
    keys = [r[0] for r in again.table(TERRITORY.history_table).collect()]
    assert sorted(keys) == [0, 1, 2, 3, 10, 11, 12, 13]
    again.append_history(TERRITORY, stamp(make([(1, "x", "b", "c")], TERRITORY_COLUMNS), dt.datetime(2025, 2, 1)))
    with pytest.raises(KeyCheckFailed):  # the other writer's load has this key and stamp
        stores[0].append_history(
            TERRITORY, stamp(make([(1, "y", "b", "c")], TERRITORY_COLUMNS), dt.datetime(2025, 2, 1)))
