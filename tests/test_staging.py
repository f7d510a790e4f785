import uuid
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources.store import Store


@pytest.fixture
def store(spark):
    return Store(spark, f"staging_{uuid.uuid4().hex}").create()


def folders(store, name):
    return [p for p in Path(store.folder.removeprefix("file:")).iterdir() if p.name.startswith(f"{name}__")]


def test_a_failed_batch_leaves_the_one_before(spark, store):
    assert store.stage("sheet", spark.range(5)) == 5
    failing = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException, match="bad row"):
        store.stage("sheet", failing)
    assert store.table("sheet").count() == 5
    assert len(folders(store, "sheet")) == 1


def test_batches_may_differ_in_columns_and_readers_keep_theirs(spark, store):
    store.stage("sheet", spark.range(5))
    begun = store.table("sheet")
    assert store.stage("sheet", spark.range(3).withColumn("more", F.lit("x"))) == 3
    assert begun.count() == 5
    assert store.table("sheet").columns == ["id", "more"]
    for n in range(4):
        store.stage("sheet", spark.range(n))
    assert len(folders(store, "sheet")) == 1 + store.keep


def test_a_batch_may_be_derived_from_the_one_it_replaces(spark, store):
    store.stage("sheet", spark.range(5))
    assert store.stage("sheet", store.table("sheet").where("id > 2")) == 2
