"""a table in parts does not fall into ever more small files as it grows."""

import math
import uuid

from tidemark.sources.store import MANY_FILES, Store


def files(store, rows):
    """Files a table of these many rows would have, and the rows in each."""
    made = store.shared_ranges("id", store.spark.range(rows))
    parts = math.ceil(rows / made.size)
    return parts * store.buckets, rows / parts / store.buckets


def test_files_hold_more_rows_than_asked_for_where_they_would_be_too_many(spark):
    store = Store(spark, f"files_{uuid.uuid4().hex}", buckets=100, rows_per_file=1).create()
    number, rows = files(store, 200_000)  # a thousand parts, hence 100,000 files, before
    assert MANY_FILES / 2 < number <= MANY_FILES and 20 <= rows < 40


def test_few_files_are_as_small_as_asked_for(spark):
    store = Store(spark, f"files_{uuid.uuid4().hex}", buckets=10, rows_per_file=5).create()
    assert files(store, 20_000) == (4000, 5)


def test_files_of_a_good_size_are_as_many_as_they_must_be(spark, monkeypatch):
    monkeypatch.setattr("tidemark.sources.store.GOOD_FILE_ROWS", 50)
    store = Store(spark, f"files_{uuid.uuid4().hex}", buckets=100, rows_per_file=1).create()
    assert files(store, 2_000_000) == (40_000, 50)
