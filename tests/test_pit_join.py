import datetime as dt
import random

import pytest

from tidemark.operators.pit_join import pit_join
from tidemark.operators.scd2 import scd2_ranges

FACT = "id bigint, k bigint, d date"
DIM = "k bigint, valid_from date, valid_to date, v bigint"
START = dt.date(2001, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def brute_force(facts, dim, how):
    result = []
    for id_, k, d in facts:
        hits = [v for key, a, b, v in dim if k is not None and key == k and d is not None and a <= d <= b]
        result += [(id_, k, d, v) for v in hits] or ([(id_, k, d, None)] if how == "left" else [])
    return sorted(result, key=str)


def joined(make, facts, dim, how, **options):
    df = pit_join(make(facts, FACT), make(dim, DIM), "k", "d", how=how, **options)
    assert df.columns == ["id", "k", "d", "v"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(seed, overlapping):
    """Key 7 is hot on both sides; some ranges are empty, some open, some facts lack a key or a date."""
    rng = random.Random(seed)
    dim = []
    for key in range(12):
        cuts = sorted(rng.sample(range(2000), 400 if key == 7 else rng.randrange(1, 6)))
        for n, cut in enumerate(cuts):
            end = day(cuts[n + 1] - 1) if n + 1 < len(cuts) else dt.date(3000, 1, 1)
            if overlapping:
                end = day(cut + rng.randrange(-3, 300))
            dim.append((key, dt.date(1900, 1, 1) if n == 0 else day(cut), end, len(dim)))
    facts = [
        (n, rng.choice([7, 7, rng.randrange(14), None]), None if rng.random() < 0.02 else day(rng.randrange(-50, 2100)))
        for n in range(600)
    ]
    return facts, dim


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("overlapping", [False, True])
@pytest.mark.parametrize("dense_versions", [0, 64, 10**6])
def test_equals_brute_force(make, how, overlapping, dense_versions):
    facts, dim = sample(3, overlapping)
    assert joined(make, facts, dim, how, dense_versions=dense_versions) == brute_force(facts, dim, how)


@pytest.mark.parametrize("most", [0, 1, 3])
def test_dense_keys_beyond_the_list_are_joined_plainly(make, most):
    facts, dim = sample(4, False)
    assert joined(make, facts, dim, "inner", dense_versions=2, most_dense=most) == brute_force(facts, dim, "inner")


def test_building_the_plan_starts_no_job(make, spark):
    facts, dim = sample(4, False)
    fact, versions = make(facts, FACT), make(dim, DIM)
    spark.sparkContext.setJobGroup("building", "")
    try:
        built = pit_join(fact, versions, "k", "d")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
        built.count()
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_version_matches_among_many_of_a_day(make):
    """The day before belongs to the first version, the day itself and later ones to its last."""
    versions = make([(1, dt.datetime(2025, 3, 5, h)) for h in range(1, 24)], "k bigint, update_ts timestamp_ntz")
    dim = scd2_ranges(versions, "k").withColumnRenamed("update_ts", "version_ts")
    facts = make([(n, 1, dt.date(2025, 3, 4 + n)) for n in range(3)], FACT)
    hours = [r.version_ts.hour for r in pit_join(facts, dim, "k", "d").orderBy("id").collect()]
    assert hours == [1, 23, 23]


def test_text_keys(make):
    facts, dim = sample(5, False)
    text = [(n, str(k) if k is not None else None, d) for n, k, d in facts]
    df = pit_join(make(text, "id bigint, k string, d date"),
                  make([(str(k), a, b, v) for k, a, b, v in dim], DIM.replace("k bigint", "k string")), "k", "d")
    expected = [(n, str(k), d, v) for n, k, d, v in brute_force(facts, dim, "inner")]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(expected, key=str)


def test_same_names_are_refused(make):
    with pytest.raises(ValueError, match="rename"):
        pit_join(make([], FACT), make([], "k bigint, valid_from date, valid_to date, id bigint"), "k", "d")
