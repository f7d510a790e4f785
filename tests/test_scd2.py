import datetime as dt
import random
from collections import defaultdict

import pytest

from tidemark.operators.scd2 import current_versions, scd2_ranges

SCHEMA = "k bigint, update_ts timestamp_ntz"
FLOOR, CEILING = dt.date(2000, 1, 1), dt.date(3000, 1, 1)
DAY = dt.timedelta(days=1)


def brute_force(versions, floor=FLOOR):
    """Ranges straight from the rules, version by version."""
    by_key = defaultdict(list)
    for key, ts in versions:
        by_key[key].append(ts)
    result = {}
    for key, stamps in by_key.items():
        stamps.sort()
        for n, ts in enumerate(stamps):
            start = floor if n == 0 else ts.date()
            end = CEILING if n + 1 == len(stamps) else stamps[n + 1].date() - DAY
            result[key, ts] = (start, end)
    return result


def ranges(df):
    return {(r[0], r.update_ts): (r.valid_from, r.valid_to) for r in df.collect()}


def test_golden(make):
    stamps = [dt.datetime(2025, 1, 10, 9), dt.datetime(2025, 3, 5, 10), dt.datetime(2025, 3, 5, 18),
              dt.datetime(2025, 6, 1)]
    df = scd2_ranges(make([(1, s) for s in stamps], SCHEMA), "k", as_of="2025-03-05").orderBy("update_ts")
    assert [tuple(r)[2:] for r in df.collect()] == [
        (FLOOR, dt.date(2025, 3, 4), 0),
        (dt.date(2025, 3, 5), dt.date(2025, 3, 4), 0),
        (dt.date(2025, 3, 5), dt.date(2025, 5, 31), 1),
        (dt.date(2025, 6, 1), CEILING, 0),
    ]
    assert current_versions(df).count() == 1


def test_single_version_is_open_on_both_sides(make):
    row = scd2_ranges(make([(1, dt.datetime(2025, 1, 1))], SCHEMA), "k", as_of=dt.date(2025, 1, 1)).first()
    assert (row.valid_from, row.valid_to, row.is_valid) == (FLOOR, CEILING, 1)


def test_first_version_before_the_floor(make):
    versions = [(1, dt.datetime(1995, 5, 5)), (1, dt.datetime(1996, 6, 6)), (1, dt.datetime(2001, 1, 1))]
    assert ranges(scd2_ranges(make(versions, SCHEMA), "k")) == brute_force(versions)


@pytest.mark.parametrize("seed", range(4))
def test_random_versions_with_a_hot_key(make, seed):
    rng = random.Random(seed)
    start = dt.datetime(2003, 1, 1)
    versions = {
        (rng.choice([7, 7, rng.randrange(40)]), start + dt.timedelta(minutes=rng.randrange(60 * 24 * 90)))
        for _ in range(1500)
    }
    df = scd2_ranges(make(list(versions), SCHEMA), "k")
    assert ranges(df) == brute_force(versions)


def test_ranges_of_a_key_are_disjoint_and_cover_everything(make):
    rng = random.Random(9)
    versions = {(rng.randrange(5), dt.datetime(2001, 1, 1) + dt.timedelta(hours=rng.randrange(9000)))
                for _ in range(400)}
    by_key = defaultdict(list)
    for (key, _), span in ranges(scd2_ranges(make(list(versions), SCHEMA), "k")).items():
        if span[0] <= span[1]:
            by_key[key].append(span)
    for spans in by_key.values():
        spans.sort()
        assert spans[0][0] == FLOOR and spans[-1][1] == CEILING
        assert all(a[1] + DAY == b[0] for a, b in zip(spans, spans[1:]))
