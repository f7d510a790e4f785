from tidemark.operators.upsert import append_missing, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_overwrites_adds_keeps_and_is_idempotent(make):
    target = make([(1, "a"), (2, "b")], "k bigint, v string")
    source = make([(2, "B"), (3, "C")], "k bigint, v string")
    once = upsert(target, source, "k")
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(upsert(once, source, "k")) == rows(once)


def test_upsert_takes_nulls_from_the_source_and_marks_hits(make):
    target = make([(1, "a"), (2, "b")], "k bigint, v string")
    merged = upsert(target, make([(2, None)], "k bigint, v string"), "k", hit="hit")
    assert rows(merged) == [(1, "a", None), (2, None, True)]


def test_upsert_of_newer_rows_only(make):
    target = make([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "k bigint, n int, v string")
    source = make([(1, 4, "A"), (2, 6, "B"), (3, 1, "C"), (4, 1, "D")], "k bigint, n int, v string")
    assert rows(upsert(target, source, "k", newer="n")) == [(1, 5, "a"), (2, 6, "B"), (3, 1, "C"), (4, 1, "D")]


def test_append_missing_never_updates(make):
    target = make([(1, "a")], "k bigint, v string")
    source = make([(1, "z"), (2, "b")], "k bigint, v string")
    assert rows(append_missing(source, target, "k")) == [(2, "b")]
