"""Spelling variants, URL rules and periodic runs against brute force, with odd input; SQL of queries that have it."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from compare import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import runs, urlcascade, variants
from tidemark.llm.common import ship
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES, periodic_texts


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), duck(folder), ORACLE[name]) is None


# Periodic runs


def plain_runs(words, least, times):
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def expand(grammar, symbol):
    out, todo = [], [symbol]
    while todo:
        s = todo.pop()
        if s < grammar.terminals:
            out.append(s)
        else:
            todo += [grammar.right[s - grammar.terminals], grammar.left[s - grammar.terminals]]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 5), st.integers(0, 40), st.integers(3, 12))
def test_runs_equal_brute_force(head, period, more, least):
    words = head + (head[-period:] or [0]) * more + head[:7]
    assert runs.find_runs(words, least, 3) == plain_runs(words, least, 3)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_long_texts(seed):
    rng = random.Random(seed)
    words = []
    passage = [rng.randrange(9) for _ in range(40)]
    for _ in range(12):
        piece = [rng.randrange(60) for _ in range(rng.randrange(1, 50))]
        words += piece * rng.choice([1, 1, 3, 4, 30]) + passage * rng.choice([0, 1, 3]) + piece[:5]
    assert runs.find_runs(words) == plain_runs(words, 24, 3) != []


def test_grammar_gives_the_words_back_and_no_pair_twice():
    rng = random.Random(1)
    ids = [rng.randrange(5) for _ in range(500)] + [1] * 37
    grammar = runs.re_pair(runs.np.array(ids), 5)
    start = [grammar.symbol[i] for i in range(len(ids)) if grammar.alive[i]]
    assert [t for s in start for t in expand(grammar, s)] == ids
    places = {}
    for i, pair in enumerate(zip(start, start[1:], strict=False)):
        places.setdefault(pair, []).append(i)
    assert all(p[-1] - p[0] < 2 for p in places.values())


def test_runs_in_texts(make):
    text = "x y " + "a b c " * 10 + "\u00a0z\td"
    docs = make(
        [(1, text, 5), (1, text, 5), (2, None, 5), (3, "", 5), (4, " \n", 5), (None, "q " * 3000, 5)],
        "doc_id long, text string, of_runs int")
    got = runs.with_runs(docs.withColumn("Runs", F.lit(0))).collect()
    rows = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed, r.of_runs) for r in got)
    kept = "x y a b c \u00a0z d"
    assert rows == Counter({
        (1, ((2, 30, 3),), kept, 5): 2, (2, (), "", 5): 1, (3, (), "", 5): 1, (4, (), "", 5): 1,
        (None, ((0, 3000, 1),), "q", 5): 1})
    assert runs.with_runs(docs.where("false")).count() == 0


def test_registered_runs_against_plain_code(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words, 24, 3) if n < 600 else runs.find_runs(words)
        gone = {i for s, e, q in found for i in range(s + q, e)}
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        r = got[doc_id]
        assert r.n_runs == len(found) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        if found:
            s, e, q = min(found, key=lambda x: (-(x[1] - x[0]) / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, e - s, q, 1000 * (e - s) // q)


def test_periodic_text_of_odd_rows(make):
    rows = make([(None, "a b c d"), (3, None), (None, ""), (None, None)], "doc_id long, text string")
    got = [r.text for r in periodic_texts(rows).collect()]
    assert got == ["a b a b", None, "", None]  # the empty text's CRC-32 is 0


# Spelling variants


def within_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times=2):
    near = {w: [x for x in counts if within_one(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts.get(form[w]), root)
    return out


def vocabulary(seed, size, letters, longest):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(size)}
    words |= {"a" * k for k in range(1, 9)}
    return {w: rng.choice([1, 2, 3, 5, 8, 40, 41, 500]) for w in words}


@pytest.mark.parametrize(("block", "letters", "longest"), [(4096, "abc", 7), (3, "ab\u00e9", 6), (16, "abcdefgh", 4)])
def test_variants_equal_brute_force(make, block, letters, longest):
    counts = vocabulary(block, 300, letters, longest)
    got = variants.grouped_variants(make(list(counts.items()), "word string, n long"), block=block).collect()
    assert len(got) == len(counts)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == plain_variants(counts)


def test_no_index_is_larger_than_a_block(make):
    counts = vocabulary(2, 800, "ab", 9)
    indexes = variants.position_indexes(make(list(counts.items()), "word string, n long"), 5)
    wide = indexes.where("high - low > 1").groupBy(*variants.KEY).count()
    assert wide.agg(F.max("count")).first()[0] <= 5
    assert indexes.where("high - low <= 1").groupBy(*variants.KEY).count().agg(F.max("count")).first()[0] <= 3 * 2


def test_words_of_texts(make):
    long = "Stra\u00dfe " * 3 + "\u00c9COLE \u00e9cole " * 4 + "don't \u0130stanbul co\u0301operate \U0001f600hello " * 5
    docs = make([(1, long, 1), (1, long, 1), (2, None, 1), (None, "", 1), (None, "stra\u00dfe" + " " * 10, 1)],
                "doc_id long, text string, n int")
    got = {r.word: r.n for r in variants.word_counts(docs, least_length=4, least_count=3).collect()}
    assert got == {"stra\u00dfe": 7, "\u00c9cole": 8, "\u00e9cole": 8, "stanbul": 10, "operate": 10, "hello": 10}
    empty = variants.grouped_variants(variants.word_counts(docs.where("false")))
    assert empty.count() == 0 and set(empty.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
    with pytest.raises(ValueError):
        variants.grouped_variants(docs.selectExpr("text as word", "n"), times=1)


def test_misspelled_runs(make):
    rng = random.Random(3)
    runs_of = {d: ["".join(rng.choices("abcde\u00e9", k=rng.randint(4, 7))) for _ in range(400)] for d in (1, None)}
    expected = Counter()
    for d, words in runs_of.items():
        for w in words:
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            expected[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 5 == 0 else w] += 1
    docs = make([(d, " ".join(w)) for d, w in runs_of.items()], "doc_id long, text string")
    got = {r.word: r.n for r in variants.word_counts(docs, least_length=5, least_count=1, misspell=5).collect()}
    assert got == {w: n for w, n in expected.items() if len(w) >= 5}


# URL rules


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(h, p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    h, p, v = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"))
    return host, path, h + p, v


def test_rules_equal_brute_force(make):
    rng = random.Random(5)
    parts, paths = ["a", "b", "cc", "net", "x-y"], ["", "/", "/a", "/a/", "/en/x", "/\u00e9"]
    rules = {(".".join(rng.choices(parts, k=rng.randint(1, 3))), rng.choice(paths), rng.choice(["block", "allow"]))
             for _ in range(120)}
    urls = [f"{rng.choice(['http', 'ftp'])}://{'.'.join(rng.choices(parts, k=rng.randint(1, 4)))}"
            f"{rng.choice(paths)}{rng.choice(['', 'q', '?a/b', '#x', '/z?y'])}" for _ in range(900)]
    urls += [None, "", "net/", "://", "http://", "HTTP://A.NET", "x://y://net/", "http://net.", "http://.net/", "a\n://b/"]
    table = make([(k, u, "old", "kept") for k, u in enumerate(urls)], "page_id long, url string, host string, url_keys string")
    odd = [(None, "/", "block"), ("net", None, "block"), ("net", "en", "block"), ("n/t", "/", "block"), ("a", "/", None)]
    listed = make([*rules, *odd, *list(rules)[:9]], "host string, path string, verdict string")
    got = {r.page_id: r for r in urlcascade.judged(table, listed).collect()}
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        r = got[k]
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(u, rules), u
        assert r.url == u and r.url_keys == "kept"


def test_no_rules_and_no_urls(make):
    table = make([(1, "http://a.net/x"), (1, "http://a.net/x")], "page_id long, url string")
    none = make([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in urlcascade.judged(table, none).collect()] == [(None, "allow")] * 2
    some = make([("net", "/", "block")], none.schema)
    assert [(r.rule, r.verdict) for r in urlcascade.judged(table, some).collect()] == [("net/", "block")] * 2
    assert urlcascade.judged(table.where("false"), some).count() == 0


def test_cascade_is_exact_and_alternates(spark):
    keys = spark.range(40000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("key"))
    listed = keys.where("key like '%7'")
    made = urlcascade.cascade(listed, keys.union(keys), 40000)
    assert len(made.levels) > 3
    wrong = keys.where(made.lists(F.col("key")) != F.col("key").like("%7"))
    assert wrong.count() == 0
    with pytest.raises(ValueError, match="over the bound"):
        urlcascade.cascade(listed, keys, 40000, most_bits=64)


def test_url_filter_stays_in_the_jvm(spark, folder):
    plan = QUERIES["op12_url_cascade"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Join", "Cartesian"))
