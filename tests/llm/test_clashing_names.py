"""Extra columns may be called like anything an operator uses inside, and stay as they came."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, pagediff, runs, surrogates, urlcascade
from tidemark.llm.common import ship

ROOT = Path(__file__).resolve().parents[2]
NAME = re.compile(r"""["'](?:__)?([a-z][a-z_0-9]*)["']""")

TEXT = "Mr John Smith wrote to jane@example.org. " + "The quick brown fox jumps over the lazy dog. " * 3
DOCS = [(1, TEXT, "en", "a"), (2, TEXT, "en", "b"), (3, "Der schnelle braune Fuchs " * 9, "de", "a"), (4, None, None, None)]
PAGE = "<html><body><div>Home of all</div><p>{}</p><div>Imprint here</div></body></html>"
PAGES = [(k, f"http://a.net/{k}", PAGE.format(f"Own words of page number {k}, all alone")) for k in range(5)]


def words_of(module):
    """Every name in quotes in a module's source: all helper columns are among them."""
    return sorted(set(NAME.findall((ROOT / "tidemark" / "llm" / f"{module}.py").read_text())))


def mixed(docs):
    return mixing.mixed(docs, mixing.Goal(max_repetition=2.0))


def language(docs):
    return langid.with_language(docs, langid.learn(docs.select("lang", "text")))


def verdicts(docs):
    rules = docs.sparkSession.createDataFrame([("a.net", "/1", "block")], "host string, path string, verdict string")
    return urlcascade.judged(docs, rules)


CASES = {
    "mixing": (mixed, DOCS, "doc_id long, text string, lang string, source string"),
    "langid": (language, DOCS, "doc_id long, text string, lang string, source string"),
    "runs": (runs.with_runs, DOCS, "doc_id long, text string, lang string, source string"),
    "surrogates": (lambda d: surrogates.surrogated(d, "key"), DOCS, "doc_id long, text string, lang string, source string"),
    "pagediff": (pagediff.main_text, PAGES, "page_id long, url string, html string"),
    "urlcascade": (verdicts, PAGES, "page_id long, url string, html string"),
}


@pytest.mark.parametrize("module", sorted(CASES))
def test_any_extra_column_stays_as_it_came(spark, make, module):
    ship(spark)
    operator, rows, schema = CASES[module]
    plain = make(rows, schema)
    expected = operator(plain)
    taken = {c.lower() for c in plain.columns} | {c.lower() for c in expected.columns}
    extra = [n for n in words_of(module) if n.lower() not in taken]
    assert len(extra) > 5
    wide = plain.select("*", *(F.lit(n).alias(n) for n in extra))
    got = operator(wide)
    assert set(got.columns) == set(expected.columns) | set(extra)
    assert all(r[n] == n for r in got.collect() for n in extra)
    columns = expected.columns if module != "mixing" else [c for c in expected.columns if c not in mixing.PLACES]

    def content(df):
        return Counter(str([r[c] for c in columns]) for r in df.collect())

    assert content(got) == content(expected)


@pytest.mark.parametrize("name", ["mix_block", "Mix_Place"])
def test_places_replace_columns_of_their_name(make, name):
    docs = make(DOCS, CASES["mixing"][2]).withColumn(name, F.lit("old"))
    got = mixed(docs)
    assert [c.lower() for c in got.columns].count(name.lower()) == 1
    assert dict(got.dtypes)[name.lower()] == "int"


def test_copies_of_one_row_spread_over_blocks(make):
    docs = make([(1, "the same words", "a")] * 30000 + [(k, "w", "a") for k in range(2, 10000)],
                "doc_id long, text string, source string")
    sizes = [r["count"] for r in mixed(docs).groupBy("source", "mix_epoch", "mix_block").count().collect()]
    assert max(sizes) < 1.3 * mixing.BLOCK_ROWS
    places = mixed(docs).groupBy("source", "mix_epoch", "mix_block", "mix_place").count().where("count > 1")
    assert places.isEmpty()
