"""Main text of web pages by nearest-URL page differencing.

Pages of one site share their template. Within each host, pages are paired with the one whose URL path and query are
nearest (the longest common beginning) and that is no copy of theirs, the lines of both are aligned by a longest common
subsequence, and lines that both share are deleted from what the page does not mark as its article.

A page's own marks come first: elements that are menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or reader comments by their tag, role or class hold no lines at all, and lines within ``<article>`` or
``<main>`` are kept, as two articles may well share a line. An element that is such by its class, id or as a form but
holds the page's article is none. Differencing decides about all other lines.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, numbered

#: Pages sharing at least this part of their lines are copies of each other, not siblings in a template.
COPY = 0.8
#: Ranks that are searched for the ends of runs of copies at a time.
BLOCK = 4096
#: Bits of an alignment table kept at a time.
TABLE_BITS = 1 << 28

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split())
CHROME_TAGS = frozenset("nav footer aside form menu dialog button label search head".split()) | RAW
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social comment "
    "comments disqus respond replies reply sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer masthead related recommended widget toolbar skip hidden".split())
#: A start tag of the first kind ends an open element of the second, unless one of the third stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _chrome(tag: str, attributes: str, in_article: bool) -> str:
    """Empty for content, "weak" for forms and by a word of class or id, else "strong"."""
    if tag != "form" and tag in CHROME_TAGS or (tag == "header" and not in_article):
        return "strong"
    found = "weak" if tag == "form" else ""
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if tag not in ("html", "body", "article", "main") and any(
                    w.lower() in CHROME_WORDS for w in WORDS.findall(value)):
                found = "weak"
        elif name == "role":
            if value.lower() in CHROME_ROLES:
                return "strong"
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "strong"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "strong"
    return found


def lines_of(html: str | None) -> tuple[list[str], list[bool]]:
    """The page's text blocks outside chrome, in order, and for each whether it stands in an article.

    White space in a block is one space, character references are decoded, empty blocks do not count. Weak chrome that
    holds a main element or an article is content, but of articles only those within the fewest weak elements count:
    others are teasers and comments.
    """
    html = html or ""
    blocks, held = [], []  # a block: its pieces (text, number of the innermost weak element), and its mark
    outer, depths = [-1], [0]  # of weak elements: the one around it, and how many it stands in with itself; 0 is none
    mains, articles = [], []  # the weak elements they stand in directly
    open_tags = [("", False, False, 0)]  # tag, within strong chrome, within an article, innermost weak element

    def end_block() -> None:
        if held:
            blocks.append((held.copy(), open_tags[-1][2]))
            held.clear()

    def close(names: tuple[str, ...], until: tuple[str, ...]) -> None:
        for k in range(len(open_tags) - 1, 0, -1):
            if open_tags[k][0] in names:
                del open_tags[k:]
                return
            if open_tags[k][0] in until:
                return

    at = 0
    while True:
        found = MARKUP.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text and not open_tags[-1][1]:
            held.append((entities.unescape(text) if "&" in text else text, open_tags[-1][3]))
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            end_block()
        elif tag == "br":
            held.append((" ", open_tags[-1][3]))
        if found[1]:
            if any(name == tag for name, *_ in open_tags):
                while open_tags[-1][0] != tag:
                    open_tags.pop()
                open_tags.pop()
            continue
        if tag in BLOCKS:
            close(("p",), ("article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "td", "li"))
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in VOID or found[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        _, strong, article, weak = open_tags[-1]
        kind = _chrome(tag, found[3], article)
        strong = strong or kind == "strong"
        if kind == "weak" and not strong:
            outer.append(weak)
            depths.append(depths[weak] + 1)
            weak = len(outer) - 1
        if tag in ("article", "main") and not strong:
            (articles if tag == "article" else mains).append(weak)
        open_tags.append((tag, strong, article or tag in ("article", "main"), weak))
    end_block()
    content = {0}
    least = min((depths[k] for k in articles), default=0)
    for k in [*mains, *(k for k in articles if depths[k] == least)]:
        while k not in content:
            content.add(k)
            k = outer[k]
    lines, marks = [], []
    for pieces, mark in blocks:
        text = " ".join("".join(t for t, k in pieces if k in content).split())
        if text:
            lines.append(text)
            marks.append(mark)
    return lines, marks


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """For each beginning of ``a`` a number whose bit j is 0 where b[: j + 1] allows a longer alignment than b[:j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def aligned(a: list[int], b: list[int]) -> list[int]:
    """Indexes into ``a`` of one longest common subsequence of ``a`` and ``b``, ascending."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    middle = _aligned(a[start : len(a) - end], b[start : len(b) - end])
    return [*range(start), *(k + start for k in middle), *range(len(a) - end, len(a))]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    if len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2

        def lengths(x: list[int], y: list[int]) -> np.ndarray:
            *_, last = _rows(x, y)
            raw = np.frombuffer(last.to_bytes(len(y) // 8 + 1, "little"), np.uint8)
            return np.concatenate([[0], np.cumsum(np.unpackbits(raw, bitorder="little")[: len(y)] == 0)])

        split = int(np.argmax(lengths(a[:half], b) + lengths(a[half:][::-1], b[::-1])[::-1]))
        return _aligned(a[:half], b[:split]) + [k + half for k in _aligned(a[half:], b[split:])]
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                out.append(i)
                j -= 1
    return out[::-1]


def shared_lines(page: list[int], others: list[tuple[str, list[int]]], path: str) -> list[int]:
    """Indexes of the page's lines that the nearest of the other pages shares, nearest by path, ties to the first.

    A page that shares most lines both ways is a copy and is passed over.
    """
    for _, other in sorted(others, key=lambda o: -len(commonprefix([o[0], path]))):
        met = aligned(page, other)
        if other and len(met) < COPY * max(len(page), len(other)):
            return met
    return []


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """The path without a slash at the end, with its query, without fragment."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*|#.*$", "")
    return F.regexp_replace(rest, r"^([^?]*?)/+(\?.*)?$", "$1$2")


@F.pandas_udf(T.StructType([
    T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("marks", T.ArrayType(T.BooleanType()))]))
def _parsed(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([lines_of(p) for p in pages], columns=["lines", "marks"])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _shared(page: pd.Series, path: pd.Series, before: pd.Series, path_before: pd.Series,
            after: pd.Series, path_after: pd.Series) -> pd.Series:
    return pd.Series([
        shared_lines(list(p), [(n, list(o)) for n, o in ((nb, b), (na, a)) if o is not None], own)
        for p, own, b, nb, a, na in zip(page, path, before, path_before, after, path_after, strict=True)])


@F.pandas_udf(T.BooleanType())
def _copies(one: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([
        len(aligned(list(a), list(b))) >= COPY * max(len(a), len(b)) for a, b in zip(one, other, strict=True)], dtype=bool)


def _ranked(paths: DataFrame) -> DataFrame:
    """Distinct (host, path, page) with consecutive ranks in their order, from range partitions and their sizes."""
    inside = F.lit((1 << 33) - 1)
    ordered = cut(
        paths.repartitionByRange("host", "path", "page").sortWithinPartitions("host", "path", "page")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND(inside)))
    sizes = sorted(ordered.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row for each partition
    starts, upto = [], 0
    for part, n in sizes:
        starts.append((part, upto))
        upto += n
    offsets = ordered.sparkSession.createDataFrame(starts, "part long, start long")
    return ordered.join(F.broadcast(offsets), "part").select(
        "host", "path", "page", (F.col("start") + F.col("place")).alias("rank"))


def _run_ends(ranks: DataFrame) -> DataFrame:
    """Ranks (rank, first) with ``start``, the last rank up to here that is a first one, and ``next``, the first beyond."""
    own = F.when(F.col("first"), F.col("rank"))
    blocked = ranks.withColumn("block", F.floor(F.col("rank") / BLOCK))
    blocks = blocked.groupBy("block").agg(F.min(own).alias("least"), F.max(own).alias("most"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    carried = blocks.select(  # one row for each BLOCK ranks
        "block", F.max("most").over(earlier).alias("start_before"), F.min("least").over(later).alias("next_behind"))
    within = Window.partitionBy("block").orderBy("rank")
    upto = F.max(own).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    beyond = F.min(own).over(within.rowsBetween(1, Window.unboundedFollowing))
    return blocked.withColumn("start", upto).withColumn("next", beyond).join(carried, "block").select(
        "rank", F.coalesce("start", "start_before").alias("start"), F.coalesce("next", "next_behind").alias("next"))


def shared_by_nearest(pages: DataFrame) -> DataFrame:
    """(host, path, page, shared): what the nearest page shares with each page that has lines outside an article.

    ``pages`` has host, path, page (a hash of the html), hashes (of the lines) and marks. Only hashes are shuffled. In
    the order of paths the nearest one is a direct neighbour, so ranks replace a search, and a host of any size
    spreads over many tasks. Neighbours that are copies of each other form runs, and a page is compared with the pages
    before and behind its run. Other contents of the same path are neighbours as well; pages without lines are not.
    """
    full = pages.where(F.size("hashes") > 0)
    ranks = cut(_ranked(full.select("host", "path", "page").distinct()))
    one = full.groupBy("host", "path", "page").agg(F.first("hashes").alias("hashes"))
    known = cut(ranks.join(one, ["host", "path", "page"]))

    def neighbour(at: Column, name: str) -> DataFrame:
        return known.select(
            at.alias(f"rank_{name}"), F.col("host").alias(f"host_{name}"), F.col("path").alias(f"path_{name}"),
            F.col("hashes").alias(name))

    last = neighbour(F.col("rank") + 1, "last")
    copies = (
        known.join(last, (F.col("rank") == F.col("rank_last")) & (F.col("host") == F.col("host_last")))
        .where(_copies("hashes", "last")).select("rank", F.lit(False).alias("first")))
    firsts = ranks.join(copies, "rank", "left").select("rank", F.coalesce("first", F.lit(True)).alias("first"))
    ends = _run_ends(cut(firsts))
    asking = full.where(F.exists("marks", lambda m: ~m)).select("host", "path", "page").distinct()
    around = (
        known.join(asking, ["host", "path", "page"]).join(ends, "rank")
        .join(neighbour(F.col("rank") + 1, "before"), F.col("start") == F.col("rank_before"), "left")
        .join(neighbour(F.col("rank"), "after"), F.col("next") == F.col("rank_after"), "left"))
    for name in ("before", "after"):
        same = F.col(f"host_{name}") == F.col("host")
        around = around.withColumn(name, F.when(same, F.col(name)))
    return (
        around.withColumn("shared", _shared("hashes", "path", "before", "path_before", "after", "path_after"))
        .where(F.size("shared") > 0).select("host", "path", "page", "shared"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", name: str = "text") -> DataFrame:
    """The pages with their main text in ``name`` (replaced if there); other columns and rows as they came.

    Lines are joined by two line ends; nothing found is the empty string, as for null and empty html. Null urls are
    pages of one nameless host. Whole pages are read whatever their length. Pages alone on their host lose no line to
    differencing. Repeated rows come back repeated; an empty table stays empty; extra columns may have any name.
    """
    others = [c for c in pages.columns if c.lower() != name.lower()]
    pages, own = numbered(pages)
    url, html = own[url], own[html]
    others = [F.col(own[c]).alias(c) for c in others]
    host, path, page, parsed = "page_host", "page_path", "page_hash", "page_parsed"

    def named(made: DataFrame) -> DataFrame:
        return made.select(*others, F.col("page_text").alias(name))

    keyed = (
        pages.withColumn(host, host_of(F.col(url))).withColumn(path, path_of(F.col(url)))
        .withColumn(page, F.xxhash64(F.col(html))))
    read = keyed.withColumn(parsed, _parsed(F.col(html)))
    compared = cut(
        read.select(F.col(host).alias("host"), F.col(path).alias("path"), F.col(page).alias("page"),
                    F.transform(f"{parsed}.lines", lambda x: F.xxhash64(x)).alias("hashes"),
                    F.col(f"{parsed}.marks").alias("marks")))
    lines, marks = F.col(f"{parsed}.lines"), F.col(f"{parsed}.marks")
    if compared.where(F.exists("marks", lambda m: ~m)).isEmpty():
        return named(read.withColumn("page_text", F.array_join(lines, "\n\n")))
    found = shared_by_nearest(compared).alias("found")
    kept = F.filter(lines, lambda x, k: F.element_at(marks, k + 1) | ~F.array_contains(
        F.coalesce(F.col("found.shared"), F.array().cast("array<int>")), k))
    same = (F.col(host) == F.col("found.host")) & (F.col(path) == F.col("found.path")) & (
        F.col(page) == F.col("found.page"))
    return named(read.join(found, same, "left").withColumn("page_text", F.array_join(kept, "\n\n")))
