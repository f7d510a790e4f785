"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams, most frequent first. A document's profile is compared with
each language's by the out-of-place distance: for every n-gram of the document, how far its rank is from its rank in
the language's profile, or the longest distance if the language's profile lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

UNDETERMINED = "und"
PROFILE = 300
#: Bits of a code point; three fit into one long.
POINT = 21
LONGEST = 3
CHARS_AT_ONCE = 1 << 20
TEXTS_AT_ONCE = 256
GRAMS_HELD = 2_000_000


@cache
def _letters() -> np.ndarray:
    """The lower-case letter of every code point, 0 where it is none."""
    chars = (chr(c) for c in range(0x110000))
    return np.fromiter(
        (ord(low) if c.isalpha() and len(low := c.lower()) == 1 else ord(c) if c.isalpha() else 0 for c in chars),
        np.int64, 0x110000)


def _runs(text: str) -> Iterator[np.ndarray]:
    """The text's letters in pieces that end at a word's end; 0 stands before, between and behind words."""
    held = np.zeros(1, np.int64)
    for k in range(0, len(text), CHARS_AT_ONCE):
        raw = text[k : k + CHARS_AT_ONCE].encode("utf-32-le", "surrogatepass")
        own = np.concatenate([held, _letters()[np.frombuffer(raw, "<u4")]])
        own = own[np.concatenate([[True], (own[1:] != 0) | (own[:-1] != 0)])]
        if k + CHARS_AT_ONCE < len(text):
            ends = np.flatnonzero(own == 0)
            last = int(ends[-1])
            if last == 0:  # one word so far
                held = own
                continue
            yield own[: last + 1]
            held = own[last:]
        else:
            yield own if own[-1] == 0 else np.concatenate([own, [0]])


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three letters as longs, ascending, and their counts.

    Words are runs of letters, lower-cased; a word's edge counts as a letter of bi- and trigrams.
    """
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for own in _runs(text or ""):
        if len(own) < 3:
            continue
        two = (own[:-1] << POINT) | own[1:]
        inner = own[1:-1]
        three = ((own[:-2] << 2 * POINT) | (inner << POINT) | own[2:])[inner != 0]
        # A leading 0 would make a bigram equal a single letter; lengths are told apart by the bit above.
        grams = np.concatenate([own[own != 0], two | (1 << 62), np.where(three >= 0, ~three, three)])
        found, n = np.unique(grams, return_counts=True)
        if len(keys):
            keys, where = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
        else:
            keys, counts = found, n
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by n-gram."""
    return keys[np.lexsort((keys, -counts))[:size]]


def ngram_counts(docs: DataFrame, label: str = "lang", text: str = "text") -> DataFrame:
    """(label, gram, n) over whole texts, summed within each task before the shuffle."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k in range(0, len(batch), TEXTS_AT_ONCE):
                for name, texts in batch.iloc[k : k + TEXTS_AT_ONCE].groupby("label", sort=False)["body"]:
                    held[name] = merged([*(ngrams(t) for t in texts), *([held[name]] if name in held else [])])
            if sum(len(keys) for keys, _ in held.values()) > GRAMS_HELD:
                yield from (pd.DataFrame({"label": name, "gram": g, "n": n}) for name, (g, n) in held.items())
                held.clear()
        yield from (pd.DataFrame({"label": name, "gram": g, "n": n}) for name, (g, n) in held.items())

    return (
        docs.select(F.col(label).alias("label"), F.col(text).alias("body")).dropna()
        .mapInPandas(count, "label string, gram long, n long")
        .groupBy("label", "gram").agg(F.sum("n").alias("n"))
    )


@dataclass(frozen=True)
class Profiles:
    """Languages in order of name, each with its n-grams, most frequent first."""

    names: tuple[str, ...]
    grams: tuple[np.ndarray, ...]

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language at the smallest out-of-place distance, ties to the first name, and 1 less that distance.

        The distance is a share of the longest possible one. ``und`` and 0 without letters or without languages.
        """
        own = ranked(*ngrams(text), size=max(map(len, self.grams), default=0))
        if not len(own):
            return UNDETERMINED, 0.0
        if not hasattr(self, "sorted"):
            order = [np.argsort(g, kind="stable") for g in self.grams]
            object.__setattr__(self, "sorted", [(g[o], o) for g, o in zip(self.grams, order, strict=True)])
        rank = np.arange(len(own))
        away = []
        for grams, places in self.sorted:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            longest = len(grams)
            out = np.where(grams[at] == own, np.minimum(np.abs(places[at] - rank), longest), longest)
            away.append(out.sum() / (longest * len(own)))
        best = int(np.argmin(away))
        return self.names[best], float(1 - away[best])


def learn(docs: DataFrame, label: str = "lang", text: str = "text", size: int = PROFILE) -> Profiles:
    """Profiles of every non-null label, learned from whole texts; null and empty texts teach nothing.

    The driver receives ``size`` rows per label.
    """
    counts = ngram_counts(docs, label, text)
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size).select("label", "place", "gram").toPandas()
    top = top.sort_values(["label", "place"])
    names = tuple(sorted(top["label"].unique()))
    return Profiles(names, tuple(top.loc[top["label"] == n, "gram"].to_numpy(np.int64) for n in names))


def predicted(text: Column, profiles: Profiles) -> Column:
    """A struct of ``lang`` and ``score`` for a text column."""
    shared = profiles

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.nearest(t) for t in texts], columns=["lang", "score"])

    return of(text)


def with_language(
    docs: DataFrame, profiles: Profiles, text: str = "text", lang: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """Adds the predicted language and its score from 0 to 1; columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score 0, whatever their length. Rows neither vanish nor
    multiply, and an empty table stays empty.
    """
    cols = [c for c in docs.columns if c.lower() not in (lang.lower(), score.lower())]
    found = predicted(F.col(text), profiles)
    both = free_name(docs, "language_found")
    return (
        docs.select(*cols, found.alias(both))
        .select(*cols, F.col(f"{both}.lang").alias(lang), F.col(f"{both}.score").alias(score))
    )
