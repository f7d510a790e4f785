"""Spelling variants: words one edit apart, found on bit-sliced position indexes.

The index of a set of words has one bitset for each position and letter: which words have that letter there. A query
runs over its letters and keeps, for all words at once, those without an error so far, those with one letter replaced
and those with one letter more, whose positions are shifted by one from there on. A word with one letter less is found
from the other side.

The vocabulary is dealt to many small indexes. Words within one edit of each other agree outside either half of their
positions, so each word goes into the index of what it has outside each half, once for its own length and once as the
longer word of a pair. An index of over ``block`` words is dealt again by the halves of its half until it is small, so
nothing is left out and no task holds more than a block. Every pair is found in exactly one index: a replaced letter
lies in one half, and an inserted letter counts at the first place where it gives the longer word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Letters, lower-cased from A to Z, and spaces for everything else, by Latin-1 code.
LETTERS = bytes(c if chr(c).isascii() and chr(c).islower() or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32
                for c in range(256))
PIECE = 1 << 22
HELD = 1 << 18
BLOCK = 4096
KEY = ("m", "low", "high", "outside")


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The text's runs of letters, some megabytes at a time."""
    data = text.encode("latin-1", "replace").translate(LETTERS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    least_length: int = 5, least_count: int = 3, misspell: int | None = None,
) -> DataFrame:
    """(word, n) of the lower-cased runs of letters in all texts that are long and frequent enough.

    With ``misspell`` a run whose CRC-32 of ``id:run`` is divisible by it loses the letter at that number modulo its
    length; a null id counts as the empty text. Null texts have no runs. Texts are counted whole, and a task holds at
    most a bounded number of words before it hands them on.
    """
    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc, body in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if body is None:
                    continue
                base = zlib.crc32(f"{doc}:".encode())
                for runs in _pieces(body):
                    for run, n in Counter(runs).items():
                        if len(run) < least_length:
                            continue
                        if misspell is not None:
                            h = zlib.crc32(_utf8(run), base)
                            if h % misspell == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least_length:
                                    continue
                        held[run] += n
                if len(held) > HELD:
                    yield _batch(held)
                    held.clear()
        if held:
            yield _batch(held)

    bodies = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text).alias("body"))
    return (
        bodies.mapInArrow(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    )


def _batch(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "word": pa.array([w.decode("latin-1") for w in held], pa.string()), "n": pa.array(held.values(), pa.int64())})


def _dealt(rows: DataFrame, windows: Column) -> DataFrame:
    """Rows (word, n) with what lies inside and outside each of the windows of positions (m, low, high)."""
    width = F.col("high") - F.col("low") + F.length("word") - F.col("m")
    outside = F.concat(
        F.expr("substring(word, 1, low)"), F.lit(" "), F.substring("word", F.col("low") + width + 1, F.length("word")))
    return rows.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*").withColumn(
        "outside", outside)


def _halves(m: Column, low: Column, high: Column) -> Column:
    middle = low + F.floor((high - low) / 2).cast("int")
    return F.array(*(
        F.struct(m.alias("m"), a.alias("low"), b.alias("high")) for a, b in ((low, middle), (middle, high))))


def position_indexes(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (m, low, high, outside, word, n): the words of each index, none of which has over ``block`` words.

    An index holds words of m letters, and of one letter more, that agree outside positions low to high. Halving ends
    at one position, where an index has at most two words a letter of the alphabet.
    """
    own, longer = F.length("word"), F.length("word") - 1
    zero = F.lit(0)
    level = _dealt(words, F.concat(_halves(own, zero, own), _halves(longer, zero, longer)))
    whole = None
    while True:
        sizes = level.groupBy(*KEY).agg(F.count("*").alias("in_index"))
        large = cut(sizes.where((F.col("in_index") > block) & (F.col("high") - F.col("low") > 1)).select(*KEY))
        if large.isEmpty():
            return level if whole is None else whole.unionByName(level)
        small = level.join(large, list(KEY), "left_anti").select(*KEY, "word", "n")
        whole = small if whole is None else whole.unionByName(small)
        again = level.join(large, list(KEY), "left_semi")
        level = cut(_dealt(again, _halves(F.col("m"), F.col("low"), F.col("high"))))


def near_in_index(
    m: int, low: int, high: int, words: list[str], counts: list[int],
) -> list[tuple[str, int, int, str]]:
    """(word, near words, the best one's count, the best one) of an index's words that have near words in it.

    The best near word has the largest count; ties go to the smallest in code-point order.
    """
    order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))  # the lowest bit is the best word
    words, counts = [words[k] for k in order], [counts[k] for k in order]
    width = high - low
    same = 0
    sliced: list[dict[str, int]] = [{} for _ in range(width + 1)]
    for k, word in enumerate(words):
        bit = 1 << k
        extra = len(word) - m
        if not extra:
            same |= bit
        for row, letter in zip(sliced, word[low : high + extra], strict=False):
            row[letter] = row.get(letter, 0) | bit
    more = ((1 << len(words)) - 1) & ~same
    near, best = [0] * len(words), [-1] * len(words)
    for k, word in enumerate(words):
        if len(word) != m:
            continue
        exact, replaced, longer = same | more, 0, 0
        previous = word[low - 1] if low else ""
        for i in range(width):
            letter = word[low + i]
            here = sliced[i].get(letter, 0)
            begun = exact & more & ~sliced[i].get(previous, 0)
            longer = (longer | begun) & sliced[i + 1].get(letter, 0)
            replaced = replaced & here | exact & same & ~here
            exact &= here
            previous = letter
        if high == m:  # a letter more at the end
            longer |= exact & more & ~sliced[width].get(previous, 0)
        found = replaced | longer
        if not found:
            continue
        near[k] += found.bit_count()
        first = (found & -found).bit_length() - 1
        if best[k] < 0 or first < best[k]:
            best[k] = first
        while longer:
            j = (longer & -longer).bit_length() - 1
            longer &= longer - 1
            near[j] += 1
            if best[j] < 0 or k < best[j]:
                best[j] = k
    return [(w, near[k], counts[best[k]], words[best[k]]) for k, w in enumerate(words) if near[k]]


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best): of every word (word, n) that has near words their number and the best one (n, form)."""
    def search(batches):
        key, members, counts = None, [], []

        def ended():
            if len(members) > 1:
                rows = near_in_index(*key[:3], members, counts)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                        names=["word", "near", "n", "form"])

        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "word", "n")]
            for *at, word, n in zip(*columns, strict=True):
                if at != key:
                    yield from ended()
                    key, members, counts = at, [], []
                members.append(word)
                counts.append(n)
        yield from ended()

    rows = position_indexes(words, block).select(*KEY, "word", "n")
    found = rows.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(
        search, "word string, near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.form").alias("form")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) without circles: what is reached by following forms to the last.

    Each round doubles the steps taken, so a chain of k forms takes log2(k) rounds.
    """
    state = cut(links.select("word", F.col("form").alias("root")))
    pending, ended = state, None
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(pending.join(ahead, "root", "left"))
        last = moved.where(F.col("next").isNull()).select("word", "root")
        ended = last if ended is None else ended.unionByName(last)
        pending = moved.where(F.col("next").isNotNull()).select("word", F.col("next").alias("root"))
        if pending.isEmpty():
            return ended
        state = ended.unionByName(pending)


def grouped_variants(words: DataFrame, times: float = 2, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n).

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code point. ``form`` is the
    near word of largest n, ties to the smallest in code-point order, if that n is at least ``times`` the word's own,
    else null. ``root`` follows forms to the last; a word without form is its own. ``times`` over 1 keeps chains from
    closing. Words are distinct, neither null nor empty, and hold no space; an empty table gives an empty result.
    """
    if times <= 1:
        raise ValueError("forms must be more frequent than the words they stand for")
    words = cut(words.select("word", "n"))
    found = words.join(near_words(words, block), "word", "left")
    fits = F.col("best.n") >= F.col("n") * times
    table = cut(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, F.col("best.n")).alias("form_n")))
    last = roots(table.where(F.col("form").isNotNull()).select("word", "form"))
    return table.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
