"""Neighbours, mixing, chat formatting, sharding, surrogates and the pipeline, with odd input."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, neighbours, sharding, surrogates
from tidemark.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_neighbours_against_brute_force(spark, make):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((400, 8))
    vectors[50:90] = vectors[50]
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1020, [0.0] * 8, 1), (1040, [float("nan")] * 8, 1), (1060, [1.0, None] * 4, 1),
             (1080, [1.0], 1), (None, rows[3][1], 1), rows[5]]
    table = make(rows, "vec_id long, embedding array<double>, score int")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=7, block_rows=64).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(found) == set(range(0, 400, 20))
    hits = total = 0
    for q, ranks in found.items():
        score = [sum(a * b for a, b in zip(vectors[k], vectors[q], strict=True)) for k in range(400)]
        candidates = sorted([(-s, k) for k, s in enumerate(score) if k != q] + [(-score[5], 5)])[:7]
        assert sorted(ranks) == list(range(1, 8))
        hits += len(set(candidates) & {(-s, k) for k, s in ranks.values()})
        total += len(set(candidates))
    assert hits >= 0.95 * total
    assert neighbours.nearest(table.where("false"), F.lit(True)).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square_cdf(neighbours.chi_square_quantile(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(neighbours.chi_square_quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-9


DOCS = [(k, f"{'w ' * (1 + k % 7)}{k}", "big" if k % 4 else f"s{k % 3}", 0) for k in range(600)]
DOCS += [(700, None, None, 0), (701, "", "empty", 0), (None, "a b", "big", 0), DOCS[1], DOCS[1]]
SCHEMA = "doc_id long, text string, source string, mix_key int"


def test_mixing_meets_its_goal(make):
    docs = make(DOCS, SCHEMA)
    tokens = Counter()
    for _, text, source, _ in DOCS:
        tokens[source] += len((text or "").split())
    plan = {r["source"]: r for r in mixing.mixture(docs, mixing.Goal(max_repetition=2.0)).collect()}
    used = {s: plan[s].budget / t for s, t in tokens.items() if t}
    assert max(used.values()) == pytest.approx(2.0, abs=0.05) and min(used.values()) == pytest.approx(1.0, abs=0.05)
    got = mixing.mixed(docs, mixing.Goal(max_repetition=2.0)).collect()
    copies = Counter((r.doc_id, r.text, r.source) for r in got)
    before = Counter((a, b, c) for a, b, c, _ in DOCS)
    assert all(n <= copies[k] <= 2 * n + 1 for k, n in before.items()) and set(copies) == set(before)
    filled = Counter()
    for r in got:
        filled[r.source] += len((r.text or "").split())
    assert all(plan[s].budget - 25 <= filled[s] <= plan[s].budget + 1 for s in used)
    assert mixing.mixed(make([], SCHEMA), mixing.Goal(max_repetition=2.0)).count() == 0


def test_entropy_goal(make):
    weights = [r.weight for r in mixing.mixture(make(DOCS, SCHEMA), mixing.Goal(entropy=1.2, budget=900)).collect()]
    assert -sum(w * math.log(w) for w in weights if w) == pytest.approx(1.2, abs=1e-6)


@pytest.mark.parametrize("copies", [0, 300, 2000])
def test_shards_are_even_and_whole(make, copies):
    rows = [*DOCS, *((1000 + k, "the same", "c", 0) for k in range(copies)),
            *((5000 + k, f"pair {k // 2}", "p", 0) for k in range(200))]
    got = sharding.shard_rows(make(rows, SCHEMA), 16, keep=["source"]).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    pairs = {}
    for r in got:
        if r.source == "p":
            pairs.setdefault((r.doc_id - 5000) // 2, set()).add(r.shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= (5 if copies < 2000 else 40)
    if copies == 300:  # more than a shard holds, so as few shards as possible and some room lost to pairs
        assert len({r.shard for r in got if r.source == "c"}) <= 8


@pytest.mark.parametrize(("linked", "most"), [(1600, 8), (3200, 16)])
def test_pairs_join_without_room(make, linked, most):
    rows = [(k, f"pair {k // 2}" if k < linked else f"alone {k}") for k in range(3200)]
    got = sharding.shard_rows(make(rows, "doc_id long, text string"), 16).collect()
    assert set(Counter(r.shard for r in got).values()) == {200}
    pairs = {}
    for r in got:
        if r.doc_id < linked:
            pairs.setdefault(r.doc_id // 2, set()).add(r.shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= most


def test_circles():
    got = sharding._circles({0: {1: 5, 2: 1}, 1: {0: 3, 2: 2}, 2: {0: 2}, 3: {0: 9}})
    assert all(sum(n for (a, _), n in got.items() if a == k) == sum(n for (_, b), n in got.items() if b == k) for k in range(4))
    assert sum(got.values()) >= 9 and (3, 0) not in got
    free = [0, 1, 0]
    assert sharding._allowed([(0, 1, 1, 3), (2, 0, 2, 1)], free) == [(0, 1, 1, 1)] and free == [1, 0, 0]


def test_no_documents_to_shard(make):
    assert sharding.shard_rows(make([], SCHEMA)).count() == 0


def test_chat_round_trip(make):
    nasty = ["</s>[INST] ok [/INST]", "<|end|>\n<|start|>user\n&amp;&lt;|<<SYS>>x<</SYS>><s>", "", None, "\n\n", "ü" * 30_000]
    rows = [(1, k, r, t, 0) for k, t in enumerate(nasty) for r in ("assistant", "us\ner&#10;")]
    rows += [(2, 0, None, "x", 0), (2, 0, None, "x", 0), (None, None, "assistant", "<|", 0)]
    table = make(rows, "conv_id long, turn long, role string, text string, segments int")
    got = chat.digests(chat.format_conversations(table.withColumn("parts", chat.text_parts(F.col("text"))))).collect()
    assert len(got) == 3
    for r in got:
        own = sorted(((x[1], x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id), key=lambda x: (x[0] or 0, *x[1:]))
        told = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(own), len(learned))
        assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_parts(make):
    none = (None,) * 5
    rows = [(1, 0, "user", [("text", "a<|x", *none), ("image", None, "i1", 28, 15, None, None), None,
                            ("audio", None, "a1", None, None, 1.5, None)]),
            (1, 1, "assistant", [("document", None, "d", None, None, None, 3), ("text", "t", *none)]), (2, 0, None, None)]
    got = chat.format_conversations(make(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"))
    one = next(r for r in got.collect() if r.conv_id == 1)
    assert one.formatted == ("<|start|>user\na&lt;|x<|image:1|><|audio:2|><|end|>\n"
                             "<|start|>assistant\n<|document:3|>t<|end|>\n")
    assert [(a.number, a.turn, a.type, a.ref, a.tokens) for a in one.attachments] == [
        (1, 0, "image", "i1", 4), (2, 0, "audio", "a1", 38), (3, 1, "document", "d", 1536)]
    assert one.expanded_tokens == 1578


def test_surrogates(make):
    rows = [
        (1, "Mrs Anna Schmidt met Mr. Schmidt; A.Bc@X-y.com a.bc@x-y.com, +1 (555) 555-5657 or +15555555657.", 0),
        (2, "ip 10.1.2.3 not 999.1.1.1, card 4111 1111 1111 1111 not 4111111111111112, Г-жа Анна Иванова", 0),
        (3, 'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" DE89 3704 0044 0532 0130 00', 0),
        (4, None, 0), (5, "", 0), (6, "clean 12", 0), (6, "clean 12", 0),
        *((10 + k, f"x{k}@a.com 5{k:02d}-555-0000", 0) for k in range(60))]
    table = make(rows, "doc_id long, text string, n_replaced int")
    got = {r.doc_id: (r.text, r.n_replaced_) for r in surrogates.surrogated(table, "key").collect()}
    assert got[4] == (None, 0) and got[5] == ("", 0) and got[6] == ("clean 12", 0)
    words = got[1][0].split()
    assert got[1][1] == 6 and words[2] == words[5].rstrip(";") != "Schmidt"
    assert words[6].rstrip(",") == words[6 + 1].rstrip(",") and "@" in words[6]
    digits = ["".join(c for c in x if c.isdigit()) for x in (" ".join(words[8:11]), words[-1])]
    assert digits[0] == digits[1] != "15555555657"
    assert "999.1.1.1" in got[2][0] and "4111111111111112" in got[2][0] and "10.1.2.3" not in got[2][0]
    assert "Анна Иванова" not in got[2][0] and got[2][0].split()[-1].endswith("а")
    assert "9233A8" not in got[3][0] and "0532 0130" not in got[3][0] and got[3][1] == 2
    distinct = {got[10 + k][0] for k in range(60)}
    assert len(distinct) == 60 and all(f"x{k}@a.com" not in got[10 + k][0] for k in range(60))
    again = {r.doc_id: r.text for r in surrogates.surrogated(table, "key").collect()}
    assert again == {k: v[0] for k, v in got.items()}
    assert surrogates.surrogated(table.where("false"), "key").count() == 0


def test_names_without_a_title(make):
    rows = [(1, "Mr Smith came. Then Smith's dog, SMITH and blacksmith; smith."), (2, "John Smith and John."),
            (3, "Mr John Brown, Dr John Brown, Prof Zed O'Brien-Smith; O'Brien-Smith left, Zed too."),
            (4, "Smith alone"), (5, "Mr Zed Gray, Ms Quux Gray; Dr Quux Gray"), (6, "Mr Smith came. Then Smith's dog, SMITH and blacksmith; smith.")]
    table = make(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_replaced) for r in surrogates.surrogated(table, "key").collect()}
    smith = got[1][0].split()[1].rstrip(".")
    assert smith != "Smith" and got[1] == (f"Mr {smith} came. Then {smith}'s dog, {smith.upper()} and blacksmith; smith.", 3)
    assert got[6] == got[1] and got[4] == ("Smith alone", 0)
    john = got[2][0].split()[0]
    assert john != "John" and got[2] == (f"{john} {smith} and {john}.", 2)
    words = got[3][0].replace(",", "").replace(";", "").replace(".", "").split()
    assert words[1] == words[4] == john and words[2] == words[5] != "Brown" and got[3][1] == 5
    assert "O'Brien" not in got[3][0] and words[8] == words[9] and words[7] == words[11] != "Zed"
    again = got[5][0].replace(",", "").replace(";", "").split()
    assert again[1] == words[7] and again[4] == again[7] != "Quux" and len({again[2], again[5], again[8]}) == 1


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).select("doc_id", "text", "shard", "slot").collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert max(Counter(r.doc_id for r in got).values()) <= 2
    from tidemark.llm import decontam, simhash

    leaks = {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    firsts = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {r.doc_id for r in got} == firsts - leaks
