"""Sharding by balanced label propagation.

Documents with equal links (here: equal texts) should share a shard, and all shards should have the same number of
rows, give or take one. Every document starts in a shard given by its hash. Again and again the documents of a group
look up their neighbours' shards by a join and ask to move to the one where most of them are, in a tie to one drawn
anew each time. A move is granted while that shard has room, or in a circle of moves of equal size (in the least case
two rows that change places), which needs none. Rows without linked partners then fill every shard up to its quota.

What moves are cells, the rows of a group with the same first shard: rows of a cell are alike, so the state has one
row for each, and a group of copies that holds a third of all rows is a few rows that differ in shard. A group larger
than a shard's room is split only as far as the room demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

BUCKETS = 4096
#: Parts of all requests of one size from one shard to another, so that they are not numbered in one task.
REQUEST_BUCKETS = 256
ROUNDS = 20
#: Turns without a move before the end; targets and ties differ from turn to turn.
QUIET = 4
#: Rows of cells up to this size that found no room are kept side by side.
SMALL = 64


def _by_shard(shard: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), shard + 1)


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = cells.agg(*(F.sum(F.when(F.col("shard") == k, F.col("n"))) for k in range(shards))).first()
    return [n or 0 for n in found]


def _queued(cells: DataFrame, turn: int) -> DataFrame:
    """Adds ``queue``: the rows that ask for the wanted shard in a cell's bucket, up to the cell itself.

    Groups queue in the order of a hash, another one in each turn; within a group small cells come first.
    """
    place = Window.partitionBy("wanted", "bucket").orderBy(F.xxhash64(F.lit(turn), "link"), "link", "n", "s0")
    return cells.withColumn("bucket", F.pmod(F.xxhash64("link"), F.lit(BUCKETS))).withColumn(
        "queue", F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _granted(queued: DataFrame, room: list[int], turn: int) -> DataFrame:
    """Adds ``granted`` to queued cells (link, s0, n, wanted, bucket, queue): true while the wanted shard has room."""
    upto = Window.partitionBy("wanted").orderBy(F.xxhash64(F.lit(turn), "bucket"), "bucket")
    sums = (
        queued.where("wanted is not null").groupBy("wanted", "bucket").agg(F.sum("n").alias("own"))
        .withColumn("before", F.sum("own").over(upto) - F.col("own")).drop("own")
    )  # at most BUCKETS rows for each shard
    fits = F.col("before") + F.col("queue") <= _by_shard(F.col("wanted"), room)
    return (
        queued.join(F.broadcast(sums), ["wanted", "bucket"], "left")
        .withColumn("granted", F.coalesce(fits, F.lit(False))).drop("bucket", "queue", "before")
    )


def _circles(asked: dict[int, dict[int, int]]) -> dict[tuple[int, int], int]:
    """How many of the moves ``asked[a][b]`` from a to b can be made in circles, so that no place gains or loses.

    Takes circles out until none is left; changes ``asked``.
    """
    granted: dict[tuple[int, int], int] = {}
    for start in list(asked):
        path, at = [start], {start: 0}
        while path:
            here = path[-1]
            there = next(iter(asked.get(here, ())), None)
            if there is None:  # no circle leads through here
                del at[path.pop()]
                if path:
                    del asked[path[-1]][here]
            elif there in at:
                circle = [*path[at[there] :], there]
                steps = list(zip(circle, circle[1:], strict=False))
                n = min(asked[a][b] for a, b in steps)
                for a, b in steps:
                    granted[a, b] = granted.get((a, b), 0) + n
                    asked[a][b] -= n
                    if not asked[a][b]:
                        del asked[a][b]
                for place in path[at[there] + 1 :]:
                    del at[place]
                del path[at[there] + 1 :]
            else:
                at[there] = len(path)
                path.append(there)
    return granted


def _allowed(requests: list[tuple[int, int, int, int]], free: list[int]) -> list[tuple[int, int, int, int]]:
    """(shard, wanted, n, allowed) for requests (shard, wanted, n, how many); brings ``free``, the room, up to date.

    Room is a place of its own that everyone may come from and as many may go to as fit in.
    """
    out, room, unlimited = [], -1, 1 << 62
    for size in sorted({n for _, _, n, _ in requests}):
        asked: dict[int, dict[int, int]] = {}
        for shard, wanted, n, count in requests:
            if n == size:
                asked.setdefault(shard, {})[wanted] = count
        asked[room] = dict.fromkeys(asked, unlimited)
        for k, rows in enumerate(free):
            if rows >= size:
                asked.setdefault(k, {})[room] = rows // size
        for (a, b), count in _circles(asked).items():
            if a == room:
                free[b] += size * count
            elif b == room:
                free[a] -= size * count
            else:
                out.append((a, b, size, count))
    return out


def _moved(asks: DataFrame, allowed: list[tuple[int, int, int, int]], turn: int) -> DataFrame:
    """Cells (link, s0, n, shard) after as many of the requests (shard, wanted, n) as are allowed."""
    request = ["shard", "wanted", "n"]
    bucketed = asks.withColumn("bucket", F.pmod(F.xxhash64(F.lit(turn), "link"), F.lit(REQUEST_BUCKETS)))
    asking = bucketed.where("wanted is not null")
    upto = Window.partitionBy(*request).orderBy("bucket")
    before = (
        asking.groupBy(*request, "bucket").agg(F.count("*").alias("own"))
        .withColumn("before", F.sum("own").over(upto) - F.col("own")).drop("own"))
    limits = asks.sparkSession.createDataFrame(allowed, "shard int, wanted int, n long, allowed long")
    place = F.row_number().over(Window.partitionBy(*request, "bucket").orderBy("link", "s0"))
    numbered = (
        asking.withColumn("place", place).join(before, [*request, "bucket"]).join(F.broadcast(limits), request, "left")
        .withColumn("shard", F.when(F.col("before") + F.col("place") <= F.col("allowed"), F.col("wanted"))
                    .otherwise(F.col("shard"))))
    names = ["link", "s0", "n", "shard"]
    return asks.where("wanted is null").select(names).unionAll(numbered.select(names))


def propagate(cells: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Cells (link, s0, n, shard) after label propagation; null shards where there was no room at all.

    In every other turn groups ask only for shards with room for one of their cells elsewhere, else for any. Ends when no move
    is granted any more, or after ``rounds``. Each move brings a row to at least as many of its group, so none comes
    back.
    """
    shards = len(quotas)
    free = [q - n for q, n in zip(quotas, _loads(cells, shards), strict=True)]
    quiet = 0
    for turn in range(rounds):
        cells = cells.repartition("link")  # both sums and the join below keep to it
        there = cells.groupBy("link", "shard").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
        # One entry for each shard; in a tie all of a group ask for the same one.
        neighbours = there.groupBy("link").agg(
            F.collect_list(F.struct("n", F.xxhash64(F.lit(turn), "link", "shard").alias("drawn"), "shard", "least")).alias("all"),
            F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("by_shard"))
        open_to = F.filter("all", lambda s: F.exists("all", lambda o: (o["shard"] != s["shard"]) & (o["n"] <= s["n"]) & (
            o["least"] <= _by_shard(s["shard"], free)))) if turn % 2 == 0 else F.col("all")
        neighbours = neighbours.select("link", "by_shard", F.array_max(open_to).alias("most"))
        better = (F.col("most.n") >= F.element_at("by_shard", F.col("shard"))) & (F.col("most.shard") != F.col("shard"))
        asks = cut(cells.join(neighbours, "link").select(
            "link", "s0", "n", "shard", F.when(better, F.col("most.shard")).alias("wanted")))
        # At most one row for each pair of shards and size of a cell.
        requests = asks.where("wanted is not null").groupBy("shard", "wanted", "n").agg(F.count("*")).collect()
        if not requests and turn % 2:
            break
        allowed = _allowed([tuple(r) for r in sorted(requests)], free)
        quiet = 0 if allowed else quiet + 1
        if quiet == QUIET:
            break
        if allowed:
            cells = cut(_moved(asks, allowed, turn))
    if all(n >= 0 for n in free):
        return cells
    stay = _granted(cut(_queued(cells.withColumn("wanted", F.col("shard")), -1)), quotas, -1)
    return cut(stay.select("link", "s0", "n", F.when(F.col("granted"), F.col("shard")).alias("shard")))


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text: str = "text",
               keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, ``keep`` columns, size, text_crc32, law, shard, slot and grown_shard.

    size is the text's UTF-8 bytes plus one (1 for null). The law is ``rows``: shard sizes differ by one row at most,
    so grown_shard is null. slot numbers a shard's rows from 0 without gaps. Documents with equal texts are linked;
    null texts (crc null) link nothing, empty ones are equal texts. Repeated rows and null ids get slots of their own.
    Other columns are ignored; an empty table gives an empty result.
    """
    keep = keep or []
    link = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    own = cut(
        docs.select(
            F.col(id_col).alias("id"), F.struct(*keep, F.lit(0).alias("__")).alias("kept"), link.alias("link"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.col(text).cast("binary")).alias("crc"))
        .withColumn("spread", F.xxhash64(F.col("id").cast("string"), "link"))
        .withColumn("s0", F.pmod("spread", F.lit(shards)).cast("int"))
        .withColumn("bucket", F.pmod(F.xxhash64("spread"), F.lit(BUCKETS)).cast("int"))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    total = own.count()
    quotas = [total // shards + (k < total % shards) for k in range(shards)]
    of_link = Window.partitionBy("link")
    cells = (
        own.where("link is not null").groupBy("link", "s0").agg(F.count("*").alias("n"))
        .withColumn("all", F.sum("n").over(of_link)).where("all > 1").drop("all").withColumn("shard", F.col("s0"))
    )
    placed = propagate(cut(cells), quotas, rounds).select("link", "s0", "n", "shard")
    together = F.col("shard").isNull() & (F.col("n") <= SMALL)
    first = cut(
        own.join(placed, ["link", "s0"], "left")
        .withColumn("spread", F.when(together, F.xxhash64("link")).otherwise(F.col("spread")))
        .withColumn("bucket", F.pmod(F.xxhash64("spread"), F.lit(BUCKETS)).cast("int")).drop("n"))
    taken = _loads(first.where("shard is not null").withColumn("n", F.lit(1)), shards)
    # The rest is ranked, bucket by bucket, and cut where each shard is full.
    rest = _numbered(first.where("shard is null"), [])
    edges, upto = [], 0
    for quota, n in zip(quotas, taken, strict=True):
        upto += quota - n
        edges.append(upto)
    filled = rest.withColumn("shard", sum((F.when(F.col("place") >= e, 1).otherwise(0) for e in edges[:-1]), F.lit(0)))
    names = first.columns
    whole = cut(first.where("shard is not null").select(*names).unionAll(filled.select(*names)))
    return _numbered(whole, ["shard"]).select(
        F.col("id").alias(id_col), *(F.col(f"kept.{c}").alias(c) for c in keep), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def _numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``place``, gapless from 0 within ``by``: the place in a bucket plus the rows of the buckets before."""
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*by, "bucket").agg(F.count("*").alias("own"))
        .withColumn("start", F.coalesce(F.sum("own").over(before), F.lit(0))).drop("own")
    )  # at most BUCKETS rows for each shard
    within = Window.partitionBy(*by, "bucket").orderBy("spread", "uid")
    return (
        rows.withColumn("within", F.row_number().over(within)).join(F.broadcast(starts), [*by, "bucket"])
        .withColumn("place", F.col("start") + F.col("within") - 1).drop("start", "within")
    )
