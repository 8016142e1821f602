"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring is divided into a fixed number of cells. A document's hash names its cell;
from there it goes clockwise to the first virtual node whose shard has room. Only
the row count of each cell (bounded by the ring, not by the data) reaches the
driver, which walks the ring once and cuts each cell's rows into runs, a shard for
each. Everything that touches documents is DataFrame expressions: one shuffle of
ids by cell ranks the rows of a cell, and a broadcast of the runs places them. Rows that are
alike in id and text are ranked as one group, and a cell with very many rows, such as those of one id, is ranked in parts.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells on the ring: 2 to this power.
CELL_BITS = 14
#: Points of each shard on the ring.
VIRTUAL_NODES = 64
#: Rows of a cell, or of a part of one, that one task ranks, about.
PART_ROWS = 1 << 20
#: What a row takes besides its text.
ROW_BYTES = 16


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in clockwise order, one node a cell at most.

    A shard's nodes depend on its number alone but for taken cells, so a new shard leaves the others in place.
    """
    if shards * virtual_nodes > 1 << (bits - 1):
        raise ValueError("the ring needs more cells for so many virtual nodes")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            cell = xxhash.xxh64_intdigest(f"{shard}:{node}") >> (64 - bits)
            while cell in taken:
                cell = (cell + 1) % (1 << bits)
            taken[cell] = shard
    return sorted(taken.items())


def capacities(total: int, shards: int, load: float | None) -> list[int]:
    """Rows that each shard may hold: counts at most one apart, or load times the mean."""
    if load is None:
        return [total // shards + (s < total % shards) for s in range(shards)]
    if load < 1:
        raise ValueError("load below 1 leaves rows without a place")
    return [-(-int(load * total * 1000) // (shards * 1000)) + 1] * shards


def runs(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, past the last rank, shard, slot of the first) of each run of rows.

    First every shard takes the keys of its own arcs while it has room, then the keys
    that found it full go on clockwise, each to the first node whose shard has room.
    """
    room, cells, out, late = list(room), [c for c, _ in nodes], [], []
    for cell in sorted(counts):
        at, n = bisect_left(cells, cell) % len(nodes), counts[cell]
        take = min(n, room[nodes[at][1]])
        room[nodes[at][1]] -= take
        if take:
            out.append((cell, 0, take, nodes[at][1]))
        if take < n:
            late.append((cell, take, n, at))
    for cell, rank, n, at in late:
        while rank < n:
            at = (at + 1) % len(nodes)
            shard = nodes[at][1]
            if take := min(n - rank, room[shard]):
                room[shard] -= take
                out.append((cell, rank, rank + take, shard))
                rank += take
    used, placed = [0] * len(room), []
    for cell, lo, hi, shard in out:
        placed.append((cell, lo, hi, shard, used[shard]))
        used[shard] += hi - lo
    return placed


def ring_shards(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", load: float | None = None, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """One row for each row of docs: doc_id, size, text_crc32, shard, slot.

    load: a shard holds at most so many times the mean number of rows; None: counts are
    at most one apart. slot counts a shard's rows from 0 without gaps. A null text has
    no bytes; null ids hash like any other key; rows alike in id and text are placed
    one by one, in any order. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    key = F.col(f"`{doc_id}`")
    cell = F.shiftrightunsigned(F.xxhash64(key), 64 - CELL_BITS).cast("int")
    counts = {r["cell"]: r["n"] for r in docs.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = runs(counts, ring(shards, virtual_nodes), capacities(sum(counts.values()), shards, load))
    # A row for each run of a cell. Bounded by the ring: one for each cell, and one more for each time a shard fills up.
    table = spark.createDataFrame(found, "cell int, lo long, hi long, shard int, base long")
    rows = docs.select(key.alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(key).alias("hash"), cell.alias("cell"))
    before = _parts(rows, {c: -(-n // PART_ROWS) for c, n in counts.items() if n > PART_ROWS})
    alike = rows.join(F.broadcast(before), "cell", "left").withColumn("part", F.coalesce(_part(F.col("many")), F.lit(0)))
    alike = alike.groupBy("cell", "part", "hash", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"), F.first("starts").alias("starts"))
    order = Window.partitionBy("cell", "part").orderBy("hash", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(order), F.lit(0)) + F.coalesce(F.get("starts", F.col("part")), F.lit(0))
    ranked = alike.select("cell", "doc_id", "size", "text_crc32", first.alias("first"), "n")
    # A group may reach over several runs; each takes its share of it.
    met = ranked.join(F.broadcast(table), "cell").filter("first < hi AND first + n > lo")
    ranks = F.explode(F.sequence(F.greatest("first", "lo"), F.least(F.col("first") + F.col("n"), F.col("hi")) - 1))
    placed = met.select("doc_id", "size", "text_crc32", "shard", "base", "lo", ranks.alias("rank"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))


def _part(many: Column) -> Column:
    """The part of its cell in which a row is ranked: by its text, as a hot cell's rows may share one id."""
    return F.pmod(F.xxhash64("text_crc32", "size"), many).cast("int")


def _parts(rows: DataFrame, many: dict[int, int]) -> DataFrame:
    """(cell, many, starts) of the cells that are ranked in parts: where each part's ranks begin. As many parts as all rows have millions, about."""
    spark = rows.sparkSession
    hot = spark.createDataFrame(list(many.items()), "cell int, many int")
    if not many:
        return hot.withColumn("starts", F.array().cast("array<long>"))
    sizes: dict[int, list[int]] = {c: [0] * k for c, k in many.items()}
    for r in rows.join(F.broadcast(hot), "cell").groupBy("cell", _part(F.col("many")).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["cell"]][r["part"]] = r["n"]
    return spark.createDataFrame([(c, many[c], [0, *accumulate(n)][:-1]) for c, n in sizes.items()], "cell int, many int, starts array<long>")
