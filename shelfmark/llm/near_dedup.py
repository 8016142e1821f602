"""Near-duplicate documents with b-bit MinHash: exact components at Jaccard 0.75.

A document is its set of five-word shingles. Each minimum keeps its low bits, packed
into a short signature; bands of full minima generate candidates, bit counts on the
packed signatures estimate their similarity (agreement by chance taken off), and every link is
confirmed on the full sets. Equal sets are folded into one node first.

A group of near copies is not compared pair by pair. In each band the members are
matched with one leader, the member that shares most bands with others; what is linked is one
component. Only members of a band that are still in different components are compared further, in
tiles of bounded size: first each with its likeliest partner in another component, then, for
the few that remain apart, with all of them. Bitmaps of small sets rule out there what cannot be a link. So a link between different components
is never left out, and pairs inside a component cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, one_row_each, rows, small_batches, texts, words
from shelfmark.llm.components import components
from shelfmark.llm.minhash import permutations, shingle_hashes, signatures

#: Bands of so many minima: a pair at 0.75 shares none with a chance of 1 in 4 million.
BANDS, PLACES = 40, 4
BITS = 4
SEED = 8
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Deviations of the estimate below the threshold down to which a candidate is confirmed.
DEVIATIONS = 5
#: Sets up to this size also have a bitmap of hashed shingles, which bounds what two sets can share.
MAPPED, MAP_BITS = 512, 8192
#: Members of a band, and members apart, compared in one tile.
TILE = 1024
#: A list of ids is broadcast up to so many (8 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 1 << 20

NIBBLES = np.uint64(0x1111111111111111)

SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64())), ("text_key", pa.int64())])
SETS = pa.schema([("key", pa.binary()), ("shingles", pa.binary()), ("map", pa.binary())])
PAIRS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("other", pa.binary()), ("estimate", pa.float64())])
EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def shingle_set(body: bytes) -> np.ndarray:
    """The distinct shingles of a text, A-Z in lower case, sorted."""
    return np.unique(shingle_hashes(words(body.lower())))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def pack(signature: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, two to a byte."""
    low = (signature & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] | low[1::2] << 4).tobytes()


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each shingle's hash; empty for a set too large."""
    if len(shingles) > MAPPED:
        return b""
    bits = np.zeros(MAP_BITS, bool)
    bits[(shingles >> np.uint64(51)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def could_link(maps: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Whether sets can be similar enough by their bitmaps. Never wrong about a link: what
    a set shares is at most the bits in common and its own shingles that fell on a taken bit."""
    common = np.bitwise_count(maps & one).sum(-1, dtype=np.int64)
    hidden = np.minimum(sizes - np.bitwise_count(maps).sum(-1, dtype=np.int64), size - int(np.bitwise_count(one).sum()))
    most = np.minimum(common + hidden, np.minimum(sizes, size))
    return 100 * most >= percent * (sizes + size - most)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (rows of uint64) by counting bits; broadcasts."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    differ = np.bitwise_count(x & NIBBLES).sum(-1, dtype=np.int64)
    n, chance = a.shape[-1] * 16, 2.0**-BITS
    return ((n - differ) / n - chance) / (1 - chance)


def least_estimate(percent: int = PERCENT) -> float:
    j, chance, n = percent / 100, 2.0**-BITS, BANDS * PLACES
    agree = j + (1 - j) * chance
    return j - DEVIATIONS * (agree * (1 - agree) / n) ** 0.5 / (1 - chance)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough, exactly."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = permutations(BANDS * PLACES, SEED)
    for ids, bodies, keys in rows(batches, "doc_id", "text", "text_key"):
        sets = [shingle_set(x) for x in bodies]
        sig = signatures(sets, a, b)
        bands = sig.reshape(len(sets), BANDS, PLACES).astype(np.uint64)
        h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS)).copy()
        for k in range(PLACES):
            h = (h ^ bands[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        yield batch(SIGNED, ids, [len(s) for s in sets], [set_key(s) if len(s) else None for s in sets], [pack(s) for s in sig], [x.tolist() if len(s) else [] for x, s in zip(h.view(np.int64), sets, strict=True)], keys)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (bodies,) in rows(batches, "text"):
        sets = [s for s in map(shingle_set, bodies) if len(s)]
        yield batch(SETS, [set_key(s) for s in sets], [s.tobytes() for s in sets], [bitmap(s) for s in sets])


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for a, b, x, y in rows(batches, "a", "b", "sig_a", "sig_b"):
        e = estimates(np.frombuffer(b"".join(x), np.uint64).reshape(len(x), -1), np.frombuffer(b"".join(y), np.uint64).reshape(len(y), -1))
        yield batch(PAIRS, a, b, b, e)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, x, y in rows(batches, "a", "b", "set_a", "set_b"):
            good = [(p, q) for p, q, s, t in zip(a, b, x, y, strict=True) if linked(np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64), percent)]
            if good:
                yield batch(EDGES, *zip(*good, strict=True))

    return run


def _tiles(percent: int, best: bool):
    """Of each tile (rows in order of band, i, j): pairs of a member apart with members of other components."""
    least = least_estimate(percent)

    def match(tile: list[tuple]) -> Iterator[tuple]:
        apart, every = [r for r in tile if r[3]], [r for r in tile if not r[3]]
        if not apart or not every:
            return
        sig = np.frombuffer(b"".join([r[6] for r in every]), np.uint64).reshape(len(every), -1)
        sizes, comps = np.array([r[7] for r in every]), np.array([r[5] for r in every], dtype=object)
        mapped = np.flatnonzero([bool(r[8]) for r in every])
        maps = np.frombuffer(b"".join([r[8] for r in every]), np.uint64).reshape(len(mapped), MAP_BITS // 64)
        for r in apart:
            e = estimates(sig, np.frombuffer(r[6], np.uint64))
            good = (100 * np.minimum(sizes, r[7]) >= percent * np.maximum(sizes, r[7])) & (e >= least) & (comps != r[5])
            if r[8] and good.any():
                some = good[mapped]
                good[mapped[some]] = could_link(maps[some], sizes[mapped[some]], np.frombuffer(r[8], np.uint64), r[7], percent)
            hits = np.flatnonzero(good)
            if best and len(hits):
                hits = hits[[int(np.argmax(e[hits]))]]
            for k in hits.tolist():
                yield r[4], every[k][4], comps[k], float(e[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: list[tuple] = []
        for columns in rows(batches, "band", "i", "j", "apart", "key", "comp", "sig", "n", "map"):
            out: list[tuple] = []
            for r in zip(*columns, strict=True):
                if tile and r[:3] != tile[0][:3]:
                    out.extend(match(tile))
                    tile = []
                tile.append(r)
            if out:
                yield batch(PAIRS, *zip(*out, strict=True))
        if out := list(match(tile)):
            yield batch(PAIRS, *zip(*out, strict=True))

    return run


class _Search:
    """One run's tables and what is known of its components."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, percent: int):
        self.percent, self.source = percent, texts(docs, doc_id, text)
        #: Tables of a round, which go when its candidates are confirmed.
        self.scratch: list[Stored] = []
        #: Those of the whole search.
        self.tables: list[Stored] = []
        self.signed = Stored(self.source.mapInArrow(_sign, "doc_id long, n_shingles long, key binary, sig binary, bands array<long>, text_key long"), "signed").df()
        self.nodes = self.made(
            self.signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nodes"
        )
        banded = self.nodes.select("key", F.explode("bands").alias("band"))
        shared = Stored(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "shared")
        self.members = self.made(banded.join(shared.df(), "band"), "members")
        shared.drop()
        self.keys = self.made(self.members.groupBy("key").agg(F.sum("size").alias("popularity")), "keys")
        needed = self.nodes.join(self.keys, "key", "left_semi").select(F.col("first").alias("doc_id")).filter("doc_id IS NOT NULL")
        few = self.keys.count() <= BROADCAST_ROWS
        bodies = self.source.join(F.broadcast(needed) if few else needed, "doc_id", "left_semi")
        nameless = self.source.filter("doc_id IS NULL")
        self.sets = self.made(bodies.unionByName(nameless).mapInArrow(_sets, "key binary, shingles binary, map binary").dropDuplicates(["key"]).join(self.keys.select("key"), "key", "left_semi"), "sets")
        self.roots: Stored | None = None
        self.edges: DataFrame | None = None

    def made(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(Stored(df, name))
        return self.tables[-1].df()

    def done(self) -> None:
        for table in (*self.tables, *([self.roots] if self.roots else [])):
            table.drop()

    def held(self, df: DataFrame, name: str) -> DataFrame:
        self.scratch.append(Stored(df, name))
        return self.scratch[-1].df()

    def confirm(self, pairs: DataFrame | None) -> None:
        """Adds the links among the candidate pairs (a, b), if any."""
        if pairs is not None:
            self._confirm(pairs)
        for done in self.scratch:
            done.drop()
        self.scratch = []

    def _confirm(self, pairs: DataFrame) -> None:
        x = self.sets.select(F.col("key").alias("a"), F.col("shingles").alias("set_a"))
        y = self.sets.select(F.col("key").alias("b"), F.col("shingles").alias("set_b"))
        found = self.held(pairs.select("a", "b").join(x, "a").join(y, "b").mapInArrow(_confirmed(self.percent), "a binary, b binary"), "links")
        if found.isEmpty():
            return
        if self.roots is None:
            self.roots = components(found)
            return
        # The roots found so far, drawn together by the new links.
        up = self.roots.df()
        for end in ("a", "b"):
            found = found.join(up.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left").withColumn(end, F.coalesce(f"root_{end}", end)).select("a", "b")
        new = components(found)
        moved = new.df().select(F.col("node").alias("root"), F.col("root").alias("new"))
        merged = up.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
        fresh = new.df().join(up, "node", "left_anti")
        old, self.roots = self.roots, Stored(merged.unionByName(fresh), "roots")
        old.drop()
        new.drop()

    def components(self) -> DataFrame:
        if self.roots is None:
            return self.keys.select("key", F.col("key").alias("comp"))
        return self.keys.select("key").join(self.roots.df().withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("comp"))

    def leaders(self) -> DataFrame:
        """Each member with the leader of one of its bands: the one it is likeliest similar to."""
        popular = self.members.join(self.keys, "key")
        leader = popular.groupBy("band").agg(F.max(F.struct("popularity", "key")).alias("top")).select("band", F.col("top.key").alias("b"))
        leader = self.held(leader, "leaders")  # read anew, so that a join with a hot band can be split
        pairs = self.members.join(leader, "band").filter("key <> b").select(F.col("key").alias("a"), "b").distinct()
        sig = self.nodes.select("key", "sig")
        both = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        near = both.mapInArrow(_estimated, "a binary, b binary, other binary, estimate double").filter(F.col("estimate") >= least_estimate(self.percent))
        return near.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))

    def apart(self, best: bool) -> DataFrame | None:
        """Candidate pairs (a, b) between members of a band in different components; None where no band has such."""
        now = self.held(self.members.select("band", "key").join(self.components(), "key"), "now")
        several = self.held(now.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band"), "several")
        if several.isEmpty():
            return None
        mixed = self.held(now.join(several, "band", "left_semi"), "mixed")
        counts = mixed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c"))
        bands = counts.groupBy("band").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("all"))
        bands = bands.select("band", F.col("top.comp").alias("main"), F.ceil(F.col("all") / TILE).cast("int").alias("is"), F.ceil((F.col("all") - F.col("top.c")) / TILE).cast("int").alias("js"))
        bands = self.held(bands, "bands")
        rich = mixed.join(bands, "band").join(self.nodes.select("key", "sig", "n"), "key").join(self.sets.select("key", "map"), "key")
        own = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.col(n)).cast("int")
        every = rich.select("band", own("is", 1).alias("i"), F.explode(F.sequence(F.lit(0), F.col("js") - 1)).alias("j"), F.lit(False).alias("apart"), "key", "comp", "sig", "n", "map")
        alone = rich.filter("comp <> main").select("band", F.explode(F.sequence(F.lit(0), F.col("is") - 1)).alias("i"), own("js", 2).alias("j"), F.lit(True).alias("apart"), "key", "comp", "sig", "n", "map")
        dealt = every.unionByName(alone).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        found = dealt.mapInArrow(_tiles(self.percent, best), "a binary, b binary, other binary, estimate double")
        if best:
            found = found.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
        return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _judged(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    small_batches(docs.sparkSession)
    s = _Search(docs, doc_id, text, percent)
    s.confirm(s.leaders())
    # Stars first, then the likeliest partners, then whatever is still apart.
    s.confirm(s.apart(best=True))
    s.confirm(s.apart(best=False))
    comp = s.nodes.select("key", "first").join(s.components(), "key", "left").select("key", "first", F.coalesce("comp", "key").alias("comp"))
    comp = Stored(comp, "comps").df()
    least = Stored(comp.groupBy("comp").agg(F.min("first").alias("component_id")), "least").df()
    s.done()
    final = comp.join(least, "comp").select("key", "comp", "component_id")
    out = s.signed.select("doc_id", "n_shingles", "key", "text_key").join(final, "key", "left")
    component = F.when(F.col("comp").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "comp", "text_key")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach. A null text, or one without
    words, has no shingles and no links: it is its own component. Rows that repeat a doc_id are
    documents of their own; rows of a component without any doc_id have a null one and
    say kept. An empty table gives an empty result.
    """
    return _judged(docs, doc_id, text, percent).drop("comp", "text_key")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns unchanged, that near_duplicates() keeps: one document of each group.

    Where several rows of a group have its smallest doc_id, or none has one, one of them stays. Rows without words are in no group: all stay.
    """
    stays = _judged(docs, doc_id, text, percent).filter("kept AND comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*")
    worded = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return one_row_each(docs.filter(worded), stays, doc_id, text).unionByName(docs.filter(~worded))
