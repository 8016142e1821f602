"""MinHash fingerprints of documents, and links between similar ones.

A document is the set of its shingles: five words in a row, or all its words if it
has fewer. Each of many universal hash functions permutes the shingles' hashes, and the
least value under each is the signature. Two signatures agree in a place as often as the
sets' Jaccard similarity says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, rows, small_batches, texts, words

SHINGLE = 5
#: Permutations of a fingerprint, and bits of each minimum that it keeps.
PERMUTATIONS, BITS = 128, 8
SEED = 1
#: Shingles hashed together: what fits a processor's cache.
BLOCK = 1 << 15
#: The minimum of no shingles.
EMPTY = 0xFFFFFFFF


def permutations(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of universal hash functions on 64 bits; the high 32 bits of a * x + b count."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def shingle_hashes(ws: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of size words; of the whole sequence if it is shorter; none for no words."""
    if not ws:
        return np.zeros(0, np.uint64)
    h = word_hashes(ws)
    out = np.full(max(1, len(h) - size + 1), np.uint64(min(len(h), size)))
    for k in range(min(size, len(h))):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def signatures(shingles: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """documents x permutations: the least 32-bit value under each; EMPTY for no shingles."""
    out = np.full((len(shingles), len(a)), EMPTY, np.uint32)
    k = 0
    while k < len(shingles):
        end, size = k, 0
        while end < len(shingles) and (size == 0 or size + len(shingles[end]) <= BLOCK):
            size += len(shingles[end])
            end += 1
        some = [j for j in range(k, end) if len(shingles[j])]
        if some:
            x = np.concatenate([shingles[j] for j in some])
            starts = np.cumsum([0] + [len(shingles[j]) for j in some[:-1]])
            y = np.empty_like(x)
            for p in range(len(a)):
                np.multiply(x, a[p], out=y)
                y += b[p]
                high = y.view(np.uint32)[1::2]
                out[some, p] = np.minimum.reduceat(high, starts)
        k = end
    return out


def fingerprint(signature: np.ndarray) -> bytes:
    """The low bits of each minimum."""
    return (signature & np.uint32((1 << BITS) - 1)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The similarity that two fingerprints tell, agreements by chance taken off, 0 to 1."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    equal, chance = float(np.mean(x == y)), 2.0**-BITS
    return max(0.0, (equal - chance) / (1 - chance))


def successor(text: str | None, following: str | None) -> str:
    """The edited text: the last quarter replaced by as many code points of the next document, or all it has."""
    text, following = text or "", following or ""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


FINGERPRINTS = pa.schema(
    [("place", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edge", pa.string()), ("body", pa.binary())]
)
FINGERPRINTS_SQL = "place long, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, edge string, body binary"


class Fingerprinter:
    """Fingerprints of whole texts and of their edited forms."""

    def __init__(self, permutation_count: int = PERMUTATIONS):
        self.a, self.b = permutations(permutation_count)

    def of(self, bodies: list[bytes]) -> list[bytes]:
        return [fingerprint(s) for s in signatures([shingle_hashes(words(b)) for b in bodies], self.a, self.b)]

    def compared(self, place: int, ids: list, bodies: list[str], prints: list[bytes]) -> list[tuple]:
        """Rows of FINGERPRINTS for all but the last of the documents, which are in order of their ids."""
        edited = [successor(t, u).encode() for t, u in zip(bodies, bodies[1:], strict=False)]
        return [
            (place, doc, len(text), hashlib.sha256(e).hexdigest(), f, g, likeness(f, g), likeness(f, after), None, None)
            for doc, text, e, f, g, after in zip(ids, bodies, edited, prints, self.of(edited), prints[1:], strict=False)
        ]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition: rows for all documents but the last, and its first and last whole, for the seams."""
    from pyspark import TaskContext

    place, maker = TaskContext.get().partitionId(), Fingerprinter()
    ids, bodies, prints = [], [], []

    def edge(kind: str) -> pa.RecordBatch:
        return batch(FINGERPRINTS, *zip((place, ids[-1], None, None, prints[-1], None, None, None, kind, bodies[-1].encode()), strict=True))

    for new_ids, raw in rows(batches, "doc_id", "text"):
        first = not ids
        new = [b.decode() for b in raw]
        ids, bodies, prints = ids[-1:] + new_ids, bodies[-1:] + new, prints[-1:] + maker.of(raw)
        if first:
            yield batch(FINGERPRINTS, *zip((place, ids[0], None, None, prints[0], None, None, None, "first", raw[0]), strict=True))
        if done := maker.compared(place, ids, bodies, prints):
            yield batch(FINGERPRINTS, *zip(*done, strict=True))
    if ids:
        yield edge("last")


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maker = Fingerprinter()
    for ids, bodies, prints, next_bodies, next_prints in rows(batches, "doc_id", "body", "fingerprint", "next_body", "next_fingerprint"):
        out = []
        for doc, body, f, following, g in zip(ids, bodies, prints, next_bodies, next_prints, strict=True):
            out += maker.compared(0, [doc, None], [body.decode(), following.decode()], [f, g])
        yield batch(FINGERPRINTS, *zip(*out, strict=True))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are in the order of their ids, null ids first, texts breaking ties; after
    the last comes the first, and a single document follows itself. A null text is an
    empty one; texts without words are alike and unlike all others. Rows alike in id and text follow each other
    in any order. Each text crosses the network once, to its place in the order; only the first and last row of each
    partition meet again. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    # Rows alike in id and text differ in the last key alone, so however many there are, they are dealt to several ranges.
    ordered = texts(docs, doc_id, text).repartitionByRange(F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    made = Stored(ordered.mapInArrow(_run, FINGERPRINTS_SQL), "fingerprints").df()
    # A row for each partition: no more than there are tasks. They are put in order without their texts, which then follow.
    ends = made.filter("edge IS NOT NULL")
    order = Window.orderBy("place")
    firsts = ends.filter("edge = 'first'").select("place").select("place", F.row_number().over(order).alias("k"))
    lasts = ends.filter("edge = 'last'").select("place").select("place", F.row_number().over(order).alias("k"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    met = lasts.withColumn("k", F.col("k") % F.col("n") + 1).join(firsts.withColumnRenamed("place", "next_place"), "k").select("place", "next_place")
    after = ends.filter("edge = 'first'").select(F.col("place").alias("next_place"), F.col("body").alias("next_body"), F.col("fingerprint").alias("next_fingerprint"))
    seams = ends.filter("edge = 'last'").select("place", "doc_id", "body", "fingerprint").join(met, "place").join(after, "next_place").mapInArrow(_seams, FINGERPRINTS_SQL)
    return made.filter("edge IS NULL").unionByName(seams).drop("place", "edge", "body")


BANDED = pa.schema([("doc_id", pa.int64()), ("set", pa.binary()), ("shingles", pa.binary()), ("bands", pa.list_(pa.int64()))])
#: Bands of a signature and places of each: a pair at similarity 0.75 is missed once in 40 million.
BANDS, PLACES = 32, 3
#: Members of a band that one side of a tile holds on average.
TILE = 1024
PAIRED = pa.schema([("a", pa.int64()), ("b", pa.int64())])
PAIRED_SQL = "a long, b long"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs (a < b) of a tile's two sides; its rows, sorted by band, i, j, come with a member's own part (own)."""
    at, sides = None, ([], [])

    def pairs() -> Iterator[pa.RecordBatch]:
        left, right = (np.array(x, np.int64) for x in sides)
        for x in left.tolist():
            # Within one part each pair once; between two parts all.
            other = right[right > x] if at[1] == at[2] else right
            if len(other):
                yield batch(PAIRED, np.minimum(other, x), np.maximum(other, x))

    for columns in rows(batches, "band", "i", "j", "own", "doc_id"):
        for band, i, j, own, doc in zip(*columns, strict=True):
            if (band, i, j) != at:
                if at is not None:
                    yield from pairs()
                at, sides = (band, i, j), ([], [])
            if own == i:
                sides[0].append(doc)
            if own == j:
                sides[1].append(doc)
    if at is not None:
        yield from pairs()


def _candidates(banded: DataFrame) -> DataFrame:
    """Every pair (a < b) of members of a band, once. A large band is dealt to parts, and each two parts (i <= j) meet in a tile."""
    parts = Stored(banded.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "parts").df()
    own = banded.join(parts, "band").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    with_all = own.select("band", "doc_id", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))
    tiles = with_all.select("band", F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j"), "own", "doc_id")
    return tiles.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(_tiles, PAIRED_SQL).distinct()


def _classes(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set) for each row of docs, and (set, doc_id, shingles, bands) for each different set of shingles that a row with an id has: its least id.

    set is a 128-bit hash of the set, null for no words; bands are of the first minima of the fingerprint's own signature.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (x[: BANDS * PLACES] for x in permutations(PERMUTATIONS))
        for ids, bodies in rows(batches, "doc_id", "text"):
            sets = [np.unique(shingle_hashes(words(x))) for x in bodies]
            sig = signatures(sets, a, b).reshape(len(sets), BANDS, PLACES)
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield batch(BANDED, ids, keys, [s.tobytes() for s in sets], [[xxhash.xxh3_64_intdigest(bytes([k]) + band.tobytes()) >> 1 for k, band in enumerate(s)] if len(x) else [] for s, x in zip(sig, sets, strict=True)])

    made = Stored(texts(docs, doc_id, text).select("doc_id", "text").mapInArrow(run, "doc_id long, set binary, shingles binary, bands array<long>"), "shingles").df()
    # Copies are folded below the shuffle: a set of any number of rows sends a row a task.
    sets = made.filter("set IS NOT NULL AND doc_id IS NOT NULL").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("shingles", "bands")).alias("own"))
    return made.select("doc_id", "set"), Stored(sets.select("set", "doc_id", "own.shingles", "own.bands"), "sets").df()


def near_links(docs: DataFrame, threshold: float = 0.75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, class_id, n_links.

    class_id is the least doc_id of the rows that have the same set of shingles, n_links the number of other classes that are similar
    enough: copies are in their class and no links. Rows without words are in no class, those whose set no row with an id has neither; they have no links. An empty table gives an empty result.
    """
    members, sets = _classes(docs, doc_id, text)
    pairs = Stored(_similar(sets, threshold), "links").df()
    ends = pairs.select(F.col("a").alias("class_id")).unionAll(pairs.select("b"))
    counts = ends.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    classes = sets.select("set", F.col("doc_id").alias("class_id")).join(counts, "class_id", "left")
    return members.join(classes, "set", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def similar_pairs(docs: DataFrame, threshold: float = 0.75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Links between classes of documents with one set of shingles: a, b (least doc_id of each, a < b), jaccard >= threshold. near_links() says which class a row is in.

    Bands of the fingerprint's own signature are joined in Spark, and the Jaccard similarity of each candidate pair
    is verified on the full sets. There are as many members of a band as
    different sets; all pairs of them are verified, in tiles if the band is large. Sets without any doc_id have no links, and neither
    have null texts or those without words. Ties do not arise: every pair that is similar enough is returned. An empty table gives an empty result.
    """
    return _similar(_classes(docs, doc_id, text)[1], threshold)


def _similar(sets: DataFrame, threshold: float) -> DataFrame:
    pairs = _candidates(sets.select("doc_id", F.explode(F.array_distinct("bands")).alias("band")))
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("jaccard", pa.float64())])
        for one, other, xs, ys in rows(batches, "a", "b", "x", "y"):
            out = []
            for p, q, x, y in zip(one, other, xs, ys, strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                out.append((p, q, both / (len(s) + len(t) - both)))
            yield batch(schema, *zip(*out, strict=True))

    return pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long, jaccard double").filter(F.col("jaccard") >= threshold)
