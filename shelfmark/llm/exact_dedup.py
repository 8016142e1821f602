"""Exact deduplication with counting quotient filters.

Every partition folds the 64-bit fingerprints of its normalised texts into
counting quotient filters, one for each shard of the fingerprint space. The
filters of a shard merge without loss: their runs of sorted remainders are
merged, run by run, two filters at a time, and nothing is sorted again. Only rows
whose merged count is above one are compared byte by byte; the others are
known to be alone.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, one_row_each, rows, small_batches, texts

#: Fingerprints in a merged shard, about.
SHARD_ROWS = 1 << 20
#: Shards at least, so that small inputs too are dealt to many tasks.
LEAST_SHARD_BITS = 9
#: A list of repeated fingerprints is broadcast up to so many (8 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 1 << 20
#: A partition's filters are sent on when they hold so many fingerprints.
FLUSH_ROWS = 1 << 20


@dataclass
class CountingQuotientFilter:
    """Fingerprints of q + r bits as quotient runs of sorted remainders, each with its count.

    occupied has a bit for each quotient that has a run, run_ends a bit for each
    entry that ends one: together they give every remainder its quotient back, so
    nothing of a fingerprint is lost.
    """

    q: int
    r: int
    occupied: np.ndarray
    run_ends: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, fingerprints: np.ndarray, bits: int) -> CountingQuotientFilter:
        return cls.of_sorted(*np.unique(fingerprints, return_counts=True), bits)

    @classmethod
    def of_sorted(cls, f: np.ndarray, n: np.ndarray, bits: int) -> CountingQuotientFilter:
        """Of distinct fingerprints in ascending order and their counts."""
        q = min(bits - 1, max(1, int(len(f)).bit_length()))
        r = bits - q
        quotients = (f >> np.uint64(r)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients] = True
        ends = np.ones(len(f), bool)
        ends[:-1] = quotients[1:] != quotients[:-1]
        return cls(q, r, occupied, ends, f & np.uint64((1 << r) - 1), n.astype(np.int64))

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints, ascending, and their counts."""
        starts = np.concatenate([[0], self.run_ends[:-1].cumsum()]).astype(np.int64) if len(self.run_ends) else np.zeros(0, np.int64)
        quotients = np.flatnonzero(self.occupied).astype(np.uint64)[starts]
        return (quotients << np.uint64(self.r)) | self.remainders, self.counts

    def merge(self, *others: CountingQuotientFilter) -> CountingQuotientFilter:
        """One filter with the counts of all: merged two by two, smallest first."""
        every = sorted((x.items() for x in (self, *others)), key=lambda x: len(x[0]))
        while len(every) > 1:
            # Quotient, then remainder: the order of both filters, whatever their quotients' lengths.
            every = [merged(*every[k], *every[k + 1]) if k + 1 < len(every) else every[k] for k in range(0, len(every), 2)]
        return self.of_sorted(*every[0], self.q + self.r)

    def count(self, fingerprint: int) -> int:
        quotient = fingerprint >> self.r
        if not self.occupied[quotient]:
            return 0
        ends = np.flatnonzero(self.run_ends)
        run = int(self.occupied[:quotient].sum())
        lo, hi = (ends[run - 1] + 1 if run else 0), ends[run] + 1
        at = lo + np.searchsorted(self.remainders[lo:hi], np.uint64(fingerprint & ((1 << self.r) - 1)))
        return int(self.counts[at]) if at < hi and int(self.remainders[at]) == fingerprint & ((1 << self.r) - 1) else 0

    def to_bytes(self) -> bytes:
        wide = (self.r + 7) // 8
        rest = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        many = self.counts > 1
        return b"".join((struct.pack("<BBI", self.q, self.r, len(self.remainders)), np.packbits(self.occupied).tobytes(), np.packbits(self.run_ends).tobytes(), rest.tobytes(), np.packbits(many).tobytes(), self.counts[many].astype("<i8").tobytes()))

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        q, r, n = struct.unpack_from("<BBI", data)
        at = struct.calcsize("<BBI")

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.unpackbits(take((1 << q) + 7 >> 3), count=1 << q).astype(bool)
        ends = np.unpackbits(take(n + 7 >> 3), count=n).astype(bool)
        rest = np.zeros((n, 8), np.uint8)
        wide = (r + 7) // 8
        rest[:, :wide] = take(n * wide).reshape(n, wide)
        many = np.unpackbits(take(n + 7 >> 3), count=n).astype(bool)
        counts = np.ones(n, np.int64)
        counts[many] = take(8 * int(many.sum())).view("<i8")
        return cls(q, r, occupied, ends, rest.view("<u8").ravel().astype(np.uint64), counts)


def merged(f: np.ndarray, n: np.ndarray, g: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two ascending runs of distinct fingerprints with counts, as one: equal ones add up."""
    at = np.searchsorted(f, g)
    same = f[np.minimum(at, len(f) - 1)] == g if len(f) else np.zeros(len(g), bool)
    same &= at < len(f)
    n = n.copy()
    n[at[same]] += m[same]
    new = ~same
    place = at[new] + np.arange(int(new.sum()))
    old = np.ones(len(f) + len(place), bool)
    old[place] = False
    out, counts = np.empty(len(old), f.dtype), np.empty(len(old), np.int64)
    out[place], out[old], counts[place], counts[old] = g[new], f, m[new], n
    return out, counts


HASHED = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("text_sha256", pa.string()), ("text_key", pa.int64())])
NORMAL = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("normal", pa.binary()), ("text_key", pa.int64())])
FILTERS = pa.schema([("shard", pa.int64()), ("filter", pa.binary())])
REPEATED = pa.schema([("fp", pa.int64()), ("copies", pa.int64())])


def fingerprint(normal: bytes) -> int:
    return xxhash.xxh3_64_intdigest(normal)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, bodies, keys in rows(batches, "doc_id", "text", "text_key"):
        normal = [b.lower() for b in bodies]  # bytes.lower() changes A-Z only
        yield batch(HASHED, ids, _signed([fingerprint(b) for b in normal]), [hashlib.sha256(b).hexdigest() for b in normal], keys)


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, bodies, keys in rows(batches, "doc_id", "text", "text_key"):
        normal = [b.lower() for b in bodies]
        yield batch(NORMAL, ids, _signed([fingerprint(b) for b in normal]), normal, keys)


def _filters(shard_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            f = np.sort(np.concatenate(held))
            shards = (f >> np.uint64(64 - shard_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(shards)) + 1
            low = f & np.uint64((1 << (64 - shard_bits)) - 1)
            return batch(FILTERS, shards[np.concatenate([[0], cuts]).astype(np.int64)], [CountingQuotientFilter.build(x, 64 - shard_bits).to_bytes() for x in np.split(low, cuts)])

        for b in batches:
            if b.num_rows:
                held.append(b.column(0).to_numpy().view(np.uint64))
                size += b.num_rows
                if size >= FLUSH_ROWS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return build


def _merged(shard_bits: int):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        filters = [CountingQuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()]
        f, n = filters[0].merge(*filters[1:]).items()
        f = (f | (np.uint64(key[0].as_py()) << np.uint64(64 - shard_bits)))[n > 1]
        return pa.Table.from_arrays([pa.array(f.view(np.int64)), pa.array(n[n > 1])], schema=REPEATED)

    return merge


def repeated_fingerprints(hashed: DataFrame, total: int) -> DataFrame:
    """(fp, copies) of the fingerprints that the merged filters count more than once."""
    bits = max(LEAST_SHARD_BITS, (max(1, total) // SHARD_ROWS).bit_length())
    filters = hashed.select("fp").mapInArrow(_filters(bits), "shard long, filter binary")
    return filters.groupBy("shard").applyInArrow(_merged(bits), "fp long, copies long")


def _hashed_and_repeated(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row's fingerprints, and those that come more than once: (fp), broadcast where there are few."""
    hashed = Stored(source.mapInArrow(_hashed, "doc_id long, fp long, text_sha256 string, text_key long"), "fingerprints").df()
    repeated = Stored(repeated_fingerprints(hashed, hashed.count()), "repeated").df()
    few = repeated.count() <= BROADCAST_ROWS
    suspects = repeated.select("fp")
    return hashed, F.broadcast(suspects) if few else suspects


def _judged(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    source = texts(docs, doc_id, text)
    hashed, suspects = _hashed_and_repeated(source)
    bodies = source.mapInArrow(_normal, "doc_id long, fp long, normal binary, text_key long")
    groups = (
        bodies.join(suspects, "fp", "left_semi")
        .groupBy("fp", "normal")  # whole texts: equal fingerprints are verified byte by byte
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size", F.lit(True).alias("grouped"))
    )
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return hashed.join(groups, "text_sha256", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are after lower-casing A-Z; a null text is an
    empty one, and empty texts are copies of each other. The largest doc_id of a group
    stays. Rows that repeat both text and the largest doc_id are one document and all say
    kept; a null doc_id is never kept unless its whole group has none, whose keep_id is
    then null. An empty table gives an empty result.
    """
    return _judged(docs, doc_id, text)


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs, all columns unchanged, for each different text: one that exact_duplicates() keeps.

    Where several rows have the largest doc_id, one of them stays. Rows that share a doc_id and differ in text are judged by their texts.
    Null and empty texts are equal; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    source = texts(docs, doc_id, text)
    hashed, suspects = _hashed_and_repeated(source)
    # Of each group the winner comes from one aggregate, combined before the shuffle: a group of any size sends a row a task. Of rows with its id the least key.
    best = F.max(F.struct("doc_id", F.bitwise_not("text_key").alias("turned"))).alias("best")
    winners = source.mapInArrow(_normal, "doc_id long, fp long, normal binary, text_key long").join(suspects, "fp", "left_semi").groupBy("fp", "normal").agg(best)
    alone = hashed.join(suspects, "fp", "left_anti").select("doc_id", "text_key")
    stays = alone.unionByName(winners.select("best.doc_id", F.bitwise_not("best.turned").alias("text_key")))
    return one_row_each(docs, stays, doc_id, text)
