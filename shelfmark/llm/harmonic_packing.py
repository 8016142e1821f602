"""Harmonic packing of token ids into training sequences.

Lengths fall into reciprocal-capacity classes: a document of class k is longer than
capacity / (k + 1) and at most capacity / k, and a bin of class k takes exactly k of them,
whole. What k documents leave free is filled by slices of one more document, the filler:
the next one to arrive when a bin is complete and the last filler is used up. So most documents
stay whole, one is cut for about each sequence, and a sequence is full to the last token. A document longer
than a sequence fills sequences of its own, and its rest is a filler or a document of its class.

Each worker fills the bins of its own rows, class by class, and knows nothing of the others:
no shuffle, no ranks, no collection; it holds one open bin for each class. At the end of a
partition what its unfinished bins hold is laid end to end and cut into full sequences, and the last tokens
into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.bpe_automaton import load
from shelfmark.llm.common import batch, rows, small_batches, texts

CAPACITY = 4096
#: Classes; the last takes as many of all shorter documents as surely fit.
CLASSES = 64
#: What ends a document.
END = 2
#: Sequence numbers of one partition: a partition's first is its number times this.
PER_PARTITION = 1 << 32

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_SQL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass
class Piece:
    """A run of a document's ids."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.ids[: 4 * length], self.doc_tokens), Piece(self.doc_id, self.start + length, self.ids[4 * length :], self.doc_tokens)


class Bins:
    """The open bins of one worker. Every method gives the rows (piece, sequence, offset) of the sequences that it completes."""

    def __init__(self, capacity: int = CAPACITY, first: int = 0, classes: int = CLASSES):
        self.capacity, self.next, self.classes = capacity, first, classes
        self.open: dict[int, list[Piece]] = {}
        #: What is left of the filler, and the complete bin that waits for one.
        self.filler: Piece | None = None
        self.waiting: list[Piece] = []

    def _close(self, pieces: list[Piece]) -> Iterator[tuple[Piece, int, int]]:
        at = 0
        for piece in pieces:
            yield piece, self.next, at
            at += len(piece)
        self.next += 1

    def _fill(self) -> Iterator[tuple[Piece, int, int]]:
        """Closes the waiting bin if the filler is enough for it."""
        room = self.capacity - sum(map(len, self.waiting))
        if room and self.filler:
            slice_, rest = self.filler.cut(room)
            self.waiting.append(slice_)
            self.filler = rest if len(rest) else None
            room -= len(slice_)
        if not room:
            full, self.waiting = self.waiting, []
            yield from self._close(full)

    def add(self, piece: Piece) -> Iterator[tuple[Piece, int, int]]:
        """One document, or what is left of one."""
        while len(piece) >= self.capacity:
            whole, piece = piece.cut(self.capacity)
            yield from self._close([whole])
        if not len(piece):
            return
        if self.waiting or (piece.start and not self.filler):
            self.filler = piece  # a bin waits only while there is none
            if self.waiting:
                yield from self._fill()
            return
        kind = min(self.capacity // len(piece), self.classes)
        bin_ = self.open.setdefault(kind, [])
        bin_.append(piece)
        if len(bin_) == kind:
            self.waiting, self.open[kind] = bin_, []
            yield from self._fill()

    def finish(self) -> Iterator[tuple[Piece, int, int]]:
        left = [*self.waiting, *([self.filler] if self.filler else []), *(p for _, bin_ in sorted(self.open.items()) for p in bin_)]
        self.open, self.filler, self.waiting = {}, None, []
        total = sum(map(len, left))
        sizes = [self.capacity] * (total // self.capacity) + [1 << k for k in range(self.capacity.bit_length() - 1, -1, -1) if total % self.capacity >> k & 1]
        for size in sizes:
            sequence: list[Piece] = []
            while size:
                piece = left.pop(0)
                if len(piece) > size:
                    piece, rest = piece.cut(size)
                    left.insert(0, rest)
                sequence.append(piece)
                size -= len(piece)
            yield from self._close(sequence)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    path: the vocabulary file, there on every executor; capacity: a power of two. ids
    are little-endian unsigned 32-bit. Every id of a document, its end mark included, is
    in exactly one piece; a null or empty text is the end mark alone; rows that repeat
    a doc_id, or have none, are packed one by one. An empty table gives an empty result.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    small_batches(docs.sparkSession)
    mark = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (_, encoder), bins = load(path), Bins(capacity, TaskContext.get().partitionId() * PER_PARTITION)

        def table(placed: list) -> pa.RecordBatch:
            return batch(PIECES, *zip(*((p.doc_id, p.start, len(p), p.ids, p.doc_tokens, sequence, offset) for p, sequence, offset in placed), strict=True))

        for ids, bodies in rows(batches, "doc_id", "text"):
            placed: list = []
            for doc, coded in zip(ids, encoder.encode_batch([b.decode() for b in bodies]), strict=True):
                coded += mark
                placed.extend(bins.add(Piece(doc, 0, coded, len(coded) // 4)))
            if placed:
                yield table(placed)
        if rest := list(bins.finish()):
            yield table(rest)

    return texts(docs, doc_id, text).mapInArrow(run, PIECES_SQL)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of what pack() returned: the training sequences; at most capacity ids each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
