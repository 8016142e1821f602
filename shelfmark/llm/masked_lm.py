"""Masked pseudo-likelihood scores from a bidirectional window network.

Each word of a document is hidden in turn and predicted from the words on both sides
of it; the sum of the log-probabilities is the document's score. The network embeds the
window's words by place, has one hidden layer, and predicts in two steps: the word's class,
then the word within its class. It is trained in numpy on every document of the corpus: each
partition goes through its own text from the weights of the round before, and the weights,
weighted by the words they saw, are averaged in Spark.

The network knows the most frequent words and buckets of the others. A word of a bucket has the bucket's
probability times its own share in it, from counts of every word of the corpus: the vocabulary grows
with the corpus, what a scorer holds does not. Texts are read once, into blocks of about two million words with
a list of the distinct words of each; only these lists are counted in Spark, and the counts return to their blocks. A word is in
a block's list once, so no key has more rows than there are blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, rows, small_batches, texts, words

#: Words with an id of their own, and ids that the others share by their first and last letters.
FREQUENT, SHARED = 512, 512
CLASSES = 32
#: Words on either side, sizes of an embedding and of the hidden layer.
SIDE, EMBED, HIDDEN = 2, 16, 32
#: Rounds over the corpus; in each, every STRIDE-th word of each text is predicted, starting one further on in the next round:
#: with as many rounds as the stride, every word of every text is a target once.
STRIDE = 4
ROUNDS = STRIDE
STEP, RATE, SEED = 2048, 0.01, 5
#: Words scored together: what fits a processor's cache.
TOGETHER = 1 << 12
#: Rows of a batch in which a block's words are streamed to it.
WORD_ROWS = 1 << 15
#: Words of a block, about.
BLOCK_WORDS = 1 << 21
#: Averages are made in so many groups at most before the driver joins them.
GROUPS = 32

VOCABULARY = FREQUENT + SHARED
NOTHING = VOCABULARY  # before the first word and after the last

ENTRY = pa.struct([("word", pa.binary()), ("n", pa.int64())])
BLOCKS = pa.schema([("block", pa.int64()), ("body", pa.binary()), ("vocabulary", pa.list_(ENTRY))])
BLOCKS_SQL = "block long, body binary, vocabulary array<struct<word: binary, n: long>>"
CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("own", pa.float64())])
CODED_SQL = "doc_id long, ids binary, own double"
TRAINED = pa.schema([("place", pa.int64()), ("weights", pa.binary()), ("seen", pa.int64())])
SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("own", pa.float64())])


class _Block:
    """Texts as indices into a list of their distinct words."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.docs, self.lengths, self.codes, self.size = [], [], [], 0

    def add(self, ids: list, bodies: list[bytes]) -> None:
        split = [words(b.lower()) for b in bodies]
        flat = pc.dictionary_encode(pa.array([w for ws in split for w in ws], pa.binary()))
        known = self.words
        table = np.array([known.setdefault(w, len(known)) for w in flat.dictionary.to_pylist()], np.uint32)
        if len(flat):
            self.codes.append(table[flat.indices.to_numpy()])
        self.docs += ids
        self.lengths += [len(ws) for ws in split]
        self.size += len(flat)

    def row(self, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        counts = np.bincount(codes, minlength=len(self.words))
        entries = pa.StructArray.from_arrays([pa.array(list(self.words), pa.binary()), pa.array(counts[: len(self.words)], pa.int64())], fields=list(ENTRY))
        vocabulary = pa.ListArray.from_arrays(pa.array([0, len(self.words)], pa.int32()), entries)
        return batch(BLOCKS, [number], [packed(self.docs, self.lengths, codes)], vocabulary)


def packed(docs: list[int | None], lengths: list[int], codes: np.ndarray) -> bytes:
    """A block's texts as bytes: how many, their ids, which have one, their lengths, and the codes: low halves, then the high ones, which are nearly all zero."""
    ids = np.array([d or 0 for d in docs], "<i8")
    named = np.array([d is not None for d in docs], np.uint8)
    return b"".join((len(docs).to_bytes(8, "little"), ids.tobytes(), named.tobytes(), np.array(lengths, "<i8").tobytes(), codes.astype("<u4").view("<u2").reshape(-1, 2).T.tobytes()))


def unpacked(body: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, lengths and codes of packed()."""
    n = int.from_bytes(body[:8], "little")
    ids, named = np.frombuffer(body, "<i8", n, 8), np.frombuffer(body, np.uint8, n, 8 + 8 * n)
    low, high = np.frombuffer(body, "<u2", -1, 8 + 17 * n).reshape(2, -1).astype(np.int64)
    return pa.array(ids, mask=named == 0), np.frombuffer(body, "<i8", n, 8 + 9 * n), low | high << 16


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, block = TaskContext.get().partitionId() << 31, _Block()
    for ids, bodies in rows(batches, "doc_id", "text"):
        block.add(ids, bodies)
        if block.size >= BLOCK_WORDS:
            yield block.row(number)
            number, block = number + 1, _Block()
    if block.docs:
        yield block.row(number)


def read(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, text): block, body (its texts, packed), vocabulary (distinct words and their numbers)."""
    return docs.mapInArrow(_read, BLOCKS_SQL)


def word_totals(blocks: DataFrame) -> DataFrame:
    """A row for each word of each block's list: block, at (its place there), total (in all texts), bucket (the id it would share).

    first_block and first_at, the least place of the word in any list, tell words apart; word itself stands there alone, elsewhere it is null.
    """
    each = blocks.select("block", F.posexplode("vocabulary").alias("at", "entry")).select("block", "at", "entry.word", "entry.n")
    by = Window.partitionBy("word")
    counted = each.select("block", "at", "word", F.sum("n").over(by).alias("total"), F.min(F.struct("block", "at")).over(by).alias("first"))
    first_block, first_at = F.col("first.block"), F.col("first.at")
    word = F.when((first_block == F.col("block")) & (first_at == F.col("at")), F.col("word"))
    return counted.select("block", "at", "total", _shared(F.col("word")).cast("short").alias("bucket"), first_block.alias("first_block"), first_at.alias("first_at"), word.alias("word"))


def most_frequent(totals: DataFrame, size: int = FREQUENT) -> list[bytes]:
    """The most frequent words of all texts, ties in byte order; size bounds what is collected."""
    return [bytes(r["word"]) for r in totals.filter("word IS NOT NULL").orderBy(F.desc("total"), "word").limit(size).collect()]


def shared_id(word: bytes) -> int:
    """The id of a rarer word: by its first two and last two bytes."""
    return FREQUENT + zlib.crc32(word[:2] + b" " + word[-2:]) % SHARED


def _shared(word: Column) -> Column:
    """shared_id() in Spark."""
    ends = F.concat(F.substring(word, 1, 2), F.lit(b" "), F.when(F.octet_length(word) < 2, word).otherwise(F.substring(word, -2, 2)))
    return FREQUENT + F.crc32(ends) % SHARED


def _numbered(totals: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(block, at, id, share): each listed word's id, and the log of its part of all words of that id; 0 for a word that has its own."""
    spark = totals.sparkSession
    named = totals.filter("word IS NOT NULL")
    ids = spark.createDataFrame([(bytearray(w), k) for k, w in enumerate(vocabulary)], "word binary, own_id short")
    frequent = named.join(F.broadcast(ids), "word").select("first_block", "first_at", "own_id")  # FREQUENT rows at most
    buckets = named.join(F.broadcast(ids), "word", "left_anti").groupBy("bucket").agg(F.sum("total").alias("all"))  # SHARED rows at most
    known = totals.select("block", "at", "total", "bucket", "first_block", "first_at").join(F.broadcast(frequent), ["first_block", "first_at"], "left").join(F.broadcast(buckets), "bucket", "left")
    return known.select("block", "at", F.coalesce("own_id", "bucket").alias("id"), F.when(F.col("own_id").isNull(), F.log(F.col("total") / F.col("all"))).otherwise(0.0).cast("float").alias("share"))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block its words (id, share) in their places, then its texts: a row for each text with ids (unsigned 16-bit) and own, the sum of its words' shares."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        ids, share, bodies = (b.column(b.schema.get_field_index(c)) for c in ("id", "share", "body"))
        ids, share = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (ids, share))
        begin = 0
        for end in [*np.flatnonzero(bodies.is_valid().to_numpy(zero_copy_only=False)).tolist(), None]:
            if len(ids[begin:end]):
                held.append((ids[begin:end], share[begin:end]))
            if end is None:
                break
            id_of, log_of = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int16), np.zeros(0))
            docs, lengths, line = unpacked(bodies[end].as_py())
            ends = np.concatenate([[0], np.cumsum(lengths)])
            sums = np.concatenate([[0.0], np.cumsum(log_of.astype(np.float64)[line])])
            coded = id_of.astype(np.uint16)[line].tobytes()
            yield batch(CODED, docs, [coded[2 * x : 2 * y] for x, y in zip(ends.tolist(), ends[1:].tolist(), strict=False)], sums[ends[1:]] - sums[ends[:-1]])
            held, begin = [], end + 1


def _dealt(block: Column, tasks: int) -> Column:
    """The task of a block: a partition's blocks, and those of its neighbours, go to tasks side by side."""
    return F.pmod(F.shiftright(block, 31) * 4 + block.bitwiseAND(F.lit((1 << 31) - 1)), F.lit(tasks)).cast("int")


def coded_texts(docs: DataFrame) -> Stored:
    """(doc_id, ids, own) of every row of (doc_id, text)."""
    blocks = Stored(read(docs), "blocks")
    totals = Stored(word_totals(blocks.df()), "totals")
    listed = _numbered(totals.df(), most_frequent(totals.df()))
    words_ = listed.select("block", "at", "id", "share", F.lit(None).cast("binary").alias("body"))
    bodies = blocks.df().select("block", F.lit(None).cast("int").alias("at"), F.lit(None).cast("short").alias("id"), F.lit(None).cast("float").alias("share"), "body")
    # Streamed, words first: no list of a block's words is ever one value.
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = words_.unionByName(bodies).repartitionById(tasks, _dealt(F.col("block"), tasks)).sortWithinPartitions("block", F.col("body").isNotNull(), "at")
    length = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(length)
    spark.conf.set(length, WORD_ROWS)  # short rows but for one in each block
    try:
        out = Stored(ordered.select("id", "share", "body").mapInArrow(_coded, CODED_SQL), "coded")
    finally:
        spark.conf.set(length, before)
    blocks.drop()
    totals.drop()
    return out


@dataclass
class WindowNet:
    """Weights in one flat array, seen as matrices; ids are dealt to classes in turn, so that frequent words spread."""

    flat: np.ndarray

    SHAPES = {"embed": (VOCABULARY + 1, EMBED), "w": (2 * SIDE * EMBED, HIDDEN), "b": (HIDDEN,), "top": (HIDDEN, CLASSES), "top_b": (CLASSES,), "leaf": (CLASSES, HIDDEN, VOCABULARY // CLASSES), "leaf_b": (CLASSES, VOCABULARY // CLASSES)}

    @classmethod
    def new(cls) -> WindowNet:
        rng = np.random.default_rng(SEED)
        parts = [rng.normal(0, 0 if k.endswith("b") else 0.3 if k == "embed" else s[-2] ** -0.5, s) for k, s in cls.SHAPES.items()]
        return cls(np.concatenate([p.ravel() for p in parts]).astype(np.float32))

    def views(self, flat: np.ndarray | None = None) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in self.SHAPES.items():
            out[k] = (self.flat if flat is None else flat)[at : at + int(np.prod(s))].reshape(s)
            at += int(np.prod(s))
        return out

    def _forward(self, v: dict, around: np.ndarray, target: np.ndarray):
        """Of targets in order of their classes; cuts are where the classes begin."""
        kind, member = target % CLASSES, target // CLASSES
        cuts = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
        x = v["embed"][around].reshape(len(around), -1)
        h = np.tanh(x @ v["w"] + v["b"])
        top = _softmax(h @ v["top"] + v["top_b"])
        leaf = v["leaf_b"][kind]
        for c in range(CLASSES):
            lo, hi = cuts[c], cuts[c + 1]
            if lo < hi:
                leaf[lo:hi] += h[lo:hi] @ v["leaf"][c]
        _softmax(leaf)
        every = np.arange(len(target))
        log_prob = np.log(top[every, kind] + 1e-12) + np.log(leaf[every, member] + 1e-12)
        return x, h, top, leaf, kind, member, cuts, log_prob

    def log_probs(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        v, out = self.views(), np.empty(len(target), np.float32)
        for k in range(0, len(target), TOGETHER):
            some = k + by_class(target[k : k + TOGETHER])
            out[some] = self._forward(v, around[some], target[some])[-1]
        return out

    def gradient(self, around: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
        """Of the mean negative log-probability of the targets."""
        v, flat = self.views(), np.zeros_like(self.flat)
        g, n, order = self.views(flat), len(target), by_class(target)
        around, target = around[order], target[order]
        x, h, top, leaf, kind, member, cuts, log_prob = self._forward(v, around, target)
        every = np.arange(n)
        top[every, kind] -= 1
        leaf[every, member] -= 1
        g["top"][...], g["top_b"][...] = h.T @ top, top.sum(0)
        dh = top @ v["top"].T
        for c in range(CLASSES):
            lo, hi = cuts[c], cuts[c + 1]
            if lo < hi:
                part = leaf[lo:hi]
                np.matmul(h[lo:hi].T, part, out=g["leaf"][c])
                part.sum(0, out=g["leaf_b"][c])
                dh[lo:hi] += part @ v["leaf"][c].T
        dh *= 1 - h * h
        g["w"][...], g["b"][...] = x.T @ dh, dh.sum(0)
        dx = (dh @ v["w"].T).reshape(-1, EMBED)
        at = around.ravel()
        for k in range(EMBED):
            g["embed"][:, k] = np.bincount(at, dx[:, k], VOCABULARY + 1)
        return flat / np.float32(n), -float(log_prob.mean())


def by_class(target: np.ndarray) -> np.ndarray:
    return np.argsort((target % CLASSES).astype(np.uint8), kind="stable")


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(1, keepdims=True)
    return x


def positions(coded: list[bytes], first: int = 0, stride: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words around every stride-th word of each text, those words, and how many each text has."""
    edge = np.full(SIDE, NOTHING, np.int64)
    ids = [np.frombuffer(c, np.uint16).astype(np.int64) for c in coded]
    line = np.concatenate([x for i in ids for x in (i, edge)]) if ids else np.zeros(0, np.int64)
    line = np.concatenate([edge, line])
    starts = np.cumsum([SIDE] + [len(i) + SIDE for i in ids[:-1]])
    at = [np.arange(s + first % stride, s + len(i), stride) for s, i in zip(starts, ids, strict=False)]
    flat = np.concatenate(at) if at else np.zeros(0, np.int64)
    around = np.stack([line[flat + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1) if len(flat) else np.zeros((0, 2 * SIDE), np.int64)
    return around, line[flat], np.array([len(a) for a in at], np.int64)


def _trainer(weights: bytes, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        net, seen, k = WindowNet(np.frombuffer(weights, np.float32).copy()), 0, 0
        m, s = np.zeros_like(net.flat), np.zeros_like(net.flat)
        for (coded,) in rows(batches, "ids"):
            around, target, _ = positions(coded, turn, STRIDE)
            order = np.random.default_rng(SEED + turn).permutation(len(target))
            for at in range(0, len(target), STEP):
                some = order[at : at + STEP]
                g, _ = net.gradient(around[some], target[some])
                k += 1
                m += np.float32(0.1) * (g - m)
                s += np.float32(0.01) * (g * g - s)
                net.flat -= np.float32(RATE / (1 + turn) / (1 + k / 400)) * (m / np.float32(1 - 0.9**k)) / (np.sqrt(s / np.float32(1 - 0.99**k)) + np.float32(1e-6))
            seen += len(target)
        if seen:
            yield batch(TRAINED, [TaskContext.get().partitionId()], [net.flat.tobytes()], [seen])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = None, 0
    for blobs, many in rows(batches, "weights", "seen"):
        for w, n in zip(blobs, many, strict=True):
            part = np.frombuffer(w, np.float32).astype(np.float64) * n
            total, seen = part if total is None else total + part, seen + n
    if seen:
        yield batch(TRAINED, [0], [(total / seen).astype(np.float32).tobytes()], [seen])


def train(coded: DataFrame, rounds: int = ROUNDS) -> WindowNet:
    """Goes over all texts in each round. The driver gets at most GROUPS averages, however many partitions there are."""
    net = WindowNet.new()
    for turn in range(rounds):
        each = coded.select("ids").mapInArrow(_trainer(net.flat.tobytes(), turn), "place long, weights binary, seen long")
        dealt = each.repartition(GROUPS, F.col("place")).sortWithinPartitions("place").mapInArrow(_averaged, "place long, weights binary, seen long")
        got = [(np.frombuffer(bytes(r["weights"]), np.float32).astype(np.float64), r["seen"]) for r in dealt.collect()]
        if got:
            net = WindowNet((sum(w * n for w, n in got) / sum(n for _, n in got)).astype(np.float32))
    return net


def _scorer(weights: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = WindowNet(np.frombuffer(weights, np.float32).copy())
        for ids, coded, own in rows(batches, "doc_id", "ids", "own"):
            around, target, many = positions(coded)
            sums = np.concatenate([[0.0], np.cumsum(net.log_probs(around, target), dtype=np.float64)])
            ends = np.concatenate([[0], np.cumsum(many)])
            yield batch(SCORED, ids, many, sums[ends[1:]] - sums[ends[:-1]], own)

    return run


def _scored(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    coded = coded_texts(texts(docs, doc_id, text)).df()
    return coded.mapInArrow(_scorer(train(coded).flat.tobytes()), "doc_id long, n_tokens long, log_prob double, own double")


def _with_mean(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))


def pseudo_likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The network alone: log_prob is that of the ids, which rarer words share. For the words' own see token_likelihood().

    One row for each row of docs: doc_id, n_tokens, log_prob (the sum), mean_log_prob.
    Words are runs without white space, A-Z in lower case. A null text, or one without
    words, has log_prob 0 and a null mean; rows that repeat are read, and scored, one by one.
    An empty table gives an empty result. The weights are averages over partitions, so scores differ a little with
    the table's division into files.
    """
    return _with_mean(_scored(docs, doc_id, text))


def token_likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As pseudo_likelihood(), of the words themselves: a rarer one has its id's probability times its share among all words of that id."""
    return _with_mean(_scored(docs, doc_id, text).withColumn("log_prob", F.col("log_prob") + F.col("own")))
