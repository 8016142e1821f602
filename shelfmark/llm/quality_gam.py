"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature's contribution is a table over its bins. Training goes round the features
in turn, each time fitting a shallow tree to what is still unexplained and adding it
to that feature's table; then the strongest pairs get tables over two features the
same way. A score is a sum of looked-up bins, for a whole batch at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import batch, rows, slices, small_batches, texts

#: Labelled rows that the model is fitted on, at most: those with the least hashes of their ids.
TRAIN_ROWS = 20_000
#: From this score on a document is predicted to be good.
KEEP_FROM = 0.3
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, SHRINK = 150, 60, 0.15, 4.0

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "upper", "digit", "common_mark", "rare_mark", "exclaim",
    "mark_runs", "wide", "control", "distinct_words", "same_as_previous", "top_word", "line_words", "repeated_lines", "capital_words",
)

# Kinds of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 common mark, 5 rare mark, 6 exclamation mark, 7 part of a wider letter, 8 white space, 9 control.
_KIND = np.zeros(256, np.uint8)
_KIND[list(range(33))] = 9
_KIND[127] = 9
_KIND[list(b" \t\n\r\x0b\x0c")] = 8
_KIND[list(range(97, 123))] = 1
_KIND[list(range(65, 91))] = 2
_KIND[list(range(48, 58))] = 3
_KIND[list(b".,;:'\"-()?")] = 4
_KIND[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = 5
_KIND[33] = 6
_KIND[128:] = 7


def features(body: bytes) -> list[float]:
    """Numbers from the whole text alone; an empty text has zeros."""
    if not body:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(body, np.uint8)
    kinds = _KIND[raw]
    n = len(raw)
    count = np.bincount(kinds, minlength=10)
    letters = max(1, int(count[1] + count[2] + count[7]))
    marks = (kinds >= 4) & (kinds <= 6)
    ws = body.split()
    many = max(1, len(ws))
    seen = Counter(ws)
    lines = [x for x in body.split(b"\n") if x.strip()]
    starts = np.concatenate([[True], kinds[:-1] >= 8])
    return [
        np.log1p(n), np.log1p(len(ws)), (n - int(count[8])) / many, float(np.mean(np.fromiter(map(len, ws), np.int64, len(ws)) > 20)) if ws else 0.0,
        count[2] / letters, count[3] / n, count[4] / n, count[5] / n, count[6] / n,
        float(np.count_nonzero(marks[1:] & marks[:-1])) / many, count[7] / n, count[9] / n,
        len(seen) / many, sum(map(eq, ws, ws[1:])) / many, max(seen.values(), default=0) / many,
        np.log1p(len(ws) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), np.count_nonzero(starts & (kinds == 2)) / many,
    ]


@dataclass
class AdditiveModel:
    """Tables over bins: score = sigmoid(base + tables[f][bin f] + pair tables[f, g][bins])."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def _bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for table, at in zip(self.tables, self._bins(x, self.edges), strict=True):
            out += table[at]
        at = self._bins(x, self.coarse)
        for (f, g), table in self.pairs.items():
            out += table[at[f], at[g]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best place to cut a histogram in two, and its gain."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(a):
        return 0.0, 0
    gain = _gain(a, b) + _gain(g.sum() - a, h.sum() - b) - _gain(g.sum(), h.sum())
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of three leaves over a histogram, as a table of steps."""
    _, k = _cut(g, h)
    left, right = _cut(g[:k], h[:k]), _cut(g[k:], h[k:])
    second = left[1] if left[0] >= right[0] else k + right[1]
    out = np.zeros(len(g))
    for lo, hi in zip((0, *sorted((k, second))), (*sorted((k, second)), len(g)), strict=True):
        if hi > lo:
            out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SHRINK)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts one axis and then the other on each side; its gain and its table."""
    best, out = -1.0, np.zeros(g.shape)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, k = _cut(a.sum(1), b.sum(1))
        gain, table = 0.0, np.zeros(a.shape)
        for side in (slice(0, k), slice(k, None)):
            x, y = a[side].sum(0), b[side].sum(0)
            _, m = _cut(x, y)
            for part in (slice(0, m), slice(m, None)):
                gain += float(_gain(x[part].sum(), y[part].sum()))
                table[side, part] = x[part].sum() / (y[part].sum() + SHRINK)
        if gain > best:
            best, out = gain, table.T if turned else table
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on rows x features; deterministic. Rows of one class alone, or none, give a constant."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    coarse = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    mean = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(edges, coarse, float(np.log(mean / (1 - mean))), [np.zeros(len(e) + 1) for e in edges])
    if not len(y) or y.min() == y.max():
        return model
    bins, logit = model._bins(x, edges), np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for f, at in enumerate(bins):
            p = 1 / (1 + np.exp(-logit))
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size))
            model.tables[f] += step
            logit += step[at]
    bins, shape = model._bins(x, coarse), [len(e) + 1 for e in coarse]

    def grid(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        at, size = bins[f] * shape[g] + bins[g], shape[f] * shape[g]
        p = 1 / (1 + np.exp(-logit))
        return np.bincount(at, y - p, size).reshape(shape[f], shape[g]), np.bincount(at, p * (1 - p), size).reshape(shape[f], shape[g])

    chosen = sorted(combinations(range(x.shape[1]), 2), key=lambda fg: -_pair_tree(*grid(*fg))[0])[:PAIRS]
    model.pairs = {(f, g): np.zeros((shape[f], shape[g])) for f, g in chosen}
    for _ in range(PAIR_ROUNDS):
        for f, g in chosen:
            step = RATE * _pair_tree(*grid(f, g))[1]
            model.pairs[f, g] += step
            logit += step[bins[f], bins[g]]
    return model


FEATURED = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, bodies in rows(batches, "doc_id", "text"):
        yield batch(FEATURED, ids, [features(b) for b in bodies])


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; 0 is held out. A null id is an empty text here."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fits on labels (doc_id, quality) outside the held-out fold: on all of them up to train_rows.

    An id with several labels has their mean; null labels count for nothing. Of rows that share an id the one with the least features counts,
    so that no more than train_rows are gathered. Without labels, or with those of one kind alone, the model is a constant.
    """
    small_batches(docs.sparkSession)
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(fold() != 0).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # Bounded by train_rows.
    found = texts(docs, doc_id, text).join(F.broadcast(few), "doc_id").select("doc_id", "text", "y")
    y = {r["doc_id"]: r["y"] for r in few.collect()}
    got = found.mapInArrow(_features, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x")).toArrow()
    ids, x = got.column("doc_id").to_pylist(), got.column("x").to_pylist()
    order = sorted(range(len(ids)), key=lambda k: (ids[k], x[k]))
    return fit(np.array([x[k] for k in order], float).reshape(-1, len(FEATURES)), np.array([y[ids[k]] for k in order], float))


def score(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted. A null or empty text has the features 0.

    Rows that repeat are scored one by one; a null id is in the held-out fold. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, bodies in rows(batches, "doc_id", "held_out", "text"):
            s = model.scores(np.array([features(b) for b in bodies], float))
            yield batch(SCORED, ids, held, s, (s >= KEEP_FROM).astype(np.int32))

    source = texts(docs, doc_id, text)
    return source.withColumn("held_out", fold() == 0).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns unchanged, that the model does not reject; rows that repeat stay or go together."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                bodies = b.column(b.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
                good = model.scores(np.array([features(x or b"") for x in bodies], float)) >= KEEP_FROM
                yield b.filter(pa.array(good))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)
