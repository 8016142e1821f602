"""Toxicity: a noisy channel is undone first, then the restored words are scored.

What was written may be disguised: letters as look-alikes (1d10t), spread out (i d i o t, i-d-i-o-t) or repeated
(idiooot). A disguised stretch is a lattice: each mark may stand for some letters, for nothing, or for the end of a word,
each at a price. The cheapest path through it under a character model of the whole corpus is what was meant (Viterbi).
Only stretches that look disguised are decoded; other words are as they are.

Words and their first letters have weights from labelled documents; the three heaviest words of a document make its score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, rows, slices, small_batches, texts
from shelfmark.llm.quality_gam import fold

#: Labelled documents that weights are learned from, at most: those with the least hashes of their ids.
TRAIN_ROWS = 20_000
#: Words and beginnings with a weight, at most, and the documents that one must be in.
MOST_WEIGHTS, LEAST_DOCS = 50_000, 4
#: From this score on a document is predicted to be toxic.
TOXIC_FROM = 0.5
#: Words that a worker remembers, and paths that are followed at once.
REMEMBERED, PATHS = 1 << 19, 24
#: The heaviest words of a document that count.
HEAVIEST = 3

# Symbols of the character model: a to z, any wider letter, and what is no letter.
WIDER, BREAK, SYMBOLS = 26, 27, 28
_SYMBOL = np.full(256, BREAK, np.uint8)
_SYMBOL[97:123] = np.arange(26)
_SYMBOL[65:91] = np.arange(26)
_SYMBOL[128:] = WIDER

#: What a mark may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ı": "i", "α": "a", "ο": "o",
}
#: Prices in nats: a mark for a letter, for nothing, for the end of a word; a foreign letter for one like it, for itself; a letter once more; a divider for nothing, for the end of a word.
LETTER, NOTHING, END, ALIKE, FOREIGN, AGAIN, JOIN, PART = 1.0, 8.0, 8.0, 0.3, 3.0, 0.3, 0.2, 5.0

#: Three single characters and more with white space between them.
_SPREAD = re.compile(r"(?<!\S)\S(?:\s{1,2}\S){2,}(?!\S)")
_THRICE = re.compile(r"(.)\1\1")
_LETTERS = re.compile(r"[^\W\d_]+")
#: What may stand around a word without disguising it: dividers, one mark of exclamation, and marks in a row.
_AROUND = ".,;:?\"')[]{}>«»…-_*#%&/\\~^`="
_IN_A_ROW = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$|!$")

GRAMS = pa.schema([("gram", pa.int32()), ("n", pa.int64())])


def gram_counts(bodies: list[bytes]) -> np.ndarray:
    """How often each four symbols follow each other; what is no letter counts once in a row, as do the bytes of wider letters."""
    seen = _SYMBOL[np.frombuffer(b" ".join([b"", *bodies, b""]), np.uint8)].astype(np.int32)
    seen = seen[(seen < WIDER) | (seen != np.concatenate([[-1], seen[:-1]]))]
    seen = np.concatenate([[BREAK, BREAK], seen])
    return np.bincount(((seen[:-3] * SYMBOLS + seen[1:-2]) * SYMBOLS + seen[2:-1]) * SYMBOLS + seen[3:], minlength=SYMBOLS**4)


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Prices (negative logarithms) of a symbol after three others, at ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d, from all texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**4, np.int64)
        for whole in batches:
            for b in slices(whole, 4 << 20):
                total += gram_counts(b.column(0).to_pylist())
        found = np.flatnonzero(total)
        yield batch(GRAMS, pa.array(found.astype(np.int32)), pa.array(total[found]))

    sent = docs.select(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text")).mapInArrow(run, "gram int, n long")
    made = sent.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # SYMBOLS ** 4 rows at most
    total = np.zeros(SYMBOLS**4)
    total[made.column("gram").to_numpy()] = made.column("n").to_numpy()
    return prices(total)


def prices(total: np.ndarray) -> np.ndarray:
    """Four orders, mixed."""
    four = total.reshape([SYMBOLS] * 4)
    p = np.full(four.shape, 0.02 / SYMBOLS)
    for order, share in ((four, 0.58), (four.sum(0), 0.26), (four.sum((0, 1)), 0.14)):
        p += share * order / np.maximum(order.sum(-1, keepdims=True), 1)
    return -np.log(p).astype(np.float32).ravel()


def _arcs(c: str, before: str) -> list[tuple[str, float]]:
    """What a character may stand for, and at what price."""
    own, alike = c.isalpha(), LOOKS_LIKE.get(c, "")
    out = [(x, ALIKE if own else LETTER) for x in alike]
    if own:
        out.append((c, FOREIGN if alike else 0.0))
    elif alike or c.isdigit():
        out += [("", NOTHING), (" ", END)]
    else:
        out += [("", JOIN), (" ", PART)]
    if c == before and (own or alike):
        out.append(("", AGAIN))
    return out


def _symbol(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else BREAK if c == " " else WIDER


def decode(seen: str, model: np.ndarray) -> str:
    """The cheapest reading of a disguised stretch in lower case, as words with single blanks between them.

    A state is the last three symbols; a path that comes to a state another is cheaper at ends there.
    """
    mark, states = SYMBOLS**3, {(BREAK * SYMBOLS + BREAK) * SYMBOLS + BREAK: (0.0, None)}
    before = ""
    for c in seen:
        following: dict[int, tuple[float, tuple | None]] = {}
        arcs = [(out, price, _symbol(out) if out else -1) for out, price in _arcs(c, before)]
        for state, (cost, path) in states.items():
            for out, price, symbol in arcs:
                if symbol < 0 or (symbol == BREAK and state % SYMBOLS == BREAK):
                    to, total, way = state, cost + price, path
                else:
                    at = state * SYMBOLS + symbol
                    to, total, way = at % mark, cost + price + float(model[at]), (path, out)
                if to not in following or total < following[to][0]:
                    following[to] = (total, way)
        states = dict(sorted(following.items(), key=lambda x: (x[1][0], x[0]))[:PATHS]) if len(following) > PATHS else following
        before = c
    path = min((cost + (0.0 if state % SYMBOLS == BREAK else float(model[state * SYMBOLS + BREAK])), state, path) for state, (cost, path) in states.items())[2] if len(states) else None
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return " ".join("".join(reversed(out)).split())


def once(word: str) -> str:
    """Letters in a row that are the same as one."""
    return re.sub(r"(.)\1+", r"\1", word)


class Reader(dict):
    """Tokens between white space, in lower case, as (words, words that were disguised). Forgets all when it is full."""

    def __init__(self, model: np.ndarray):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = found = self._read(token)
        return found

    def _read(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        plain = tuple(_LETTERS.findall(token))
        if not plain or len(token) < 3:
            return plain, ()
        bare = token if token.isalpha() else _IN_A_ROW.sub("", token.strip(_AROUND)).strip(_AROUND)
        mixed = not bare.isascii() and any(c.isascii() for c in bare) and any(c in LOOKS_LIKE for c in bare)
        if bare.isalpha() and not mixed and not _THRICE.search(bare):
            return plain, ()
        return plain, tuple(decode(_THRICE.sub(r"\1\1", bare) if len(bare) > 200 else bare, self.model).split())

    def words(self, text: str) -> tuple[set[str], set[str]]:
        """The words of a text as they are, and those that were disguised."""
        low = text.lower()
        plain: set[str] = set()
        hidden: set[str] = set()
        for token in set(low.split()):
            a, b = self[token]
            plain.update(a)
            hidden.update(b)
        for m in _SPREAD.finditer(low):
            hidden.update(decode(m[0], self.model).split())
        return plain, hidden


def restored(text: str, model: np.ndarray) -> str:
    """The text in lower case, each disguised stretch as it is read."""
    reader = Reader(model)
    low = _SPREAD.sub(lambda m: decode(m[0], model), text.lower())
    return re.sub(r"\S+", lambda m: " ".join(reader[m[0]][1]) or m[0], low)


def beginnings(word: str) -> list[str]:
    """A word's features: it, and its first 4, 5 and 6 letters where it has more."""
    return [word, *(f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k)]


@dataclass
class Channel:
    """A character model, weights of words and beginnings, and how the heaviest words make a score."""

    model: np.ndarray
    weights: dict[str, float]
    slopes: np.ndarray
    base: float

    def reader(self) -> tuple[Reader, dict[str, float]]:
        return Reader(self.model), {once(f): w for f, w in sorted(self.weights.items(), key=lambda x: x[1])}

    def heaviest(self, plain: set[str], hidden: set[str], folded: dict[str, float]) -> list[float]:
        """The greatest weights of different words. A disguised word counts by its letters once too."""
        own = {w: max((self.weights.get(f, 0.0) for f in beginnings(w)), default=0.0) for w in plain | hidden if len(w) > 2}
        for w in hidden:
            if len(w) > 2:
                own[w] = max(own[w], *(folded.get(f, 0.0) for f in beginnings(once(w))))
        return sorted(own.values(), reverse=True)[:HEAVIEST] + [0.0] * max(0, HEAVIEST - len(own))

    def scores(self, heaviest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(heaviest @ self.slopes + self.base, -30, 30)))


SAID = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("plain", pa.list_(pa.string())), ("hidden", pa.list_(pa.string()))])
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
RESTORED = pa.schema([("doc_id", pa.int64()), ("restored", pa.string())])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> Channel:
    """The character model from all texts; weights and slopes from labels (doc_id, toxic) outside the held-out fold, up to train_rows documents.

    An id with several labels has their mean; null labels count for nothing. Of rows that share an id the one with the least words counts,
    and of documents whose least two hashes of words agree (copies, near copies) one. Without labels, or with those of one kind alone, all scores are the same.
    """
    small_batches(docs.sparkSession)
    model = character_model(docs, text)
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(fold() != 0).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for ids, ys, bodies in rows(batches, "doc_id", "y", "text"):
            said = [reader.words(b.decode(errors="replace")) for b in bodies]
            yield batch(SAID, ids, ys, [sorted(w for w in a if len(w) > 2) for a, _ in said], [sorted(w for w in b if len(w) > 2) for _, b in said])

    # Bounded by train_rows.
    found = texts(docs, doc_id, text).join(F.broadcast(few), "doc_id").select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, plain array<string>, hidden array<string>")
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct("plain", "hidden")).alias("w")).select("y", "w.plain", "w.hidden")
    least = F.slice(F.array_sort(F.transform("plain", lambda w: F.xxhash64(w))), 1, 2)
    alike = one.withColumn("key", least).groupBy("key", "y").agg(F.min(F.struct("plain", "hidden")).alias("w")).select("y", "w.plain", "w.hidden")
    held = Stored(alike, "toxicity")
    counts = dict(held.df().groupBy("y").count().toArrow().to_pandas().itertuples(index=False, name=None))
    if len(counts) < 2:
        mean = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
        return Channel(model, {}, np.zeros(HEAVIEST), float(np.log(mean / (1 - mean))))
    word = F.col("word")
    features = F.array_compact(F.array(word, *(F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("*"))) for k in (4, 5, 6))))
    each = held.df().withColumn("row", F.monotonically_increasing_id()).select("y", "row", F.explode(F.array_union("plain", "hidden")).alias("word"))
    each = each.select("y", "row", F.explode(features).alias("feature")).distinct().groupBy("feature").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (counts[1] + 1.0)) - F.log((F.col("good") + 0.5) / (counts[0] + 1.0))
    heavy = each.filter(F.col("bad") >= LEAST_DOCS).withColumn("weight", odds).filter("weight > 1").orderBy(F.desc("weight"), "feature").limit(MOST_WEIGHTS).toArrow()
    weights = dict(zip(heavy.column("feature").to_pylist(), heavy.column("weight").to_pylist(), strict=True))
    channel = Channel(model, weights, np.zeros(HEAVIEST), 0.0)
    folded = channel.reader()[1]
    got = held.df().toArrow()  # up to train_rows
    x = np.array([channel.heaviest(set(a), set(b), folded) for a, b in zip(got.column("plain").to_pylist(), got.column("hidden").to_pylist(), strict=True)])
    channel.slopes, channel.base = fitted(x, np.array(got.column("y").to_pylist(), float))
    return channel


def fitted(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's steps, with slopes that are never below 0: a heavier word can't make a text milder."""
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    design, free = np.column_stack([x, np.ones(len(x))]), np.ones(x.shape[1] + 1, bool)
    while True:
        w = np.zeros(design.shape[1])
        d = design[:, free]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(d @ w[free], -30, 30)))
            curve = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(d.shape[1])
            w[free] += np.linalg.solve(curve, d.T @ (y - p) - ridge * w[free])
        below = (w[:-1] < 0) & free[:-1]
        if not below.any():
            return w[:-1], float(w[-1])
        free[:-1] &= ~below


def score(docs: DataFrame, channel: Channel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted. A null or empty text has no words, and so the least score.

    Rows that repeat are scored one by one; a null id is in the held-out fold. An empty table gives an empty result; other columns are left behind.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, folded = channel.reader()
        for ids, held, bodies in rows(batches, "doc_id", "held_out", "text"):
            s = channel.scores(np.array([channel.heaviest(*reader.words(b.decode(errors="replace")), folded) for b in bodies]))
            yield batch(SCORED, ids, held, s, (s >= TOXIC_FROM).astype(np.int32))

    source = texts(docs, doc_id, text).select("doc_id", "text", (fold() == 0).alias("held_out"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def deobfuscate(docs: DataFrame, model: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, restored): each text in lower case with its disguised stretches as they are read; a null text is empty. One row for each row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in rows(batches, "doc_id", "text"):
            yield batch(RESTORED, ids, [restored(b.decode(errors="replace"), model) for b in bodies])

    return texts(docs, doc_id, text).select("doc_id", "text").mapInArrow(run, "doc_id long, restored string")
