"""Language identification: a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in segments, forwards and backwards. Every position gets
a probability for each language from the two states that meet there, and a
document's probabilities are the mean over all its positions. Trained in numpy by
backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, rows, small_batches, texts
from shelfmark.llm.quality_gam import fold

#: Labelled documents of each language that the network is trained on, about: those whose hash is under the share that so many are. All segments
#: of their whole texts are used, up to about a bound for each language, and one for all that the languages share out; beyond it, likewise, those with small hashes.
TRAIN_DOCS, TRAIN_SEGMENTS, ALL_SEGMENTS = 1000, 1 << 16, 1 << 18
#: Languages that are learned, the most frequent.
MOST_LANGS = 1000
#: Every segment is in a training step once at least; with few of them, steps are as many as this.
TRAIN_LENGTH, STEPS, TRAIN_BATCH, RATE, SEED = 64, 500, 512, 0.01, 7
HIDDEN = 8
#: Bytes of a segment when scoring, and segments read together.
LENGTH, TOGETHER = 128, 2048
#: The symbol after the last byte of a segment: it leaves the state as it is.
PAD = 256
UNKNOWN = "und"


def segments(body: bytes, length: int) -> np.ndarray:
    """All bytes of a text as rows of symbols, the last row padded."""
    n = -(-len(body) // length)
    out = np.full(n * length, PAD, np.int16)
    out[: len(body)] = np.frombuffer(body, np.uint8)
    return out.reshape(n, length)


@dataclass
class BiGRU:
    """Weights, [0] forwards and [1] backwards. Gates in order z, r, n; state' = z * state + (1 - z) * n."""

    langs: list[str]
    x: np.ndarray  # 2, 257, 3h: what each symbol adds to the gates
    u: np.ndarray  # 2, h, 3h: what the state adds
    v: np.ndarray  # 2, h, languages
    c: np.ndarray  # languages

    @classmethod
    def new(cls, langs: list[str], hidden: int = HIDDEN, seed: int = SEED) -> BiGRU:
        rng = np.random.default_rng(seed)
        x = rng.normal(0, 0.3, (2, 257, 3 * hidden))
        out = cls(langs, x, rng.normal(0, hidden**-0.5, (2, hidden, 3 * hidden)), rng.normal(0, 0.3, (2, hidden, len(langs))), np.zeros(len(langs)))
        for name in ("x", "u", "v", "c"):
            setattr(out, name, getattr(out, name).astype(np.float32))
        out.pin()
        return out

    def pin(self) -> None:
        """The pad keeps the state: its z is 1."""
        h = self.u.shape[1]
        self.x[:, PAD] = 0
        self.x[:, PAD, :h] = 40

    def _symbols(self, rows_: np.ndarray, t: int) -> np.ndarray:
        """What the symbols at step t add to the gates, both ways: 2, rows, 3h."""
        return np.stack((self.x[0][rows_[:, t]], self.x[1][rows_[:, rows_.shape[1] - 1 - t]]))

    def logits(self, rows_: np.ndarray) -> np.ndarray:
        """rows, positions, languages."""
        n, length = rows_.shape
        h = self.u.shape[1]
        half_x, half_u = self.x.copy(), self.u.copy()  # sigmoid(a) = tanh(a / 2) / 2 + 1 / 2
        half_x[:, :, : 2 * h] *= 0.5
        half_u[:, :, : 2 * h] *= 0.5
        state = np.zeros((2, n, h), np.float32)
        out = np.empty((2, length, n, len(self.langs)), np.float32)
        g, a = np.empty((2, n, 3 * h), np.float32), np.empty((2, n, 3 * h), np.float32)
        columns = np.ascontiguousarray(rows_.T)
        for t in range(length):
            np.take(half_x[0], columns[t], axis=0, out=g[0], mode="clip")
            np.take(half_x[1], columns[length - 1 - t], axis=0, out=g[1], mode="clip")
            np.matmul(state, half_u, out=a)
            zr = g[:, :, : 2 * h]
            zr += a[:, :, : 2 * h]
            zr = np.tanh(zr)
            zr *= 0.5
            zr += 0.5
            new = a[:, :, 2 * h :] * zr[:, :, h:]
            new += g[:, :, 2 * h :]
            np.tanh(new, out=new)
            state -= new
            state *= zr[:, :, :h]
            state += new
            y = np.matmul(state, self.v)
            out[0, t], out[1, length - 1 - t] = y[0], y[1]
        return (out[0] + out[1] + self.c).transpose(1, 0, 2)

    def step(self, rows_: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over the positions of all rows, and its gradients by backpropagation through time."""
        n, length = rows_.shape
        h = self.u.shape[1]
        state, kept = np.zeros((2, n, h), np.float32), []
        out = np.empty((2, length, n, h), np.float32)
        for t in range(length):
            g, a = self._symbols(rows_, t), state @ self.u
            zr = 1 / (1 + np.exp(-np.clip(g[..., : 2 * h] + a[..., : 2 * h], -40, 40)))
            new = np.tanh(g[..., 2 * h :] + zr[..., h:] * a[..., 2 * h :])
            kept.append((state, zr, new, a[..., 2 * h :]))
            state = zr[..., :h] * state + (1 - zr[..., :h]) * new
            out[:, t] = state
        real = (rows_ != PAD).T
        logit = out[0] @ self.v[0] + out[1][::-1] @ self.v[1] + self.c
        logit -= logit.max(-1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(-1, keepdims=True)
        some = max(1, int(real.sum()))
        loss = -float((np.log(p[:, np.arange(n), y] + 1e-12) * real).sum()) / some
        p[:, np.arange(n), y] -= 1
        d = (p * real[..., None] / some).astype(np.float32)
        dx, du = np.zeros_like(self.x), np.zeros_like(self.u)
        dv = np.stack((np.einsum("tnh,tnk->hk", out[0], d), np.einsum("tnh,tnk->hk", out[1][::-1], d)))
        each = (d @ self.v[0].T, d[::-1] @ self.v[1].T)
        back, gates = np.zeros((2, n, h), np.float32), np.empty((2, length, n, 3 * h), self.x.dtype)
        for t in range(length - 1, -1, -1):
            before, zr, new, an = kept[t]
            z, r = zr[..., :h], zr[..., h:]
            back = back + np.stack((each[0][t], each[1][t]))
            dn = back * (1 - z) * (1 - new * new)
            dz = back * (before - new) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            dg = np.concatenate((dz, dr, dn), -1)
            da = np.concatenate((dz, dr, dn * r), -1)
            gates[:, t] = dg
            du += before.transpose(0, 2, 1) @ da
            back = back * z + da @ self.u.transpose(0, 2, 1)
        for way, symbols in enumerate((rows_.T.ravel(), rows_.T[::-1].ravel())):
            for k in range(3 * h):
                dx[way, :, k] = np.bincount(symbols, gates[way, :, :, k].ravel(), 257)
        return loss, [dx, du, dv, d.sum((0, 1))]

    def document_probabilities(self, bodies: list[bytes]) -> np.ndarray:
        """documents, languages: the mean over every position of each text; equal shares for an empty one."""
        out = np.zeros((len(bodies), len(self.langs)))
        parts = [segments(b, LENGTH) for b in bodies]
        owner = np.repeat(np.arange(len(bodies)), [len(p) for p in parts])
        every = np.concatenate(parts) if parts else np.zeros((0, LENGTH), np.int16)
        for k in range(0, len(every), TOGETHER):
            rows_ = every[k : k + TOGETHER]
            p = self.logits(rows_)
            p = np.exp(p - p.max(-1, keepdims=True))
            p /= p.sum(-1, keepdims=True)
            p *= (rows_ != PAD)[..., None]
            np.add.at(out, owner[k : k + TOGETHER], p.sum(1, dtype=np.float64))
        total = np.array([len(b) for b in bodies], float)[:, None]
        return np.where(total > 0, out / np.maximum(total, 1), 1 / max(1, len(self.langs)))


def fit(rows_: np.ndarray, y: np.ndarray, langs: list[str]) -> BiGRU:
    """Adam over shuffled segments, each of them once at least; deterministic."""
    net, rng, steps = BiGRU.new(langs), np.random.default_rng(SEED), max(STEPS, -(-len(rows_) // TRAIN_BATCH))
    names, moments, waiting = ("x", "u", "v", "c"), None, np.zeros(0, np.int64)
    for k in range(1, steps + 1):
        while len(waiting) < min(TRAIN_BATCH, len(rows_)):
            waiting = np.concatenate([waiting, rng.permutation(len(rows_))])
        chosen, waiting = waiting[:TRAIN_BATCH], waiting[TRAIN_BATCH:]
        _, gradients = net.step(rows_[chosen], y[chosen])
        moments = moments or [(np.zeros_like(g), np.zeros_like(g)) for g in gradients]
        rate = RATE * (1 - 0.9 * k / steps)
        for name, g, (m, s) in zip(names, gradients, moments, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            getattr(net, name)[...] -= rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
        net.pin()
    return net


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every segment of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("place", pa.int64()), ("part", pa.binary())])
    for ids, langs, bodies in rows(batches, "doc_id", "lang", "text"):
        for doc, lang, body in zip(ids, langs, bodies, strict=True):
            places = range(0, len(body), TRAIN_LENGTH)
            if places:
                yield batch(schema, [doc] * len(places), [lang] * len(places), list(places), [body[p : p + TRAIN_LENGTH] for p in places])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS, train_segments: int = TRAIN_SEGMENTS) -> BiGRU:
    """Fits on documents with a language outside the held-out fold: on all of them up to about train_docs of each language, so that a rare language is learned too.

    Whole texts are used, up to about train_segments pieces of 64 bytes for each language. What is taken is told by hashes alone, so no task gathers a
    language. Rows alike in id and text count once. Rows without a language or an id teach nothing; without any others the network knows no language.
    """
    small_batches(docs.sparkSession)
    key, tongue = F.col(f"`{doc_id}`"), F.col(f"`{lang}`")
    source = docs.select(key.alias("doc_id"), tongue.alias("lang"), F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"))
    source = source.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(fold() != 0)
    counts = source.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()
    if not counts:
        return BiGRU.new([])
    hashed = source.withColumn("key", F.xxhash64("doc_id", "text"))
    taken = hashed.filter(_under(F.col("key"), {r["lang"]: train_docs / r["n"] for r in counts})).groupBy("doc_id", "lang", "key").agg(F.min("text").alias("text"))
    few = Stored(taken.drop("key"), "languages")
    most = min(train_segments, ALL_SEGMENTS // len(counts))
    sizes = few.df().groupBy("lang").agg(F.sum(F.ceil(F.octet_length("text") / TRAIN_LENGTH)).alias("n")).collect()  # a row for each language
    pieces = few.df().mapInArrow(_pieces, "doc_id long, lang string, place long, part binary")
    # About ALL_SEGMENTS in all, whatever the input.
    got = pieces.filter(_under(F.xxhash64("doc_id", "place", "part"), {r["lang"]: most / max(1, r["n"]) for r in sizes})).select("lang", F.xxhash64("place", "doc_id", "part").alias("k"), "part").toArrow()
    few.drop()
    found = sorted(zip(*(got.column(c).to_pylist() for c in ("lang", "k", "part")), strict=True))
    langs = sorted({g[0] for g in found})
    if not langs:
        return BiGRU.new([])
    return fit(np.concatenate([segments(g[2], TRAIN_LENGTH) for g in found]), np.array([langs.index(g[0]) for g in found]), langs)


def _under(key: Column, shares: dict[str, float]) -> Column:
    """Whether a hash is in the share of its language; none is for other languages."""
    bounds = F.create_map(*[F.lit(x) for lang, share in shares.items() for x in (lang, int(min(1.0, share) * 2**31))]) if shares else F.create_map(F.lit(""), F.lit(0))
    return F.coalesce(F.pmod(key, F.lit(2**31)) < F.try_element_at(bounds, F.col("lang")), F.lit(False))


def languages(docs: DataFrame, net: BiGRU, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score (of that language).

    A null text and one without a letter are `und` with score 0; so are all if nothing was learned. Every
    byte of a text is read. Rows that repeat have the same answer each; a null id is in the held-out fold.
    An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held, bodies in rows(batches, "doc_id", "held_out", "text"):
            able = [bool(net.langs) and any(map(str.isalpha, b.decode())) for b in bodies]
            best: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(ids)
            at = [k for k, a in enumerate(able) if a]
            p = net.document_probabilities([bodies[k] for k in at])
            for k, row in zip(at, p, strict=True):
                best[k] = net.langs[int(row.argmax())], min(1.0, float(row.max()))
            yield batch(schema, ids, held, *zip(*best, strict=True))

    return texts(docs, doc_id, text).withColumn("held_out", fold() == 0).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
