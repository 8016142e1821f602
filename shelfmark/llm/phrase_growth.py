"""Phrase collocations: contiguous patterns grown from frequent prefixes, PrefixSpan-style.

1. Words and pairs of neighbours are counted in each lang, the pairs in buckets: a filter that says which may be frequent, and which are hot.
2. Threes of which both pairs may be frequent are counted the same way.
3. Each occurrence of a frequent pair is projected: the pair and the words that may follow, five in all, equal projections of
   a task once with a count. Projections travel packed, by buckets of prefixes of about equal size. A prefix is in one bucket, whose task grows it to the
   right, depth first, over slices of its sorted projections. The projections of a hot prefix are dealt to all buckets instead; each of
   these gives its share of the counts, and the shares are summed.
4. Candidates are cut, scored in whole numbers, dropped under longer ones of the same count, and ranked.

Words are 63-bit hashes on the way, under a seed with which no frequent word of the corpus shares its hash with
another word; so what is counted is exact. The filters have a fixed size: more words leave more projections, not other results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelfmark.llm.common import Stored, batch, rows, small_batches

#: Words of the longest phrase.
LONGEST = 5
#: Occurrences of a bucket of prefixes, about, and buckets at least.
BUCKET, LEAST_BUCKETS = 1 << 20, 64
#: Bits of a filter, and of the part of it that one row carries (what Spark's bitmap functions have).
FILTER_BITS, CHUNK = 1 << 26, 1 << 15
#: Occurrences from which on a prefix of two words is hot.
HOT = 1 << 20
#: Distinct words, runs of words and projections that a worker holds before it sends them on.
HELD_WORDS, HELD_RUNS, HELD_ROWS = 1 << 19, 1 << 22, 1 << 19

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(10 if c in _BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(body: bytes) -> list[bytes]:
    """The words of a text, with b"\\n" where a piece ends; empty ones count for nothing."""
    return body.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


class Numbers(dict):
    """The words of one lang as numbers from 1 on, 0 for the end of a piece and -1 for no word. Forgets all when it is full."""

    def __init__(self, lang: bytes, seed: int, bits: int, most: float = HELD_WORDS):
        super().__init__()
        self.lang, self.seed, self.bits, self.most = lang + b"\0", seed, bits, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        n = {b"": -1, b"\n": 0}.get(word)
        if n is None:
            n = (xxhash.xxh3_64_intdigest(self.lang + word, self.seed) >> 64 - self.bits) or 1
        self[word] = n
        return n

    def of(self, body: bytes) -> np.ndarray:
        """A text as numbers, with 0 where a piece ends, last of all too."""
        said = tokens(body)
        found = np.fromiter(map(self.__getitem__, said), np.int64, len(said))
        return np.append(found[found >= 0], 0)


def by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    for langs, bodies in rows(batches, "lang", "text"):
        yield from zip(langs, bodies, strict=True)


def numbered(batches: Iterator[pa.RecordBatch], seed: int, bits: int) -> Iterator[np.ndarray]:
    langs: dict[bytes, Numbers] = {}
    for lang, body in by_lang(batches):
        yield langs.setdefault(lang, Numbers(lang, seed, bits)).of(body)


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def bucket(*columns: np.ndarray) -> np.ndarray:
    """The places of runs of words in their filter."""
    return (_mixed(list(columns)) >> np.uint64(20)).astype(np.int64) & (FILTER_BITS - 1)


class Bits:
    """A fixed number of bits; has() for an array of places."""

    def __init__(self, chunks: list[tuple[int, bytes]]):
        self.packed = np.zeros(FILTER_BITS // 8, np.uint8)
        for k, bitmap in chunks:
            self.packed[k * CHUNK // 8 : (k + 1) * CHUNK // 8] = np.frombuffer(bitmap, np.uint8)

    def has(self, places: np.ndarray) -> np.ndarray:
        return (self.packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


COUNTED = pa.schema([("lang", pa.binary()), ("word", pa.binary()), ("number", pa.int64()), ("n", pa.int64()), ("chunk", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
BITMAPS = pa.schema([("chunk", pa.int32()), ("frequent", pa.binary()), ("hot", pa.binary()), ("n", pa.int64())])


def chunks_of(places: np.ndarray) -> tuple[list, list, list]:
    """How often each place comes, a row for each chunk of the filter: chunk, places in it, counts."""
    places, counts = np.unique(places, return_counts=True)
    cuts = np.flatnonzero(np.diff(places >> 15, prepend=-1))
    parts = [slice(lo, hi) for lo, hi in zip(cuts, np.append(cuts[1:], len(places)), strict=True)]
    return [int(places[p][0]) >> 15 for p in parts], [(places[p] & CHUNK - 1).astype(np.uint16).tobytes() for p in parts], [counts[p].astype(np.uint32).tobytes() for p in parts]


def counted(source: DataFrame, seed: int, bits: int) -> DataFrame:
    """Two kinds of rows: words of a lang with their number and count, and chunks of counted pairs. Both are parts of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[bytes, tuple[Numbers, list[np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            pairs = []
            for lang, (numbers, held) in langs.items():
                found = np.concatenate(held)
                held.clear()
                x, y = found[:-1], found[1:]
                both = (x > 0) & (y > 0)
                pairs.append(bucket(x[both], y[both]).astype(np.int32))
                known, counts = np.unique(found[found > 0], return_counts=True)
                # Of words that share a number one has the count here; such numbers are found out later and drawn again.
                own = {n: w for w, n in numbers.items() if n > 0}
                numbers.clear()
                nothing = [None] * len(known)
                yield batch(COUNTED, [lang] * len(known), [own[n] for n in known.tolist()], pa.array(known), pa.array(counts), nothing, nothing, nothing)
            places = np.concatenate(pairs)
            if len(places):
                chunks = chunks_of(places)
                nothing = [None] * len(chunks[0])
                yield batch(COUNTED, nothing, nothing, nothing, nothing, *chunks)

        for lang, body in by_lang(batches):
            if lang not in langs:
                langs[lang] = (Numbers(lang, seed, bits, float("inf")), [])
            langs[lang][1].append(langs[lang][0].of(body))
            size += len(langs[lang][1][-1])
            if size >= HELD_RUNS or sum(len(n) for n, _ in langs.values()) >= HELD_WORDS:
                yield from out()
                langs.clear()
                size = 0
        if langs:
            yield from out()

    return source.mapInArrow(run, "lang binary, word binary, number long, n long, chunk int, places binary, counts binary")


def merged(chunks: DataFrame, least: int, hot: int) -> tuple[Bits, Bits, int]:
    """Which places of a filter hold least, and which hold hot occurrences: never one too few. How many occurrences the first have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, totals = None, np.zeros(CHUNK, np.int64)

        def out() -> pa.RecordBatch:
            frequent, is_hot = (np.packbits(totals >= x, bitorder="little").tobytes() for x in (least, hot))
            return batch(BITMAPS, [at], [frequent], [is_hot], [int(totals[totals >= least].sum())])

        for ks, places, counts in rows(batches, "chunk", "places", "counts"):
            for k, p, c in zip(ks, places, counts, strict=True):
                if k != at and at is not None:
                    yield out()
                    totals[:] = 0
                at = k
                totals[np.frombuffer(p, np.uint16)] += np.frombuffer(c, np.uint32)
        if at is not None:
            yield out()

    made = chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "chunk int, frequent binary, hot binary, n long").toArrow()  # two filters of FILTER_BITS
    ks, frequent, is_hot, n = (made.column(c).to_pylist() for c in BITMAPS.names)
    return Bits(list(zip(ks, frequent, strict=True))), Bits(list(zip(ks, is_hot, strict=True))), sum(n)


def words_and_pairs(source: DataFrame, least: int, bits: int, hot: int) -> tuple[Stored, int, Bits, Bits, int]:
    """The counted words, the first seed with which no word that occurs least times shares its number, the filters of pairs and how many occurrences may be frequent."""
    for seed in count():
        parts = Stored(counted(source, seed, bits), "counts")
        words = Stored(parts.df().filter("chunk IS NULL").groupBy("lang", "word", "number").agg(F.sum("n").alias("n")), "words")
        shared = words.df().groupBy("number").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).filter((F.col("words") > 1) & (F.col("n") >= least))
        if shared.isEmpty():
            pairs = merged(parts.df().filter("chunk IS NOT NULL").select("chunk", "places", "counts"), least, hot)
            parts.drop()
            return words, seed, *pairs
        parts.drop()
        words.drop()


THREES = pa.schema(list(COUNTED)[4:])


def pairs_on(found: np.ndarray, pairs: Bits) -> np.ndarray:
    """Where a pair begins that may be frequent; as long as found."""
    x, y = found[:-1], found[1:]
    on = (x > 0) & (y > 0)
    on[on] = pairs.has(bucket(x[on], y[on]))
    return np.append(on, False)


def counted_threes(source: DataFrame, pairs: Bits, seed: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in numbered(batches, seed, bits):
            on = pairs_on(found, pairs)
            at = np.flatnonzero(on[:-1] & on[1:])
            held.append(bucket(found[at], found[at + 1], found[at + 2]).astype(np.int32))
            size += len(at)
            if size >= HELD_RUNS:
                yield batch(THREES, *chunks_of(np.concatenate(held)))
                held, size = [], 0
        if size:
            yield batch(THREES, *chunks_of(np.concatenate(held)))

    return source.mapInArrow(run, "chunk int, places binary, counts binary")


WORD = [f"w{k}" for k in range(1, LONGEST + 1)]
PROJECTED = pa.schema([("bucket", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
GROWN = pa.schema([*[(w, pa.int64()) for w in WORD], ("n", pa.int64())])


def project(found: np.ndarray, pairs: Bits, threes: Bits) -> np.ndarray:
    """A row for each pair that may be frequent: it and what may follow, up to LONGEST words, then zeros."""
    on = pairs_on(found, pairs)
    goes_on = np.zeros(len(found) + LONGEST, bool)  # from here a third word may follow
    at = np.flatnonzero(on[:-1] & on[1:])
    goes_on[at] = threes.has(bucket(found[at], found[at + 1], found[at + 2]))
    starts = np.flatnonzero(on)
    out = np.zeros((len(starts), LONGEST), np.int64)
    out[:, 0], out[:, 1] = found[starts], found[starts + 1]
    still = np.ones(len(starts), bool)
    for k in range(2, LONGEST):
        still &= goes_on[starts + k - 2]
        out[still, k] = found[starts[still] + k]
    return out


def folded(projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, and how many each stands for. Rows of one hash lie together; only rows that are equal are counted as such."""
    projected = projected[np.argsort(_mixed(list(projected.T)), kind="stable")]
    starts = changes(projected, LONGEST)
    return projected[starts], np.diff(np.append(starts, len(projected)))


def grow(projected: np.ndarray, upto: np.ndarray, lo: int, hi: int, depth: int, least: int, out: list[tuple]) -> None:
    """Appends each phrase that occurs least times among the projections lo to hi, which share their first depth words.

    projected is sorted; upto holds the counts of all rows before each. What continues a prefix is a slice of its slice: the pointers to its occurrences.
    """
    column = projected[lo:hi, depth]
    cuts = np.append(lo + np.flatnonzero(np.diff(column, prepend=-1)), hi)
    totals = upto[cuts[1:]] - upto[cuts[:-1]]
    for k in np.flatnonzero((totals >= least) & (projected[cuts[:-1], depth] > 0)):
        a, b = int(cuts[k]), int(cuts[k + 1])
        out.append((*projected[a, : depth + 1].tolist(), *[0] * (LONGEST - depth - 1), int(totals[k])))
        if depth + 1 < LONGEST:
            grow(projected, upto, a, b, depth + 1, least, out)


def shares(projected: np.ndarray, counts: np.ndarray, out: list[tuple]) -> None:
    """Appends every prefix of two words and more with what it has here: a share of a hot prefix's counts."""
    for depth in range(2, LONGEST + 1):
        cuts = changes(projected, depth)
        totals = np.add.reduceat(counts, cuts)
        for k in np.flatnonzero(projected[cuts, depth - 1] > 0):
            out.append((*projected[cuts[k], :depth].tolist(), *[0] * (LONGEST - depth), int(totals[k])))


def changes(projected: np.ndarray, depth: int) -> np.ndarray:
    """Where rows begin whose first depth words are not those of the row before."""
    return np.flatnonzero(np.append(True, (projected[1:, :depth] != projected[:-1, :depth]).any(axis=1))[: len(projected)])


def grown(projected: np.ndarray, counts: np.ndarray, is_hot: np.ndarray, least: int) -> list[tuple]:
    """The phrases of a bucket with their counts, or their shares of these."""
    order = np.lexsort(projected.T[::-1])
    projected, counts, is_hot = projected[order], counts[order], is_hot[order]
    out: list[tuple] = []
    if is_hot.any():
        shares(projected[is_hot], counts[is_hot], out)
    projected, counts = projected[~is_hot], counts[~is_hot]
    upto, cuts = np.append(0, np.cumsum(counts)), np.append(changes(projected, 2), len(projected))
    for k in np.flatnonzero(upto[cuts[1:]] - upto[cuts[:-1]] >= least):
        grow(projected, upto, int(cuts[k]), int(cuts[k + 1]), 1, least, out)
    return out


def phrases(source: DataFrame, pairs: Bits, threes: Bits, hot: Bits, seed: int, bits: int, least: int, buckets: int) -> DataFrame:
    """(w1, .., w5, n): phrases of two words and more that occur least times; shorter ones end in zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            found, counts = folded(np.concatenate(held))
            is_hot = hot.has(bucket(found[:, 0], found[:, 1]))
            deal = (np.where(is_hot, _mixed(list(found.T)), _mixed([found[:, 0], found[:, 1]])) >> np.uint64(8)).astype(np.int64) % buckets
            order = np.argsort(deal, kind="stable")
            found, counts, deal = found[order], counts[order], deal[order]
            for lo, hi in zip(cuts := changes(deal[:, None], 1), [*cuts[1:], len(deal)], strict=True):
                yield batch(PROJECTED, [int(deal[lo])], [found[lo:hi].T.tobytes()], [counts[lo:hi].tobytes()])

        for one in numbered(batches, seed, bits):
            held.append(project(one, pairs, threes))
            size += len(held[-1])
            if size >= HELD_ROWS:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bucket after bucket; one is held whole. It has about BUCKET rows at most, and those of one prefix more: under HOT."""
        at, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            projected, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            if found := grown(projected, counts, hot.has(bucket(projected[:, 0], projected[:, 1])), least):
                yield batch(GROWN, *map(list, zip(*found, strict=True)))

        for deals, projected, counts in rows(batches, "bucket", "words", "counts"):
            for deal, p, n in zip(deals, projected, counts, strict=True):
                if held and deal != at:
                    yield from out()
                at = deal
                held.append((np.frombuffer(p, np.int64).reshape(LONGEST, -1).T, np.frombuffer(n, np.int64)))
        if held:
            yield from out()

    sent = source.mapInArrow(run, "bucket long, words binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    found = sent.mapInArrow(tasks, f"{', '.join(f'{w} long' for w in WORD)}, n long")
    return found.groupBy(*WORD).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


@F.pandas_udf(LongType())
def cut_score(a: pd.Series, n: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
    """floor(1000 * a * n / (l * r)), in whole numbers of any length."""
    return pd.Series([1000 * w * x // (y * z) for w, x, y, z in zip(a.tolist(), n.tolist(), left.tolist(), right.tolist(), strict=True)], dtype="int64")


def collocations(
    docs: DataFrame, least: int = 100, top: int | None = 2000, text: str = "text", lang: str = "lang", hot: int = HOT, bits: int = 63
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's phrases of 2 to 5 words, the best first; all of them where top is None.

    A phrase occurs a times, least at least; its worst cut leaves parts that occur l and r times, and scores floor(1000 * a * n / (l * r)),
    where n counts the lang's words. Phrases inside a longer one that occurs as often are dropped. Words are runs without blanks and tabs,
    A-Z in lower case, in pieces that end at . , ; : ! ? and line ends; a null lang is und, a null text is empty, an empty table gives no rows.
    Rows that repeat count each time; other columns are left behind. bits: of a word's number, fewer in tests.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).cast("binary").alias("lang"), F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"))
    words, seed, pairs, is_hot, n = words_and_pairs(source, least, bits, hot)
    threes, _, _ = merged(counted_threes(source, pairs, seed, bits), least, hot)
    found = Stored(phrases(source, pairs, threes, is_hot, seed, bits, least, max(LEAST_BUCKETS, -(-n // BUCKET))), "phrases")
    totals = words.df().groupBy("lang").agg(F.sum("n").alias("total"))
    return ranked(found.df(), words.df().filter(F.col("n") >= least).join(totals, "lang"), top)


def ranked(found: DataFrame, common: DataFrame, top: int | None) -> DataFrame:
    """Cuts, scores, drops and ranks phrases (w1, .., w5, n) of words (lang, word, number, n, total)."""
    whole = found.select(F.filter(F.array(*WORD), lambda x: x != 0).alias("p"), F.col("n").alias("a"))
    part = lambda first, length: F.slice("p", first, length)
    longer = whole.filter(F.size("p") > 2)
    inside = longer.select(F.explode(F.array(part(F.lit(1), F.size("p") - 1), part(F.lit(2), F.size("p") - 1))).alias("p"), "a")
    # A longer phrase that occurs as often has one of one more word inside it that does too, so these are enough.
    kept = whole.join(inside, ["p", "a"], "left_anti")
    single = common.select(F.col("number"), "lang", "word", F.col("n").alias("f"), "total")
    parts = whole.unionByName(single.select(F.array("number").alias("p"), F.col("f").alias("a")))
    left, right = (parts.select(F.col("p").alias(f"p_{c}"), F.col("a").alias(c)) for c in ("l", "r"))
    heads = kept.withColumn("number", F.element_at("p", 1)).join(single.select("number", "lang", "total"), "number").drop("number")
    cuts = heads.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("p") - 1)))
    cuts = cuts.withColumns({"p_l": F.slice("p", F.lit(1), F.col("k")), "p_r": F.slice("p", F.col("k") + 1, F.size("p") - F.col("k"))})
    cuts = cuts.join(left, "p_l").join(right, "p_r").withColumn("score", cut_score("a", "total", "l", "r"))
    worst = cuts.groupBy("lang", "p", "a", "total").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut"))
    said = worst.select("*", F.posexplode("p").alias("at", "number")).join(single.select("number", "word"), "number")
    own: list[str | Column] = ["lang", "p", "a", "total", "cut"]
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"].cast("string")), " ")
    shown = said.groupBy(*own).agg(joined.alias("phrase"))
    # The limit is taken below the shuffle too: a task sends the best rows of a lang.
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    numbers = shown.withColumn("rank", F.row_number().over(order))
    if top is not None:
        numbers = numbers.filter(F.col("rank") <= top)
    return numbers.select(F.col("lang").cast("string").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"), F.col("cut.score").alias("score"))
