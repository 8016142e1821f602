"""Substring deduplication with repeated-phrase automata.

Every run of 50 words has one marker phrase of 8: the one with the least hash. Equal
runs have equal markers, so only markers that recur in two documents can lie in a
passage that repeats. Those are confirmed by a count over all documents, and the first document that has one
gives its words: one list of phrases for the whole corpus. The list is dealt to shards, the phrases
of one document, which are those of one passage as a rule, to the same shard. Each shard is compiled into an Aho-Corasick automaton, and
every document with a phrase of the shard is streamed through it; documents without any confirmed
phrase have nothing to be found. The occurrences that the automata report mark the
50-word windows that can repeat; these are grouped by 128-bit hashes: a window that starts in a
document with a smaller id too is removed from the later one.

A window has one marker, a marker one shard, and all documents with the marker are in it. There are as many shards as texts need,
so nearly every shard is one part, whose windows meet where they are found: what leaves it are the stretches of words to
be removed. Only the documents of a shard with more text than that (a hot passage) are dealt to parts of bounded size, each with an automaton of
its own. Each part keeps one of equal windows, that of its smallest document, for a second meeting, by hash, with those of the other parts;
so a hot passage is no hot task.

Documents with the same word sequence are folded first. An automaton's size is bounded by the phrases of a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored, batch, rows, small_batches, words
from shelfmark.llm.minhash import shingle_hashes

WINDOW, PHRASE = 50, 8
#: Phrases of a shard, about; those of one document that are sure to share one; bytes of text that one automaton reads, about; bytes of all texts for which there is a shard.
SHARD_PHRASES, OWNER_PHRASES, PART_BYTES, SHARD_BYTES = 8_000, 4_000, 4_000_000, 1_000_000
#: Lists of recurring phrases are broadcast up to so many phrases in all (8 bytes each), and the parts of shards up to so many shards; beyond, the joins shuffle.
BROADCAST_PHRASES = 1 << 20
#: Windows that one of several parts holds at once (32 bytes each). A shard of one part has fewer, as a word and a blank are two bytes.
HELD_WINDOWS = 1 << 21

READ = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_bytes", pa.int64()), ("words_sha256", pa.string()), ("markers", pa.list_(pa.int64()))])
PHRASES = pa.schema([("marker", pa.int64()), ("shard", pa.int64()), ("phrase", pa.binary())])
#: The stretches that a text loses; or windows of one of several parts that are to meet the others', packed.
WINDOWS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64())), ("shard", pa.int64()), ("bucket", pa.int64()), ("windows", pa.binary())])
REMOVED = pa.schema([("doc_id", pa.int64()), ("hashes", pa.binary())])
CHANGED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def marker_places(phrases: np.ndarray, span: int) -> np.ndarray:
    """For each run of span phrases the place of the least hash, the leftmost if it comes twice."""
    at, have = np.arange(len(phrases)), 1
    while have * 2 <= span:
        a, b = at[: len(at) - have], at[have:]
        at, have = np.where(phrases[a] <= phrases[b], a, b), have * 2
    if have < span:
        n = len(phrases) - span + 1
        a, b = at[:n], at[span - have : span - have + n]
        at = np.where(phrases[a] <= phrases[b], a, b)
    return at


def wide_hashes(ws: list[bytes]) -> np.ndarray:
    """words x 2: 128 bits of hash for each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, ws)), np.uint64).reshape(-1, 2)


def window_hashes(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """windows x 2 hashes of each run of words, given the words' hashes (words x 2); equal runs have equal hashes."""
    out = np.empty((len(h) - window + 1, 2), np.uint64)
    for k, (base, mix) in enumerate(((0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD), (0xC2B2AE3D27D4EB4F, 0xC4CEB9FE1A85EC53))):
        x = (h[:, k] ^ (h[:, k] >> np.uint64(31 + k))) * np.uint64(mix)
        up = np.full(len(h) + 1, np.uint64(base))
        up[0] = 1
        down = np.full(len(out), np.uint64(pow(base, -1, 1 << 64)))
        down[:1] = 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * np.cumprod(up)[: len(h)])])
        w = (total[window:] - total[: len(out)]) * np.cumprod(down)
        w ^= w >> np.uint64(32)
        out[:, k] = w * np.uint64(mix)
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words counted and hashed, and the distinct markers of each document."""
    for ids, keys, bodies in rows(batches, "doc_id", "text_key", "text"):
        split = [words(b) for b in bodies]
        markers = []
        for ws in split:
            if len(ws) < WINDOW:
                markers.append([])
                continue
            p = shingle_hashes(ws, PHRASE)
            markers.append(np.unique(p[marker_places(p, WINDOW - PHRASE + 1)]).view(np.int64).tolist())
        yield batch(READ, ids, keys, [len(ws) for ws in split], [len(b) for b in bodies], [hashlib.sha256(b" ".join(ws)).hexdigest() for ws in split], markers)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the phrases that documents own: the confirmed ones that no document before them has."""
    for bodies, owned in rows(batches, "text", "owned"):
        out = []
        for body, own in zip(bodies, owned, strict=True):
            ws = words(body)
            if len(ws) < WINDOW:
                continue
            hashes, places = np.unique(shingle_hashes(ws, PHRASE).view(np.int64), return_index=True)
            at = np.searchsorted(hashes, [o["marker"] for o in own])
            # Another text with the same doc_id may be the owner.
            out += [(o["marker"], o["shard"], b" ".join(ws[(p := int(places[k])) : p + PHRASE])) for o, k in zip(own, at.tolist(), strict=True) if k < len(hashes) and hashes[k] == o["marker"]]
        if out:
            yield batch(PHRASES, *zip(*out, strict=True))


def compiled(phrases: list[bytes]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase in phrases:
        # One byte, one letter; the blanks on both sides make occurrences begin and end with words.
        automaton.add_word(" %s " % phrase.decode("latin-1"))
    automaton.make_automaton()
    return automaton


def marked_places(automaton: ahocorasick.Automaton, ws: list[bytes]) -> np.ndarray:
    """Where the windows start whose marker is an occurrence that the automaton reports."""
    lengths = np.fromiter(map(len, ws), np.int64, len(ws))
    blanks = np.concatenate([[0], np.cumsum(lengths + 1)])  # of " w1 w2 ... wn "
    ends = np.fromiter((end for end, _ in automaton.iter(" %s " % b" ".join(ws).decode("latin-1"))), np.int64)
    found = np.zeros(len(ws) - PHRASE + 1, bool)
    found[np.searchsorted(blanks, ends) - PHRASE] = True
    return np.flatnonzero(found[marker_places(shingle_hashes(ws, PHRASE), WINDOW - PHRASE + 1)]) if found.any() else np.zeros(0, np.int64)


def marked_windows(automaton: ahocorasick.Automaton, ws: list[bytes]) -> np.ndarray:
    """The distinct windows (hashes, signed) at the marked places."""
    at = marked_places(automaton, ws)
    return np.unique(window_hashes(wide_hashes(ws))[at].view(np.int64), axis=0) if len(at) else np.zeros((0, 2), np.int64)


def later_windows(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows (hashes: windows x 2) also start in a document with a smaller id; docs: the document of each."""
    order = np.lexsort((docs, hashes[:, 1], hashes[:, 0]))
    d, h = docs[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (h[1:] != h[:-1]).any(axis=1)
    out = np.empty(len(d), bool)
    out[order] = d > d[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return out


def stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the words that windows at these places (ascending) cover."""
    gap = np.flatnonzero(np.diff(places) > WINDOW)
    return places[np.concatenate([[0], gap + 1])], places[np.concatenate([gap, [len(places) - 1]])] + WINDOW


def _settled(held: list[tuple], shard: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The stretches that the texts of a part lose, and of several parts what each is to tell the others. held: id, key, places and hashes of each text."""
    if not held:
        return
    sizes = [len(at) for _, _, at, _ in held]
    docs, hashes = np.repeat(np.array([h[0] for h in held], np.int64), sizes), np.concatenate([h[3] for h in held])
    later = later_windows(docs, hashes)
    out = []
    for (doc_id, key, at, _), gone in zip(held, np.split(later, np.cumsum(sizes)[:-1]), strict=True):
        if gone.any():
            starts, stops = stretches(at[gone])
            out.append((doc_id, key, starts.tolist(), stops.tolist(), None, None, None))
    if parts > 1:
        first = np.unique(np.column_stack([docs, hashes])[~later], axis=0)
        buckets = first[:, 1] % parts
        first = first[order := np.argsort(buckets, kind="stable")]
        found, at = np.unique(buckets[order], return_index=True)
        out += [(None, None, None, None, shard, k, w.tobytes()) for k, w in zip(found.tolist(), np.split(first, at[1:]), strict=True)]
    if out:
        yield batch(WINDOWS, *zip(*out, strict=True))


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard, part: the shard's phrases and its count of parts, then the part's documents."""
    automaton, at, of, held, n = None, (None, None), 0, [], 0
    for shards, parts, ids, keys, bodies, lists, counts in rows(batches, "shard", "part", "doc_id", "text_key", "text", "phrases", "parts"):
        for shard, part, doc_id, key, body, phrases, count in zip(shards, parts, ids, keys, bodies, lists, counts, strict=True):
            if phrases is not None:
                yield from _settled(held, at[0], of)
                automaton, at, of, held, n = compiled(phrases), (shard, part), count, [], 0
                continue
            assert at == (shard, part), "a part's phrases come before its documents"
            ws = words(body)
            places = marked_places(automaton, ws) if len(ws) >= WINDOW else ()
            if len(places):
                held.append((doc_id, key, places, window_hashes(wide_hashes(ws))[places].view(np.int64)))
                n += len(places)
            if of > 1 and n > HELD_WINDOWS:
                yield from _settled(held, shard, of)
                held, n = [], 0
    yield from _settled(held, at[0], of)


def _met(shared: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The windows of a bucket that another part has in a document with a smaller id, packed by document."""
    if not shared:
        return
    w = np.frombuffer(b"".join(shared), np.int64).reshape(-1, 3)
    w = w[later_windows(w[:, 0], w[:, 1:])]
    if len(w):
        w = w[np.argsort(w[:, 0], kind="stable")]
        docs, at = np.unique(w[:, 0], return_index=True)
        yield batch(REMOVED, docs.tolist(), [x[:, 1:].tobytes() for x in np.split(w, at[1:])])


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard, bucket: windows of all parts of a shard, equal ones in one bucket."""
    at, shared = None, []
    for shards, buckets, packed in rows(batches, "shard", "bucket", "windows"):
        for shard, bucket, w in zip(shards, buckets, packed, strict=True):
            if at != (shard, bucket):
                yield from _met(shared)
                at, shared = (shard, bucket), []
            shared.append(w)
    yield from _met(shared)


def _streams(phrases: DataFrame, suspects: DataFrame, shards: int) -> DataFrame:
    """For each part of each shard its phrases, then its documents: sorted for _located()."""
    routed = suspects.select(F.explode("shards").alias("shard"), "doc_id", "text_key", "text")
    parts = suspects.select(F.explode("shards").alias("shard"), F.octet_length("text").alias("size")).groupBy("shard").agg((1 + F.floor(F.sum("size") / PART_BYTES)).alias("parts"))
    parts = F.broadcast(parts) if shards <= BROADCAST_PHRASES else parts  # a row a shard: the texts cross the network once
    # SHARD_PHRASES or so in each list.
    lists = phrases.groupBy("shard", "marker").agg(F.min("phrase").alias("phrase")).groupBy("shard").agg(F.sort_array(F.collect_list("phrase")).alias("phrases")).join(parts, "shard")
    none = F.lit(None)
    heads = lists.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), none.cast("long").alias("doc_id"), none.cast("long").alias("text_key"), none.cast("binary").alias("text"), "phrases", "parts")
    bodies = routed.join(parts, "shard").select("shard", F.pmod(F.xxhash64("doc_id", "text"), F.col("parts")).alias("part"), "doc_id", "text_key", "text", none.cast("array<binary>").alias("phrases"), none.cast("long").alias("parts"))
    return heads.unionByName(bodies).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("phrases").isNull())


def keep_mask(ws: list[bytes], repeated: np.ndarray, starts: list[int] = (), stops: list[int] = ()) -> np.ndarray:
    """Which words no window among the repeated ones (windows x 2, signed) covers, and no stretch from a start to its stop."""
    depth = np.zeros(len(ws) + 1, np.int64)
    np.add.at(depth, np.array(starts, np.int64), 1)
    np.add.at(depth, np.array(stops, np.int64), -1)
    if len(repeated):
        w = window_hashes(wide_hashes(ws)).view(np.int64)
        both = np.isin(w[:, 0], repeated[:, 0])
        at = np.flatnonzero(both)
        pairs = set(map(tuple, repeated.tolist()))
        bad = np.array([p for p in at.tolist() if (int(w[p, 0]), int(w[p, 1])) in pairs], np.int64)
        np.add.at(depth, bad, 1)
        np.add.at(depth, bad + WINDOW, -1)
    return np.cumsum(depth)[:-1] == 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, keys, bodies, windows, cuts in rows(batches, "doc_id", "text_key", "text", "hashes", "cuts"):
        out = []
        for doc, key, body, packed, cut in zip(ids, keys, bodies, windows, cuts, strict=True):
            ws = words(body)
            if len(ws) < WINDOW:
                continue
            own = [c for c in cut if c["text_key"] == key]
            keep = keep_mask(ws, np.frombuffer(b"".join(packed), np.int64).reshape(-1, 2), [p for c in own for p in c["starts"]], [p for c in own for p in c["stops"]])
            if keep.all():  # another text with the same doc_id has them
                continue
            kept = b" ".join([w for w, k in zip(ws, keep.tolist(), strict=True) if k])
            out.append((doc, key, int(len(ws) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        if out:
            yield batch(CHANGED, *zip(*out, strict=True))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))


def repeated_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, text_key, n_words, n_removed, kept_sha256, kept_text.

    A word goes if a run of 50 words that covers it also starts in a document with a
    smaller doc_id; runs are judged on the input. kept_text is null where nothing goes. A null text
    has no words; rows with the same doc_id are one document to each other; a null
    doc_id is neither smaller nor larger than any. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    source = _keyed(docs, doc_id, text)
    read = Stored(source.mapInArrow(_read, "doc_id long, text_key long, n_words long, n_bytes long, words_sha256 string, markers array<long>"), "read").df()
    # Of documents with the same words all but the first lose every word, and say nothing new.
    firsts = Stored(read.filter(f"n_words >= {WINDOW} AND doc_id IS NOT NULL").groupBy("words_sha256").agg(F.min("doc_id").alias("first"), F.max("n_bytes").alias("n_bytes"), F.first("markers").alias("markers")), "firsts").df()
    marked = firsts.select(F.col("first").alias("doc_id"), F.explode("markers").alias("marker"))
    recurring = Stored(marked.groupBy("marker").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("marker", "lo"), "recurring")
    shards = 1 + max(recurring.df().count() // SHARD_PHRASES, (firsts.agg(F.sum("n_bytes")).first()[0] or 0) // SHARD_BYTES)
    owner = F.floor(F.count(F.lit(1)).over(Window.partitionBy("lo")) / OWNER_PHRASES) + 1  # a document's phrases: no more than it has words
    confirmed = Stored(recurring.df().select("marker", "lo", F.pmod(F.xxhash64("lo", F.pmod("marker", owner)), F.lit(shards)).alias("shard")), "confirmed")
    named = marked.join(confirmed.df(), "marker").groupBy("doc_id")
    lists = Stored(named.agg(F.collect_set("shard").alias("shards"), F.collect_set(F.when(F.col("lo") == F.col("doc_id"), F.struct("marker", "shard"))).alias("owned"), F.count(F.lit(1)).alias("n")), "lists")
    recurring.drop(), confirmed.drop()
    few = (lists.df().agg(F.sum("n")).first()[0] or 0) <= BROADCAST_PHRASES
    suspects = Stored(source.join(F.broadcast(lists.df()) if few else lists.df(), "doc_id"), "suspects")
    lists.drop()
    phrases = Stored(suspects.df().filter(F.size("owned") > 0).select("text", "owned").mapInArrow(_phrases, "marker long, shard long, phrase binary"), "phrases")
    located = _streams(phrases.df(), suspects.df(), shards).mapInArrow(_located, "doc_id long, text_key long, starts array<long>, stops array<long>, shard long, bucket long, windows binary")
    windows = Stored(located, "windows")
    phrases.drop()
    shared = windows.df().filter("windows IS NOT NULL").select("shard", "bucket", "windows").repartition("shard", "bucket").sortWithinPartitions("shard", "bucket")
    met = Stored(shared.mapInArrow(_resolved, "doc_id long, hashes binary"), "met")
    settled = windows.df().filter("windows IS NULL").select("doc_id", F.struct("text_key", "starts", "stops").alias("cut"))
    removed = settled.unionByName(met.df(), allowMissingColumns=True).groupBy("doc_id").agg(F.collect_list("hashes").alias("hashes"), F.collect_list("cut").alias("cuts"))
    changed = suspects.df().drop("shards", "owned", "n").join(removed, "doc_id").mapInArrow(_cut, "doc_id long, text_key long, n_removed long, kept_sha256 string, kept_text string")
    changed = Stored(changed, "changed").df().dropDuplicates(["doc_id", "text_key"])
    for done in (suspects, windows, met):
        done.drop()
    out = read.drop("markers", "n_bytes").join(firsts.drop("markers", "n_bytes"), "words_sha256", "left").join(changed, ["doc_id", "text_key"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return out.select(
        "doc_id",
        "text_key",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def drop_repeated_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns of docs; a text that loses words becomes its kept words, joined by one space.

    n_chars, where docs has such a column, follows the text. Other texts stay as they are, null ones too.
    """
    found = repeated_substrings(docs, doc_id, text).filter("n_removed > 0").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("kept_text").alias("__kept")).dropDuplicates(["__id", "__key"])
    body = F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")))
    joined = docs.withColumn("__text_key", body).join(found, (F.col(f"`{doc_id}`") == F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left")
    new = {text: F.coalesce(F.col("__kept"), F.col(f"`{text}`"))}
    if n_chars in docs.columns:
        new[n_chars] = F.when(F.col("__kept").isNotNull(), F.length("__kept").cast(docs.schema[n_chars].dataType)).otherwise(F.col(f"`{n_chars}`"))
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
