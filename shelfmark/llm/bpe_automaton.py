"""Byte-pair encoding and decoding by a tokenization automaton.

The automaton reads tokens: a state for each token last read, and an arc from token
a to token b where b may come next. It starts as the loop of all single symbols and
is built by successive gadgets, one for each merge (u, v) -> w in order of priority:
  - the arc v leaves the states reached by u (u then v is always merged);
  - a state for w gets a copy of the arcs that leave v;
  - every state with an arc u gets an arc w beside it (but u itself, where u = v:
    runs merge from the left).
What is left accepts the correct encoding of each word and nothing else.

A state copied from v after some moment keeps what was closed before and shares what
v lost until then, so numbering every token next to its copies, the latest first, makes the states
that one gadget reaches a run of numbers; the same holds for the arcs that it takes away.
A gadget closes one rectangle of states and arcs. States, and arcs, that no rectangle's edge tells apart share one row,
or column, of the transition table: 12,000 by 16,000 bits for a vocabulary of 49,000.

Encoding is driven by that table: every prefix of a word has one correct encoding,
so reading a word symbol by symbol needs, for each prefix, only the last token of
its encoding: the one token that ends there and whose arc from the state of the
shorter prefix exists. All words of a batch advance together in numpy. Decoding
emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.bpe_words import TextEncoder, byte_letters, library_splitter
from shelfmark.llm.common import batch, rows, small_batches, texts

#: Rows of the transition table that are drawn at once while it is compiled.
DRAWN = 512
#: Words read together, and the longest of them; a longer one is read alone.
WORDS_AT_ONCE, LONGEST = 20_000, 48

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Distinct 64-bit keys to their values, looked up for whole arrays; -1 if absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, -1, np.int64)
        mask = (1 << self.bits) - 1
        for k, v, at in zip(keys.tolist(), values.tolist(), self._slot(keys).tolist(), strict=True):
            while self.values[at] >= 0:
                at = (at + 1) & mask
            self.keys[at], self.values[at] = k, v

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at]
        wrong = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            out[wrong] = self.values[at[wrong]]
            wrong = wrong[(self.keys[at[wrong]] != keys[wrong]) & (out[wrong] >= 0)]
        return out


class TokenizationAutomaton:
    """Compiled from the vocabulary and merges of a byte-level BPE file with an end-of-word suffix."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = "</w>"):
        size = max(vocabulary.values()) + 1
        self.labels = [""] * size
        for label, i in vocabulary.items():
            self.labels[i] = label
        letters = byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int64)
        self.final = np.array([vocabulary[x + suffix] for x in letters], np.int64)
        # A token that no merge makes is a symbol, born at 0; merge number k gives birth at k + 1.
        self.born, self.left, self.right = (np.zeros(size, np.int64) for _ in range(3))
        self.span = np.ones(size, np.int64)
        made = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        for k, (u, v, w) in enumerate(made):
            if self.born[w]:
                raise ValueError("two merges make the same token")
            self.born[w], self.left[w], self.right[w], self.span[w] = k + 1, u, v, self.span[u] + self.span[v]
        if any(max(self.born[u], self.born[v]) > k for k, (u, v, _) in enumerate(made)):
            raise ValueError("a merge comes before one of its parts")
        self._compile(size, made)
        # The symbols of a token, spelt as a polynomial hash.
        self.base = np.uint64(0x9FB21C651E98DF25)
        self.code = (np.arange(1, size + 1).astype(np.uint64) * GOLDEN) ^ (np.arange(1, size + 1).astype(np.uint64) << np.uint64(29))
        self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(self.span.max()), self.base)]), dtype=np.uint64)
        spelt, order = self.code.copy(), np.argsort(self.born, kind="stable")
        for w in order[self.born[order] > 0].tolist():
            u, v = self.left[w : w + 1], self.right[w : w + 1]  # arrays, which wrap around without a warning
            spelt[w] = (spelt[u] * self.power[self.span[v]] + spelt[v])[0]
        known = np.flatnonzero((self.born > 0) | np.isin(np.arange(size), np.concatenate([self.inner, self.final])))
        self.token_at = HashIndex(spelt[known], known)
        # Tokens by their bytes, inside a word and at its end, for words read alone.
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.inside, self.at_end = {}, {}
        for w in known.tolist():
            label = self.labels[w]
            table, label = (self.at_end, label[: -len(suffix)]) if label.endswith(suffix) else (self.inside, label)
            table[bytes(map(byte_of.__getitem__, label))] = w

    def _compile(self, size: int, made: list[tuple[int, int, int]]) -> None:
        """All gadgets, as rectangles, and the table of what they leave open.

        Going back from the last merge, copies and beside count the copies that each token will have had; what a gadget
        reaches are the token itself and its copies made later, which are numbered right behind it.
        """
        copies, beside = [0] * size, [0] * size  # of a state, of an arc
        state_at, arc_at, tall, wide = [0] * size, [0] * size, [0] * len(made), [0] * len(made)
        for k in range(len(made) - 1, -1, -1):
            u, v, w = made[k]
            arc_at[w] = beside[u]
            beside[u] += 1 + beside[w]  # first, so that with u = v the arc w leaves u too
            tall[k], wide[k] = 1 + copies[u], 1 + beside[v]
            state_at[w] = copies[v]
            copies[v] += 1 + copies[w]
        state, arc, next_state, next_arc = [0] * size, [0] * size, 0, 0
        for x in np.flatnonzero(self.born == 0).tolist():
            state[x], arc[x] = next_state, next_arc
            next_state, next_arc = next_state + 1 + copies[x], next_arc + 1 + beside[x]
        for u, v, w in made:
            state[w], arc[w] = state[v] + 1 + state_at[w], arc[u] + 1 + arc_at[w]
        top, low = np.array([state[u] for u, _, _ in made], np.int64), np.array([arc[v] for _, v, _ in made], np.int64)
        bottom, high = top + np.array(tall, np.int64), low + np.array(wide, np.int64)
        rows_, columns = np.unique(np.concatenate([top, bottom])), np.unique(np.concatenate([low, high]))
        self.row = np.searchsorted(rows_, np.array(state), "right")
        self.column = np.searchsorted(columns, np.array(arc), "right")
        self.width = -(-(len(columns) + 1) // 8) * 8
        top, bottom, low, high = (np.searchsorted(edges, x, "right") for edges, x in ((rows_, top), (rows_, bottom), (columns, low), (columns, high)))
        order = np.argsort(top, kind="stable")
        ends, drawn, waiting, k = bottom.tolist(), [], [], 0
        for first in range(0, len(rows_) + 1, DRAWN):
            last = min(first + DRAWN, len(rows_) + 1)
            block = np.zeros((last - first, self.width), bool)
            while k < len(order) and top[order[k]] < last:
                waiting.append(int(order[k]))
                k += 1
            for g in waiting:
                block[max(0, top[g] - first) : bottom[g] - first, low[g] : high[g]] = True
            waiting = [g for g in waiting if ends[g] > last]
            drawn.append(np.packbits(block))
        #: A bit for each row and column: whether the arc was taken away.
        self.closed = np.concatenate(drawn)

    def arcs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the state of each token a has an arc to token b."""
        bit = self.row[a] * self.width + self.column[b]
        return (self.closed[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 0

    def _read(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The last token of every prefix of each word, -1 past its end. symbols: a row a word."""
        n, longest = symbols.shape
        prefix = np.zeros((longest + 1, n), np.uint64)
        for j in range(longest):
            prefix[j + 1] = prefix[j] * self.base + self.code[symbols[:, j]]
        last = np.full((longest + 1, n), -1, np.int64)
        for j in range(1, longest + 1):
            todo = np.flatnonzero(lengths >= j)
            for span in range(min(j, len(self.power) - 1), 0, -1):
                if not len(todo):
                    break
                token = self.token_at.get(prefix[j, todo] - prefix[j - span, todo] * self.power[span])
                hit = np.flatnonzero(token >= 0)
                if len(hit) and span < j:
                    state = last[j - span, todo[hit]]
                    hit = hit[self.arcs(state, token[hit])]
                if len(hit):
                    last[j, todo[hit]] = token[hit]
                    todo = np.delete(todo, hit)
            assert not len(todo), "every prefix has one encoding"
        return last

    def _read_alone(self, word: bytes) -> bytes:
        """The ids of one long word, symbol by symbol."""
        last, longest = [-1] * (len(word) + 1), len(self.power) - 1
        for j in range(1, len(word) + 1):
            table = self.inside if j < len(word) else self.at_end
            for span in range(min(j, longest), 0, -1):
                token = table.get(word[j - span : j])
                if token is not None:
                    if span < j:
                        bit = int(self.row[last[j - span]]) * self.width + int(self.column[token])
                        if self.closed[bit >> 3] >> (7 - (bit & 7)) & 1:
                            continue
                    last[j] = token
                    break
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= int(self.span[last[at]])
        return np.array(out[::-1], "<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (not empty), as little-endian unsigned 32-bit integers."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        order = sorted(range(len(raw)), key=lambda k: len(raw[k]))
        short = [k for k in order if len(raw[k]) <= LONGEST]
        groups = [short[k : k + WORDS_AT_ONCE] for k in range(0, len(short), WORDS_AT_ONCE)]
        for k in order[len(short) :]:
            out[k] = self._read_alone(raw[k])
        for group in groups:
            lengths = np.array([len(raw[k]) for k in group])
            symbols = np.zeros((len(group), int(lengths.max())), np.int64)
            inside = np.arange(symbols.shape[1]) < lengths[:, None]
            symbols[inside] = self.inner[np.frombuffer(b"".join([raw[k] for k in group]), np.uint8)]
            ends = np.frombuffer(b"".join([raw[k][-1:] for k in group]), np.uint8)
            symbols[np.arange(len(group)), lengths - 1] = self.final[ends]
            last = self._read(symbols, lengths)
            at, emitted = lengths.copy(), np.zeros((len(group), symbols.shape[1]), "<u4")
            count, live = np.zeros(len(group), np.int64), np.arange(len(group))
            while len(live):
                token = last[at[live], live]
                count[live] += 1
                emitted[live, symbols.shape[1] - count[live]] = token
                at[live] -= self.span[token]
                live = live[at[live] > 0]
            for row, n, k in zip(emitted, count.tolist(), group, strict=True):
                out[k] = row[len(row) - n :].tobytes()
        return out

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, as the library joins them where a file names no decoder."""
        labels = self.labels
        return " ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()])


_loaded: dict[str, tuple] = {}


def load(path: str) -> tuple[TokenizationAutomaton, TextEncoder]:
    """The automaton of a vocabulary file, one for each process, and a new encoder for texts.

    An encoder's cache lives as long as the task that asked for it, so idle workers hold none.
    """
    if path not in _loaded:
        with open(path, encoding="utf8") as f:
            file = json.load(f)
        specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        automaton = TokenizationAutomaton({**file["model"]["vocab"]}, file["model"]["merges"], file["model"]["end_of_word_suffix"])
        for label, i in specials.items():
            automaton.labels.extend([""] * (i + 1 - len(automaton.labels)))
            automaton.labels[i] = label
        _loaded[path] = automaton, specials, library_splitter(path)
    automaton, specials, splitter = _loaded[path]
    return automaton, TextEncoder(automaton.encode_words, specials, splitter)


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, ids (little-endian unsigned 32-bit integers).

    path: the vocabulary file, there on every executor. A null or empty text has no ids; rows that repeat are
    encoded one by one, and a null doc_id stays null. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = load(path)
        for ids, bodies in rows(batches, "doc_id", "text"):
            yield batch(ENCODED, ids, encoder.encode_batch([b.decode() for b in bodies]))

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of what encode() returned, a row for each row. No ids, or null ones, are the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, _ = load(path)
        for ids, coded in rows(batches, "doc_id", "ids"):
            yield batch(schema, ids, [automaton.decode(c or b"") for c in coded])

    return encoded.mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 (encode, then decode, in one pass).

    A null or empty text has no ids; rows that repeat are encoded one by one. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, encoder = load(path)
        for ids, bodies in rows(batches, "doc_id", "text"):
            coded = encoder.encode_batch([b.decode() for b in bodies])
            yield batch(DIGESTS, ids, [len(c) // 4 for c in coded], [hashlib.sha256(c).hexdigest() for c in coded], [hashlib.sha256(automaton.decode(c).encode()).hexdigest() for c in coded])

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
