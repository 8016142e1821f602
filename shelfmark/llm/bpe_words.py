"""Texts cut into the words of a byte-pair vocabulary, and ids kept for words seen before.

Follows the file's own normaliser and splitter: NFC, lower case (each character by
itself), white space between words, then the splitting pattern; the special tokens
are found in the raw text first.
"""

from __future__ import annotations

import gc
import re
import unicodedata
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# The splitting pattern of the vocabulary file, and what Unicode calls white space.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
SPACES = regex.compile(r"\p{White_Space}+")
#: Controls that str.split() takes for white space and Unicode doesn't.
SEPARATORS = re.compile("[\x1c-\x1f]")

#: Beyond these letters and signs, what is a letter depends on the Unicode version: the library's own splitter decides.
RARE = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")

#: Words, or chunks, in one generation of a worker's cache; two generations are held.
KEPT = 400_000


def normal(chunk: str) -> str:
    """NFC, then lower case without regard to neighbours (a capital sigma is never final)."""
    return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()


def library_splitter(path: str) -> Callable[[str], list[str]]:
    """Words as the library's own normaliser and splitter make them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}

    def split(chunk: str) -> list[str]:
        found = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(chunk))
        return [bytes(map(byte_of.__getitem__, w)).decode() for w, _ in found]

    return split


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next free code point from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


@contextmanager
def uncollected() -> Iterator[None]:
    """No cycle collection for a while: encoding makes millions of objects and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Generations:
    """A cache of two generations: when the young one is full it becomes the old one."""

    def __init__(self, make: Callable[[list[str]], list[bytes]], size: int = KEPT):
        self.make, self.size, self.young, self.old = make, size, {}, {}

    def hold(self, keys: set[str]) -> dict[str, bytes]:
        """A table that has all of keys, for now."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        absent = keys - young.keys()
        if found := absent & old.keys():
            young.update(zip(found, map(old.__getitem__, found), strict=True))
            absent -= found
        if absent:
            new = list(absent)
            young.update(zip(new, self.make(new), strict=True))
        return young


class TextEncoder:
    """Texts to ids (little-endian unsigned 32-bit), given a function that encodes distinct words.

    split_rare: the words of a chunk with letters outside the Latin script.
    """

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], specials: dict[str, int], split_rare: Callable[[str], list[str]]):
        self.split_rare = split_rare
        self.specials = {k: v.to_bytes(4, "little") for k, v in specials.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.words = Generations(encode_words)
        self.chunks = Generations(self._encode_chunks)

    def _split(self, chunk: str, lower: str) -> list[str]:
        if lower[:-1].isalpha() and lower[-1] in ".,;:!?" and (chunk.isascii() or not RARE.search(chunk)):
            return [lower[:-1], lower[-1]]
        if not chunk.isascii() and RARE.search(chunk):
            return self.split_rare(chunk)
        return PATTERN.findall(normal(chunk))

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        # Most chunks are one word: composed letters of the Latin script, which are in NFC already.
        lower = [c.lower() for c in chunks]
        one = [w.isalpha() and (w.isascii() or not RARE.search(c)) for c, w in zip(chunks, lower, strict=True)]
        split = [None if o else self._split(c, w) for c, w, o in zip(chunks, lower, one, strict=True)]
        words = set(compress(lower, one)).union(*filter(None, split))
        table = self.words.hold(words)
        return [table[w] if ws is None else b"".join([table[x] for x in ws]) for w, ws in zip(lower, split, strict=True)]

    def _encode_odd(self, text: str) -> bytes:
        """One text that holds special tokens or separator controls."""
        cut = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            cut += [part] if k % 2 else [c for c in SPACES.split(part) if c]
        table = self.chunks.hold(set(cut) - self.specials.keys())
        return b"".join([self.specials.get(c) or table[c] for c in cut])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Distinct chunks of the whole batch are looked up once; the rest is array work."""
        with uncollected():
            return self._encode_batch(texts)

    def _encode_batch(self, texts: list[str]) -> list[bytes]:
        odd = {k for k, t in enumerate(texts) if SEPARATORS.search(t) or ("<|" in t and self.special and self.special.search(t))}
        cut = pc.utf8_split_whitespace(pa.array(["" if k in odd else t for k, t in enumerate(texts)], pa.large_string()))
        starts = cut.offsets.to_numpy()
        flat = cut.values
        whole = flat.dictionary_encode()
        names = whole.dictionary.to_pylist()
        table = self.chunks.hold({n for n in names if n})
        ids = [table[n] if n else b"" for n in names]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, first = np.frombuffer(b"".join(ids), "<u4"), np.concatenate([[0], sizes.cumsum()])
        at = whole.indices.to_numpy().astype(np.int64)
        counts = sizes[at]
        ends = np.concatenate([[0], counts.cumsum()])
        # Position k of the output reads from the pool at the first id of its chunk plus its place in the chunk.
        data = pool[np.repeat(first[at] - ends[:-1], counts) + np.arange(ends[-1])].tobytes() if len(at) else b""
        bounds = (4 * ends[starts]).tolist()
        return [self._encode_odd(t) if k in odd else data[bounds[k] : bounds[k + 1]] for k, t in enumerate(texts)]
