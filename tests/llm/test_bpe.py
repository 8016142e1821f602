import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import bpe_automaton
from tests.llm.fixtures import awkward, clashing, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abcdeinorst '.,!AÉß0123", max_size=120))
def test_encodes_and_decodes_as_the_library(text):
    automaton, encoder = bpe_automaton.load(PATH)
    coded = encoder.encode_batch([text])[0]
    assert np.frombuffer(coded, "<u4").tolist() == ids(text)
    assert automaton.decode(coded) == LIBRARY.decode(ids(text), skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 70, "ab" * 100, "inintheanre" * 12, "zq" * 60])
def test_long_words_are_read_alone(word):
    automaton, _ = bpe_automaton.load(PATH)
    assert np.frombuffer(automaton.encode_words([word])[0], "<u4").tolist() == ids(word)


def test_arcs_are_what_the_merges_leave():
    """On a tiny vocabulary: an arc exists exactly if its two tokens, joined, are encoded as those two."""
    letters = bpe_automaton.byte_letters()
    merges = [["a", "b"], ["a", "a"], ["aa", "b</w>"], ["ab", "ab"], ["b", "a"], ["ab", "c</w>"]]
    names = [*letters, *(x + "</w>" for x in letters), *(a + b for a, b in merges)]
    automaton = bpe_automaton.TokenizationAutomaton({n: k for k, n in enumerate(names)}, merges)

    def slow(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        for a, b in merges:
            k = 0
            while k < len(parts) - 1:
                if parts[k] == a and parts[k + 1] == b:
                    parts[k : k + 2] = [a + b]
                k += 1
        return parts

    from itertools import product

    for n in range(1, 8):
        for w in map("".join, product("abc", repeat=n)):
            got = [names[i] for i in np.frombuffer(automaton.encode_words([w])[0], "<u4").tolist()]
            assert got == slow(w), w


def outlived(automaton, merges, a, b):
    """The rule without a table: an arc is followed back from copy to original, until a merge took it away."""
    until = 1 << 60
    while True:
        ba, bb, left, right = automaton.born[a], automaton.born[b], automaton.left, automaton.right
        if merges.get((a, b), until) < until or (bb > ba and left[b] == right[b] == a):
            return False
        if not ba and not bb:
            return True
        until = max(ba, bb)
        a, b = right[a] if ba >= bb else a, left[b] if bb >= ba else b


def test_table_says_what_the_gadgets_say():
    automaton, _ = bpe_automaton.load(PATH)
    merges = {(int(automaton.left[w]), int(automaton.right[w])): int(automaton.born[w]) for w in np.flatnonzero(automaton.born)}
    r = np.random.default_rng(3)
    pairs = [*r.integers(0, 49406, (4000, 2)).tolist(), *list(merges)[::37], *((a, int(automaton.left[b])) for a, b in list(merges)[::41] if automaton.born[b])]
    a, b = np.array(pairs).T
    assert automaton.arcs(a, b).tolist() == [outlived(automaton, merges, *p) for p in pairs]
    assert not automaton.arcs(a, b).all() and automaton.closed.nbytes < 40 << 20


def test_ids_come_from_the_table():
    """One arc taken away: the words that went along it are read otherwise, or not at all."""
    automaton, _ = bpe_automaton.load(PATH)
    word, (a, b) = "shelfmark", ids("shelfmark")[:2]
    bit = int(automaton.row[a]) * automaton.width + int(automaton.column[b])
    automaton.closed[bit >> 3] ^= 128 >> (bit & 7)
    try:
        with pytest.raises(AssertionError):
            automaton.encode_words([word])
    finally:
        automaton.closed[bit >> 3] ^= 128 >> (bit & 7)
    assert np.frombuffer(automaton.encode_words([word])[0], "<u4").tolist() == ids(word)


def test_merges_in_no_order_are_refused():
    letters = bpe_automaton.byte_letters()
    for merges in ([["ab", "c"], ["a", "b"]], [["a", "bc"], ["ab", "c"], ["b", "c"]]):
        names = dict.fromkeys([*letters, *(x + "</w>" for x in letters), "ab", "bc", "abc"])
        with pytest.raises(ValueError):
            bpe_automaton.TokenizationAutomaton({n: k for k, n in enumerate(names)}, merges)


def test_repeated_rows_and_a_very_long_text(spark):
    long = " ".join(f"word{k % 977} ünd" for k in range(90_000))  # about 1 MB
    rows = [(1, long, "en", "s", len(long)), (1, "same", "en", "s", 4), (1, "same", "en", "s", 4)]
    got = sorted(r["n_tokens"] for r in bpe_automaton.digests(frame(spark, rows), PATH).collect())
    assert got == sorted(len(ids(t)) for _, t, *_ in rows)


def test_digests(spark):
    for df in (frame(spark), clashing(frame(spark))):
        got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe_automaton.digests(df, PATH).collect()}
        for doc, text, *_ in awkward():
            i = ids(text or "")
            assert got[doc] == (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(i, skip_special_tokens=False).encode()).hexdigest())


def test_round_trip_and_empty_table(spark):
    coded = bpe_automaton.encode(frame(spark), PATH)
    back = {r["doc_id"]: r["text"] for r in bpe_automaton.decode(coded, PATH).collect()}
    assert back == {d: LIBRARY.decode(ids(t or ""), skip_special_tokens=False) for d, t, *_ in awkward()}
    assert bpe_automaton.digests(frame(spark, []), PATH).collect() == []
