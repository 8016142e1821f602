import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfmark.llm import phrase_growth
from shelfmark.llm.oracles import ORACLES
from tests.llm.fixtures import awkward, clashing, frame, prose
from tests.oracle import both, connect


def pieces(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def brute(rows, least, top=None):
    """The contract, phrase by phrase."""
    f, n = Counter(), Counter()
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(t):
            n[lang] += len(ws)
            f.update((lang, *ws[i : i + m]) for m in range(1, 6) for i in range(len(ws) - m + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = set()
    for p, a in cands.items():
        for m in range(2, len(p) - 1):
            for i in range(1, len(p) - m + 1):
                part = (p[0], *p[i : i + m])
                if 100 * a >= 100 * cands[part]:
                    inside.add(part)
    found = {}
    for p, a in cands.items():
        if p not in inside:
            cuts = [(1000 * a * n[p[0]] // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k, f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
            score, _, left, right = min(cuts)
            found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, k + 1, w.decode(), -a, left, right, n[lang], -s) for lang, xs in found.items() for k, (s, a, w, left, right) in enumerate(sorted(xs)[:top]))


def got(df, **more):
    return sorted(map(tuple, phrase_growth.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=3):
    """Few words, so that phrases recur; marks, tabs and line ends; a phrase that a third of all texts is made of."""
    r = random.Random(seed)
    said = "red blue the of a É 日本 x' <b> go".split()
    rows = []
    for k in range(150):
        t = "".join(r.choice(said) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "!?", "\n", "\r\n", " ; "]) for _ in range(r.randint(0, 40)))
        rows.append((k, t if k % 3 else "Go go GO red blue " * r.randint(1, 4), r.choice(["en", "fr", None, "und"]), "s", len(t)))
    return rows + awkward()


def test_words():
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choice("aZ.,;:!?\n\x0b\x0c\r\t x\x1c\x85\xa0é-'") for _ in range(40))
        mine = [[w.decode() for w in p] for p in _split(phrase_growth.tokens(t.encode()))]
        assert mine == pieces(t)


def _split(tokens):
    out = [[]]
    for w in tokens:
        if w == b"\n":
            out.append([])
        elif w:
            out[-1].append(w)
    return out


@pytest.mark.parametrize("hot", [20, 1])
def test_equals_brute_force(spark, hot):
    """With some hot prefixes, and with hot ones alone; the other tests have none."""
    rows = corpus()
    want = brute(rows, 3)
    assert len({len(x[2].split(" ")) for x in want}) == 4 and got(frame(spark, rows).repartition(3), least=3, top=None, hot=hot) == want


def test_small_flushes_and_best_rows(spark, monkeypatch):
    for name, value in (("HELD_ROWS", 7), ("HELD_RUNS", 9), ("HELD_WORDS", 11)):
        monkeypatch.setattr(phrase_growth, name, value)
    rows = corpus(5)
    assert got(frame(spark, rows), least=4, top=5) == brute(rows, 4, 5)


def test_numbers_that_words_share_are_drawn_again(spark):
    rows = corpus(7)
    source = frame(spark, rows).select(F.lit(b"en").alias("lang"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    assert phrase_growth.words_and_pairs(source, 50, 17, 1 << 20)[1] > 0
    assert got(frame(spark, rows), least=50, top=None, bits=17) == brute(rows, 50)


def test_repeats_nulls_and_clashing_columns(spark):
    rows = [(1, "a b c. a b c", "en", "s", 1)] * 5 + [(None, "a b c", None, None, None), (2, None, "en", "s", 0), (3, "", None, "s", 0), (None, "b c, b c", None, None, None)]
    assert got(frame(spark, rows), least=2, top=None) == brute(rows, 2)
    assert got(clashing(frame(spark, rows)).withColumns({c: F.lit(1) for c in ("n", "p", "w1", "number", "word")}), least=2, top=None) == brute(rows, 2)


def test_empty_tables(spark):
    assert got(frame(spark, [])) == [] and got(frame(spark, [(1, None, None, None, None)]), least=1) == []


def test_a_very_long_text(spark):
    rows = [(1, prose(random.Random(1), 60_000, "ab"), "en", "s", 1), (2, "go " * 50_000, "en", "s", 1)]
    assert got(frame(spark, rows), least=400, top=None) == brute(rows, 400)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    df = spark.createDataFrame([(big + 1, 7 * big + 3, 2 * big - 1, 5 * big + 7), (1, 2**62, 1, 2**61)], "a long, n long, l long, r long")
    assert [r[0] for r in df.select(phrase_growth.cut_score("a", "n", "l", "r")).collect()] == [1000 * (big + 1) * (7 * big + 3) // ((2 * big - 1) * (5 * big + 7)), 2000]


def test_equal_hashes_do_not_mix_rows(monkeypatch):
    monkeypatch.setattr(phrase_growth, "_mixed", lambda columns: np.zeros(len(columns[0]), np.uint64))
    rows, n = phrase_growth.folded(np.array([[1, 2, 0, 0, 0], [1, 2, 0, 0, 0], [1, 3, 0, 0, 0], [1, 2, 0, 0, 0]]))
    total = Counter()
    for r, k in zip(rows.tolist(), n.tolist(), strict=True):
        total[tuple(r)] += k
    assert total == {(1, 2, 0, 0, 0): 3, (1, 3, 0, 0, 0): 1}


def test_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    mine, theirs = both(entry.queries()["op11_phrase_growth"](spark, sf), ORACLES["op11_phrase_growth"], connect(sf))
    assert mine == theirs and len(mine) > 50
