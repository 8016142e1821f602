import math
import random
import re
from collections import Counter

import numpy as np

import __spark_entry__ as entry
from shelfmark.llm import wand_search
from shelfmark.llm.oracles import ORACLES
from tests.llm.fixtures import awkward, clashing, frame, prose
from tests.oracle import both, connect

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, k=10):
    """Every document scored for every item, from the contract alone."""
    counts = [(r[0], Counter(terms(r[1]))) for r in rows]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out, asked = [], {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    for item, ts in asked.items():
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **more):
    found = wand_search.search(docs, spark.createDataFrame(items, ITEMS), **more)
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(rows, r):
    texts = [x[1] for x in rows if x[1]]
    return [(k, " ".join(w for t in r.sample(texts, 3) for w in r.sample(t.split() or ["x"], min(6, len(t.split()) or 1)))) for k in range(12)] + [(90, None), (91, ""), (92, "?!"), (93, "nowhere-to-be-found"), (94, "Hello"), (94, "日本語"), (None, "go a é")]


def test_terms():
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice("aZ09 @[`{\x7f\x00\x80\xa0\x85É日 /:_-\n") for _ in range(40))
        assert [x.decode() for x in wand_search.terms(t.encode())] == terms(t)


def test_equals_brute_force(spark, monkeypatch):
    rows = awkward()
    items = items_of(rows, random.Random(5))
    assert got(spark, frame(spark), items) == brute(rows, items)
    # Many small shards, small windows, several blocks.
    for name, value in (("SHARD_DOCS", 3), ("WINDOW", 2), ("SHARD_POSTINGS", 40)):
        monkeypatch.setattr(wand_search, name, value)
    assert got(spark, frame(spark).repartition(3), items, block=4) == brute(rows, items)
    assert got(spark, frame(spark), items, k=1) == brute(rows, items, 1)


def test_ties_repeats_and_clashing_columns(spark):
    rows = [(k % 37, "Same old text, same score", "en", "s", 1) for k in range(60)] + [(None, "same old text same score", None, None, None), (99, "other words", "en", "s", 1)]
    items = [(1, "same text"), (2, "other"), (3, "old old SCORE words")]
    assert got(spark, frame(spark, rows), items) == brute(rows, items)
    assert got(spark, clashing(frame(spark, rows)), items) == brute(rows, items)


def test_empty_tables(spark):
    assert got(spark, frame(spark, []), [(1, "a")]) == []
    assert got(spark, frame(spark, [(1, None, None, None, None), (2, "", "en", "s", 0)]), [(1, "a")]) == []
    assert got(spark, frame(spark), []) == []


def test_one_very_long_text(spark):
    rows = [(1, prose(random.Random(2), 300_000), "en", "s", 1), (2, "aa bb", "en", "s", 1), (3, "bb cc", "en", "s", 1)]
    items = [(1, "aa bb zz"), (2, "a b c")]
    assert got(spark, frame(spark, rows), items) == brute(rows, items)


def test_documents_below_the_heap_are_not_scored():
    r = np.random.default_rng(1)
    n, heap = 20_000, wand_search.Heap(10)
    lists = [(np.flatnonzero(r.random(n) < share), top) for share, top in ((0.9, 5), (0.7, 9), (0.4, 30), (0.02, 3000), (0.01, 4000))]
    lists = [(p, r.integers(1, top + 1, len(p)), top) for p, top in lists]
    whole = np.zeros(n, np.int64)
    for p, i, _ in lists:
        whole[p] += i
    wand_search.wand(heap, [(p, i, int(i.max())) for p, i, _ in lists], list(range(n)))
    assert sorted(heap.held) == sorted((int(whole[k]), -k) for k in sorted(range(n), key=lambda k: (-whole[k], k))[:10])
    assert heap.scored < n / 10
    before = heap.scored
    wand_search.wand(heap, [(np.arange(5), np.full(5, 2), 2)], list(range(5)))  # a shard that can't beat the heap is left out whole
    assert heap.scored == before


def test_equals_its_sql(spark, sf):
    mine, theirs = both(entry.queries()["op13_wand_search"](spark, sf), ORACLES["op13_wand_search"], connect(sf))
    assert mine == theirs and len(mine) > 100


def test_shuffles_carry_hits_alone(spark, sf):
    plan = entry.queries()["op13_wand_search"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning(item") == 1 and "postings" in plan
