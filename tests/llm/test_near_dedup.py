import random

import numpy as np

from shelfmark.llm import components, minhash, near_dedup
from tests.llm.fixtures import awkward, clashing, frame, prose


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [r[0]]
        out.append((r[0], len(sets[i]), min(ids, default=None), r[0] == min(ids, default=None)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, near_dedup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_equals_brute_force(spark):
    assert got(frame(spark)) == brute(awkward())
    assert got(clashing(frame(spark)).repartition(5)) == brute(awkward())


def family(seed, n, edits):
    """Copies of one text with edits of their own: most link to it alone, not to each other."""
    r = random.Random(seed)
    base = prose(r, 150).split()
    rows = []
    for k in range(n):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(len(copy))] = prose(r, 1, "xyzuvw")
        rows.append((5 * k + 3, " ".join(copy), "en", "s", 0))
    r.shuffle(rows)
    return rows + [(1_000 + k, prose(r, 80), "en", "s", 0) for k in range(20)]


def test_chains_and_stars(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 16)  # so that a group spans many tiles
    for seed in (1, 2):
        rows = family(seed, 120, 9)
        assert got(frame(spark, rows)) == brute(rows)


def test_empty_and_repeated(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []
    rows = [(4, "a b c d e f", "en", "s", 1)] * 2 + [(4, "u v w x y z", "en", "s", 1), (9, "A B C D E F", "en", "s", 1)]
    assert got(frame(spark, rows)) == sorted([(4, 2, 4, True)] * 3 + [(9, 2, 4, False)], key=str)


def test_dropping(spark):
    df = clashing(frame(spark))
    out = near_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {x[0] for x in brute(awkward()) if x[3]}


def test_one_row_of_each_group_is_left(spark):
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    for rows, left in (
        ([(2, base), (2, base), (4, base)], 1),
        ([(5, base), (5, base + " end"), (9, base)], 1),
        ([(5, base), (5, "quite another text of six"), (9, base)], 2),
        ([(None, base), (None, base + " end"), (3, ""), (3, ""), (4, None)], 4),
    ):
        df = clashing(frame(spark, [(*r, "en", "s", 0) for r in rows]))
        out = near_dedup.drop_near_duplicates(df)
        assert out.columns == df.columns and out.count() == left


def test_a_very_long_text(spark):
    long = prose(random.Random(8), 180_000)
    rows = [(1, long, "en", "s", 0), (2, long + " and an end", "en", "s", 0), (3, long[: len(long) // 2], "en", "s", 0)]
    assert got(frame(spark, rows)) == brute(rows)


def test_bitmap_never_rules_out_a_link():
    rng = np.random.default_rng(3)
    for n in (5, 60, 400, 512):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        for share in (0.8, 0.86, 0.9, 1.0):
            b = np.unique(np.concatenate([a[: int(len(a) * share)], rng.integers(0, 2**63, len(a) - int(len(a) * share), dtype=np.uint64)]))
            m = np.frombuffer(near_dedup.bitmap(b), np.uint64)[None]
            if near_dedup.linked(a, b, 75):
                assert near_dedup.could_link(m, np.array([len(b)]), np.frombuffer(near_dedup.bitmap(a), np.uint64), len(a), 75)[0]


def test_estimate_is_close():
    r = random.Random(2)
    base = prose(r, 400).split()
    copy = [w if r.random() > 0.03 else "zz" for w in base]
    s, t = (near_dedup.shingle_set(" ".join(x).encode()) for x in (base, copy))
    a, b = minhash.permutations(near_dedup.BANDS * near_dedup.PLACES, near_dedup.SEED)
    sig = [np.frombuffer(near_dedup.pack(x), np.uint64) for x in minhash.signatures([s, t], a, b)]
    true = len(np.intersect1d(s, t)) / len(np.union1d(s, t))
    assert abs(near_dedup.estimates(sig[0], sig[1]) - true) < 0.15


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 100), (200, 201)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(edges).df().collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 200: 200, 201: 200}


def test_many_bands_are_joined_by_a_shuffle(spark, monkeypatch):
    """Beyond the bound on what is broadcast the results are the same."""
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    assert got(frame(spark)) == brute(awkward())
