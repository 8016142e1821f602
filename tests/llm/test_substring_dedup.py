import hashlib
import random

import numpy as np

from shelfmark.llm import substring_dedup as sd
from tests.llm.fixtures import awkward, clashing, frame, prose


def brute(rows):
    ws = [(r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for doc, w in ws:
        if doc is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k : k + 50])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in ws:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if doc is not None and first[tuple(w[k : k + 50])] < doc:
                gone[k : k + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, sd.repeated_substrings(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    assert got(frame(spark)) == brute(awkward())
    monkeypatch.setattr(sd, "BROADCAST_PHRASES", -1)
    assert got(clashing(frame(spark)).repartition(5)) == brute(awkward())


def test_overlapping_passages(spark):
    r = random.Random(4)
    pool = prose(r, 400).split()
    rows = []
    for k in range(40):  # stretches of one text, some under fifty words, between words of their own
        a = r.randrange(350)
        rows.append((k, f"{prose(r, 20, 'xyz')} {' '.join(pool[a : a + r.choice([30, 49, 50, 51, 90])])} {prose(r, 20, 'uvw')}", "en", "s", 0))
    assert got(frame(spark, rows)) == brute(rows)


def test_empty_and_repeated(spark):
    assert sd.repeated_substrings(frame(spark, [])).collect() == []
    t = prose(random.Random(1), 60)
    rows = [(2, t, "en", "s", 0), (2, t, "en", "s", 0), (2, "own words " + t, "en", "s", 0), (3, t + " more", "en", "s", 0), (None, t, "en", "s", 0)]
    assert got(frame(spark, rows)) == brute(rows)


def test_cutting_keeps_rows_and_columns(spark):
    df = clashing(frame(spark))
    out = sd.drop_repeated_substrings(df)
    assert out.columns == df.columns and out.count() == df.count()
    expected = {r[0]: r[2] for r in brute(awkward())}
    for r in out.collect():
        before = next(x for x in awkward() if x[0] == r["doc_id"])
        if expected[r["doc_id"]]:
            assert len(r["text"].split()) == len(before[1].split()) - expected[r["doc_id"]] and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == before[1] and r["n_chars"] == before[4]


def test_markers_and_windows_depend_on_content_alone():
    h2 = np.random.default_rng(1).integers(0, 2**63, (300, 2), dtype=np.uint64)
    h = h2[:, 0]
    at = sd.marker_places(h, 43)
    assert all(at[k] == k + int(np.argmin(h[k : k + 43])) for k in range(len(at)))
    w = sd.window_hashes(np.concatenate([h2[:100], h2[20:120]]))
    assert (w[20:51] == w[100:131]).all() and len(np.unique(w[:, 0])) == len(w) - 31


def test_occurrences_come_from_the_automaton():
    """Without one phrase, the windows that it marks are not found; with all, they are."""
    r = random.Random(5)
    ws = prose(r, 200).encode().split()
    hashes = sd.shingle_hashes(ws, sd.PHRASE)
    places = sd.marker_places(hashes, sd.WINDOW - sd.PHRASE + 1)
    every = [b" ".join(ws[p : p + sd.PHRASE]) for p in np.unique(places).tolist()]
    assert len(sd.marked_windows(sd.compiled(every), ws)) == len(ws) - sd.WINDOW + 1
    for k, p in enumerate(np.unique(places).tolist()):
        left = sd.marked_windows(sd.compiled(every[:k] + every[k + 1 :]), ws)
        assert len(left) == len(places) - int((places == p).sum())
    assert len(sd.marked_windows(sd.compiled([b"no such phrase"]), ws)) == 0


def test_many_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_PHRASES", 5)
    monkeypatch.setattr(sd, "OWNER_PHRASES", 3)
    monkeypatch.setattr(sd, "PART_BYTES", 2000)
    assert got(frame(spark)) == brute(awkward())


def passages(n):
    """Texts that share passages of a pool in twos and threes, each between words of its own."""
    r = random.Random(7)
    pool = [prose(r, 90) for _ in range(n // 3)]
    return [(k, f"{prose(r, 60, 'xyz')} {r.choice(pool)} {prose(r, 60, 'uvw')} {r.choice(pool)}", "en", "s", 0) for k in range(n)]


def stored(monkeypatch):
    """Rows of each table that is stored from now on."""
    seen = {}

    class Counted(sd.Stored):
        def __init__(self, df, name):
            super().__init__(df, name)
            seen[name] = self.df().count()

    monkeypatch.setattr(sd, "Stored", Counted)
    return seen


def test_windows_meet_where_they_are_found(spark, monkeypatch):
    """Of a shard that is one part no window is stored or crosses the network, only the stretches that texts lose."""
    rows, seen = passages(60), stored(monkeypatch)
    monkeypatch.setattr(sd, "SHARD_PHRASES", 5)
    assert got(frame(spark, rows)) == brute(rows)
    assert sum(x[2] for x in brute(rows)) > 2000 and seen["windows"] <= 2 * len(rows) and seen["met"] == 0


def test_shards_in_parts_share_what_is_first(spark, monkeypatch):
    """A hot passage beside others in shards of several parts, which also hold few windows at once: windows travel packed, equal ones of a part once."""
    hot = prose(random.Random(8), 90)
    rows = passages(60) + [(100 + k, f"{prose(random.Random(k), 30, 'rst')} {hot}", "en", "s", 0) for k in range(40)]
    rows += [(100, rows[0][1] + " under an id of its own", "en", "s", 0), (7, hot, "en", "s", 0)]
    seen = stored(monkeypatch)
    monkeypatch.setattr(sd, "PART_BYTES", 20_000)
    assert got(frame(spark, rows)) == brute(rows)
    assert seen["met"] > 0 and seen["windows"] < 3 * len(rows)
    monkeypatch.setattr(sd, "PART_BYTES", 6_000)
    monkeypatch.setattr(sd, "HELD_WINDOWS", 40)
    monkeypatch.setattr(sd, "BROADCAST_PHRASES", -1)
    assert got(frame(spark, rows).repartition(3)) == brute(rows)


def test_later_windows_and_their_stretches():
    docs, h = np.array([5, 3, 5, 9, 3, 3]), np.array([[1, 1], [1, 1], [1, 2], [1, 2], [7, 7], [7, 7]])
    assert sd.later_windows(docs, h).tolist() == [True, False, False, True, False, False]
    starts, stops = sd.stretches(np.array([0, 1, 51, 102, 110]))
    assert (starts.tolist(), stops.tolist()) == ([0, 102], [101, 160])


def test_a_very_long_text(spark):
    r = random.Random(6)
    long = prose(r, 180_000)  # over 0.7 MB
    rows = [(1, " ".join(long.split()[500:900]), "en", "s", 0), (2, long, "en", "s", 0), (3, long + " end", "en", "s", 0)]
    assert got(frame(spark, rows)) == brute(rows)
