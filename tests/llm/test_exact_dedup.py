import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.exact_dedup import CountingQuotientFilter, drop_exact_duplicates, exact_duplicates
from tests.llm.fixtures import awkward, clashing, frame


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**40 - 1) | st.integers(0, 7), max_size=40), min_size=1, max_size=4))
def test_filters_merge_without_loss(parts):
    built = [CountingQuotientFilter.build(np.array(p, np.uint64), 40) for p in parts]
    merged = CountingQuotientFilter.from_bytes(built[0].merge(*built[1:]).to_bytes())
    expected = defaultdict(int)
    for p in parts:
        for x in p:
            expected[x] += 1
    f, n = merged.items()
    assert dict(zip(f.tolist(), n.tolist(), strict=True)) == expected
    assert f.tolist() == sorted(f.tolist())
    assert all(merged.count(x) == c for x, c in expected.items()) and merged.count(2**40 - 12345) == expected.get(2**40 - 12345, 0)


def lower(t):
    return (t or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for doc, t, *_ in rows:
        groups[lower(t)].append(doc)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    for df in (frame(spark), clashing(frame(spark)), frame(spark).repartition(7)):
        got = exact_duplicates(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
        assert sorted(map(tuple, got), key=str) == brute(awkward())


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "x", "en", "s", 1), (1, "x", "en", "s", 1), (2, "X", "en", "s", 1)]
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_duplicates(frame(spark, rows)).collect()) == [(1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True)]
    assert exact_duplicates(frame(spark, [])).collect() == []


def test_dropping_keeps_columns(spark):
    df = clashing(frame(spark))
    out = drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == {x[0] for x in brute(awkward()) if x[3]}


def test_one_row_of_each_text_is_left(spark):
    for rows, left in (
        ([(2, "x"), (2, "x"), (1, "x")], [(2, "x")]),
        ([(5, "x"), (5, "y"), (9, "x")], [(5, "y"), (9, "x")]),
        ([(3, "x"), (3, "X"), (None, "x"), (None, "z"), (None, "Z"), (4, None), (6, "")], None),
    ):
        out = [(r["doc_id"], r["text"]) for r in drop_exact_duplicates(clashing(frame(spark, [(*r, "en", "s", 0) for r in rows]))).collect()]
        assert left is None or sorted(out, key=str) == sorted(left, key=str)
        assert len(out) == len({lower(t) for _, t in rows}) == len({lower(t) for _, t in out})
    assert (6, "") in out and any(d == 3 for d, _ in out)


def test_very_long_texts(spark):
    long = "Ab " * 400_000  # 1.2 MB
    rows = [(k, long if k % 2 else long.lower(), "en", "s", 0) for k in range(6)] + [(9, long + "c", "en", "s", 0)]
    got = exact_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(k, 5, 6) for k in range(6)] + [(9, 9, 1)]


def test_many_repeats_are_joined_by_a_shuffle(spark, monkeypatch):
    """Beyond the bound on what is broadcast the results are the same."""
    from shelfmark.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    got = exact_duplicates(frame(spark)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(awkward())
    assert {r["doc_id"] for r in drop_exact_duplicates(frame(spark)).collect()} == {x[0] for x in brute(awkward()) if x[3]}


def test_a_group_sends_one_row_a_task(spark):
    """Winners come from an aggregate that is combined before the shuffle; no window or join gathers a text's rows."""
    rows = [(k, "copy" if k % 3 else f"own {k}", "en", "s", 0) for k in range(200)]
    out = drop_exact_duplicates(frame(spark, rows))
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in p and "text_sha256" not in p.replace("text_sha256:", "")
    assert {r["doc_id"] for r in out.collect()} == {k for k in range(200) if k % 3 == 0} | {199}
