"""Operators on small relations, and order-dependent ones against a plain restatement."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import fuzzy
from shelfmark.operators import cluster, dedupe, gates, names, sets, spatial
from shelfmark.plans import candidates
from shelfmark.plans.queries import QUERIES

PRODUCT = "n int, store_id string, sale_start string, sale_end string, product_name string, specification string, price_ex_tax_yen string, price_in_tax_yen string, tax_rate string, category string"


def test_policy(spark):
    day = ("2026-09-12", "2026-09-12")
    rows = [
        (1, "s", *day, "りんご", "1個", "108.9", None, "0.08", "食品"),
        (2, "s", *day, " リンゴ ", "", "199.9", "", "0.08", "食品"),
        (3, "s", *day, "りんご", "１個", "108", "116.2", "0.08", "食品"),
        (4, "s", *day, "みかん", "", "", "0", "", "食品"),
        (5, "s", *day, "50%OFF", "", None, None, None, "食品"),
        (6, "s", *day, "アリエール", "", "300", None, "0.1", "日用品"),
        (7, "s", *day, "なし", "", "-5", "3", "", "食品"),
    ]
    df = spark.createDataFrame(rows, PRODUCT)
    kept = {r["n"]: (r["price_ex_tax_yen"], r["price_in_tax_yen"]) for r in dedupe.output_policy(df, [F.col("n")]).collect()}
    assert kept == {1: (108, 116), 2: (199, 214), 6: (300, 330)}
    assert {r["n"] for r in dedupe.output_policy(df, [F.col("n")], drop_household=True).collect()} == {1, 2}


def test_gate_never_counts_rows(spark):
    schema = "n int, store_id string, product_name string, specification string, promotion string, price_in_tax_yen string, sale_start string, sale_end string, source_url string, source_image string, source_fingerprint string"
    good = (1, "s", "りんご", "", "", "100", "2026-09-12", "2026-09-13", "u", "i", "f")
    verdict = gates.row_verdict(gates.row_report(spark.createDataFrame([good], schema), [F.col("n")], "2020-01-01")).first()
    assert verdict["passes"] and verdict["errors"] == []
    bad = [good, (2, *good[1:]), (3, "s", "", "", "50%OFF", "", "2026-09-14", "2026-09-13", "u", " ", "f")]
    verdict = gates.row_verdict(gates.row_report(spark.createDataFrame(bad, schema), [F.col("n")], "2026-09-12")).first()
    assert verdict["errors"] == ["bad_price=1", "blank_name=1", "duplicates=1", "bad_dates=1", "percent_only=1", "missing_provenance=1"]


def test_recall_of_nothing_is_one(spark):
    none, some = spark.createDataFrame([], "v int"), spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert sets.recall(none, some, ["v"]).first()["recall"] == 1.0
    assert sets.recall(some, spark.createDataFrame([(1,), (3,)], "v int"), ["v"]).first()["recall"] == pytest.approx(1 / 3)


@pytest.mark.parametrize(
    ("read", "expected", "status"),
    [
        ("とろけるチーズ ３ 連", "とろけるチーズ3連", "dictionary_resolved"),
        ("とろけるチーズ 連 3", "とろけるチーズ3連", "dictionary_resolved"),
        ("とろけるチーズ 4連", "とろけるチーズ 4連", "ocr_unverified"),
        ("明治ブルガリアヨーグルト", "明治ブルガリアヨーグルト", "dictionary_resolved"),
        ("牛乳 199円", "牛乳 199円", "ocr_unverified"),
    ],
)
def test_resolve(spark, read, expected, status):
    d = spark.createDataFrame([("とろけるチーズ3連", 0), ("明治ブルガリアヨーグルト", 1), ("天然水900ml", 2)], "name string, ordinal int")
    got = names.resolve(spark.createDataFrame([(1, read)], "text_id int, text string"), d).first()
    assert (got["name"], got["status"]) == (expected, status)


def test_resolve_without_dictionary(spark):
    got = names.resolve(spark.createDataFrame([(1, " x ")], "text_id int, text string"), spark.createDataFrame([], "name string, ordinal int")).first()
    assert (got["name"], got["reason"]) == ("x", "empty_dictionary")


@pytest.mark.parametrize("size", [1000, 3])
def test_every_text_is_ranked_against_every_name(spark, monkeypatch, size):
    monkeypatch.setattr(names, "TEXTS", size, raising=False)
    monkeypatch.setattr(names, "NAMES", size, raising=False)
    entries = [(f"{n} {k}本", 10 * i + k) for i, n in enumerate(["牛乳", "豆乳", "うどん", "large ring"]) for k in range(1, 5)]
    reads = [(k, t) for k, t in enumerate(["牛乳 2本", "豆 乳", "largc ring 3本", "x", "", None, "うどん", "牛乳 2本"])]
    ranked = names.ranks(spark.createDataFrame(reads, "text_id int, text string"), spark.createDataFrame(entries, "name string, ordinal int")).collect()
    assert len(ranked) == len({t for _, t in reads}) * len(entries)
    for text in {t for _, t in reads}:
        mine = sorted((r for r in ranked if r["text"] == text), key=lambda r: r["rank"])
        assert {(r["name"], r["ordinal"]) for r in mine} == set(entries) and [r["rank"] for r in mine] == list(range(1, len(entries) + 1))
        assert mine == sorted(mine, key=lambda r: (r["veto"], -r["score"], -r["support"], r["ordinal"]))
        assert all(r["base_score"] == fuzzy.base_score(r["name"], text) for r in mine)


def test_the_best_names_without_scoring_all(spark):
    """The best two of each text are those of the whole ranking; few pairs come to be scored."""
    import random

    r = random.Random(3)
    letters = "牛乳豆うどん天然水国産鶏大容量国産 ring clock large"
    entries = [("".join(r.choice(letters) for _ in range(r.randint(0, 9))) + r.choice(["", "3本", "500ml", "１２枚"]), k) for k in range(160)]
    reads = [(k, "".join(c for c in r.choice(entries)[0] if r.random() < 0.85) + r.choice(["", "3本", " 1"])) for k in range(40)] + [(98, None), (99, ""), (100, "x"), (101, "x")]
    t, d = spark.createDataFrame(reads, "text_id int, text string"), spark.createDataFrame(entries, "name string, ordinal int")
    key = lambda rows: sorted((x["text"] or "~", x["rank"], x["name"], x["ordinal"], x["score"], x["support"], x["veto"]) for x in rows)
    whole = names.ranks(t, d).collect()
    assert key(names.ranks(t, d, 2).collect()) == key(x for x in whole if x["rank"] <= 2)
    assert key(names.ranks(t, d.limit(1), 2).collect()) == key(names.ranks(t, d.limit(1)).collect())
    pairs = names.bounded_pairs(t, d)
    over = names._scored(pairs).filter(F.col("score") > F.col("__most"))
    assert over.count() == 0 and names.able_pairs(pairs, 2).count() < 0.35 * pairs.count()


def test_all_parts_are_resolved_and_scored(spark, sf):
    from shelfmark.plans import text_queries

    keys = sorted(r[0] for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect())
    assert sorted(r["text_id"] for r in text_queries.dictionary_resolve(spark, sf).collect()) == keys
    assert sorted(r["text_id"] for r in text_queries.record_scores(spark, sf).collect()) == sorted(4 * keys)
    parts = spark.read.parquet(f"{sf}/part.parquet").select("p_name", "p_size").distinct().count()
    assert text_queries.dictionary(spark, sf).count() == parts


def test_gate_takes_prices_that_are_no_numbers(spark):
    schema = "n int, store_id string, product_name string, specification string, promotion string, price_in_tax_yen string, sale_start string, sale_end string, source_url string, source_image string, source_fingerprint string"
    prices = ["NaN", "Infinity", "-Infinity", "1e30", "1e30", "-0.5", "99.9", "99", "x", None, "1e400"]
    rows = [(k, "s", "りんご", "", "", p, "2026-09-12", "2026-09-13", "u", "i", "f") for k, p in enumerate(prices)]
    got = {r["n"]: (r["bad_price"], r["duplicate"]) for r in gates.row_faults(spark.createDataFrame(rows, schema), [F.col("n")]).collect()}
    assert [got[k][0] for k in range(11)] == [True, True, True, False, False, True, False, False, True, True, True]
    assert got[4][1] and got[7][1] and not got[3][1] and not got[6][1]
    verdict = gates.row_verdict(gates.row_report(spark.createDataFrame(rows, schema), [F.col("n")], "2026-09-12")).first()
    assert verdict["errors"] == ["bad_price=7", "duplicates=8"]


@pytest.mark.parametrize(
    ("reads", "expected"),
    [(["198", "1980", "1980"], 198), (["1980", "1980", "198円"], 198), (["98", "980", "98"], 98), (["12", "3456"], 12), (["1", "x", ""], None), (["23", "234", "2345", "123"], 234), (["045", "45"], 45), (["12345", "99"], 99), (["77", "78"], 77)],
)
def test_majority(spark, reads, expected):
    df = spark.createDataFrame([("a", r, k) for k, r in enumerate(reads)], "k string, r string, o int")
    assert names.majority(df, "k", "r", "o").first()["value"] == expected


def test_sibling_margin(spark, monkeypatch):
    records = [("牛乳小", 70.0), ("牛乳大", 60.0), ("うどん", 90.0), ("バニラアイス", 50.0), ("抹茶アイス", 55.0), ("abc", 10.0)]
    df = spark.createDataFrame(records, "name string, score double")

    def plain(name, own):
        t = fuzzy.japanese_only(name)
        like = [s for n, s in records if n != name and t and fuzzy.japanese_only(n) and fuzzy.ratio(t, fuzzy.japanese_only(n)) >= 58.0]
        return own - max(like) if like else 100.0

    expected = {n: plain(n, s) for n, s in records}
    assert expected["牛乳小"] == 10.0 and expected["うどん"] == 100.0
    for size in (64, 2):
        monkeypatch.setattr(names, "NAMES", size)
        assert {r["name"]: r["margin"] for r in names.sibling_margin(df).collect()} == expected


@pytest.mark.parametrize("most", [10_000, 0])
def test_records_are_scored_in_tiles_too(spark, monkeypatch, most):
    monkeypatch.setattr(names, "BROADCAST", most)
    records = spark.createDataFrame([("国産鶏むね肉", "大容量"), ("北海道牛乳", None)], "name string, specification string")
    reads = spark.createDataFrame([(1, "国産鶏むね 大容量"), (2, "道牛乳"), (3, None), (4, "道牛乳")], "text_id int, text string")
    got = {(r["text_id"], r["name"]): r["name_score"] for r in names.record_scores(reads, records).collect()}
    assert len(got) == 8 and all(v == pytest.approx(fuzzy.dictionary_score(n, {1: "国産鶏むね 大容量", 2: "道牛乳", 3: None, 4: "道牛乳"}[k])) for (k, n), v in got.items())


def test_inventory(spark):
    required = spark.createDataFrame([("g", "u1"), ("g", "u2"), ("h", "u1")], "group_id string, source_url string")
    from shelfmark.functions.urls import cache_name

    files = required.filter("source_url = 'u1'").select(cache_name(F.col("source_url")).alias("cache_filename"))
    verdicts = spark.createDataFrame([("g", "u1", True), ("g", "u2", True), ("x", "u1", True)], "group_id string, source_url string, passes boolean")
    items = gates.cache_inventory(required, files, verdicts)
    assert sorted((r["group_id"], r["source_url"], r["present"], r["provenance_valid"]) for r in items.collect()) == [("g", "u1", True, True), ("g", "u2", False, True), ("h", "u1", True, False)]
    assert tuple(gates.inventory_report(items).first()) == (3, 2, 1, 2, False, False)


def test_positions_and_ordered_union(spark):
    a = spark.createDataFrame([(k * 7 % 100,) for k in range(100)], "x long")
    got = {r["x"]: r["k"] for r in sets.numbered(a, "x", parts=8).collect()}
    assert got == {x: x + 1 for x in range(100)}
    b = spark.createDataFrame([(5, "p"), (9, "q")], "y long, v string")
    assert sorted(map(tuple, sets.zipped(a, "x", b, "y").collect())) == [(0, 5, "p"), (1, 9, "q")]
    parts = [spark.createDataFrame([("u2", 0), ("u1", 1)], "u string, o int"), spark.createDataFrame([("u3", 0), ("u2", 1), ("u3", 2)], "u string, o int")]
    assert [tuple(r) for r in sets.ordered_union(parts, ["u"], "o").orderBy("part", "o").collect()] == [("u2", 0, 0), ("u1", 0, 1), ("u3", 1, 0)]


def test_rows_of_bullets(spark):
    def plain(ys, i, span, height):
        j = min(len(ys) - 1, i + span - 1)
        top = max(0, ys[i] - 8)
        if j + 1 < len(ys):
            gap = max(1, ys[j + 1] - ys[j])
            bottom = max(top + 18, ys[j + 1] - max(3, round(gap * 0.10)))
        else:
            bottom = min(height, int(ys[j] + max(65.0, 1.7 * (median([b - a for a, b in zip(ys, ys[1:])]) if len(ys) > 1 else 40.0))))
        if bottom - top < 18:
            bottom = min(height, top + 24)
        return top, min(height, bottom)

    pages = {"a": [5, 40, 95, 95, 300, 990], "b": [700], "c": [3, 4, 5]}
    df = spark.createDataFrame([(p, i, y) for p, ys in pages.items() for i, y in enumerate(ys)], "p string, i int, y int")
    for span in (1, 2):
        got = {(r["p"], r["i"]): (r["y1"], r["y2"]) for r in spatial.row_windows(df, "p", "i", "y", F.lit(1000), span).collect()}
        assert got == {(p, i): plain(ys, i, span, 1000) for p, ys in pages.items() for i in range(len(ys))}


def test_columns_have_three_points(spark):
    xs = [10, 13, 18, 40, 41, 200, 204, 208.5, 213]
    df = spark.createDataFrame([("p", k, float(x)) for k, x in enumerate(xs)], "p string, i int, x double")
    got = {r["i"]: (r["column"], r["centre"]) for r in cluster.point_columns(df, "p", "i", "x").collect()}
    groups = []
    for k, x in enumerate(xs):
        hit = next((g for g in groups if abs(x - sum(xs[i] for i in g) / len(g)) <= 5), None)
        groups.append([k]) if hit is None else hit.append(k)
    big = [g for g in groups if len(g) >= 3]
    assert got == {i: (n + 1, pytest.approx(sum(xs[j] for j in g) / len(g))) for n, g in enumerate(big) for i in g}


def test_running_clusters_depend_on_order():
    assert cluster.running_clusters([0, 4, 8, 12], 5) == [0, 0, 1, 1]
    assert cluster.running_clusters([], 5) == []


def restated(rows, f):
    out = set()
    for user in {r["user_id"] for r in rows}:
        out |= f(user, [r for r in rows if r["user_id"] == user])
    return out


def test_order_dependent_queries(spark, sf):
    rows = spark.read.parquet(f"{sf}/events.parquet").withColumn("h", F.hour("ts")).collect()

    def clusters(user, own):
        groups, out = [], set()
        for r in sorted(own, key=lambda r: (r["value"], r["event_id"])):
            k = next((k for k, g in enumerate(groups) if abs(r["value"] - median(g)) <= 5.0), None)
            if k is None:
                groups.append([])
                k = len(groups) - 1
            groups[k].append(r["value"])
            out.add((user, r["event_id"], k))
        return out

    def greedy(user, own):
        kept = []
        for r in sorted(own, key=lambda r: (r["h"], r["value"], r["event_id"])):
            if not any(q["event_type"] == r["event_type"] and abs(q["value"] - r["value"]) < 12 and abs(q["h"] - r["h"]) < 3 for q in kept):
                kept.append(r)
        return {(user, r["event_id"]) for r in kept}

    def repeats(user, own):
        kept = []
        for r in sorted(own, key=lambda r: (r["value"], r["event_id"])):
            if not kept or kept[-1]["event_type"] != r["event_type"] or abs(r["value"] - kept[-1]["value"]) > 30:
                kept.append(r)
        return {(user, r["event_id"]) for r in kept}

    for name, f in (("cluster_running_median", clusters), ("greedy_spatial_dedupe", greedy), ("suppress_repeats", repeats)):
        assert set(map(tuple, QUERIES[name](spark, sf).collect())) == restated(rows, f), name


def test_nearest_separator_without_lines(spark):
    gaps = spark.createDataFrame([("i", 1, 0.0, 10.0, 5.0)], "k string, gap int, lo double, hi double, target double")
    lines = spark.createDataFrame([], "k string, pos double, length double")
    assert spatial.nearest_separator(gaps, lines, "k", "gap").first()["separator"] == 5.0


def test_candidates(spark):
    cells = spark.createDataFrame([("i", "s", 1, 198, 10.0, 50.0, 0.0, 0.0, 100.0, 49.0), ("i", "s", 2, 298, 150.0, 50.0, 101.0, 0.0, 200.0, 49.0)], "image_id string, store_id string, cell int, value int, x double, y double, x1 double, y1 double, x2 double, y2 double")
    tokens = spark.createDataFrame([("i", 1, "国産りんご", 20.0, 20.0), ("i", 2, "税込", 30.0, 20.0), ("i", 3, "柔軟剤大容量", 150.0, 20.0)], "image_id string, ordinal int, text string, x double, y double")
    regions = spark.createDataFrame([("i", 0, 1, 0.0, 0.0, 400.0, 400.0, "2026-09-12", "2026-09-18", "parent"), ("i", 1, 0, 0.0, 0.0, 100.0, 100.0, "2026-09-13", "2026-09-13", "explicit_ocr")], "image_id string, ordinal int, explicit int, x1 double, y1 double, x2 double, y2 double, sale_start string, sale_end string, date_source string")
    groups = spark.createDataFrame([("s", "c", "n", "2026-09-12", "2026-09-18", "f", "u")], "store_id string, chain string, store_name string, sale_start string, sale_end string, fingerprint string, source_url string")
    rows = candidates.candidates(cells, tokens, regions, groups)
    got = {r["product_name"]: (r["price_in_tax_yen"], r["sale_start"], r["scope_level"], r["category"]) for r in rows.collect()}
    assert got == {"国産りんご": (213, "2026-09-13", "explicit_ocr", "食品"), "柔軟剤大容量": (327, "2026-09-12", "parent", "日用品")}
    assert [r["unresolved"] for r in candidates.report(rows, cells).collect()] == [0]
