"""Every registered query of the core runs, and equals its SQL where it has one."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfmark.plans import product_queries, text_queries
from shelfmark.plans.queries import ORACLES, QUERIES
from shelfmark.plans.registry import products
from tests.oracle import both, connect

ROWS_ONLY = {"dictionary_resolve", "distinct_by_period", "page_discovery", "record_scores"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, sf, name):
    mine, theirs = both(entry.queries()[name](spark, sf), ORACLES[name], connect(sf))
    assert mine == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_keys_and_first_words_are_of_whole_texts(spark, tmp_path):
    long = "ａ" * 40
    texts = [f"{long}x", f"{long}y", f"{long} x", "ＡＢ c", "ab　C", f"{long * 3}x", f"{long * 3}y", f"{'1' * 35}abc d", "12 abc", None]
    spark.createDataFrame([(12 * k + 6, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    keys = [r["key"] for r in text_queries.nfkc_key(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert keys[0] != keys[1] and keys[0] == keys[2] and keys[3] == keys[4] and keys[5] != keys[6] and len(keys) == len(texts)
    tokens = [r["token"] for r in text_queries.name_tokens(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert tokens == [True, True, False, False, True, True, True, True, False, False]


def test_coverage_and_groups_of_whole_tables(spark, sf):
    parts, items = spark.read.parquet(f"{sf}/part.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    pairs = {(n[0], i[0]) for n in parts.select("p_name").distinct().collect() for i in items.select("item_id").collect()}
    got = [(r["p_name"], r["item_id"]) for r in QUERIES["char_coverage"](spark, sf).collect()]
    assert len(got) == len(pairs) and set(got) == pairs
    sizes = {}
    for name, size in {(r["p_name"], r["p_size"]) for r in parts.collect()}:
        sizes.setdefault(name, set()).add(size)
    groups = {r["name"]: r["sibling_group"] for r in QUERIES["sibling_groups"](spark, sf).collect()}
    assert groups == {f"{k} {s}cm": len(v) > 1 for k, v in sizes.items() for s in v}


def test_the_address_alone_says_what_is_held(spark, tmp_path):
    """Pages whose number is no multiple of 4 have brought their address in; all pages of that address are present then."""
    pages = [(0, "a"), (1, "a"), (4, "a"), (2, "b"), (3, "b"), (8, "c"), (12, "c"), (5, None), (16, None), (7, "e"), (7, "e"), (7, "f"), (20, "f"), (-3, "a"), (24, ""), (None, "a"), (None, "c"), (None, None)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    want = [(p, u in ("a", "b", "e", "f")) for p, u in pages]
    assert sorted(((r["page_id"], r["present"]) for r in text_queries.cache_lookup(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
    c = duckdb.connect()
    c.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    mine, theirs = both(text_queries.cache_lookup(spark, str(tmp_path)), ORACLES["cache_lookup"], c)
    assert mine == theirs


def test_wide_letters_are_the_same_product(spark, sf):
    """Half of the second writings are in wide letters: in the products, in no shelf."""
    wide = "product_name RLIKE '[Ａ-Ｚ]'"
    assert products(spark, sf).filter(wide).count() > 100
    assert product_queries.shelf(spark, sf).filter(wide).count() == 0
