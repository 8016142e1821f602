"""Plans have the shape that scale needs: narrow scans, limits below the shuffle, no join without an equality key."""

import pytest

from shelfmark.plans import product_queries
from shelfmark.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_limited_before_the_shuffle(spark, sf):
    p = plan(product_queries.dedupe_first_wins(spark, sf))
    limit, exchange = p.index("WindowGroupLimit"), p.index("Exchange hashpartitioning")
    assert p.count("WindowGroupLimit") == 2 and limit < exchange < p.rindex("WindowGroupLimit")
    assert p.count("FileScan parquet") == 2  # lineitem and part, each once


def test_days_reach_the_scan(spark, sf):
    scan = next(x for x in plan(product_queries.ui_search(spark, sf)).splitlines() if "FileScan" in x and "l_shipdate" in x)
    assert "l_shipdate#" in scan.split("DataFilters")[1] and "l_comment" not in scan and "l_discount" not in scan


@pytest.mark.parametrize("name", ["point_in_region", "overlap_neighbourhood", "nearest_separator", "left_neighbour", "issue_gate", "provenance_join"])
def test_joins_have_a_key(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in p
    for line in p.splitlines():  # region tiles and the like: six rows
        assert "BroadcastNestedLoopJoin" not in line or "Cross" in line


@pytest.mark.parametrize("name", ["tax_floor", "char_coverage", "row_integrity", "temporal_rules", "price_hypotheses", "gap_sessionize", "map_diff", "knn_template"])
def test_no_python_where_expressions_do(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert "Python" not in p and "Pandas" not in p and "ArrowEval" not in p


def test_a_key_is_normalised_in_one_go(spark, sf):
    """NFKC is Python's: one function over one text a row, before the rows are sent."""
    p = plan(product_queries.dedupe_first_wins(spark, sf))
    assert p.count("ArrowEvalPython") == 1 and p.count("pythonUDF0") >= 1 and "pythonUDF1" not in p
    assert p.index("Exchange hashpartitioning") < p.index("ArrowEvalPython")  # below it in the tree


def test_crowded_cells_are_limited_before_they_are_collected(spark, sf):
    """The join has brought a cell's words together already, so the limit needs no shuffle of its own."""
    p = plan(QUERIES["token_in_cell_topk"](spark, sf))
    assert p.index("collect_list") < p.index("WindowGroupLimit")


@pytest.mark.parametrize("name", ["dictionary_resolve", "sibling_margin", "char_coverage"])
def test_all_pairs_meet_in_tiles(spark, sf, name):
    """No side of all pairs is broadcast: they are joined by the number of a tile."""
    p = plan(QUERIES[name](spark, sf))
    assert "SortMergeJoin" in p and "BroadcastNestedLoop" not in p and "CartesianProduct" not in p


def test_positions_are_numbered_in_parts(spark, sf):
    """The only window over all rows counts the parts: what it reads has been aggregated."""
    p = plan(QUERIES["positional_zip"](spark, sf))
    lines = p.splitlines()
    single = [k for k, x in enumerate(lines) if "Exchange SinglePartition" in x]
    assert single and all(any("HashAggregate" in x for x in lines[k + 1 : k + 4]) for k in single)


def test_issue_rows_are_counted_before_they_are_joined(spark, sf):
    """The rows are scanned once, and leave the scan's stage as counts."""
    p = plan(QUERIES["issue_gate"](spark, sf))
    scans = [x for x in p.splitlines() if "FileScan parquet" in x and "l_suppkey" in x]
    above = p[: p.index(scans[0])].splitlines()[-6:]
    assert any("partial_count" in x for x in above) and not any("Exchange" in x for x in above[above.index(next(x for x in above if "partial_count" in x)) + 1 :])


def test_large_scans_are_left_alone(spark, sf):
    from shelfmark.plans.registry import spread

    few, many = spark.range(10, numPartitions=2), spark.range(1000, numPartitions=64)
    assert "RoundRobin" in plan(spread(few)) and "Exchange" not in plan(spread(many))
