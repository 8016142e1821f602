"""From tokens, anchors and regions to candidate product rows: one plan, from evidence to policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import price, text
from shelfmark.operators import dedupe, spatial


def candidates(cells: DataFrame, tokens: DataFrame, regions: DataFrame, groups: DataFrame) -> DataFrame:
    """Product rows of an issue.

    cells: image_id, store_id, cell, value, x, y, x1..y2 (a price anchor and the area of its name). tokens: image_id, ordinal,
    text, x, y. regions: image_id, ordinal, explicit, x1..y2, sale_start, sale_end, date_source. groups: store_id, chain,
    store_name, sale_start, sale_end, fingerprint, source_url.
    """
    named = spatial.tokens_in_cells(tokens, cells.select("image_id", "cell", "x1", "y1", "x2", "y2"), "image_id", "cell", ["y", "x", "ordinal"], limit=14)
    anchors = cells.select("image_id", "store_id", "cell", "value", "x", "y")
    scope = spatial.point_in_region(anchors, regions, "image_id", ["cell"], ["explicit", "ordinal"], ["sale_start", "sale_end", "date_source"])
    rows = scope.join(named.select("image_id", "cell", text.longest_fragment(F.col("text")).alias("product_name")), ["image_id", "cell"])
    g = groups.select("store_id", "chain", "store_name", F.col("sale_start").alias("g_start"), F.col("sale_end").alias("g_end"), "fingerprint", "source_url")
    household = text.is_household_name(F.col("product_name"))
    rows = rows.join(g, "store_id").filter((F.col("product_name") != "") & F.col("value").between(1, 10_000)).withColumn("tax_rate", F.when(household, 0.10).otherwise(0.08))
    shown = rows.select(
        "image_id", "cell", "store_id", "chain", "store_name", F.coalesce(F.nullif("sale_start", F.lit("")), "g_start").alias("sale_start"), F.coalesce(F.nullif("sale_end", F.lit("")), "g_end").alias("sale_end"),
        "product_name", F.lit("").alias("specification"), F.col("value").cast("long").alias("price_ex_tax_yen"), price.tax_included(F.col("value"), F.col("tax_rate")).alias("price_in_tax_yen"), "tax_rate",
        F.when(household, "日用品").otherwise("食品").alias("category"), F.coalesce("date_source", F.lit("page_default")).alias("scope_level"), "source_url", F.col("image_id").alias("source_image"), F.col("fingerprint").alias("source_fingerprint"),
    )
    order = [F.col("image_id"), F.col("cell")]
    return dedupe.first_wins(dedupe.output_policy(shown, order), dedupe.strong_key(), order)


def report(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """(store_id, image_id, price_anchors, candidate_rows, unresolved): what evidence of each page found no product."""
    found = rows.groupBy("store_id", F.col("source_image").alias("image_id")).agg(F.count(F.lit(1)).alias("candidate_rows"))
    anchors = cells.groupBy("store_id", "image_id").agg(F.count(F.lit(1)).alias("price_anchors"))
    both = anchors.join(found, ["store_id", "image_id"], "left").na.fill(0, ["candidate_rows"])
    return both.withColumn("unresolved", F.greatest(F.col("price_anchors") - F.col("candidate_rows"), F.lit(0)))
