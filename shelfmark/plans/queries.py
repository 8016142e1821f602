"""All registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans import evidence_queries, product_queries, text_queries
from shelfmark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "evidence_queries", "flagship", "text_queries"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_queries.search(spark, sf_dir)
