"""The published payload: one line of script that sets a variable to {meta, products}."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX = "window.FLYER_DATA="


def to_payload(products: DataFrame, meta: dict[str, str], schema: StructType, order: list[str]) -> DataFrame:
    """One row, value: the payload's text. The payload is one file by its nature, so its rows meet in one place."""
    del schema
    row = F.struct(*[F.col(c) for c in products.columns])
    every = products.agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], row.alias("row")))).alias("l"))
    body = F.to_json(F.struct(F.struct(*[F.lit(v).alias(k) for k, v in meta.items()]).alias("meta"), F.transform("l", lambda x: x["row"]).alias("products")), {"ignoreNullFields": "false"})
    return every.select(F.concat(F.lit(PREFIX), body, F.lit(";")).alias("value"))


def from_payload(lines: DataFrame, product: StructType, meta: str) -> DataFrame:
    """A row for each product, with meta. A text that doesn't begin as a payload does is an error, not an empty table."""
    text = F.trim("value")
    checked = F.when(text.startswith(PREFIX), F.regexp_replace(F.substring(text, F.lit(len(PREFIX) + 1), F.length(text)), ";$", "")).otherwise(F.raise_error(F.lit("not a payload")))
    schema = f"struct<meta:struct<{meta.replace(' ', ':')}>,products:array<{product.simpleString()}>>"
    parsed = lines.select(F.from_json(checked, schema, {"mode": "FAILFAST"}).alias("p"))
    return parsed.select("p.meta", F.explode("p.products").alias("r")).select("meta", "r.*")
