"""First-wins deduplication, duplicate reports and output policies over product rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import price, text


def ranked(df: DataFrame, keys: list[Column], order: list[Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_wins(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key. The limit is pushed below the shuffle, so a hot key sends one row a task."""
    return ranked(df, keys, order, "__rn").filter("__rn = 1").drop("__rn")


def later_ones(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The second and later rows of each key, with their number: rows beyond those that first_wins() keeps."""
    return ranked(df, keys, order).filter("rn > 1")


def policy_key(normal: bool = True) -> list[Column]:
    """Store, period, name, specification and price; names are compared in NFKC, or for the older reports, with normal=False, as they are."""
    names = [F.col(c) for c in ("store_id", "product_name", "specification")]
    form = [text.key_of(*names)] if normal else [text.compact(c) for c in names]
    return [*form, text.blank_null(F.col("sale_start")), text.blank_null(F.col("sale_end")), F.col("price_in_tax_yen")]


def strong_key() -> list[Column]:
    """Store, name without white space and price: no dates, no specification, case kept."""
    return [F.col("store_id"), F.regexp_replace(text.blank_null(F.col("product_name")), r"(?U)\s+", ""), F.col("price_in_tax_yen")]


def priced(df: DataFrame) -> DataFrame:
    """Whole-yen prices; rows without a positive price with tax, or with a negative one without, go."""
    text_typed = {c for c, t in df.dtypes if t == "string"}
    number = lambda c: price.to_number(F.col(c), c not in text_typed)
    # Step by step, so that each text is read as a number once.
    read = df.withColumns({"__ex": number("price_ex_tax_yen"), "__inc": number("price_in_tax_yen"), "__rate": number("tax_rate")})
    whole = read.withColumn("price_ex_tax_yen", price.floor_yen(F.col("__ex"), True))
    inc = price.derived_in_tax(F.col("price_ex_tax_yen"), F.col("__inc"), F.col("__rate"), True)
    return whole.withColumn("price_in_tax_yen", inc).drop("__ex", "__inc", "__rate").filter("price_in_tax_yen > 0 AND coalesce(price_ex_tax_yen, 0) >= 0")


def output_policy(df: DataFrame, order: list[Column], drop_household: bool = False) -> DataFrame:
    """Priced rows, the first of each policy key. drop_household: the older policy, which leaves household goods out."""
    out = priced(df)
    if drop_household:
        out = out.filter(~text.is_household_good(F.col("category"), F.col("product_name")))
    return first_wins(out, policy_key(), order)
