"""Where queries register themselves, and the relations that many of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of few tasks, dealt to all cores: a small file in one row group would keep one of them busy. A large scan is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


#: What product rows take from the lineitem table; then what makes one unique and tells its place in the input.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate"]
ORDINAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy"]


def order(*columns: str) -> list[Column]:
    return [F.col(c) for c in columns]


#: Capitals, and the wide letters that NFKC makes them of.
WIDE = ("".join(map(chr, range(65, 91))), "".join(map(chr, range(0xFF21, 0xFF3B))))


def products(spark: SparkSession, sf_dir: str, lines: str = "true") -> DataFrame:
    """lineitem and part as product rows: some without a price, some negative, a tenth twice with the name written otherwise, half of these in wide letters.

    lines: a condition on lineitem, which its scan takes.
    """
    k, price = F.col("l_orderkey"), F.col("l_extendedprice")
    day = F.col("l_shipdate").cast("date")
    base = (
        spread(table(spark, sf_dir, "lineitem").select(*LINE).filter(lines))
        .join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_size"), "l_partkey")
        .select(
            *[c for c in ORDINAL if c != "copy"],
            F.col("l_suppkey").cast("string").alias("store_id"),
            "p_name",
            F.col("p_brand").alias("category"),
            F.concat(F.col("p_size").cast("string"), F.lit("cm")).alias("specification"),
            F.when(k % 97 == 0, None).when(k % 89 == 0, -price).otherwise(price).alias("price_ex_tax_yen"),
            F.when(k % 5 == 0, price * 1.1).when(k % 83 == 0, 0.0).alias("price_in_tax_yen"),
            F.when(k % 79 != 0, F.col("l_tax")).alias("tax_rate"),
            day.cast("string").alias("sale_start"),
            F.date_add(day, (F.col("l_linenumber") - 1).cast("int")).cast("string").alias("sale_end"),
        )
    )
    copies = F.explode(F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    capitals = F.concat(F.lit("  "), F.upper("p_name"))
    again = F.when(F.col("copy") == 0, F.col("p_name")).when(k % 20 == 0, F.translate(capitals, *WIDE)).otherwise(capitals)
    return base.withColumn("copy", copies).withColumn("product_name", again).drop("p_name")


PRODUCTS = f"""
base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_suppkey AS VARCHAR) AS store_id, p_name, p_brand AS category, CAST(p_size AS VARCHAR) || 'cm' AS specification,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price_ex,
         CASE WHEN l_orderkey % 5 = 0 THEN l_extendedprice * 1.1::DOUBLE WHEN l_orderkey % 83 = 0 THEN 0.0::DOUBLE END AS price_in,
         CASE WHEN l_orderkey % 79 <> 0 THEN l_tax END AS tax_rate,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS sale_start, CAST(CAST(l_shipdate AS DATE) + CAST(l_linenumber - 1 AS INTEGER) AS VARCHAR) AS sale_end
  FROM lineitem JOIN part ON l_partkey = p_partkey),
product AS (
  SELECT *, 0 AS copy, p_name AS product_name FROM base
  UNION ALL SELECT *, 1, '  ' || CASE WHEN l_orderkey % 20 = 0 THEN translate(upper(p_name), '{WIDE[0]}', '{WIDE[1]}') ELSE upper(p_name) END FROM base WHERE l_orderkey % 10 = 0),
priced AS (
  SELECT *, CAST(floor(price_ex) AS BIGINT) AS ex, CAST(coalesce(floor(price_in), floor(floor(price_ex) * (1.0::DOUBLE + tax_rate))) AS BIGINT) AS inc FROM product),
sold AS (SELECT * FROM priced WHERE inc > 0 AND coalesce(ex, 0) >= 0),
shelf AS (
  SELECT * FROM sold QUALIFY row_number() OVER (
    PARTITION BY store_id, sale_start, sale_end, lower(regexp_replace(translate(product_name, '{WIDE[1]}', '{WIDE[0]}'), '\\s+', '', 'g')), lower(regexp_replace(specification, '\\s+', '', 'g')), inc
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, copy) = 1)
"""
