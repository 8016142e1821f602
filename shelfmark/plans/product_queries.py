"""Queries over product rows: prices, deduplication, days, gates, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import dates, price, text, urls
from shelfmark.operators import dedupe, gates, sets
from shelfmark.plans.registry import ORDINAL, PRODUCTS, order, products, query, table

DAY, WORD = "1998-06-15", "red"
IDS = [c for c in ORDINAL if c != "copy"]
IDS_SQL = ", ".join(IDS)
ORDER_SQL = ", ".join(ORDINAL)


@query(
    "tax_floor",
    f"""SELECT {IDS_SQL}, CASE WHEN l_orderkey % 97 <> 0 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS ex,
    CASE WHEN l_orderkey % 97 <> 0 THEN CAST(floor(floor(l_extendedprice) * (1.0::DOUBLE + l_tax)) AS BIGINT) END AS inc FROM lineitem""",
)
def tax_floor(spark: SparkSession, d: str) -> DataFrame:
    given = F.when(F.col("l_orderkey") % 97 != 0, F.col("l_extendedprice")).when(F.col("l_linenumber") == 1, F.lit(float("nan")))
    return table(spark, d, "lineitem").select(*IDS, price.floor_yen(given).alias("ex"), price.tax_included(given, F.col("l_tax")).alias("inc"))


@query(
    "infer_tax_rate",
    f"""WITH p AS (SELECT *, floor(floor(l_extendedprice) * (1.0::DOUBLE + CASE l_linenumber % 3 WHEN 0 THEN 0.08::DOUBLE WHEN 1 THEN 0.1::DOUBLE ELSE 0.05::DOUBLE END)) AS inc FROM lineitem)
    SELECT {IDS_SQL}, CASE WHEN floor(floor(l_extendedprice) * (1.0::DOUBLE + 0.08::DOUBLE)) = inc THEN 0.08::DOUBLE WHEN floor(floor(l_extendedprice) * (1.0::DOUBLE + 0.1::DOUBLE)) = inc THEN 0.1::DOUBLE END AS rate FROM p""",
)
def infer_tax_rate(spark: SparkSession, d: str) -> DataFrame:
    rate = F.when(F.col("l_linenumber") % 3 == 0, 0.08).when(F.col("l_linenumber") % 3 == 1, 0.1).otherwise(0.05)
    inc = price.tax_included(F.col("l_extendedprice"), rate)
    return table(spark, d, "lineitem").select(*IDS, price.infer_tax_rate(F.col("l_extendedprice"), inc).alias("rate"))


@query("policy_normalize", f"WITH {PRODUCTS} SELECT {ORDER_SQL}, store_id, product_name, ex AS price_ex_tax_yen, inc AS price_in_tax_yen FROM sold")
def policy_normalize(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.priced(products(spark, d)).select(*ORDINAL, "store_id", "product_name", "price_ex_tax_yen", "price_in_tax_yen")


def shelf(spark: SparkSession, d: str, lines: str = "true", period: str = "true") -> DataFrame:
    """The published products: priced, the first of each key.

    lines and period narrow the days before anything is sorted, the one in the scan, the other by the period. Days
    are part of the key, so the same rows come first as in the whole table.
    """
    return dedupe.output_policy(products(spark, d, lines).filter(period), order(*ORDINAL))


@query("dedupe_first_wins", f"WITH {PRODUCTS} SELECT {ORDER_SQL}, store_id, product_name, inc AS price_in_tax_yen FROM shelf")
def dedupe_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return shelf(spark, d).select(*ORDINAL, "store_id", "product_name", "price_in_tax_yen")


@query(
    "household_policy",
    f"WITH {PRODUCTS}, food AS (SELECT * FROM sold WHERE category <> 'Brand#7' AND NOT contains(lower(regexp_replace(product_name, '\\s+', '', 'g')), 'ring')) SELECT store_id, count(*) AS kept FROM food GROUP BY 1",
)
def household_policy(spark: SparkSession, d: str) -> DataFrame:
    """The older policy, with a brand for the household category and a word for the household names."""
    as_goods = dedupe.priced(products(spark, d)).withColumns({
        "category": F.when(F.col("category") == "Brand#7", "洗剤").otherwise(F.col("category")),
        "name": F.when(text.compact(F.col("product_name")).contains("ring"), F.concat(F.col("product_name"), F.lit(" 柔軟剤"))).otherwise(F.col("product_name")),
    })
    return as_goods.filter(~text.is_household_good(F.col("category"), F.col("name"))).groupBy("store_id").agg(F.count(F.lit(1)).alias("kept"))


@query(
    "dedupe_strong",
    f"WITH {PRODUCTS} SELECT {ORDER_SQL} FROM sold QUALIFY row_number() OVER (PARTITION BY store_id, regexp_replace(product_name, '\\s+', '', 'g'), inc // 100 ORDER BY {ORDER_SQL}) = 1",
)
def dedupe_strong(spark: SparkSession, d: str) -> DataFrame:
    """The strong key, with prices in hundreds of yen so that it has something to remove."""
    rows = dedupe.priced(products(spark, d)).withColumn("price_in_tax_yen", F.floor(F.col("price_in_tax_yen") / 100))
    return dedupe.first_wins(rows, dedupe.strong_key(), order(*ORDINAL)).select(*ORDINAL)


@query(
    "duplicate_report",
    f"""WITH {PRODUCTS} SELECT {ORDER_SQL}, rn FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sale_start, sale_end, lower(regexp_replace(product_name, '\\s+', '', 'g')),
    lower(regexp_replace(specification, '\\s+', '', 'g')), inc ORDER BY {ORDER_SQL}) AS rn FROM sold) WHERE rn > 1""",
)
def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    rows = dedupe.priced(products(spark, d))
    return dedupe.later_ones(rows, dedupe.policy_key(normal=False), order(*ORDINAL)).select(*ORDINAL, F.col("rn").cast("long").alias("rn"))


@query("active_on_day", f"WITH {PRODUCTS} SELECT store_id, count(*) AS total, count(*) FILTER (sale_start <= '{DAY}' AND sale_end >= '{DAY}') AS active FROM shelf GROUP BY 1")
def active_on_day(spark: SparkSession, d: str) -> DataFrame:
    active = F.count_if(dates.active_on(DAY, F.col("sale_start"), F.col("sale_end")))
    return shelf(spark, d).groupBy("store_id").agg(F.count(F.lit(1)).alias("total"), active.alias("active"))


@query(
    "exact_day_counts",
    f"""WITH {PRODUCTS}, days AS (SELECT CAST(CAST(range AS DATE) AS VARCHAR) AS day FROM range(DATE '1998-05-20', DATE '1998-07-01', INTERVAL 1 DAY))
    SELECT day, count(store_id) AS n, count(DISTINCT store_id) AS stores FROM days LEFT JOIN shelf ON sale_start = day AND sale_end = day GROUP BY 1""",
)
def exact_day_counts(spark: SparkSession, d: str) -> DataFrame:
    days = spark.sql("SELECT explode(sequence(DATE'1998-05-20', DATE'1998-06-30')) AS d").select(F.col("d").cast("string").alias("day"))
    single = shelf(spark, d, "l_shipdate >= timestamp_ntz'1998-05-20' AND l_shipdate < timestamp_ntz'1998-07-01'", "sale_start = sale_end").withColumnRenamed("sale_start", "day")
    return sets.zero_kept(single, days, "day", {"n": F.count(F.lit(1)), "stores": F.count_distinct("store_id")})


@query("single_days", f"WITH {PRODUCTS} SELECT store_id, string_agg(DISTINCT sale_start, ',' ORDER BY sale_start) AS days FROM shelf WHERE sale_start = sale_end GROUP BY 1")
def single_days(spark: SparkSession, d: str) -> DataFrame:
    """The days with a button of their own, for each store."""
    one = shelf(spark, d, period="sale_start = sale_end")
    return one.groupBy("store_id").agg(F.array_join(F.array_sort(F.collect_set("sale_start")), ",").alias("days"))


@query(
    "ui_search",
    f"""WITH {PRODUCTS} SELECT store_id, product_name, specification, inc AS price_in_tax_yen,
    CASE WHEN sale_start = sale_end THEN sale_start ELSE sale_start || '〜' || sale_end END AS period
    FROM shelf WHERE sale_start LIKE '1998-06-%' AND sale_start = sale_end AND contains(lower(product_name || ' ' || specification), '{WORD}')""",
)
def ui_search(spark: SparkSession, d: str) -> DataFrame:
    return search(spark, d, "l_shipdate >= timestamp_ntz'1998-06-01' AND l_shipdate < timestamp_ntz'1998-07-01'")


def visible(rows: DataFrame, stores: list[str] | None = None, day: str | None = None, word: str = "") -> DataFrame:
    """The rows that a reader asks for: of some stores, on sale on one day alone, with a word in name or specification."""
    if stores is not None:
        rows = rows.filter(F.col("store_id").isin(stores))
    if day is not None:
        rows = rows.filter(dates.exactly_on(day, F.col("sale_start"), F.col("sale_end")))
    rows = rows.filter(F.lower(F.concat_ws(" ", "product_name", "specification")).contains(word.lower()))
    return rows.select("store_id", "product_name", "specification", "price_in_tax_yen", dates.period_label(F.col("sale_start"), F.col("sale_end")).alias("period"))


def search(spark: SparkSession, d: str, lines: str = "true") -> DataFrame:
    """What a reader sees: single days (of a month), a word in name or specification, in Japanese order."""
    shown = visible(shelf(spark, d, lines, "sale_start = sale_end"), word=WORD)
    return shown.orderBy(F.collate("store_id", "ja"), F.collate("product_name", "ja"))


def faulty(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    return products(spark, d).select(
        *ORDINAL, "store_id", "specification", "sale_end",
        F.when(k % 101 == 0, " ").otherwise(F.col("product_name")).alias("product_name"),
        F.when(k % 53 == 0, "1998-6-1").otherwise(F.col("sale_start")).alias("sale_start"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.lit("x")).when(k % 13 == 0, F.lit("NaN")).when(k % 17 == 0, F.lit("Infinity")).when(k % 19 == 0, F.lit("1e30")).otherwise(F.floor("price_ex_tax_yen").cast("string")).alias("price_in_tax_yen"),
        F.when(k % 14 == 0, "50% OFF").alias("promotion"),
        F.when(k % 29 != 0, "https://a.example/b.jpg").alias("source_url"),
        F.lit("b.jpg").alias("source_image"),
        F.when(k % 31 == 0, " ").otherwise("f").alias("source_fingerprint"),
    )


@query(
    "row_integrity",
    f"""WITH {PRODUCTS}, f AS (SELECT *, CASE WHEN l_orderkey % 101 = 0 THEN ' ' ELSE product_name END AS nm, CASE WHEN l_orderkey % 53 = 0 THEN '1998-6-1' ELSE sale_start END AS st,
      CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN 'x' WHEN l_orderkey % 13 = 0 THEN 'NaN' WHEN l_orderkey % 17 = 0 THEN 'Infinity' WHEN l_orderkey % 19 = 0 THEN '1e30' ELSE CAST(CAST(floor(price_ex) AS BIGINT) AS VARCHAR) END AS pr, CASE WHEN l_orderkey % 14 = 0 THEN '50% OFF' END AS promo FROM product),
    g AS (SELECT *, CASE WHEN isfinite(try_cast(pr AS DOUBLE)) THEN trunc(try_cast(pr AS DOUBLE)) ELSE 0 END AS i FROM f),
    h AS (SELECT *, row_number() OVER (PARTITION BY store_id, st, sale_end, lower(regexp_replace(nm, '\\s+', '', 'g')), specification, i ORDER BY {ORDER_SQL}) AS rn FROM g)
    SELECT store_id, count(*) AS rows, count(*) FILTER (st <= '{DAY}' AND sale_end >= '{DAY}') AS active, count(*) FILTER (i <= 0) AS bad_price, count(*) FILTER (trim(nm) = '') AS blank_name,
      count(*) FILTER (rn > 1) AS duplicate, count(*) FILTER (NOT regexp_full_match(st, '\\d{{4}}-\\d{{2}}-\\d{{2}}') OR st > sale_end) AS bad_dates,
      count(*) FILTER (promo IS NOT NULL AND pr IS NULL) AS percent_only, count(*) FILTER (l_orderkey % 29 = 0 OR l_orderkey % 31 = 0) AS missing_provenance, 0::BIGINT AS household
    FROM h GROUP BY 1""",
)
def row_integrity(spark: SparkSession, d: str) -> DataFrame:
    return gates.row_report(faulty(spark, d), order(*ORDINAL), DAY)


@query(
    "issue_gate",
    """WITH r AS (SELECT CAST(l_suppkey AS VARCHAR) AS store_id, count(*) AS n, count(*) FILTER (l_orderkey % 3001 = 0 AND l_suppkey % 4 = 1) AS stale, count(*) FILTER (l_linestatus = 'F' AND l_suppkey % 19 = 0) AS sourceless FROM lineitem GROUP BY 1),
    g AS (SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_suppkey AS k, 2 AS expected, CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END AS done,
      CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 600 END AS anchors, CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 3 = 1 THEN 590 ELSE 700 END AS reported FROM supplier WHERE s_suppkey % 11 <> 0),
    j AS (SELECT g.*, CASE WHEN reported = 0 THEN coalesce(n, 0) ELSE reported END AS cand, coalesce(stale, 0) AS stale, coalesce(sourceless, 0) AS sourceless FROM g LEFT JOIN r USING (store_id))
    SELECT store_id, concat_ws(',', CASE WHEN done <> expected THEN 'image_processing_incomplete' END, CASE WHEN anchors <= 0 THEN 'no_price_evidence' END, CASE WHEN anchors > 0 AND cand <= 0 THEN 'price_evidence_without_products' END,
      CASE WHEN anchors > 0 AND cand > anchors THEN 'extraction_report_inconsistent' END, CASE WHEN stale > 0 THEN 'stale_fingerprint' END, CASE WHEN sourceless > 0 THEN 'missing_source' END) AS errors,
      CAST(greatest(anchors - cand, 0) AS BIGINT) AS unresolved FROM j
    UNION ALL SELECT store_id, 'unexpected_store', 0 FROM r WHERE store_id NOT IN (SELECT store_id FROM g)""",
)
def issue_gate(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    sup = table(spark, d, "supplier").filter("s_suppkey % 11 <> 0").withColumn("store_id", s.cast("string"))
    groups = sup.select("store_id", F.lit(2).alias("images"), F.lit("now").alias("fingerprint"))
    report = sup.select("store_id", F.when(s % 5 == 0, 1).otherwise(2).alias("images"), F.when(s % 7 == 0, 0).otherwise(600).alias("price_anchors"), F.when(s % 3 == 0, 0).when(s % 3 == 1, 590).otherwise(700).alias("candidate_rows"))
    k = F.col("l_suppkey")
    rows = table(spark, d, "lineitem").select(
        k.cast("string").alias("store_id"),
        F.when((F.col("l_orderkey") % 3001 == 0) & (k % 4 == 1), "old").otherwise("now").alias("source_fingerprint"),
        F.when((F.col("l_linestatus") == "F") & (k % 19 == 0), " ").otherwise("u").alias("source_url"),
    )
    return gates.issue_faults(rows, groups, report).withColumn("errors", F.array_join("errors", ","))


@query(
    "provenance_join",
    """WITH req AS (SELECT 'g' || (doc_id % 4) AS group_id, 'https://e.example/' || doc_id AS source_url, doc_id FROM documents),
    e AS (SELECT doc_id, count(*) AS times, max(quality) AS quality, max(toxic) AS toxic FROM (SELECT * FROM labels UNION ALL SELECT * FROM labels WHERE doc_id % 9 = 0) GROUP BY 1)
    SELECT group_id, source_url, substr(sha256(source_url), 1, 20) || '.jpg' AS cache_filename, concat_ws(',',
      CASE WHEN e.doc_id IS NULL THEN 'missing_provenance_entry' END, CASE WHEN req.doc_id % 10 = 0 THEN 'missing_cache_file' END, CASE WHEN times > 1 THEN 'duplicate_provenance_entry' END,
      CASE WHEN quality = 0 THEN 'group_id_mismatch' END, CASE WHEN toxic = 1 THEN 'http_status_not_200' END,
      CASE WHEN e.doc_id IS NOT NULL AND req.doc_id % 10 <> 0 AND req.doc_id % 6 = 0 THEN 'bytes_mismatch' END,
      CASE WHEN e.doc_id IS NOT NULL AND req.doc_id % 10 <> 0 AND req.doc_id % 7 = 0 THEN 'image_too_small_bytes' END) AS reasons
    FROM req LEFT JOIN e USING (doc_id)""",
)
def provenance_join(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    url = F.concat(F.lit("https://e.example/"), i.cast("string"))
    size = F.when(i % 7 == 0, 9_999).otherwise(20_000).cast("long")
    required = table(spark, d, "documents").select(F.concat(F.lit("g"), (i % 4).cast("string")).alias("group_id"), url.alias("source_url"), F.lit("").alias("referer"))
    files = table(spark, d, "documents").filter("doc_id % 10 <> 0").select(urls.cache_name(url).alias("cache_filename"), F.lit("s").alias("sha256"), size.alias("bytes"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit("image/jpeg").alias("mime_magic"))
    lab = table(spark, d, "labels")
    lab = lab.withColumn("ordinal", F.lit(0)).unionByName(lab.filter("doc_id % 9 = 0").withColumn("ordinal", F.lit(1)))
    entries = lab.select(
        url.alias("source_url"), "ordinal", F.when(F.col("quality") == 0, "gx").otherwise(F.concat(F.lit("g"), (i % 4).cast("string"))).alias("group_id"), urls.cache_name(url).alias("cache_filename"), F.lit("").alias("referer"),
        F.lit("http_fetch_v1").alias("acquisition_method"), F.lit("2026-09-12T00:00:00Z").alias("fetched_at_utc"), F.when(F.col("toxic") == 1, 404).otherwise(200).alias("http_status"), F.lit("image/jpeg").alias("content_type_header"), url.alias("final_url"),
        F.lit("s").alias("sha256"), F.when(i % 6 == 0, 1).otherwise(size).cast("long").alias("bytes"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit("image/jpeg").alias("mime_magic"),
    )
    return gates.provenance_faults(required, entries, files).select("group_id", "source_url", "cache_filename", F.array_join("reasons", ",").alias("reasons"))


@query(
    "report_default_join",
    "SELECT n_nationkey, count(c_custkey) AS rows, CASE WHEN count(c_custkey) >= 61 THEN 'pass' WHEN count(c_custkey) = 0 THEN 'missing' ELSE 'fail' END AS status FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 0 AND c_nationkey % 6 <> 0 GROUP BY 1",
)
def report_default_join(spark: SparkSession, d: str) -> DataFrame:
    """Every required id with its report, or a failing default."""
    report = table(spark, d, "customer").filter("c_acctbal > 0 AND c_nationkey % 6 <> 0").withColumnRenamed("c_nationkey", "n_nationkey")
    out = sets.zero_kept(report, table(spark, d, "nation").select("n_nationkey"), "n_nationkey", {"rows": F.count(F.lit(1))})
    return out.withColumn("status", F.when(F.col("rows") >= 61, "pass").when(F.col("rows") == 0, "missing").otherwise("fail"))


@query(
    "map_diff",
    """WITH a AS (SELECT p_partkey, sha256(p_name) AS h FROM part WHERE p_partkey % 13 <> 0), b AS (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE sha256(p_name) END AS h FROM part WHERE p_partkey % 11 <> 0)
    SELECT p_partkey, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' ELSE 'changed' END AS status FROM (SELECT *, 1 AS k FROM a) a FULL JOIN (SELECT *, 1 AS k FROM b) b USING (p_partkey)
    WHERE a.k IS NULL OR b.k IS NULL OR a.h IS DISTINCT FROM b.h""",
)
def map_diff(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("h"))
    return gates.map_difference(p.filter("p_partkey % 13 <> 0"), p.filter("p_partkey % 11 <> 0").withColumn("h", F.when(F.col("p_partkey") % 17 != 0, F.col("h"))), "p_partkey", "h")


@query(
    "map_unchanged",
    """WITH p AS (SELECT s_nationkey AS n, s_suppkey AS k, sha256(s_name) AS h FROM supplier), c AS (SELECT n, k, CASE WHEN k % 10 <> 3 THEN CASE WHEN k % 14 = 5 THEN h || '!' ELSE h END END AS h FROM p WHERE k % 12 <> 7),
    d AS (SELECT n, count(*) AS d FROM p FULL JOIN c USING (n, k) WHERE p.h IS DISTINCT FROM c.h GROUP BY 1), s AS (SELECT n, count(*) AS size, count(*) FILTER (h IS NULL) AS blank FROM c GROUP BY 1)
    SELECT n AS s_nationkey, coalesce(size, 0) > 0 AND coalesce(blank, 0) = 0 AND coalesce(d, 0) = 0 AS unchanged FROM (SELECT DISTINCT n FROM p) LEFT JOIN d USING (n) LEFT JOIN s USING (n)""",
)
def map_unchanged(spark: SparkSession, d: str) -> DataFrame:
    """The map of each nation's suppliers against a later one, where some are gone, blank or changed."""
    p = table(spark, d, "supplier").select("s_nationkey", F.col("s_suppkey").alias("k"), F.sha2("s_name", 256).alias("h"))
    k = F.col("k")
    later = p.filter(k % 12 != 7).withColumn("h", F.when(k % 10 != 3, F.when(k % 14 == 5, F.concat("h", F.lit("!"))).otherwise(F.col("h"))))
    return gates.same_maps(p, later, "k", "h", ["s_nationkey"])


@query(
    "semi_anti",
    """SELECT c_custkey, 'ordered' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
    UNION ALL SELECT c_custkey, 'never' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 20000)""",
)
def semi_anti(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return c.join(o.filter("o_totalprice > 400000"), "c_custkey", "left_semi").withColumn("kind", F.lit("ordered")).unionByName(c.join(o.filter("o_totalprice > 20000"), "c_custkey", "left_anti").withColumn("kind", F.lit("never")))


@query(
    "parent_price_broadcast",
    """WITH m AS (SELECT CAST(floor(min(p_retailprice)) AS BIGINT) AS price FROM part WHERE p_type = 'ECONOMY')
    SELECT p_partkey, price AS price_ex_tax_yen, CAST(floor(price * (1.0::DOUBLE + 0.08::DOUBLE)) AS BIGINT) AS price_in_tax_yen FROM part, m WHERE p_type = 'ECONOMY' AND p_size < 25""",
)
def parent_price_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """One price found for a whole panel, given to each product resolved in it."""
    p = table(spark, d, "part").filter("p_type = 'ECONOMY'")
    parent = p.agg(price.floor_yen(F.min("p_retailprice")).alias("price_ex_tax_yen"))
    rows = p.filter("p_size < 25").select("p_partkey").crossJoin(F.broadcast(parent))  # one row
    return rows.withColumn("price_in_tax_yen", price.tax_included(F.col("price_ex_tax_yen"), F.lit(0.08)))


@query(
    "expected_counts",
    f"""WITH {PRODUCTS}, s AS (SELECT store_id, count(*) AS shown FROM shelf WHERE product_name NOT LIKE 'small%' GROUP BY 1), e AS (SELECT store_id, count(*) AS expected FROM shelf GROUP BY 1)
    SELECT CAST(s_suppkey AS VARCHAR) AS store_id, coalesce(expected, 0) AS expected, coalesce(shown, 0) AS shown, coalesce(expected, 0) = coalesce(shown, 0) AS passes FROM supplier LEFT JOIN e ON e.store_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN s ON s.store_id = CAST(s_suppkey AS VARCHAR)""",
)
def expected_counts(spark: SparkSession, d: str) -> DataFrame:
    """What a page shows of each store against what the table has; stores without products count too."""
    rows = shelf(spark, d).select("store_id", (~F.col("product_name").like("small%")).alias("visible"))
    stores = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("store_id"))
    both = sets.zero_kept(rows, stores, "store_id", {"expected": F.count(F.lit(1)), "shown": F.count_if("visible")})
    return both.withColumn("passes", F.col("expected") == F.col("shown"))


@query(
    "display_gate",
    """WITH p AS (SELECT p_size, p_partkey, p_name FROM part), a AS (SELECT p_size, p_partkey, CASE WHEN p_partkey % 701 = 5 THEN '?' ELSE p_name END AS p_name FROM p), b AS (SELECT * FROM p WHERE p_partkey % 997 <> 11),
    s AS (SELECT DISTINCT p_size FROM p), n AS (SELECT p_size, (SELECT count(*) FROM p WHERE p.p_size = s.p_size) AS n, (SELECT count(*) FROM b WHERE b.p_size = s.p_size) AS nb,
      (SELECT count(*) FROM (SELECT * FROM p WHERE p.p_size = s.p_size EXCEPT ALL SELECT * FROM a WHERE a.p_size = s.p_size)) AS da, (SELECT count(*) FROM (SELECT * FROM p WHERE p.p_size = s.p_size EXCEPT ALL SELECT * FROM b WHERE b.p_size = s.p_size)) AS db FROM s)
    SELECT p_size, concat_ws(',', CASE WHEN n <> nb THEN 'artifact_count_mismatch' END, CASE WHEN da > 0 OR db > 0 THEN 'artifact_content_mismatch' END, CASE WHEN p_size % 9 = 4 THEN 'payload_bytes_mismatch' END) AS errors FROM n""",
)
def display_gate(spark: SparkSession, d: str) -> DataFrame:
    """The canonical table of each size against its published copy, where some names differ, and a payload, where some rows are missing."""
    p = table(spark, d, "part").select("p_size", "p_partkey", "p_name")
    changed = p.withColumn("p_name", F.when(F.col("p_partkey") % 701 == 5, "?").otherwise(F.col("p_name")))
    found = gates.artifact_faults(p, changed, [p.filter("p_partkey % 997 <> 11")], F.col("p_size") % 9 != 4, ["p_size"])
    return found.select("p_size", F.array_join("errors", ",").alias("errors"))


@query(
    "cache_inventory",
    """WITH i AS (SELECT 'g' || (page_id % 4) AS group_id, 'https://e.example/' || page_id AS source_url, page_id % 5 <> 0 AS present, page_id % 3 <> 0 AND page_id % 7 <> 0 AS valid FROM pages)
    SELECT group_id, source_url, substr(sha256(source_url), 1, 20) || '.jpg' AS cache_filename, present, valid AS provenance_valid FROM i""",
)
def cache_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Which required images are in the cache, and which of them are proven: those of no verdict are not."""
    i = F.col("page_id")
    required = table(spark, d, "pages").select(F.concat(F.lit("g"), (i % 4).cast("string")).alias("group_id"), F.concat(F.lit("https://e.example/"), i.cast("string")).alias("source_url"), "page_id")
    files = required.filter("page_id % 5 <> 0").select(urls.cache_name(F.col("source_url")).alias("cache_filename"))
    verdicts = required.filter("page_id % 3 <> 0").select("group_id", "source_url", (i % 7 != 0).alias("passes"))
    return gates.cache_inventory(required, files, verdicts).select("group_id", "source_url", "cache_filename", "present", "provenance_valid")


@query(
    "ui_day",
    f"""WITH {PRODUCTS} SELECT store_id, product_name, specification, inc AS price_in_tax_yen, sale_start AS period FROM shelf
    WHERE CAST(store_id AS BIGINT) <= 60 AND sale_start = '{DAY}' AND sale_end = '{DAY}' AND contains(lower(product_name || ' ' || specification), 'e')""",
)
def ui_day(spark: SparkSession, d: str) -> DataFrame:
    """What a reader sees who picks stores, a day and a word."""
    rows = shelf(spark, d, f"l_shipdate >= timestamp_ntz'{DAY}' AND l_shipdate < timestamp_ntz'{DAY}' + INTERVAL 1 DAY")
    return visible(rows, [str(k) for k in range(1, 61)], DAY, "e")


@query(
    "fault_samples",
    f"""WITH {PRODUCTS}, f AS (SELECT *, CASE WHEN l_orderkey % 101 = 0 THEN ' ' ELSE product_name END AS nm, CASE WHEN l_orderkey % 53 = 0 THEN '1998-6-1' ELSE sale_start END AS st,
      CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN 'x' WHEN l_orderkey % 13 = 0 THEN 'NaN' WHEN l_orderkey % 17 = 0 THEN 'Infinity' WHEN l_orderkey % 19 = 0 THEN '1e30' ELSE CAST(CAST(floor(price_ex) AS BIGINT) AS VARCHAR) END AS pr FROM product),
    g AS (SELECT *, CASE WHEN isfinite(try_cast(pr AS DOUBLE)) THEN trunc(try_cast(pr AS DOUBLE)) ELSE 0 END AS i FROM f),
    h AS (SELECT *, row_number() OVER (PARTITION BY store_id, st, sale_end, lower(regexp_replace(nm, '\\s+', '', 'g')), specification, i ORDER BY {ORDER_SQL}) AS rn FROM g),
    a AS (SELECT 'bad_price' AS fault, {ORDER_SQL} FROM h WHERE i <= 0 UNION ALL SELECT 'blank_name', {ORDER_SQL} FROM h WHERE trim(nm) = '' UNION ALL SELECT 'duplicate', {ORDER_SQL} FROM h WHERE rn > 1
      UNION ALL SELECT 'bad_dates', {ORDER_SQL} FROM h WHERE NOT regexp_full_match(st, '\\d{{4}}-\\d{{2}}-\\d{{2}}') OR st > sale_end UNION ALL SELECT 'percent_only', {ORDER_SQL} FROM h WHERE l_orderkey % 14 = 0 AND pr IS NULL
      UNION ALL SELECT 'missing_provenance', {ORDER_SQL} FROM h WHERE l_orderkey % 29 = 0 OR l_orderkey % 31 = 0)
    SELECT fault, {IDS_SQL}, copy FROM a QUALIFY row_number() OVER (PARTITION BY fault ORDER BY {ORDER_SQL}) <= 10""",
)
def fault_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first ten rows of each kind of fault."""
    return gates.fault_samples(faulty(spark, d), order(*ORDINAL)).select("fault", *ORDINAL)
