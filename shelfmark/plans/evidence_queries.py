"""Queries over evidence with places, sequences and votes: events stand for tokens, users for images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import cascade, cluster, components, gates, names, ranges, ranking, sets, sheets, sketches, spatial, votes
from shelfmark.plans.registry import query, table

#: Seconds since midnight and since the first day of the events, in whole microseconds, so that no clock enters.
SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"


def points(spark: SparkSession, d: str) -> DataFrame:
    """Events as points: x the value, y the hour, image the user."""
    return table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("value").alias("x"), F.hour("ts").cast("double").alias("y"))


def grid(spark: SparkSession, d: str) -> DataFrame:
    """Six overlapping regions for each user; the explicit ones come second in the list and first in rank."""
    ids = table(spark, d, "events").select("user_id").distinct()
    r = spark.range(6).withColumnRenamed("id", "r")
    return ids.crossJoin(r).select(  # six rows
        "user_id",
        F.col("r").alias("ordinal"),
        F.when(F.col("r") % 2 == 1, 0).otherwise(1).alias("explicit"),
        (F.col("r") * 15.0).alias("x1"),
        (F.col("r") * 15.0 + 25.0).alias("x2"),
        (F.col("r") * 2.0).alias("y1"),
        (F.col("r") * 2.0 + 12.0).alias("y2"),
    )


@query(
    "point_in_region",
    """WITH g AS (SELECT user_id, r, CASE WHEN r % 2 = 1 THEN 0 ELSE 1 END AS explicit FROM (SELECT DISTINCT user_id FROM events), (SELECT range AS r FROM range(6))),
    h AS (SELECT event_id, arg_min(r, explicit * 100 + r) AS ordinal FROM events JOIN g USING (user_id) WHERE value >= r * 15 AND value < r * 15 + 25 AND hour(ts) >= r * 2 AND hour(ts) < r * 2 + 12 GROUP BY 1)
    SELECT e.event_id, h.ordinal FROM events e LEFT JOIN h USING (event_id)""",
)
def point_in_region(spark: SparkSession, d: str) -> DataFrame:
    found = spatial.point_in_region(points(spark, d).select("event_id", "user_id", "x", "y"), grid(spark, d), "user_id", ["event_id"], ["explicit", "ordinal"], ["ordinal"])
    return found.select("event_id", "ordinal")


@query(
    "token_in_cell_topk",
    """WITH h AS (SELECT user_id, r AS cell, event_id, event_type, row_number() OVER (PARTITION BY user_id, r ORDER BY value, event_id) AS rn FROM events, (SELECT range AS r FROM range(6)) WHERE value BETWEEN r * 15 - 2 AND r * 15 + 27 AND hour(ts) BETWEEN r * 2 - 2 AND r * 2 + 14)
    SELECT user_id, cell, string_agg(event_type, ' ' ORDER BY rn) AS text, CAST(count(*) AS BIGINT) AS n FROM h WHERE rn <= 14 GROUP BY 1, 2""",
)
def token_in_cell_topk(spark: SparkSession, d: str) -> DataFrame:
    cells = grid(spark, d).withColumnRenamed("ordinal", "cell")
    return spatial.tokens_in_cells(points(spark, d).withColumnRenamed("event_type", "text"), cells, "user_id", "cell", ["x", "event_id"])


@query(
    "overlap_neighbourhood",
    """WITH i AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS hi FROM orders)
    SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM i a JOIN i b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.lo <= b.hi AND b.lo <= a.hi""",
)
def overlap_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    i = table(spark, d, "orders").select("o_custkey", "o_orderkey", day.alias("lo"), F.date_add(day, (F.col("o_orderkey") % 40).cast("int")).alias("hi"))
    a, b = (i.select("o_custkey", F.col("o_orderkey").alias(k), F.col("lo").alias(f"{k}_lo"), F.col("hi").alias(f"{k}_hi")) for k in ("a", "b"))
    return spatial.overlapping(a, b, "o_custkey").filter("a < b").select("a", "b")


@query(
    "nearest_separator",
    """WITH s AS (SELECT s_nationkey AS k, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS gap, lead(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS hi FROM supplier),
    g AS (SELECT k, CAST(gap AS BIGINT) AS gap, s_acctbal AS lo, hi, (s_acctbal + hi) / 2 AS target FROM s WHERE hi IS NOT NULL),
    i AS (SELECT g.*, c_acctbal AS pos, c_custkey % 50 + 1 AS len, max(c_custkey % 50 + 1) OVER (PARTITION BY k, gap) AS longest FROM g JOIN customer ON c_nationkey = k AND c_acctbal > lo AND c_acctbal < hi),
    b AS (SELECT k, gap, pos FROM i WHERE len >= longest * 0.55::DOUBLE QUALIFY row_number() OVER (PARTITION BY k, gap ORDER BY abs(pos - target), pos) = 1)
    SELECT g.k, g.gap, coalesce(b.pos, g.target) AS separator FROM g LEFT JOIN b USING (k, gap)""",
)
def nearest_separator(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("k").orderBy("lo", "s_suppkey")
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("lo"), "s_suppkey")
    gaps = s.select("k", F.row_number().over(w).cast("long").alias("gap"), "lo", F.lead("lo").over(w).alias("hi")).filter("hi IS NOT NULL").withColumn("target", (F.col("lo") + F.col("hi")) / 2)
    lines = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("pos"), (F.col("c_custkey") % 50 + 1).alias("length"))
    return spatial.nearest_separator(gaps, lines, "k", "gap").select("k", "gap", "separator")


@query(
    "left_neighbour",
    """WITH g AS (SELECT event_id, user_id, value AS l, value + 3 AS r, 10 + event_id % 7 AS h FROM events)
    SELECT a.user_id, a.event_id, b.event_id AS neighbour FROM g a JOIN g b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.l - b.r BETWEEN 0 AND 1.5 AND b.h BETWEEN a.h * 0.78::DOUBLE AND a.h * 1.25::DOUBLE
    QUALIFY row_number() OVER (PARTITION BY a.user_id, a.event_id ORDER BY a.l - b.r, b.event_id) = 1""",
)
def left_neighbour(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("left"), (F.col("value") + 3).alias("right"), (10 + F.col("event_id") % 7).alias("height"))
    return spatial.left_neighbour(g, "user_id", "event_id", 1.5)


@query(
    "adjacent_bounds",
    """WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS bottom, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, CAST(day AS VARCHAR) AS day, coalesce(lag(bottom) OVER w, 0) AS top, bottom, (bottom + lead(bottom) OVER w) / 2 AS middle, CAST(row_number() OVER w AS BIGINT) AS line, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY n) AS BIGINT) AS size_rank
    FROM r WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
)
def adjacent_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a page: each begins where the one before ends; midpoints to the next."""
    r = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.max("value").alias("bottom"), F.count(F.lit(1)).alias("n"))
    w, by_size = Window.partitionBy("user_id").orderBy("d"), Window.partitionBy("user_id").orderBy("n")
    return r.select(
        "user_id", F.col("d").cast("string").alias("day"), F.coalesce(F.lag("bottom").over(w), F.lit(0.0)).alias("top"), "bottom", ((F.col("bottom") + F.lead("bottom").over(w)) / 2).alias("middle"),
        F.row_number().over(w).cast("long").alias("line"), F.dense_rank().over(by_size).cast("long").alias("size_rank"),
    )


@query(
    "gap_sessionize",
    f"""WITH l AS (SELECT user_id, event_id, {SECONDS} AS s, lag({SECONDS}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
    g AS (SELECT *, sum(CASE WHEN s - p > 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id) AS grp FROM l)
    SELECT user_id, CAST(grp AS BIGINT) AS session, min(s) AS first_s, max(s) AS last_s, count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def gap_sessionize(spark: SparkSession, d: str) -> DataFrame:
    """Runs of events with no gap over six hours, of two and more."""
    e = table(spark, d, "events").select("user_id", "event_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long").alias("s"))
    g = cluster.gap_groups(e, ["user_id"], "s", ["event_id"], 21600)
    return g.groupBy("user_id", F.col("group").alias("session")).agg(F.min("s").alias("first_s"), F.max("s").alias("last_s"), F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query(
    "filled_forward",
    """SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS paid FROM events""",
)
def filled_forward(spark: SparkSession, d: str) -> DataFrame:
    """What each user last paid, up to each event."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"))
    return ranges.filled_forward(e, ["user_id"], "ts", ["event_id"], "price", "paid").select("user_id", "event_id", "paid")


@query(
    "asof_order",
    """WITH e AS (SELECT event_id, user_id, TIMESTAMP '1995-01-01' + to_seconds(CAST(epoch(ts) AS BIGINT) % 200000000) AS moment FROM events)
    SELECT event_id, o_orderkey, o_totalprice FROM e ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1, 2) o ON e.user_id = o_custkey AND moment >= o_orderdate""",
)
def asof_order(spark: SparkSession, d: str) -> DataFrame:
    """Each event with its customer's latest order before it; events are set back into the years of the orders."""
    at = F.timestamp_seconds(F.lit(788918400) + F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000) % 200_000_000)
    e = table(spark, d, "events").select("event_id", "user_id", at.alias("at"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("placed"), "o_orderkey", "o_totalprice")
    return ranges.asof_join(e, o, ["user_id"], "at", ["event_id"], "placed", ["o_orderkey"], ["o_orderkey", "o_totalprice"]).select("event_id", "o_orderkey", "o_totalprice")


@query(
    "sticky_gap",
    """WITH l AS (SELECT user_id, event_id, value, value - lag(value) OVER w > 150 AS jump, lead(value) OVER w AS ahead, ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_id, coalesce(bool_or(jump) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS tall, coalesce(ahead, value + 1) AS below FROM l""",
)
def sticky_gap(spark: SparkSession, d: str) -> DataFrame:
    """From the first large jump on a user's rows are tall; each ends where the next begins."""
    e = ranges.placed(table(spark, d, "events").select("user_id", "event_id", "value", "ts"), ["user_id"], "ts")
    stepped = ranges.carried(e, ["user_id"], "ts", ["event_id"], previous={"before": F.col("value")}, following={"ahead": F.col("value")})
    jump = F.coalesce(F.col("value") - F.col("before") > 150, F.lit(False))
    return cluster.sticky(stepped, ["user_id"], "ts", ["event_id"], jump, "tall").select("user_id", "event_id", "tall", F.coalesce("ahead", F.col("value") + 1).alias("below"))


@query(
    "row_windows",
    """WITH p AS (SELECT user_id, event_id, CAST(floor(value * 4) AS BIGINT) AS y, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY CAST(floor(value * 4) AS BIGINT), event_id)),
    g AS (SELECT *, lead(y) OVER (PARTITION BY user_id ORDER BY i) - y AS gap, count(*) OVER (PARTITION BY user_id) AS n FROM p), m AS (SELECT user_id, median(gap) AS middle FROM g GROUP BY 1),
    j AS (SELECT a.user_id, a.event_id, greatest(0, a.y - 8) AS y1, b.y AS here, b.gap, coalesce(middle, 40) AS middle FROM g a JOIN g b ON b.user_id = a.user_id AND b.i = least(a.n, a.i + 1) JOIN m ON m.user_id = a.user_id),
    e AS (SELECT *, CASE WHEN gap IS NOT NULL THEN greatest(y1 + 18, here + gap - greatest(3, round_even(greatest(1, gap) * 0.1::DOUBLE, 0))) ELSE least(1000, floor(here + greatest(65.0::DOUBLE, 1.7::DOUBLE * middle))) END AS y2 FROM j)
    SELECT user_id, event_id, y1, CAST(least(1000, CASE WHEN y2 - y1 < 18 THEN least(1000, y1 + 24) ELSE y2 END) AS BIGINT) AS y2 FROM e""",
)
def row_windows(spark: SparkSession, d: str) -> DataFrame:
    """Two bullets a row, each ended by the bullet after; the page's last by its median gap."""
    p = table(spark, d, "events").select("user_id", "event_id", F.floor(F.col("value") * 4).alias("y"))
    return spatial.row_windows(p, "user_id", "event_id", "y", F.lit(1000), span=2)


@query(
    "slot_texts",
    """WITH c AS (SELECT DISTINCT user_id, r, r % 3 AS variant FROM events, (SELECT range AS r FROM range(6)))
    SELECT c.user_id, c.variant, r AS slot, string_agg(event_type, ' ' ORDER BY value, event_id) AS text, count(*) AS n FROM events e JOIN c ON c.user_id = e.user_id AND c.variant = e.event_id % 3 AND value BETWEEN r * 15 - 2 AND r * 15 + 27 AND hour(ts) BETWEEN r * 2 - 2 AND r * 2 + 14 GROUP BY 1, 2, 3""",
)
def slot_texts(spark: SparkSession, d: str) -> DataFrame:
    """All words of each slot that were read in the slot's own variant of the image."""
    slots = grid(spark, d).withColumnRenamed("ordinal", "slot").withColumn("variant", F.col("slot") % 3)
    words = points(spark, d).withColumnRenamed("event_type", "text").withColumn("variant", F.col("event_id") % 3)
    return spatial.tokens_in_cells(words, slots, ["user_id", "variant"], "slot", ["x", "event_id"], limit=None)


RUNNING = """WITH RECURSIVE e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events),
    r AS (SELECT user_id, rn, event_id, value, [[value]] AS groups, 0 AS k FROM e WHERE rn = 1
      UNION ALL SELECT user_id, rn, event_id, value, CASE WHEN hit > 0 THEN list_transform(groups, lambda g, i: CASE WHEN i = hit THEN list_append(g, value) ELSE g END) ELSE list_append(groups, [value]) END, CASE WHEN hit > 0 THEN hit - 1 ELSE len(groups) END
      FROM (SELECT e.user_id, e.rn, e.event_id, e.value, r.groups, coalesce(list_position(list_transform(r.groups, lambda g: abs(e.value - list_aggregate(g, '{0}')) <= 5), true), 0) AS hit FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1))"""


@query("cluster_running_median", RUNNING.format("median") + " SELECT user_id, event_id, CAST(k AS BIGINT) AS cluster FROM r")
def cluster_running_median(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    return cluster.cluster_running(e, "user_id", "event_id", "value", 5.0)


@query(
    "point_columns",
    RUNNING.format("avg") + """, c AS (SELECT user_id, k, avg(value) AS centre FROM r GROUP BY 1, 2 HAVING count(*) >= 3), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY centre, k) AS col FROM c)
    SELECT user_id, event_id, CAST(col AS BIGINT) AS "column", round(centre, 6) AS centre FROM r JOIN n USING (user_id, k)""",
)
def point_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of three points and more, by the running mean of their places."""
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    return cluster.point_columns(e, "user_id", "event_id", "value").withColumn("centre", F.round("centre", 6))


@query(
    "greedy_spatial_dedupe",
    """WITH RECURSIVE e AS (SELECT user_id, event_id, value AS x, hour(ts) AS y, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY hour(ts), value, event_id) AS rn FROM events),
    r AS (SELECT user_id, rn, event_id, [{'x': x, 'y': y, 'kind': kind}] AS kept, true AS stays FROM e WHERE rn = 1
      UNION ALL SELECT user_id, rn, event_id, CASE WHEN free THEN list_append(kept, {'x': x, 'y': y, 'kind': kind}) ELSE kept END, free
      FROM (SELECT e.*, r.kept, len(list_filter(r.kept, lambda q: q.kind = e.kind AND abs(q.x - e.x) < 12 AND abs(q.y - e.y) < 3)) = 0 AS free FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1))
    SELECT user_id, event_id FROM r WHERE stays""",
)
def greedy_spatial_dedupe(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d).withColumn("kind", F.col("event_type"))
    return cluster.greedy_dedupe(p.select("user_id", "event_id", "x", "y", "kind"), "user_id", "event_id", ["y", "x"], "kind", 12.0, 3.0)


@query(
    "suppress_repeats",
    """WITH RECURSIVE e AS (SELECT user_id, event_id, value AS x, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events),
    r AS (SELECT user_id, rn, event_id, x, kind, true AS stays FROM e WHERE rn = 1
      UNION ALL SELECT e.user_id, e.rn, e.event_id, CASE WHEN r.kind <> e.kind OR e.x - r.x > 30 THEN e.x ELSE r.x END, CASE WHEN r.kind <> e.kind OR e.x - r.x > 30 THEN e.kind ELSE r.kind END, r.kind <> e.kind OR e.x - r.x > 30 FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
    SELECT user_id, event_id FROM r WHERE stays""",
)
def suppress_repeats(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d).withColumnRenamed("event_type", "kind")
    return cluster.suppress_repeats(p, "user_id", "event_id", "x", "kind", 30.0)


@query(
    "rank_margin",
    """WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, row_number() OVER w AS rn, lead(l_quantity) OVER w AS second FROM lineitem WINDOW w AS (PARTITION BY l_partkey ORDER BY l_returnflag = 'R', l_quantity DESC, l_orderkey, l_linenumber, l_suppkey))
    SELECT l_partkey, l_orderkey, l_quantity AS top, l_quantity - coalesce(second, 0) AS margin FROM r WHERE rn = 1""",
)
def rank_margin(spark: SparkSession, d: str) -> DataFrame:
    """The best row of each part, unvetoed first, and its lead over the next."""
    order = [F.col("l_returnflag") == "R", F.desc("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    rows = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag")
    return ranking.lead(rows, ["l_partkey"], order, "l_quantity", ["l_orderkey"])


@query(
    "majority_vote",
    """WITH r AS (SELECT event_id // 5 AS slot, event_id, event_id // 5 * 37 % 900 + 100 AS b, event_id % 5 AS j, value, event_type FROM events),
    t AS (SELECT slot, event_id, CASE j WHEN 0 THEN b || '円' WHEN 1 THEN CAST(CASE WHEN slot % 2 = 1 THEN b ELSE b * 10 + slot % 10 END AS VARCHAR) WHEN 2 THEN 'x' || CASE WHEN slot % 3 = 0 THEN b + 1 ELSE (b + 2) * 10 + 3 END WHEN 3 THEN event_type ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS t FROM r),
    v AS (SELECT slot, event_id, regexp_replace(t, '[^0-9]', '', 'g') AS v FROM t), g AS (SELECT * FROM v WHERE length(v) BETWEEN 2 AND 4),
    p AS (SELECT slot, arg_min(v, event_id) AS v FROM g a WHERE length(v) = 3 AND EXISTS (SELECT 1 FROM g b WHERE b.slot = a.slot AND length(b.v) = 4 AND starts_with(b.v, a.v)) GROUP BY 1),
    c AS (SELECT slot, v, count(*) AS n, min(event_id) AS first FROM g GROUP BY 1, 2), m AS (SELECT slot, v FROM c QUALIFY row_number() OVER (PARTITION BY slot ORDER BY n DESC, abs(length(v) - 3), length(v), first) = 1)
    SELECT s.slot, CAST(coalesce(p.v, m.v) AS INTEGER) AS value, count(g.v) AS reads FROM (SELECT DISTINCT slot FROM r) s LEFT JOIN p USING (slot) LEFT JOIN m USING (slot) LEFT JOIN g USING (slot) GROUP BY s.slot, p.v, m.v""",
)
def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    """Five readings of each price, some with a sign that was read as a digit, some with no digit at all."""
    i, slot = F.col("event_id"), F.floor(F.col("event_id") / 5)
    b, j = slot * 37 % 900 + 100, F.col("event_id") % 5
    text_of = lambda c: c.cast("long").cast("string")
    read = (
        F.when(j == 0, F.concat(text_of(b), F.lit("円")))
        .when(j == 1, text_of(F.when(slot % 2 == 1, b).otherwise(b * 10 + slot % 10)))
        .when(j == 2, F.concat(F.lit("x"), text_of(F.when(slot % 3 == 0, b + 1).otherwise((b + 2) * 10 + 3))))
        .when(j == 3, F.col("event_type"))
        .otherwise(text_of(F.floor("value")))
    )
    return names.majority(table(spark, d, "events").select(slot.alias("slot"), i, read.alias("read")), "slot", "read", "event_id")


@query("exact_median", "SELECT l_suppkey, median(l_quantity) AS middle, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1")
def exact_median(spark: SparkSession, d: str) -> DataFrame:
    return ranking.extent(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")


@query(
    "consensus",
    """SELECT user_id, hour(ts)::INTEGER AS hour, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS variants, arg_max(event_type, (value, event_id)) AS best, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) >= 4""",
)
def consensus(spark: SparkSession, d: str) -> DataFrame:
    """Names seen in at least four variants of an image, with the best evidence."""
    e = table(spark, d, "events").withColumn("hour", F.hour("ts"))
    return ranking.consensus(e, ["user_id", "hour"], "event_type", [F.col("value"), F.col("event_id")], 4).withColumn("variants", F.array_join("variants", ","))


@query(
    "evidence_tiers",
    """WITH s AS (SELECT event_id, value AS score, (value * 7) % 100 AS nm, (value * 13) % 100 AS spec, value % 20 AS margin, event_id % 2 = 0 AS one FROM events)
    SELECT event_id, CASE WHEN margin < 5 THEN 'none' WHEN score >= 72 THEN 'strong' WHEN nm >= 45 AND one AND spec >= 70 AND score >= 58 THEN 'rescued' WHEN score >= 60 THEN 'medium' ELSE 'none' END AS tier FROM s""",
)
def evidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return table(spark, d, "events").select("event_id", names.evidence_tier(v, (v * 7) % 100, (v * 13) % 100, F.col("event_id") % 2 == 0, v % 20).alias("tier"))


@query(
    "multiset_recall",
    """WITH e AS (SELECT (l_suppkey + 1) // 2 AS pair, l_linenumber AS k, l_quantity AS q, count(*) AS n FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY ALL), g AS (SELECT (l_suppkey + 1) // 2 AS pair, l_linenumber AS k, l_quantity AS q, count(*) AS n FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY ALL)
    SELECT pair, k, CAST(sum(least(e.n, coalesce(g.n, 0))) AS BIGINT) AS matched, CAST(sum(e.n) AS BIGINT) AS expected, CAST(sum(least(e.n, coalesce(g.n, 0))) AS DOUBLE) / CAST(sum(e.n) AS DOUBLE) AS recall FROM e LEFT JOIN g USING (pair, k, q) GROUP BY ALL""",
)
def multiset_recall(spark: SparkSession, d: str) -> DataFrame:
    """Every line has a part: those of odd suppliers are expected, those of the next, even one are the finds."""
    q = table(spark, d, "lineitem").select(F.floor((F.col("l_suppkey") + 1) / 2).alias("pair"), F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("q"), (F.col("l_suppkey") % 2 == 1).alias("odd"))
    return sets.recall(q.filter("odd").drop("odd"), q.filter("NOT odd").drop("odd"), ["q"], ["pair", "k"]).filter("expected > 0")


@query(
    "unresolved_evidence",
    "SELECT o_custkey, count(DISTINCT o_orderkey) AS anchors, count(l_orderkey) AS rows, greatest(3 * count(DISTINCT o_orderkey) - count(l_orderkey), 0) AS unresolved FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
)
def unresolved_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Anchors without a row of their own: rows are counted before the join, so nothing is multiplied."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    j = table(spark, d, "orders").select("o_custkey", "o_orderkey").join(rows, "o_orderkey", "left")
    g = j.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("anchors"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return g.withColumn("unresolved", F.greatest(3 * F.col("anchors") - F.col("rows"), F.lit(0)).cast("long"))


@query(
    "positional_zip",
    """WITH a AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS k FROM benchmark), b AS (SELECT doc_id, quality, row_number() OVER (ORDER BY doc_id) AS k FROM labels)
    SELECT item_id, doc_id, quality FROM a JOIN b USING (k)""",
)
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    """The k-th of one list with the k-th of the other; no longer than the shorter."""
    return sets.zipped(table(spark, d, "benchmark").select("item_id"), "item_id", table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query(
    "knn_template",
    """WITH t AS (SELECT embedding AS te, label FROM embeddings WHERE vec_id < 20), p AS (SELECT vec_id, t.label, list_sum(list_transform(list_zip(e.embedding, te), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))) / 64 AS dist FROM embeddings e, t WHERE vec_id >= 20)
    SELECT vec_id, label, round(dist, 4) AS distance FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, label) = 1""",
)
def knn_template(spark: SparkSession, d: str) -> DataFrame:
    """The template whose mean squared distance is least."""
    e = table(spark, d, "embeddings")
    templates = e.filter("vec_id < 20").select(F.col("embedding").alias("t"), "label")  # twenty rows
    near = spatial.nearest_template(e.filter("vec_id >= 20").select("vec_id", "embedding"), templates, F.col("embedding"), F.col("t"), ["vec_id"], "label")
    return near.withColumn("distance", F.round("distance", 4))


@query("artifact_equality", "SELECT 'same' AS pair, 0::BIGINT AS only_first, 0::BIGINT AS only_second UNION ALL SELECT 'other', (SELECT count(*) FROM part WHERE p_size % 5 = 0), (SELECT count(*) FROM part WHERE p_size % 5 = 0)")
def artifact_equality(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_size")
    other = p.withColumn("p_size", F.when(F.col("p_size") % 5 == 0, -1).otherwise(F.col("p_size")))
    return sets.same_content(p, p).select(F.lit("same").alias("pair"), "*").unionByName(sets.same_content(p, other).select(F.lit("other").alias("pair"), "*"))


@query(
    "snapshot_replace",
    """SELECT o_orderkey, o_custkey, 'old' AS issue FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
    UNION ALL SELECT o_orderkey, o_custkey, 'new' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def snapshot_replace(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    new = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    old_rows, new_rows = (o.filter(c).select("o_orderkey", "o_custkey", F.lit(k).alias("issue")) for c, k in ((~new, "old"), (new, "new")))
    return sets.replaced(old_rows, new_rows, "o_custkey")


@query(
    "set_ops",
    """WITH c AS (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000), s AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal < 5000),
    o AS (SELECT c_nationkey AS k, c_custkey AS place, 0 AS part FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, s_suppkey, 1 FROM supplier WHERE s_acctbal < 5000)
    SELECT 'union_all' AS op, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (SELECT * FROM c UNION ALL SELECT * FROM s)
    UNION ALL SELECT 'except', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT * FROM c EXCEPT SELECT * FROM s) UNION ALL SELECT 'except_all', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM s)
    UNION ALL SELECT 'intersect', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT * FROM c INTERSECT SELECT * FROM s) UNION ALL SELECT 'intersect_all', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT * FROM c INTERSECT ALL SELECT * FROM s)
    UNION ALL SELECT 'ordered_union', count(*), CAST(sum(k + 100 * place) AS BIGINT) FROM (SELECT k, place FROM o QUALIFY row_number() OVER (PARTITION BY k ORDER BY part, place) = 1)""",
)
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("k"))
    s = table(spark, d, "supplier").filter("s_acctbal < 5000").select(F.col("s_nationkey").alias("k"))
    parts = [table(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("place")), table(spark, d, "supplier").filter("s_acctbal < 5000").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("place"))]
    ordered = sets.ordered_union(parts, ["k"], "place").select((F.col("k") + 100 * F.col("place")).alias("k"))
    every = {"union_all": c.unionByName(s), "except": c.subtract(s), "except_all": c.exceptAll(s), "intersect": c.intersect(s), "intersect_all": c.intersectAll(s), "ordered_union": ordered}
    one, *more = [x.agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total")).select(F.lit(k).alias("op"), "n", "total") for k, x in every.items()]
    for m in more:
        one = one.unionByName(m)
    return one


@query(
    "price_cells",
    """WITH a AS (SELECT user_id, event_id, hour(ts) // 4 AS line, value AS x, value / 10 + hour(ts) AS bottom FROM events), l AS (SELECT user_id, line, max(bottom) AS bottom FROM a GROUP BY 1, 2),
    r AS (SELECT user_id, line, coalesce(lag(bottom) OVER (PARTITION BY user_id ORDER BY line), 0) AS y1 FROM l)
    SELECT user_id, event_id, coalesce((lag(x) OVER w + x) / 2, 0) AS x1, coalesce((x + lead(x) OVER w) / 2, 1000) AS x2, y1, CAST(row_number() OVER w AS BIGINT) AS col FROM a JOIN r USING (user_id, line) WINDOW w AS (PARTITION BY user_id, line ORDER BY x, event_id)""",
)
def price_cells(spark: SparkSession, d: str) -> DataFrame:
    """Areas of anchors: midpoints to the neighbours of a line, the bottom of the line before, the page's edges."""
    a = table(spark, d, "events").select("user_id", "event_id", F.floor(F.hour("ts") / 4).alias("line"), F.col("value").alias("x"), (F.col("value") / 10 + F.hour("ts")).alias("bottom"))
    return spatial.anchor_cells(a, ["user_id"], "event_id", 1000.0).select("user_id", "event_id", "x1", "x2", "y1", "col")


@query(
    "component_filter",
    """WITH c AS (SELECT event_id, value AS w, value * 0.7::DOUBLE AS h, 0.3::DOUBLE + (event_id % 7) / 10.0::DOUBLE AS fill FROM events)
    SELECT event_id, w >= 120 AND h >= 40 AND h <= 288 AND w * h >= 3840 AND fill >= 0.45::DOUBLE AS banner, w * h * fill >= 19 AND w BETWEEN 2 AND 80 AND h BETWEEN 28 AND 160 AS glyph FROM c""",
)
def component_filter(spark: SparkSession, d: str) -> DataFrame:
    """Components of a page of 800 by 1600 that can be banners, and those that can be digits."""
    c = table(spark, d, "events").select("event_id", F.col("value").alias("w"), (F.col("value") * 0.7).alias("h"), (0.3 + (F.col("event_id") % 7) / 10.0).alias("fill"))
    return c.select("event_id", spatial.is_banner(800, 1600).alias("banner"), spatial.is_glyph(800, 1600).alias("glyph"))


@query(
    "candidate_order",
    """WITH c AS (SELECT user_id, event_id, round(value % 3) AS conf, event_type || CASE WHEN event_id % 2 = 0 THEN '/' ELSE '' END || CASE WHEN event_id % 3 = 0 THEN '〜' ELSE '' END AS t FROM events)
    SELECT user_id, event_id, t AS best FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY conf DESC, contains(t, '/') DESC, contains(t, '〜') DESC, length(t) DESC, event_id) = 1""",
)
def candidate_order(spark: SparkSession, d: str) -> DataFrame:
    """The reading to believe: surest, then with a slash, with a range sign, longest, first."""
    t = F.concat("event_type", F.when(F.col("event_id") % 2 == 0, "/").otherwise(""), F.when(F.col("event_id") % 3 == 0, "〜").otherwise(""))
    c = table(spark, d, "events").select("user_id", "event_id", F.round(F.col("value") % 3).alias("conf"), t.alias("t"))
    order = [F.col("conf"), F.col("t").contains("/"), F.col("t").contains("〜"), F.length("t"), -F.col("event_id")]
    return ranking.best(c, ["user_id"], order, ["event_id", "t"]).withColumnRenamed("t", "best")


@query(
    "leading_zero",
    """WITH p AS (SELECT event_id, lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 3, '0') AS t, event_id % 2 = 0 AS nine, event_id % 5 / 100.0::DOUBLE AS lead FROM events),
    q AS (SELECT event_id, CASE WHEN t[1] = '0' AND nine AND lead <= 0.03::DOUBLE THEN '9' || t[2:] ELSE t END AS t FROM p)
    SELECT event_id, CASE WHEN t[1] = '0' THEN 'invalid_leading_zero' WHEN CAST(t AS INTEGER) BETWEEN 10 AND 9999 THEN 'ok' ELSE 'invalid_value' END AS status, CASE WHEN t[1] <> '0' AND CAST(t AS INTEGER) BETWEEN 10 AND 9999 THEN CAST(t AS INTEGER) END AS value FROM q""",
)
def leading_zero(spark: SparkSession, d: str) -> DataFrame:
    digits = F.split(F.lpad(F.floor("value").cast("string"), 3, "0"), "")
    e = table(spark, d, "events").select("event_id", text.repaired_price(digits, F.when(F.col("event_id") % 2 == 0, "9").otherwise("8"), F.col("event_id") % 5 / 100.0).alias("p"))
    return e.select("event_id", "p.status", "p.value")


@query(
    "regression_gate",
    """WITH e AS (SELECT l_suppkey AS g, l_quantity AS q, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2), f AS (SELECT l_suppkey AS g, l_quantity AS q, count(*) AS n FROM lineitem WHERE l_linenumber > 2 AND l_returnflag <> 'R' GROUP BY 1, 2),
    r AS (SELECT g, CAST(sum(least(e.n, coalesce(f.n, 0))) AS DOUBLE) / CAST(sum(e.n) AS DOUBLE) AS recall FROM e LEFT JOIN f USING (g, q) GROUP BY 1),
    c AS (SELECT l_suppkey AS g, count(*) AS found, count(*) FILTER (l_linestatus = 'F') AS named FROM lineitem GROUP BY 1)
    SELECT g, recall, CASE WHEN g % 10 = 0 THEN 9999.0::DOUBLE ELSE found / (g % 10)::DOUBLE END AS density, named / found::DOUBLE AS coverage, recall >= 0.8::DOUBLE AND g % 10 <> 0 AND found / (g % 10)::DOUBLE <= 400 AND named / found::DOUBLE >= 0.49::DOUBLE AS passes FROM r JOIN c USING (g)""",
)
def regression_gate(spark: SparkSession, d: str) -> DataFrame:
    """Recall, finds per megapixel and the share of finds with a name, of each group, against their thresholds."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_quantity").alias("q"), "l_linenumber", "l_returnflag", "l_linestatus")
    r = sets.recall(li.filter("l_linenumber <= 2").select("g", "q"), li.filter("l_linenumber > 2 AND l_returnflag <> 'R'").select("g", "q"), ["q"], ["g"]).filter("expected > 0")
    c = li.groupBy("g").agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("l_linestatus") == "F").alias("named"))
    density = F.when(F.col("g") % 10 > 0, F.col("found") / (F.col("g") % 10)).otherwise(9999.0)
    shown = r.join(c, "g").select("g", "recall", density.alias("density"), (F.col("named") / F.col("found")).alias("coverage"))
    return gates.regression(shown, 0.8, 400.0, 0.49)


@query(
    "event_rollup",
    """SELECT coalesce(event_type, 'all') AS kind, coalesce(CAST(day AS VARCHAR), 'all') AS day, count(*) AS n, CAST(grouping(event_type) * 2 + grouping(day) AS BIGINT) AS level FROM (SELECT event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY CUBE (event_type, day)""",
)
def event_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Spark's own, without a counterpart: subtotals on every level."""
    e = table(spark, d, "events").select("event_type", F.col("ts").cast("date").alias("day"))
    c = e.cube("event_type", "day").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
    return c.select(F.coalesce("event_type", F.lit("all")).alias("kind"), F.coalesce(F.col("day").cast("string"), F.lit("all")).alias("day"), "n", "level")


@query(
    "event_windows",
    """SELECT CAST(epoch(date_trunc('day', ts) + CAST(hour(ts) // 6 * 6 AS INTEGER) * INTERVAL 1 HOUR) AS BIGINT) AS start_s, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Spark's own, without a counterpart: the batch form of the streamed windows."""
    from shelfmark.streaming.updates import windowed_counts

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed_counts(e, "6 hours").select(F.unix_seconds("start").alias("start_s"), "event_type", "n")


@query(
    "grid_components",
    """WITH RECURSIVE c AS (SELECT DISTINCT user_id, CAST(floor(value) AS BIGINT) AS x, CAST(hour(ts) AS BIGINT) AS y FROM events),
    r AS (SELECT user_id, x, y, x AS rx, y AS ry FROM c UNION SELECT r.user_id, r.x, r.y, c.x, c.y FROM r JOIN c ON c.user_id = r.user_id AND c.x - r.rx BETWEEN -1 AND 1 AND c.y - r.ry BETWEEN -1 AND 1),
    l AS (SELECT user_id, x, y, min(ry * 1000000 + rx) AS least FROM r GROUP BY ALL)
    SELECT user_id, least % 1000000 AS least_x, least // 1000000 AS least_y, count(*) AS cells, min(x) AS x1, min(y) AS y1, max(x) AS x2, max(y) AS y2, count(*) / ((max(x) - min(x) + 1) * (max(y) - min(y) + 1)) AS fill FROM l GROUP BY user_id, least""",
)
def grid_components(spark: SparkSession, d: str) -> DataFrame:
    """Each user's page with a cell for every whole value and hour that has an event: the cells that touch, and the box around them."""
    cells = table(spark, d, "events").select("user_id", F.floor("value").alias("x"), F.hour("ts").alias("y"))
    return components.component_boxes(components.grid_components(cells, ["user_id"], "x", "y"), ["user_id"])


VOTING = ", ".join(f"({k}, {c}, {s})" for k, (c, s) in enumerate(votes.directions(12)))


@query(
    "line_votes",
    f"""WITH n(angle, c, s) AS (VALUES {VOTING}),
    v AS (SELECT event_type, angle, CAST(floor((CAST(floor(value * 2) AS BIGINT) * c + hour(ts) * 10 * s) / {float(votes.UNIT * 8)}::DOUBLE) AS BIGINT) AS o, count(*) AS votes FROM events, n GROUP BY ALL HAVING count(*) >= 12),
    w AS (SELECT event_type, pmod AS angle, CASE WHEN a BETWEEN 0 AND 11 THEN o ELSE -o - 1 END + b AS o, votes, -angle AS t1, -v_o AS t2 FROM (SELECT v.*, o AS v_o, angle + i AS a, (angle + i + 12) % 12 AS pmod, j AS b FROM v, (VALUES (-1), (0), (1)) x(i), (VALUES (-1), (0), (1)) y(j) WHERE i <> 0 OR j <> 0))
    SELECT v.event_type, CAST(v.angle AS INTEGER) AS angle, v.o AS offset, v.votes FROM v
    WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.event_type = v.event_type AND w.angle = v.angle AND w.o = v.o AND (w.votes > v.votes OR (w.votes = v.votes AND (w.t1 > -v.angle OR (w.t1 = -v.angle AND w.t2 > -v.o)))))""",
)
def line_votes(spark: SparkSession, d: str) -> DataFrame:
    """Each kind's page with a point for every event: the lines that most of their points lie on."""
    p = table(spark, d, "events").select("event_type", F.floor(F.col("value") * 2).alias("x"), (F.hour("ts") * 10).alias("y"))
    return votes.line_votes(p, ["event_type"], "x", "y", angles=12, step=8, least=12)


@query(
    "staged_cascade",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN upper(p_name) WHEN p_partkey % 3 = 0 THEN p_brand WHEN contains(p_name, 'e') THEN p_type END AS name,
    CASE WHEN p_size % 2 = 0 THEN 'whole' WHEN p_partkey % 3 = 0 THEN 'brand' WHEN contains(p_name, 'e') THEN 'kind' END AS reading FROM part""",
)
def staged_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Three readings of each part's name, each tried on what is still unresolved."""
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    reading = lambda able, shown: lambda left: left.filter(able).select("p_partkey", shown.alias("name"))
    readings = [("whole", reading("p_size % 2 = 0", F.upper("p_name"))), ("brand", reading("p_partkey % 3 = 0", F.col("p_brand"))), ("kind", reading("contains(p_name, 'e')", F.col("p_type")))]
    return cascade.cascade(parts, "p_partkey", readings)[0].select("p_partkey", "name", "reading")


@query(
    "sheet_layout",
    """WITH b AS (SELECT p_brand, p_partkey, p_size % 23 + 5 AS w, p_size % 7 + 3 AS h FROM part), m AS (SELECT p_brand, max(w) AS mw, max(h) AS mh FROM b GROUP BY 1),
    f AS (SELECT *, sum(w) OVER (PARTITION BY p_brand ORDER BY h DESC, p_partkey) - w AS f FROM b), s AS (SELECT f.*, mh, CAST(f // (201 - mw) AS BIGINT) AS shelf FROM f JOIN m USING (p_brand)),
    d AS (SELECT p_brand, shelf, min(f) AS fst, max(h) AS deep, max(mh) AS mh FROM s GROUP BY 1, 2), t AS (SELECT *, sum(deep) OVER (PARTITION BY p_brand ORDER BY shelf) - deep AS top FROM d),
    g AS (SELECT *, CAST(top // (101 - mh) AS BIGINT) AS sheet FROM t), y AS (SELECT *, top - min(top) OVER (PARTITION BY p_brand, sheet) AS y FROM g)
    SELECT s.p_brand, p_partkey, dense_rank() OVER (PARTITION BY s.p_brand ORDER BY sheet) - 1 AS sheet, CAST(f - fst AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM s JOIN y USING (p_brand, shelf)""",
)
def sheet_layout(spark: SparkSession, d: str) -> DataFrame:
    """A box for each part, on sheets of 200 by 100 for each brand."""
    b = table(spark, d, "part").select("p_brand", "p_partkey", (F.col("p_size") % 23 + 5).alias("w"), (F.col("p_size") % 7 + 3).alias("h"))
    return sheets.sheet_layout(b, ["p_brand"], "p_partkey", "w", "h", 200, 100).select("p_brand", "p_partkey", "sheet", "x", "y")


@query("distinct_by_period")
def distinct_by_period(spark: SparkSession, d: str) -> DataFrame:
    """Each kind's users and quantiles of values by week, from a sketch for each day: an estimate, so without SQL."""
    e = table(spark, d, "events").select("event_type", "user_id", "value", F.col("ts").cast("date").alias("d"))
    days = sketches.daily(e, F.col("d"), ["event_type"], "user_id", "value")
    return sketches.by_period(days, F.date_trunc("week", F.col("day")).cast("date"), ["event_type"])
