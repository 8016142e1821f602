"""Names of products resolved against a dictionary, with a veto for numeric variants that the text doesn't show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fuzzy, text

MIN_SCORE, MIN_MARGIN = 50.0, 8.0
#: The Indel ratio from which two names are variants of each other.
LIKE = 58.0
#: Texts and names of a tile, on average: what a task scores at once.
TEXTS, NAMES = 256, 64
#: Records that are broadcast, at most.
BROADCAST = 10_000
#: Partitions of tiles at most; each then has several.
TASKS = 4096


def siblings(names: DataFrame) -> DataFrame:
    """(name, ordinal, sibling_group): whether names alike but for their numbers differ in those."""
    shown = names.select("name", "ordinal").withColumn("skeleton", text.without_numbers(F.col("name"))).withColumn("sig", F.array_join(text.numeric_signatures(F.col("name")), ","))
    groups = shown.groupBy("skeleton").agg((F.count_distinct("sig") > 1).alias("sibling_group"))
    return shown.join(groups, "skeleton").select("name", "ordinal", "sibling_group", (F.col("sig") != "").alias("numeric"))


def all_pairs(left: DataFrame, left_key: list[str], right: DataFrame, right_key: list[str]) -> DataFrame:
    """Every row of left with every row of right, where that is what is asked for: in tiles of TEXTS by NAMES, joined by their numbers."""
    across, down = (max(1, -(-df.count() // size)) for df, size in ((left, TEXTS), (right, NAMES)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda key, n: F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")
    a = left.withColumn("__across", own(left_key, across)).withColumn("__down", every(down))
    b = right.withColumn("__down", own(right_key, down)).withColumn("__across", every(across))
    # A stated number of partitions: by size alone, all of these short rows would go to one task.
    tiles = min(across * down, TASKS)
    a, b = (df.repartition(tiles, "__across", "__down") for df in (a, b))
    return a.hint("merge").join(b, ["__across", "__down"]).drop("__across", "__down")


def bag(value: Column) -> Column:
    """A text's characters as an array in which a character's second occurrence is not its first: what two texts share as bags is then an intersection."""
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.transform(letters, lambda c, i: F.concat(c, F.size(F.filter(F.slice(letters, 1, i + 1), lambda d: d == c)).cast("string")))


def _bound(shared: Column, n: Column, m: Column) -> Column:
    """The most that a partial ratio of texts of n and m characters can be: the shared ones in a stretch of as many."""
    return F.when(F.least(n, m) > 0, 200.0 * shared / (F.least(n, m) + shared)).otherwise(0.0)


def coverage(shared: Column, n: Column) -> Column:
    """How much of a name's n characters a text has, in percent; 0 for an empty name."""
    return F.when(n > 0, 100.0 * shared / n).otherwise(0.0)


#: Names of each text that are scored first; their scores say which others can still be among the best.
FIRST = 4


def _within(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score + F.col("__gain")))


def _scored(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("base_score", fuzzy.base_score_udf("name", "text")).withColumn("score", _within(F.col("base_score")))


def bounded_pairs(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Every different text with every name: support, veto, and the most that the pair can score, told by the characters it shares. Expressions alone, but for NFKC of each text and name."""
    forms = lambda df, c: df.withColumns({"__whole": text.comparable(F.col(c)), "__bare": text.without_numbers(F.col(c))})
    bags = lambda df, p: df.withColumns({f"__{p}w": bag(F.col("__whole")), f"__{p}b": bag(F.col("__bare"))})
    read = forms(texts.select("text").distinct(), "text").withColumn("__numbers", text.number_tokens(F.col("text")))
    known = forms(siblings(names), "name").withColumn("__wanted", text.numeric_signatures(F.col("name")))
    pairs = all_pairs(bags(read, "t").withColumnRenamed("__whole", "__shown").drop("__bare"), ["text"], bags(known, "n").drop("__whole", "__bare"), ["name", "ordinal"])
    shares = {"__sw": F.size(F.array_intersect("__nw", "__tw")), "__sb": F.size(F.array_intersect("__nb", "__tb"))}
    pairs = pairs.withColumns(shares)  # once a pair, as they are dear
    whole, bare, n, t, m, u = (F.col("__sw"), F.col("__sb"), *(F.size(c) for c in ("__nw", "__tw", "__nb", "__tb")))
    most = 0.30 * _bound(whole, n, t) + 0.20 * _bound(bare, m, u) + 0.25 * coverage(whole, n) + 0.25 * coverage(bare, m)
    support = text.signature_support(F.col("__wanted"), F.col("__shown"), F.col("__numbers"))
    kept = pairs.select("text", "name", "ordinal", "sibling_group", "numeric", support.alias("support"), F.when((n > 0) & (t > 0), most).otherwise(0.0).alias("__most"))
    veto = F.col("numeric") & (F.col("support") <= 0)
    gain = F.when(F.col("veto"), -40.0).when(F.col("numeric"), F.when(F.col("sibling_group"), 18.0).otherwise(8.0) * F.col("support")).otherwise(0.0)
    # A little more than the bound, for what is lost in rounding.
    return kept.withColumn("veto", veto).withColumn("__gain", gain).withColumn("__most", _within(F.col("__most")) + 1e-6)


def able_pairs(pairs: DataFrame, most: int) -> DataFrame:
    """The pairs of bounded_pairs() that can be among the most best of their text.

    The FIRST names by their bound are scored; a name whose bound is below the worst of the most best of these can't be better. A text that has fewer
    names than most keeps them all.
    """
    first = _scored(pairs.withColumn("__k", F.row_number().over(Window.partitionBy("text").orderBy("veto", F.desc("__most"), "ordinal", "name"))).filter(F.col("__k") <= max(FIRST, most)))
    rank = F.row_number().over(Window.partitionBy("text").orderBy("veto", F.desc("score")))
    worst = first.withColumn("__k", rank).filter(F.col("__k") == most).select(F.col("text").alias("__text"), F.col("veto").alias("__veto"), F.col("score").alias("__least"))
    met = pairs.join(worst, F.col("text").eqNullSafe(F.col("__text")), "left")
    could = (F.col("veto") < F.col("__veto")) | ((F.col("veto") == F.col("__veto")) & (F.col("__most") >= F.col("__least")))
    return met.filter(F.col("__least").isNull() | could).drop("__text", "__veto", "__least")


def ranks(texts: DataFrame, names: DataFrame, most: int | None = None) -> DataFrame:
    """Every different text (text) against the names of the dictionary (name, ordinal), with their rank: all names, or the most best, for which few pairs need be scored.

    Texts and names meet in tiles of TEXTS by NAMES that are joined by their number. Vetoed
    names come last; then the score, the support, and the dictionary's order.
    """
    pairs = bounded_pairs(texts, names)
    scored = _scored(pairs if most is None else able_pairs(pairs, most)).drop("__most", "__gain")
    order = Window.partitionBy("text").orderBy(F.col("veto"), F.desc("score"), F.desc("support"), "ordinal")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if most is None else ranked.filter(F.col("rank") <= most)


def resolve(texts: DataFrame, names: DataFrame, min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """A row for each text: text_id, name, status, score, margin, reason. Without a dictionary all texts stay unverified."""
    top = ranks(texts, names, 2)
    best = top.groupBy("text").agg(*[F.max(F.when(F.col("rank") == k, F.struct("name", "score", "veto", "support", "sibling_group"))).alias(f"r{k}") for k in (1, 2)])
    j = texts.join(best, "text", "left")
    one, two = F.col("r1"), F.col("r2")
    viable = one.isNotNull() & ~one["veto"]
    second = F.when(two.isNotNull() & ~two["veto"], two["score"]).otherwise(0.0)
    margin = F.when(viable, one["score"] - second).otherwise(0.0)
    reason = (
        F.when(one.isNull(), "empty_dictionary")
        .when(~viable, "numeric_variant_not_evidenced")
        .when(one["sibling_group"] & (one["support"] <= 0), "ambiguous_numeric_sibling")
        .when((one["score"] >= min_score) & (margin >= min_margin), "score_and_margin")
        .otherwise("insufficient_score_or_margin")
    )
    good = reason == "score_and_margin"
    return j.select("text_id", F.when(good, one["name"]).otherwise(F.trim(text.blank_null(F.col("text")))).alias("name"), F.when(good, "dictionary_resolved").otherwise("ocr_unverified").alias("status"), F.coalesce(one["score"], F.lit(0.0)).alias("score"), margin.alias("margin"), reason.alias("reason"))


def majority(reads: DataFrame, key: str, read: str, ordinal: str) -> DataFrame:
    """(key, value, reads): the number that several readings of a price agree on, and how many readings could be one.

    Only digits count, two to four of them; without any such reading value is null. Where a reading of three digits begins one of four,
    the last digit is a sign read as one: the first such reading wins. Else the most frequent one does; of equals the one whose length
    is nearest to three, then the shorter, then the first.
    """
    digits = F.regexp_replace(F.coalesce(F.col(read).cast("string"), F.lit("")), r"[^\p{Nd}]", "")
    able = F.when(F.length(digits).between(2, 4), digits)
    # Counted first: no more rows for a key than there are numbers of two to four digits.
    counts = reads.groupBy(key, able.alias("__v")).agg(F.count("*").alias("__n"), F.min(ordinal).alias("__first"))
    v, size = F.col("__v"), F.length("__v")
    order = F.struct(-F.col("__n"), F.abs(size - 3), size, F.col("__first"), v)
    per = counts.groupBy(key).agg(
        F.min_by(F.when(v.isNotNull(), v), F.when(v.isNotNull(), order)).alias("common"),
        F.collect_set(F.when(size == 4, F.substring(v, 1, 3))).alias("begun"),
        F.collect_list(F.when(size == 3, F.struct(F.col("__first").alias("first"), v.alias("v")))).alias("three"),
        F.sum(F.when(v.isNotNull(), F.col("__n")).otherwise(0)).alias("reads"),
    )
    begins = F.array_min(F.filter("three", lambda t: F.array_contains("begun", t["v"])))
    return per.select(key, F.coalesce(begins["v"], F.col("common")).cast("int").alias("value"), "reads")


def like_names(names: DataFrame, least: float = LIKE) -> DataFrame:
    """(name, like): pairs of different names whose Indel ratio, of their Japanese letters, is least or more.

    Names are compared in tiles; a pair that shares too few letters is not scored. A name that has no such letters is like none.
    """
    shown = names.select("name").distinct().withColumn("letters", text.japanese_only(F.col("name"))).filter("letters <> ''").withColumn("__bag", bag(F.col("letters")))
    others = shown.select(F.col("name").alias("like"), F.col("letters").alias("other"), F.col("__bag").alias("__other"))
    pairs = all_pairs(shown, ["name"], others, ["like"]).filter("name <> like")
    a, b = F.length("letters"), F.length("other")
    # A common subsequence is no longer than the shorter name, and than what they share as bags.
    could = pairs.filter(200 * F.least(a, b) >= least * (a + b)).filter(200 * F.size(F.array_intersect("__bag", "__other")) >= least * (a + b))
    return could.filter(fuzzy.ratio_udf("letters", "other") >= least).select("name", "like")


def sibling_margin(scores: DataFrame, least: float = LIKE) -> DataFrame:
    """(name, margin): each name's own score (name, score) less the best score among the names like it; 100 where none is."""
    best = like_names(scores, least).join(scores.select(F.col("name").alias("like"), "score"), "like").groupBy("name").agg(F.max("score").alias("best"))
    return scores.join(best, "name", "left").select("name", F.coalesce(F.col("score") - F.col("best"), F.lit(100.0)).alias("margin"))


def evidence_tier(score: Column, name: Column, spec: Column, distinctive: Column, margin: Column) -> Column:
    """How sure a column of evidence is: strong, rescued by a distinctive specification, medium, or none; margins under 5 never count."""
    return F.when(margin < 5, "none").when(score >= 72, "strong").when((name >= 45) & distinctive & (spec >= 70) & (score >= 58), "rescued").when(score >= 60, "medium").otherwise("none")


def record_scores(texts: DataFrame, records: DataFrame) -> DataFrame:
    """Every text (text_id, text) against every record (name, specification) of a dictionary: score, name_score, spec_score.

    Each different text is scored once. A dictionary of up to BROADCAST records is broadcast; a larger one meets the texts in tiles.

    A specification that no other record has, of three letters and more, may lift a name that has some
    support of its own; it never makes a match by itself.
    """
    keyed = records.withColumn("spec_key", text.japanese_only(F.col("specification")))
    counts = keyed.groupBy("spec_key").agg(F.count(F.lit(1)).alias("times"))
    shown = keyed.join(counts, "spec_key").withColumn("distinctive", (F.length("spec_key") >= 3) & (F.col("times") == 1)).drop("times", "spec_key")
    distinct = texts.select("text").distinct()
    met = distinct.crossJoin(F.broadcast(shown)) if shown.count() <= BROADCAST else all_pairs(distinct, ["text"], shown, ["name", "specification"])
    scored = met.withColumns({"name_score": fuzzy.dictionary_score_udf("name", "text"), "spec_score": fuzzy.dictionary_score_udf("specification", "text")})
    pairs = texts.withColumnRenamed("text", "__text").join(scored, F.col("__text").eqNullSafe(F.col("text"))).drop("__text")
    fused = 0.58 * F.col("name_score") + 0.42 * F.col("spec_score")
    lifted = F.when(F.col("distinctive") & (F.col("name_score") >= 25) & (F.col("spec_score") > 0), F.greatest("name_score", fused)).otherwise(F.col("name_score"))
    return pairs.withColumn("score", F.least(F.lit(100.0), lifted))
