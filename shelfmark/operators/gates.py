"""Gates: what is wrong with a whole relation, as rows and as counts. Row counts themselves are never a fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import dates, text
from shelfmark.operators.dedupe import policy_key, ranked


def row_faults(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with a flag for each kind of fault, and inc, the price as a whole number in a double.

    The price is truncated, not rounded down. One that is blank, no number, not a number or infinite is 0, which is a bad price;
    one too large for a long is a price like any other.
    """
    given = F.coalesce(F.when(F.trim(text.blank_null(F.col("price_in_tax_yen"))) == "", F.lit(0.0)).otherwise(F.col("price_in_tax_yen").cast("string").try_cast("double")), F.lit(0.0))
    finite = F.when(F.isnan(given) | (F.abs(given) == float("inf")), F.lit(0.0)).otherwise(given)
    whole = F.when(F.abs(finite) < 2.0**53, F.when(finite < 0, F.ceil(finite)).otherwise(F.floor(finite)).cast("double")).otherwise(finite)
    shown = rows.withColumn("inc", whole)
    key = [*policy_key(normal=False)[:-1], F.col("inc")]
    shown = ranked(shown, key, order)
    c = F.col
    return shown.withColumns(
        {
            "bad_price": c("inc") <= 0,
            "blank_name": F.trim(text.blank_null(c("product_name"))) == "",
            "duplicate": c("rn") > 1,
            "bad_dates": ~dates.well_ordered(c("sale_start"), c("sale_end")),
            "percent_only": text.is_percent_only(c("price_in_tax_yen"), c("product_name"), c("specification"), c("promotion")),
            "missing_provenance": ~text.has_all(c("source_url"), c("source_image"), c("source_fingerprint")),
            "household": text.is_household_name(c("product_name")),
        }
    ).drop("rn")


FAULTS = ("bad_price", "blank_name", "duplicate", "bad_dates", "percent_only", "missing_provenance")
#: What a fault is called in a verdict, where that is another word.
CALLED = {"duplicate": "duplicates"}


def row_report(rows: DataFrame, order: list[Column], day: str) -> DataFrame:
    """A row for each store: rows, rows active on the day, and how many have each fault."""
    counts = [F.count_if(F.col(f)).alias(f) for f in (*FAULTS, "household")]
    return row_faults(rows, order).groupBy("store_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(dates.active_on(day, F.col("sale_start"), F.col("sale_end"))).alias("active"), *counts)


def fault_samples(rows: DataFrame, order: list[Column], most: int = 10) -> DataFrame:
    """The first rows of each kind of fault, with its name; the limit is taken before the shuffle too."""
    kinds = F.explode(F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in FAULTS])))
    return ranked(row_faults(rows, order).withColumn("fault", kinds), [F.col("fault")], order).filter(F.col("rn") <= most).drop("rn")


def row_verdict(report: DataFrame) -> DataFrame:
    """One row: whether no store has a fault, and the faults as text in their order."""
    total = report.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in FAULTS])
    errors = F.array_compact(F.array(*[F.when(F.col(f) > 0, F.concat(F.lit(CALLED.get(f, f) + "="), F.col(f).cast("string"))) for f in FAULTS]))
    return total.select((F.size(errors) == 0).alias("passes"), errors.alias("errors"))


def issue_faults(rows: DataFrame, groups: DataFrame, report: DataFrame) -> DataFrame:
    """A row for each store that the manifest or the rows name: what is wrong with its issue.

    groups: store_id, images (how many), fingerprint. report: store_id, images, price_anchors,
    candidate_rows. A reported count of 0 candidates is taken for the rows there are.
    """
    # Rows are read once and counted before anything is joined: a row for each store and fingerprint.
    blank_url = F.trim(text.blank_null(F.col("source_url"))) == ""
    prints = rows.groupBy("store_id", text.blank_null(F.col("source_fingerprint")).alias("__print")).agg(F.count(F.lit(1)).alias("n"), F.count_if(blank_url).alias("sourceless"))
    named = prints.join(groups.select("store_id", text.blank_null(F.col("fingerprint")).alias("__now")), "store_id", "left")
    counted = named.groupBy("store_id").agg(F.sum("n").alias("n"), F.sum("sourceless").alias("sourceless"), F.sum(F.when(F.col("__print") != F.col("__now"), F.col("n")).otherwise(0)).alias("stale"))
    rep = report.select("store_id", F.col("images").alias("done"), "price_anchors", "candidate_rows")
    g = groups.select("store_id", F.col("images").alias("expected")).join(rep, "store_id", "left").join(counted, "store_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    anchors, done = zero("price_anchors"), zero("done")
    candidates = F.coalesce(F.nullif(zero("candidate_rows"), F.lit(0)), zero("n"))
    faults = [
        ("image_processing_incomplete", (zero("expected") > 0) & (done != zero("expected"))),
        ("no_price_evidence", (zero("expected") > 0) & (anchors <= 0)),
        ("price_evidence_without_products", (anchors > 0) & (candidates <= 0)),
        ("extraction_report_inconsistent", (anchors > 0) & (candidates > anchors)),
        ("stale_fingerprint", zero("stale") > 0),
        ("missing_source", zero("sourceless") > 0),
    ]
    known = g.select("store_id", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in faults])).alias("errors"), F.greatest(anchors - candidates, F.lit(0)).cast("long").alias("unresolved"))
    strangers = counted.join(groups, "store_id", "left_anti").select("store_id", F.array(F.lit("unexpected_store")).alias("errors"), F.lit(0).cast("long").alias("unresolved"))
    return known.unionByName(strangers)


def provenance_faults(required: DataFrame, entries: DataFrame, files: DataFrame, version_ok: bool = True, trusted: str = "http_fetch_v1") -> DataFrame:
    """required (group_id, source_url, referer) with the reasons why each image's origin isn't proven.

    entries: one row an image with group_id, cache_filename, referer, acquisition_method, fetched_at_utc,
    http_status, content_type_header, final_url, sha256, bytes, width, height, mime_magic. files: cache_filename
    and what was found in it. The last entry of an address counts (by ordinal), and that there are several is a reason.
    """
    from shelfmark.functions.urls import cache_name

    e = entries.groupBy("source_url").agg(F.max_by(F.struct(*[c for c in entries.columns if c not in ("source_url", "ordinal")]), "ordinal").alias("e"), F.count(F.lit(1)).alias("times"))
    f = files.select(F.col("cache_filename").alias("name"), F.struct("sha256", "bytes", "width", "height", "mime_magic").alias("f"))
    j = required.withColumn("name", cache_name(F.col("source_url"))).join(e, "source_url", "left").join(f, "name", "left")
    c = F.col
    there, on_disk = c("times").isNotNull(), c("f").isNotNull()
    differs = lambda a, b: ~a.eqNullSafe(b)
    kind = F.lower(text.blank_null(c("e.content_type_header")))
    reasons = [
        ("missing_provenance_entry", ~there),
        ("missing_cache_file", ~on_disk),
        ("provenance_version_mismatch", F.lit(not version_ok)),
        ("duplicate_provenance_entry", c("times") > 1),
        ("group_id_mismatch", there & differs(c("e.group_id"), c("group_id"))),
        ("cache_filename_mismatch", there & differs(c("e.cache_filename"), c("name"))),
        ("referer_mismatch", there & (text.blank_null(c("e.referer")) != text.blank_null(c("referer")))),
        ("untrusted_acquisition_method", there & differs(c("e.acquisition_method"), F.lit(trusted))),
        ("missing_fetched_at_utc", there & (text.blank_null(c("e.fetched_at_utc")) == "")),
        ("invalid_fetched_at_utc", there & (text.blank_null(c("e.fetched_at_utc")) != "") & F.try_to_timestamp(c("e.fetched_at_utc")).isNull()),
        ("http_status_not_200", there & differs(c("e.http_status").cast("long"), F.lit(200).cast("long"))),
        ("non_image_content_type_header", there & (kind != "") & ~kind.startswith("image/")),
        ("missing_final_url", there & (text.blank_null(c("e.final_url")) == "")),
        *[(f"{k}_mismatch", there & on_disk & differs(c(f"e.{k}"), c(f"f.{k}"))) for k in ("sha256", "bytes", "width", "height", "mime_magic")],
        ("unsupported_or_unknown_image_magic", there & on_disk & ~F.coalesce(c("f.mime_magic").isin("image/jpeg", "image/png", "image/webp"), F.lit(False))),
        ("image_too_small_bytes", there & on_disk & (F.coalesce(c("f.bytes"), F.lit(0)) < 10_000)),
        ("image_too_small_dimensions", there & on_disk & ((F.coalesce(c("f.width"), F.lit(0)) < 300) | (F.coalesce(c("f.height"), F.lit(0)) < 300))),
    ]
    found = F.array_compact(F.array(*[F.when(w, F.lit(n)) for n, w in reasons]))
    return j.select("group_id", "source_url", F.col("name").alias("cache_filename"), found.alias("reasons")).withColumn("passes", F.size("reasons") == 0)


def map_difference(expected: DataFrame, current: DataFrame, key: str, value: str, by: list[str] | None = None) -> DataFrame:
    """(by, key, status): missing, unexpected or changed. Nulls are values."""
    keys = [*(by or []), key]
    a = expected.select(*keys, F.col(value).alias("__a"), F.lit(True).alias("__in_a"))
    b = current.select(*keys, F.col(value).alias("__b"), F.lit(True).alias("__in_b"))
    status = F.when(F.col("__in_b").isNull(), "missing").when(F.col("__in_a").isNull(), "unexpected").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status")).filter("status IS NOT NULL")


def same_maps(expected: DataFrame, current: DataFrame, key: str, value: str, by: list[str] | None = None) -> DataFrame:
    """One row, or one for each group that either has: whether both maps are equal, not empty, and the current one has no blank value."""
    by = by or []
    diff = map_difference(expected, current, key, value, by).groupBy(*by).agg(F.count(F.lit(1)).alias("d"))
    sizes = current.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(text.blank_null(F.col(value)) == "").alias("blank"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    both = sizes.join(diff, by, "full_outer") if by else sizes.crossJoin(diff)  # one row each
    return both.select(*by, ((zero("n") > 0) & (zero("blank") == 0) & (zero("d") == 0)).alias("unchanged"))


def cache_inventory(required: DataFrame, files: DataFrame, verdicts: DataFrame) -> DataFrame:
    """required (group_id, source_url, ...) with cache_filename, present and provenance_valid; what the verdicts don't name is not valid.

    files: cache_filename of each file that is there. verdicts: group_id, source_url, passes, as provenance_faults() gives them.
    """
    from shelfmark.functions.urls import cache_name

    held = files.select("cache_filename", F.lit(True).alias("present")).distinct()
    valid = verdicts.groupBy("group_id", "source_url").agg(F.bool_and("passes").alias("provenance_valid"))
    shown = required.withColumn("cache_filename", cache_name(F.col("source_url"))).join(held, "cache_filename", "left").join(valid, ["group_id", "source_url"], "left")
    return shown.withColumns({k: F.coalesce(k, F.lit(False)) for k in ("present", "provenance_valid")})


def inventory_report(items: DataFrame) -> DataFrame:
    """One row: how many images are required, there, missing and valid; whether all are there, and all there and valid."""
    n = lambda c: F.count_if(c)
    present, valid = F.col("present"), F.col("provenance_valid")
    counts = items.agg(F.count(F.lit(1)).alias("required_count"), n(present).alias("present_count"), n(~present).alias("missing_count"), n(valid).alias("provenance_valid_count"), n(present & valid).alias("__ready"))
    c = F.col
    return counts.select("required_count", "present_count", "missing_count", "provenance_valid_count", (c("missing_count") == 0).alias("complete"), (c("__ready") == c("required_count")).alias("release_source_ready"))


def regression(groups: DataFrame, least_recall: float | Column, most_density: float, least_coverage: float) -> DataFrame:
    """groups (recall, density, coverage) with passes: enough of what is expected is found, not too much besides, and enough of it is named."""
    c = F.col
    return groups.withColumn("passes", (c("recall") >= least_recall) & (c("density") <= most_density) & (c("coverage") >= least_coverage))


def lint_sources(groups: DataFrame) -> DataFrame:
    """(id, fault) of a manifest's groups: id, images (urls), anchors (how many), minimum_recall, mode."""
    seen = groups.groupBy("id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("id", F.lit("duplicate_id").alias("fault"))
    rules = {
        "no_images": F.size("images") <= 0,
        "no_anchor_prices": F.col("anchors") <= 0,
        "bad_minimum_recall": ~F.coalesce((F.col("minimum_recall") > 0) & (F.col("minimum_recall") <= 1), F.lit(False)),
        "unknown_mode": F.col("mode").isNotNull() & ~F.col("mode").isin("red_only", "hybrid_ocr"),
        "not_https": F.exists("images", lambda u: ~u.startswith("https://")),
    }
    found = groups.select("id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("fault"))
    return seen.unionByName(found)


def artifact_faults(canonical: DataFrame, published: DataFrame, payloads: list[DataFrame], bytes_equal: bool | Column, by: list[str] | None = None) -> DataFrame:
    """One row, or one for each group that any has: what differs between the canonical table, its published copy and the products of the payloads.

    Compared as bags, by name. bytes_equal: whether the payloads' texts are the same, of the group.
    """
    from shelfmark.operators.sets import same_content

    by, cols, out = by or [], canonical.columns, None
    for k, other in enumerate([published, *payloads]):
        d = same_content(canonical, other.select(*cols), by).select(*by, ((F.col("only_first") + F.col("only_second")) > 0).alias(f"d{k}"), (F.col("only_first") != F.col("only_second")).alias(f"c{k}"))
        out = d if out is None else out.join(d, by, "full_outer") if by else out.crossJoin(d)  # one row each
    some = lambda p: F.greatest(*[F.coalesce(f"{p}{k}", F.lit(False)) for k in range(1 + len(payloads))], F.lit(False))
    same = bytes_equal if isinstance(bytes_equal, Column) else F.lit(bytes_equal)
    return out.select(*by, F.array_compact(F.array(F.when(some("c"), "artifact_count_mismatch"), F.when(some("d"), "artifact_content_mismatch"), F.when(~same, "payload_bytes_mismatch"))).alias("errors"))
