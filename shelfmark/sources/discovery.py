"""Discovery of the current issue: pages in, source groups out; pages over HTTP as a Spark data source."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from shelfmark.functions import dates, urls
from shelfmark.operators.stored import Table
from shelfmark.sources import files, images

TRIES, MOST_BYTES = 3, 60 << 20


class PageSource(DataSource):
    """spark.read.format("pages").option("urls", "u1\\nu2"): url, status, html, error; a partition for each address.

    A line may hold a referer after a tab.
    """

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "url string, status int, html string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


@dataclass
class Fetched:
    """What came of an address: its status and headers, whole content or an error."""

    status: int | None = None
    body: bytes | None = None
    content_type: str | None = None
    final_url: str | None = None
    etag: str | None = None
    last_modified: str | None = None
    error: str = ""


def fetched(url: str, timeout: float, most: int = MOST_BYTES, referer: str = "") -> Fetched:
    """Three tries with growing pauses, and a limit of size. An answer that says the address is wrong is not asked for again."""
    out = Fetched()
    for k in range(TRIES):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"Referer": referer} if referer else {}), timeout=timeout) as r:
                out = Fetched(r.status, None, r.headers.get("Content-Type"), r.geturl(), r.headers.get("ETag"), r.headers.get("Last-Modified"))
                body = r.read(most + 1)
                if len(body) > most:
                    raise ValueError("too large")
                out.body = body
                return out
        except urllib.error.HTTPError as e:
            out = Fetched(e.code, None, e.headers.get("Content-Type"), e.geturl(), error=repr(e))
            if e.code < 500:
                return out
        except (OSError, ValueError) as e:
            out.body, out.error = None, repr(e)
        if k + 1 < TRIES:
            time.sleep(min(2**k, 4))
    return out


class PageReader(DataSourceReader):
    """What fails in the end is a row with its error, not a failed job."""

    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.timeout = float(options.get("timeout", "30"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, _, referer = partition.value.partition("\t")
        got = fetched(url, self.timeout, referer=referer)
        yield url, got.status, None if got.body is None else got.body.decode("utf8", "replace"), got.error or None


IMAGE = "source_url string, referer string, acquisition_method string, fetched_at_utc string, final_url string, http_status int, content_type_header string, etag string, last_modified string, content binary, error string"


class ImageSource(DataSource):
    """spark.read.format("images").option("urls", ...): each image's content with what provenance keeps of its fetch.

    What can be no flyer's page, by its content type, kind, bytes or sides, has an error and no content.
    """

    @classmethod
    def name(cls) -> str:
        return "images"

    def schema(self) -> str:
        return IMAGE

    def reader(self, schema) -> DataSourceReader:
        return ImageReader(self.options)


def image_row(url: str, referer: str, timeout: float) -> tuple:
    got = fetched(url, timeout, referer=referer)
    if got.body is not None and (fault := images.fault_of(got.body, got.content_type)):
        got.body, got.error = None, fault
    return url, referer, "http_fetch_v1", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), got.final_url, got.status, got.content_type, got.etag, got.last_modified, got.body, got.error or None


class ImageReader(PageReader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, _, referer = partition.value.partition("\t")
        yield image_row(url, referer, self.timeout)


def provenance(fetched_images: DataFrame) -> DataFrame:
    """Entries of provenance for fetched images: name in the cache, hash, size and kind of the content."""
    c = F.col("content")
    shown = fetched_images.filter("content IS NOT NULL").withColumn("size", images.image_size(c))
    return shown.select(
        "source_url", "referer", urls.cache_name(F.col("source_url")).alias("cache_filename"), "acquisition_method", "fetched_at_utc", "final_url", "http_status",
        urls.content_type(F.col("content_type_header")).alias("content_type_header"), "etag", "last_modified", F.sha2(c, 256).alias("sha256"), F.octet_length(c).cast("long").alias("bytes"), urls.mime_of(c).alias("mime_magic"), "size.width", "size.height",
    )


def group_images(found: DataFrame, folder: str | None = None, timeout: float = 60.0, tasks: int = 64) -> DataFrame:
    """Source groups (id, page_url, images, fingerprint, ...) with local_images and a fingerprint strengthened by the images' contents.

    Each image is fetched once, on the executors, with its page as the referer. local_images has source_index, cache_filename (by content)
    and content_sha256 in the order of images; error says what could not be fetched or is too small, and the fingerprint is null then. folder: where the
    contents go, shared by all executors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [fetched(u, timeout, referer=r) for u, r in zip(b["url"], b["page_url"], strict=True)]
            small = [g.body is not None and len(g.body) < images.LEAST_BYTES for g in got]
            yield pd.DataFrame({"id": b["id"], "source_index": b["source_index"], "content": [g.body for g in got], "error": ["implausibly small image" if s else g.error or None for s, g in zip(small, got, strict=True)]})

    each = found.select("id", "page_url", F.posexplode("images").alias("source_index", "url")).repartition(tasks, "id", "source_index")
    kinds = dict(found.dtypes)
    # Fetched once: files and hashes are both of what is stored, whatever a second fetch would bring.
    got = Table(each.mapInPandas(run, f"id {kinds['id']}, source_index int, content binary, error string"), "fetched").read()
    sha = F.sha2("content", 256)
    name = F.concat(F.substring(sha, 1, 20), F.lit(".jpg"))
    if folder:
        files.write_files(got.filter("error IS NULL").select(name.alias("name"), "content"), folder)
    local = got.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("source_index", name.alias("cache_filename"), sha.alias("content_sha256")))).alias("local_images"),
        F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"),
    )
    joined = found.join(local, "id", "left").withColumn("error", F.nullif("error", F.lit("")))
    strong = strengthened(F.col("fingerprint"), F.transform(F.coalesce("local_images", F.array().cast("array<struct<source_index:int,cache_filename:string,content_sha256:string>>")), lambda x: x["content_sha256"]))
    return joined.withColumn("fingerprint", F.when(F.col("error").isNull(), strong))


def groups(pages: DataFrame, year: int) -> DataFrame:
    """pages (id, store_id, chain, store_name, choice, page_url, html) as source groups, one for each id.

    choice orders a source's own page and its fallbacks: the first that has a period and an original
    image is taken; a source without one is not ok. A source that names weekly updates takes seven days
    from an update stamp where the page has no period.
    """
    period = dates.page_range(F.col("html"), year)
    week = dates.update_week(dates.squeezed(F.col("html")), year)
    shown = pages.withColumns({"p": period, "w": week, "urls": urls.image_urls(F.col("page_url"), F.col("html"))})
    use_week = (F.col("p.start") == "") & F.col("weekly")
    numbered = F.filter("urls", lambda u: F.lower(u).contains("chirashi-guide.com/chirashi-file/") & u.rlike(r"(?i)_\d+\.(?:jpg|jpeg|png)(?:\?|$)") & ~F.lower(u).contains("thum"))
    originals = F.when(F.col("weekly"), F.slice(F.array_distinct(F.concat(urls.original_urls(F.col("urls"), None), numbered)), 1, 2)).otherwise(urls.original_urls(F.col("urls")))
    found = shown.select(
        "id", "store_id", "chain", "store_name", "choice", "page_url",
        F.when(use_week, F.coalesce("w.start", F.lit(""))).otherwise(F.col("p.start")).alias("sale_start"),
        F.when(use_week, F.coalesce("w.end", F.lit(""))).otherwise(F.col("p.end")).alias("sale_end"), originals.alias("images"),
    ).withColumn("ok", (F.col("sale_start") != "") & (F.col("sale_end") != "") & (F.size("images") > 0))
    found = found.withColumn("fingerprint", urls.fingerprint(F.col("page_url"), F.col("sale_start"), F.col("sale_end"), F.array_join("images", "|")))
    best = found.groupBy("id").agg(F.min_by(F.struct(*[c for c in found.columns if c != "id"]), F.struct(~F.col("ok"), F.col("choice"))).alias("g"))
    return best.select("id", "g.*")


def strengthened(fingerprint, content_hashes):
    """A group's fingerprint with those of its images' contents."""
    return F.sha2(F.concat_ws("|", fingerprint, F.array_join(content_hashes, "|")), 256)


def manifest(groups_: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: the groups in order of id, and the days with a button: those found in the flyers, else all days of the periods."""
    keep = ["id", "store_id", "chain", "store_name", "page_url", "sale_start", "sale_end", "images", "fingerprint"]
    g = groups_.agg(F.array_sort(F.collect_list(F.struct(*keep))).alias("groups"))
    whole = groups_.select(F.explode(dates.days(F.col("sale_start"), F.col("sale_end"))).alias("day")).agg(F.array_sort(F.collect_set("day")).alias("all_days"))
    found = daily.agg(F.array_sort(F.collect_set("day")).alias("days"))
    return g.crossJoin(whole).crossJoin(found).select("groups", F.when(F.size("days") > 0, F.col("days")).otherwise(F.col("all_days")).alias("date_buttons"))  # one row each
