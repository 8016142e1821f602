"""Files in and out: CSV with a byte-order mark, JSON documents, images, caches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions import price, urls
from shelfmark.functions.text import blank_null
from shelfmark.sources.images import image_size

#: The columns of a product, in the order of the published file.
PRODUCT_COLUMNS = [
    "store_id", "chain", "store_name", "sale_start", "sale_end", "product_name", "specification", "price_ex_tax_yen", "price_in_tax_yen", "tax_rate",
    "promotion", "category", "availability_rule", "scope_level", "source_type", "validation_status", "source_url", "source_image", "source_fingerprint", "verification_note",
]
NUMBERS = ("price_ex_tax_yen", "price_in_tax_yen", "tax_rate", "inferred_tax_rate")

PRODUCT = StructType()
for _c in PRODUCT_COLUMNS:
    PRODUCT.add(_c, "double" if _c == "tax_rate" else "long" if _c.endswith("_yen") else "string")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header; an empty field is null."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_products(spark: SparkSession, path: str, keep_text: bool = False) -> DataFrame:
    """Numbers where a column holds them; what is no number becomes null. keep_text: such a text stays in a column of its own, `<name>_text`."""
    df = read_csv(spark, path)
    there = [c for c in df.columns if c in NUMBERS]
    numbers = {c: price.to_number(F.col(c)) for c in there}
    texts = {f"{c}_text": F.when(numbers[c].isNull() & (F.trim(blank_null(F.col(c))) != ""), F.col(c)) for c in there} if keep_text else {}
    return df.withColumns({**texts, **numbers})


def read_of_type(spark: SparkSession, path: str, source_type: str) -> DataFrame:
    """Rows of one source type; the filter reaches the scan."""
    return read_csv(spark, path).filter(F.col("source_type") == source_type)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A document for each file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_images(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """cache_filename, sha256, bytes, mime_magic, width, height. Sizes are read from the headers of PNG, JPEG and WebP; they are null in what is none."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    shown = raw.withColumn("size", image_size(F.col("content")))
    return shown.select(F.element_at(F.split("path", "/"), -1).alias("cache_filename"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), urls.mime_of(F.col("content")).alias("mime_magic"), "size.width", "size.height")


def cached_images(spark: SparkSession, required: DataFrame, folder: str, offline: bool = False) -> DataFrame:
    """required (source_url, ...) with cache_filename and content, null where the cache has none; offline, that is an error."""
    held = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("cache_filename"), "content")
    found = required.withColumn("cache_filename", urls.cache_name(F.col("source_url"))).join(held, "cache_filename", "left")
    if not offline:
        return found
    return found.withColumn("content", F.coalesce("content", F.raise_error(F.concat(F.lit("cache missing: "), F.col("cache_filename"))).cast("binary")))


def tree_fingerprint(spark: SparkSession, path: str, leave_out: list[str], pattern: str = "*.py") -> DataFrame:
    """(name, sha256) of a folder's files but for those left out."""
    files = read_images(spark, path, pattern).select(F.col("cache_filename").alias("name"), "sha256")
    return files.filter(~F.col("name").isin(leave_out)) if leave_out else files


def cached(required: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """What a cache has for the required keys (image hash, version, profile: all must agree), and what it hasn't."""
    return required.join(cache, keys), required.join(cache.select(*keys).distinct(), keys, "left_anti")


def save_detections(found: DataFrame, folder: str) -> int:
    """A JSON document for each image in a shared folder, named as the image: detector_version, image_filename, image_sha256, profile, result. How many."""
    body = F.to_json(F.struct("detector_version", "image_filename", "image_sha256", "profile", "result"), {"ignoreNullFields": "false"})
    stem = F.regexp_replace("image_filename", r"\.[^.]*$", "")
    return write_files(found.select(F.concat(stem, F.lit(".json")).alias("name"), body.cast("binary").alias("content")), folder)


def read_detections(spark: SparkSession, folder: str, profile: str, result: str) -> DataFrame:
    """What save_detections() wrote; profile and result are their SQL types."""
    schema = f"detector_version string, image_filename string, image_sha256 string, profile {profile}, result {result}"
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").option("multiLine", True).json(folder)


def write_files(files: DataFrame, folder: str) -> int:
    """(name, content) as files of a folder that all executors share; each is written beside its place and moved there. How many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(root, recursive=True)
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                part = f"{root}/.{name}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(part) as f:
                    f.write(content)
                fs.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return files.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A folder of files with a header and the named columns only; null is an empty field."""
    df.select(*(columns or df.columns)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_csv_file(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One file for readers of spreadsheets: a byte-order mark, a header, the named columns in the rows' order. One task writes it."""
    columns = columns or df.columns
    spark = df.sparkSession
    options = {"escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(columns)]), options)
    names = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"c{k}") for k, c in enumerate(columns)]), options).alias("value"))
    head = names.select(F.lit(-1).cast("long").alias("at"), F.concat(F.lit("\ufeff"), F.col("value")).alias("value"))
    lines = head.unionByName(df.select(F.monotonically_increasing_id().alias("at"), line.alias("value")))
    _one_file(lines.repartition(1).sortWithinPartitions("at").select("value"), path, "\r\n")


def write_json(df: DataFrame, path: str) -> None:
    """A folder of files with a row to a line."""
    df.write.mode("overwrite").json(path)


def write_document(df: DataFrame, path: str) -> None:
    """The one row of df as one JSON document, indented, for people to read. More rows, or none, are an error."""
    got = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).limit(2).collect()
    if len(got) != 1:
        raise ValueError("a document is made of one row")
    text = json.dumps(json.loads(got[0]["value"]), ensure_ascii=False, indent=2)
    _one_file(df.sparkSession.createDataFrame([(text,)], "value string"), path, "\n")


def write_text(lines: DataFrame, *paths: str) -> None:
    """The lines in one file, at each of the places."""
    for p in paths:
        _one_file(lines, p, "\n")


def _one_file(lines: DataFrame, path: str, end: str) -> None:
    """Written to a folder beside the file's place; the only part is then moved there."""
    spark = lines.sparkSession
    parts = f"{path}.{uuid.uuid4().hex}.parts"
    lines.coalesce(1).write.option("lineSep", end).text(parts)
    sc = spark.sparkContext
    folder, place = sc._jvm.org.apache.hadoop.fs.Path(parts), sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    [part] = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    fs.delete(place, True)
    if not fs.rename(part, place):
        raise OSError(f"could not move {part} to {place}")
    fs.delete(folder, True)


def token_rows(words: DataFrame, target_height: int) -> DataFrame:
    """Recognised words (left, top, width, height on a page scaled to target_height) as tokens in the page's own measure."""
    inv = F.col("page_height") / F.lit(float(target_height))
    r = lambda c: F.bround(c).cast("int")
    kept = words.filter((F.col("confidence") >= 0) & (F.trim(blank_null(F.col("text"))) != ""))
    return kept.select(
        "image_id", "ordinal", F.trim("text").alias("text"), "confidence", r(F.col("left") * inv).alias("x1"), r(F.col("top") * inv).alias("y1"),
        r((F.col("left") + F.col("width")) * inv).alias("x2"), r((F.col("top") + F.col("height")) * inv).alias("y2"), F.col("height").alias("scaled_height"), F.lit(target_height).alias("target_height"),
    )


def write_issue(rows: DataFrame, path: str, by: str = "store_id") -> None:
    """Writes the rows of some stores into their folders, in place of what these had; other stores' files are not touched.

    A store of which there are no rows keeps its issue: to take one down is drop_issue()'s work. The setting for this is the writer's own, not the session's.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_issue(spark: SparkSession, path: str, stores: list | None = None, by: str = "store_id") -> DataFrame:
    """The rows of these stores, or all; only their folders are listed and read."""
    rows = spark.read.parquet(path)
    return rows if stores is None else rows.filter(F.col(by).isin(stores))


def drop_issue(spark: SparkSession, path: str, store: str, by: str = "store_id") -> bool:
    """Takes one store's issue down; False if it had none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={store}")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
