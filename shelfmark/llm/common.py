"""What the training-data operators share: words, shared storage, Arrow batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of whole documents in one Arrow batch: bounds a Python worker's memory.
ROWS_PER_BATCH = 1000
#: Bytes of a batch that become Python objects at once: very long texts are taken a few at a time.
BYTES_PER_LIST = 16 << 20


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Lowers the session's Arrow batch length, so that batches of whole texts stay small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Without one there is no safe place for a table, so that is an error."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found:
        # Driver and executors are one process here, so any folder is shared.
        found = tempfile.mkdtemp(prefix="shelfmark-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        sc.setCheckpointDir(found)
    return found


class Stored:
    """A table written to the shared folder; reading it needs nothing that came before. It goes when the driver ends."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.schema = df.sparkSession, df.schema
        self.path = f"{shared_dir(self.spark)}/shelfmark/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self._place()[0].deleteOnExit(self._place()[1])

    def _place(self) -> tuple:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        fs, path = self._place()
        fs.delete(path, True)


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", empty: bool = True) -> DataFrame:
    """(doc_id, text, text_key), the text as UTF-8 bytes; a null text counts as empty, or stays null.

    All other columns are left behind here, so none of their names can clash.
    """
    body = F.col(f"`{text}`").cast("binary")
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.coalesce(body, F.lit(b"")) if empty else body).alias("text"), text_key(text).alias("text_key"))


def text_key(text: str = "text") -> Column:
    """64 bits that tell the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")))


def one_row_each(docs: DataFrame, stays: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each (doc_id, text_key) of stays one row of docs, all columns. Rows with the same id and text are told apart by nothing else: the first that comes stays."""
    own = {"__id": F.coalesce(F.col(f"`{doc_id}`"), F.lit(0)).cast("long"), "__none": F.col(f"`{doc_id}`").isNull(), "__key": text_key(text)}
    kept = stays.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("__id"), F.col("doc_id").isNull().alias("__none"), F.col("text_key").alias("__key"))
    number = F.row_number().over(Window.partitionBy(*own).orderBy("__key"))
    found = docs.withColumns(own).join(kept, list(own), "left_semi").withColumn("__number", number).filter("__number = 1")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def slices(b: pa.RecordBatch, most: int = BYTES_PER_LIST) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most so many bytes, or of one row."""
    if b.num_rows > 1 and b.nbytes > most:
        half = b.num_rows // 2
        yield from slices(b.slice(0, half), most)
        yield from slices(b.slice(half), most)
    elif b.num_rows:
        yield b


def rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each batch as Python lists; a batch of very long texts comes in pieces."""
    for b in batches:
        for part in slices(b):
            yield tuple(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def words(text: bytes) -> list[bytes]:
    """The runs of [^\\x20\\x09-\\x0D]: what bytes.split() splits into, no more and no less."""
    return text.split()
