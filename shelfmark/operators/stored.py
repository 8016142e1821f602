"""Tables that iterative plans write between their steps, where driver and executors can both reach them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. In local mode, where all is one process, one is made if none is named; on a cluster that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="shelfmark-core-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    sc.setCheckpointDir(made)
    return made


class Table:
    """A written table. Its readers depend on its files alone, so a lost executor costs no more than its own tasks; it goes with the driver, or by drop()."""

    def __init__(self, df: DataFrame, name: str, by: list[str] | None = None):
        self.spark, self.schema = df.sparkSession, df.schema
        self.path = f"{shared_folder(self.spark)}/shelfmark-core/{name}-{uuid.uuid4().hex}"
        (df.write.partitionBy(*by) if by else df.write).parquet(self.path)
        fs, path = self._file()
        fs.deleteOnExit(path)

    def _file(self) -> tuple:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        fs, path = self._file()
        fs.delete(path, True)
