"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A written table cuts lineage, survives the loss of executors and gives both sides of a later
join a plain exchange, which adaptive execution can split when a key is hot.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir


#: While a table is written: its shuffle files go when it is done, and Arrow batches are bounded by bytes.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextlib.contextmanager
def bounded(spark: SparkSession):
    """Writes inside remove their shuffle files when they end, not when the driver happens to collect
    garbage (nothing reads them again, and a file that is missed is recomputed), and hand some
    megabytes at a time to Python, however long the texts are."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Workspace:
    """One folder per call; tables in it are written once and read many times."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        with bounded(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """Plain scan of a given table (a folder or a file, through Spark's reader only)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
