"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


class Workspace:
    """Writes intermediate results as Parquet tables and reads them back.

    A written table cuts lineage, survives lost executors, is read back column by column, and
    gives the optimizer true sizes. Tables lie under ``root``, else under the folder named by
    ``spark.checkpoint.dir``. Where that is unset, a local session uses its warehouse folder and a
    cluster session gets an error, as its warehouse may not be shared. ``close`` deletes the tables.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        root = root or spark.conf.get(CHECKPOINT, None)
        if root is None:
            if not (spark.conf.get("spark.master", "") or "").startswith("local"):
                raise ValueError(f"set {CHECKPOINT} to a folder that all executors share")
            root = spark.conf.get(WAREHOUSE)
        self.root = f"{root.rstrip('/')}/recordtrust-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete the tables of this workspace, through the file system they were written to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
