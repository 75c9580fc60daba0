"""Folders that all executors share, for tables that are written and read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where there is none a temporary folder does for one machine; on a cluster it is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is not taken, below a folder of this application, which goes when the application ends."""
    context = spark.sparkContext
    home = f"{shared_folder(spark)}/runscope-{context.applicationId}"
    where = context._jvm.org.apache.hadoop.fs.Path(home)
    store = where.getFileSystem(context._jsc.hadoopConfiguration())
    if store.mkdirs(where):
        store.deleteOnExit(where)
    return f"{home}/{name}-{uuid.uuid4().hex}"


#: Has Spark delete a query's shuffle files when the query has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go when each write has ended. Else they stay until the driver collects its garbage, those of many writes at once."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows written as Parquet in the shared folder and read back, for tables that are read several times."""
    path = new_folder(rows.sparkSession, name)
    with released(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
