"""What jobs share: intermediate tables, and this package's code on the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.sources.folders import new_folder


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def landed(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back: it cuts the lineage and outlives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a landed table that nothing reads any more; tables that a result reads stay, as results are lazy."""
    if path := _paths.pop(df, None):
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def beside_text(docs: DataFrame, text: str) -> tuple[Column, str]:
    """All columns but the text as one, and its type: a text goes to Python and back once only."""
    rest = docs.drop(text)
    return (F.struct(*[F.col(f"`{c}`") for c in rest.columns]), rest.schema.simpleString()) if rest.columns else (F.lit(0), "int")


def together(docs: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """The columns of docs from (row: all but the text, text: as binary)."""
    return rows.select(*[F.decode("text", "UTF-8").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}"
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(app)
