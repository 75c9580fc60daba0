"""Normalization of run documents as they arrive, and running costs of bill rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from runscope.operators import costs, normalize
from runscope.sources import schemas

NORMALIZERS = {"runs": normalize.normalize_runs, "tasks": normalize.normalize_tasks, "metrics": normalize.normalize_metrics}


def stream_runs(spark: SparkSession, folder: str, most_files: int = 1000) -> DataFrame:
    """Documents of a folder as a stream."""
    reader = spark.readStream.schema(schemas.RUN).option("multiLine", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", most_files)
    return reader.json(folder)


def normalized(documents: DataFrame, table: str) -> DataFrame:
    """runs, tasks or metrics of the documents: no state, so it holds for streams as for tables."""
    return NORMALIZERS[table](documents)


def running_costs(bill: DataFrame, label_map: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """Costs by key of all bill rows so far; write it in update mode."""
    return costs.normalize_costs(bill, label_map)
