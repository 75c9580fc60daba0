"""Machine telemetry: CSV files whose headers differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.sources import schemas
from runscope.sources.folders import new_folder
from runscope.sources.order import file_order


def read_machines(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a folder's *.csv as strings, columns by name; missing ones are null.

    Lines are split into cells where they are read, whatever their file, and each cell is looked up by its file's header, which meets
    the lines by the file's path: a table of one row for each file. The driver learns one number, the most cells of a header. A file's
    header is its first line that is not blank; blank lines are none; of columns with one name the last counts; cells that a header
    doesn't name are ignored.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select("value", F.col("_metadata.file_path").alias("path"), file_order().alias("ordinal"))
    lines = lines.withColumn("value", F.regexp_replace("value", "^\ufeff|\r$", "")).filter(F.trim("value") != "")
    first = F.struct("ordinal.block", "ordinal.row")
    # a header is looked for once: its few rows are kept, those of the other lines are read once more
    heads = lines.groupBy("path").agg(F.min(F.struct(first.alias("at"), "value")).alias("head")).select(F.col("path").alias("_path"), "head.*")
    kept = new_folder(spark, "machine-headers")
    heads.write.parquet(kept)
    heads = spark.read.parquet(kept)
    most = heads.agg(F.max(F.length("value") - F.length(F.replace("value", F.lit(","), F.lit(""))))).first()[0]
    if most is None:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in schemas.MACHINE_ROWS))
    names = [f"c{i}" for i in range(most + 1)]
    # cells are a variable, so that the plan names them: a line is split once, not once for each cell
    cells = lambda c: F.transform(F.array(F.from_csv(F.col(c), ", ".join(f"{n} string" for n in names))), lambda row: F.array(*[row[n] for n in names]))[0]
    known = heads.withColumn("header", F.reverse(cells("value")))
    at = {n: F.when(F.array_position("header", F.lit(n)) > 0, len(names) + 1 - F.array_position("header", F.lit(n))) for n in schemas.MACHINE_ROWS}
    known = known.select("_path", "at", *[c.cast("int").alias(f"_{n}") for n, c in at.items()])
    rows = lines.join(known, F.col("path") == F.col("_path")).filter(F.struct("ordinal.block", "ordinal.row") != F.col("at"))
    named = lambda row: F.struct(*[F.get(row, F.col(f"_{n}") - 1).alias(n) for n in schemas.MACHINE_ROWS])
    return rows.select(F.inline(F.transform(F.array(cells("value")), named)))
