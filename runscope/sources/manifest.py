"""The list of runs: reading, validation, routing and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.sources import files, schemas
from runscope.sources.order import file_order, ordinal_of

# What each column of a manifest must look like.
PATTERNS = {
    "id": r"^[A-Za-z0-9]{9,14}$",
    "workspace": r"^(?:external|[a-zA-Z0-9][a-zA-Z0-9-_]{0,38}/[a-zA-Z0-9][a-zA-Z0-9-_]{0,38})$",
    "group": r"^[a-zA-Z0-9][-a-zA-Z0-9_ ]{0,37}$",
    "logs": r"^\S+$",
    "machines": r"^\S+$",
    "platform": r"^https?://.*$",
    "token_env": r"^[A-Za-z_][A-Za-z0-9_]*$",
}
REQUIRED = ("id", "workspace")
EXTERNAL = "external"


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors) of a CSV with a header; columns are found by name, missing ones are null.

    ordinal: each row's place in the file.
    """
    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(*[(F.col(f"`{n}`") if n in raw.columns else F.lit(None)).cast("string").alias(n) for n in schemas.MANIFEST.names], file_order().alias("ordinal"))
    checked = validate(rows)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def validate(rows: DataFrame) -> DataFrame:
    """rows with `errors`: names of the columns that are required and missing, or filled and malformed."""
    wrong = []
    for name, pattern in PATTERNS.items():
        if name not in rows.columns:
            bad = F.lit(name in REQUIRED)
        else:
            value = S.filled(F.col(name))
            bad = F.coalesce(~value.rlike(pattern), F.lit(name in REQUIRED))
        wrong.append(F.when(bad, F.lit(name)))
    return rows.withColumn("errors", F.array_compact(F.array(*wrong)))


def route(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(API runs, external runs with logs, external runs without, which go nowhere)."""
    external = F.coalesce(F.col("workspace") == EXTERNAL, F.lit(False))
    has_logs = S.filled(F.col("logs")).isNotNull()
    return rows.filter(~external), rows.filter(external & has_logs), rows.filter(external & ~has_logs)


def idle_api_runs(rows: DataFrame) -> DataFrame:
    """(n_api_runs): how many API runs a manifest names, to warn of when no report is asked for."""
    return route(rows)[0].agg(F.count("*").alias("n_api_runs"))


def resolve_logs(rows: DataFrame, manifest_folder: str) -> DataFrame:
    """rows with `logs_path` (relative paths are below the manifest's folder) and `logs_kind`, archive or directory, as the name has it.

    A plan for paths that are not there yet; `probe_logs` asks the store.
    """
    absolute = F.col("logs").startswith("/") | F.col("logs").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:/")
    path = F.when(absolute, F.col("logs")).otherwise(F.concat(F.lit(manifest_folder.rstrip("/") + "/"), F.col("logs")))
    kind = F.when(F.lower("logs").rlike(r"\.(tar\.gz|tgz)$"), "archive").otherwise("directory")
    return rows.withColumns({"logs_path": path, "logs_kind": kind})


def probe_logs(rows: DataFrame) -> DataFrame:
    """rows of resolve_logs with the `logs_kind` that the store tells: directory, archive (any file) or missing. Tasks ask for the paths of their rows."""
    found = files.with_kind(rows.drop("logs_kind"), F.col("logs_path"), "logs_kind")
    return found.withColumn("logs_kind", F.when(F.col("logs_kind") == "file", "archive").otherwise(F.col("logs_kind")))


def existing(rows: DataFrame) -> DataFrame:
    """rows of probe_logs; one whose path is missing fails the job that reads them."""
    missing = F.raise_error(F.concat(F.lit("no such file or folder: "), F.col("logs_path"))).cast("string")
    return rows.withColumn("logs_kind", F.when(F.col("logs_kind") == "missing", missing).otherwise(F.col("logs_kind")))


def meta(default_platform: str = "") -> Column:
    """The meta of an API run's document, from its manifest row."""
    return F.struct(
        F.col("id").alias("id"), F.col("workspace").alias("workspace"), F.coalesce(S.filled(F.col("group")), F.lit("default")).alias("group"),
        F.coalesce(S.filled(F.col("platform")), F.lit(default_platform)).alias("platform"), F.col("token_env").alias("token_env"),
    )


def attach_meta(documents: DataFrame, rows: DataFrame, default_platform: str = "") -> DataFrame:
    """Run documents of API runs with the meta of their manifest rows; documents that no row names are dropped. Of rows with one id
    the last counts, without an order the greatest."""
    own = rows.select(F.col("id").alias("_id"), meta(default_platform).alias("_meta"), *(["ordinal"] if ordinal_of(rows) else []))
    last = F.max_by("_meta", "ordinal") if ordinal_of(rows) else F.max("_meta")
    named = own.filter("_id is not null").groupBy("_id").agg(last.alias("_meta"))
    return documents.join(named, F.col("workflow.id") == F.col("_id")).withColumn("meta", F.col("_meta")).drop("_id", "_meta")
