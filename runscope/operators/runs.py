"""Run sections: status, links, overview, summary and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.sources.order import ordinal_of

# How run states are classed.
FAILED = ("FAILED", "ERROR", "FAILING")
CANCELLED = ("CANCELLED", "CANCELED", "ABORTED", "ABORT", "STOPPED")
SUCCEEDED = ("SUCCEEDED", "SUCCESS", "COMPLETED")
PLACEHOLDER = "example.invalid"


def classify_status(status: Column, include_failed: bool = False) -> Column:
    """struct(label, category, included)."""
    state = F.upper(S.stripped(S.text(status)))

    def of(label: str | Column, category: str, included: bool) -> Column:
        return F.struct((F.lit(label) if isinstance(label, str) else label).alias("label"), F.lit(category).alias("category"), F.lit(included).alias("included"))

    return (
        F.when(state.isin(*FAILED), of("Failed", "failed", include_failed))
        .when(state.isin(*CANCELLED), of("Cancelled", "cancelled", False))
        .when(state.isin(*SUCCEEDED), of("Succeeded", "success", True))
        .when(state == "", of("Unknown", "unknown", True))
        .otherwise(of(S.title_case(state), "other", True))
    )


def run_link(run_id: Column, workspace: Column, platform: Column, existing: Column) -> Column:
    """The given link unless it is a placeholder; else one into the platform's workspace; empty without organisation or platform."""
    given, place = S.stripped(S.text(existing)), S.stripped(S.text(workspace))
    base = F.rtrim(S.stripped(S.text(platform)), F.lit("/"))
    parts = F.split(place, "/", 2)
    made = F.concat(base, F.lit("/orgs/"), parts[0], F.lit("/workspaces/"), F.get(parts, 1), F.lit("/watch/"), run_id)
    usable = (given != "") & ~F.lower(given).contains(PLACEHOLDER)
    return F.when(usable, given).when(place.contains("/") & (base != ""), made).otherwise("")


def with_status(runs: DataFrame, include_failed: bool = False) -> DataFrame:
    """runs with status_label, status_category, report_included."""
    s = F.col("_s")
    out = runs.withColumn("_s", classify_status(F.col("status"), include_failed))
    return out.withColumns({"status_label": s["label"], "status_category": s["category"], "report_included": s["included"]}).drop("_s")


def included(runs: DataFrame) -> DataFrame:
    """Runs (with status) that the report goes on with."""
    return runs.filter("report_included")


def of_included(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """rows whose run has an included row."""
    return rows.join(included(runs).select("run_id").distinct(), "run_id", "left_semi")


def last_by_run(rows: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One row for each run_id: the last by ordinal (by default the column of that name), or the greatest where there is no order."""
    ordinal = ordinal_of(rows, ordinal)
    names = [c for c in rows.columns if c not in ("run_id", "ordinal")]
    row = F.struct(*names)
    pick = F.max_by(row, F.col(ordinal)) if ordinal else F.max(row)
    return rows.groupBy("run_id").agg(pick.alias("_r")).select("run_id", *[F.col("_r")[n].alias(n) for n in names])


def benchmark_overview(runs: DataFrame) -> DataFrame:
    """All runs, included or not."""
    return runs.select("pipeline", "group", "run_id", "status", "status_label", "status_category", "report_included", *order_of(runs))


def order_of(runs: DataFrame) -> list[str]:
    """The column ordinal if the runs have it: sections of runs carry it until they are sorted."""
    return ["ordinal"] if "ordinal" in runs.columns else []


def _link() -> Column:
    return run_link(F.col("run_id"), F.col("workspace"), F.col("platform"), F.col("run_url"))


def run_summary(runs: DataFrame) -> DataFrame:
    """All runs with their versions, counts and settings."""
    names = {"pipeline_version": "Version", "nextflow_version": "Nextflow_version"}
    counts = {"succeeded": "succeedCount", "failed": "failedCount", "cached": "cachedCount"}
    return runs.select(
        "pipeline", "group", "run_id", "workspace", _link().alias("runUrl"), "username", "status", "status_label", "status_category", "report_included",
        *[F.col(c).alias(n) for c, n in names.items()], "platform_version", *[S.number(F.col(c)).alias(n) for c, n in counts.items()], "executor", "region",
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("fusion_enabled", "wave_enabled")], "container_engine", *order_of(runs),
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Included runs with durations, efficiencies and bytes, in hours and GB."""
    whole = lambda c: S.number(F.col(c)).cast("long")
    gb = lambda c: S.rounded(S.number(F.col(c)).cast("double") / S.GB, 0)
    return included(runs).select(
        "pipeline", "group", "run_id", "workspace", _link().alias("runUrl"), whole("duration_ms").alias("duration"), S.rounded(S.hours(F.col("cpu_time_ms")), 1).alias("cpuTime"),
        whole("cpu_time_ms").alias("pipeline_runtime"), S.rounded(F.col("cpu_efficiency"), 0).alias("cpuEfficiency"), S.rounded(F.col("memory_efficiency"), 2).alias("memoryEfficiency"),
        gb("read_bytes").alias("readBytes"), gb("write_bytes").alias("writeBytes"), *order_of(runs),
    )
