"""Runtime panels: shares of processes in a pipeline's and group's runtime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators.tasks import completed
from runscope.sources.order import ordinal_of

# Parts of process names that are shown in another colour.
HIGHLIGHTS = "qc|qualimap|multiqc|rseqc|dupradar"
LEGEND = 20
PANEL = ("pipeline", "group")


def is_highlight(process: Column) -> Column:
    return F.lower(process).rlike(HIGHLIGHTS)


def process_runtime(tasks: DataFrame, runs: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Runtime, wait and number of COMPLETED tasks by panel and process. A run's pipeline is that of its last row, without an order the greatest."""
    ordinal = ordinal_of(runs, ordinal)
    last = F.max_by("pipeline", ordinal) if ordinal else F.max("pipeline")
    names = runs.groupBy("run_id").agg(last.alias("_pipeline"))
    process = S.first_filled(F.col("process"), F.col("process_short"), F.lit("unknown"))
    pipeline = S.first_filled(F.col("_pipeline"), F.lit("unknown"))
    rows = completed(tasks).join(names, "run_id", "left").select(pipeline.alias("pipeline"), "group", process.alias("process"), "realtime_ms", "wait_ms")
    return rows.groupBy(*PANEL, "process").agg(F.sum(S.number(F.col("realtime_ms"))).alias("runtime_ms"), F.sum(S.number(F.col("wait_ms"))).alias("wait_ms"), F.count("*").alias("n_tasks"))


def segments(per_process: DataFrame) -> DataFrame:
    """Processes of each panel with rank, share and highlight; panels without runtime are dropped. A panel has as many rows as processes."""
    panel = Window.partitionBy(*PANEL)
    ranked = panel.orderBy(F.desc("runtime_ms"), "process")
    rows = per_process.withColumns({"total": F.sum("runtime_ms").over(panel), "rank": F.row_number().over(ranked)}).filter("total > 0")
    return rows.withColumns({"pct": S.rounded(F.col("runtime_ms") / F.col("total") * 100.0, 2), "highlight": is_highlight(F.col("process"))})


def legend(rows: DataFrame) -> DataFrame:
    """Segments of rank 20 at most; all others of a panel as one."""
    slot = F.least(F.col("rank"), F.lit(LEGEND + 1))
    grouped = rows.groupBy(*PANEL, slot.alias("rank")).agg(
        F.first("process").alias("process"), F.sum("runtime_ms").alias("runtime_ms"), F.first("total").alias("total"), F.bool_or("highlight").alias("highlight"), F.count("*").alias("n")
    )
    rest = F.col("rank") > LEGEND
    name = F.when(rest, F.concat(F.lit("Other ("), F.col("n"), F.lit(" small processes)"))).otherwise(F.col("process"))
    return grouped.select(
        *PANEL, "rank", name.alias("process"), "runtime_ms", S.rounded(F.col("runtime_ms") / F.col("total") * 100.0, 2).alias("pct"),
        F.when(rest, F.lit(False)).otherwise(F.col("highlight")).alias("highlight"),
    )


def combined_runtime(per_process: DataFrame) -> DataFrame:
    """One row for each panel: totals, segments, legend and highlight totals. A panel is one aggregation of its processes, sorted inside it."""
    sums = per_process.withColumn("highlight", is_highlight(F.col("process"))).groupBy(*PANEL).agg(
        F.sum("runtime_ms").alias("total_runtime_ms"), F.sum("wait_ms").alias("scheduling_runtime_ms"), F.sum(F.col("runtime_ms") + F.col("wait_ms")).alias("total_duration_ms"),
        F.sum("n_tasks").alias("total_tasks"), F.count("*").alias("unique_processes"), F.sum(F.when(F.col("highlight"), F.col("runtime_ms")).otherwise(0)).alias("_qc"),
        F.array_sort(F.collect_list(F.struct((-F.col("runtime_ms")).alias("_order"), "process", "runtime_ms", "highlight"))).alias("_own"),
    )
    total = F.col("total_runtime_ms")
    share = lambda ms: S.rounded(ms / total * 100.0, 2)
    shown = lambda x: F.struct(x["process"].alias("process"), x["runtime_ms"].alias("runtime_ms"), share(x["runtime_ms"]).alias("pct"), x["highlight"].alias("highlight"))
    small = F.aggregate(F.slice("_own", LEGEND + 1, F.greatest(F.size("_own") - LEGEND, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x["runtime_ms"])
    name = F.concat(F.lit("Other ("), (F.size("_own") - LEGEND).cast("string"), F.lit(" small processes)"))
    other = F.struct(name.alias("process"), F.col("_small").alias("runtime_ms"), share(F.col("_small")).alias("pct"), F.lit(False).alias("highlight"))
    split = F.struct(F.col("_qc").alias("qc_runtime_ms"), (total - F.col("_qc")).alias("other_runtime_ms"))
    top = F.slice("segments", 1, LEGEND)
    out = sums.filter(total > 0).withColumn("segments", F.transform("_own", shown)).withColumn("_small", small)
    return out.select(
        *PANEL, F.concat_ws("::", *PANEL).alias("panel_id"), "total_runtime_ms", "scheduling_runtime_ms", "total_duration_ms", "total_tasks", "unique_processes",
        "segments", F.when(F.size("_own") > LEGEND, F.concat(top, F.array(other))).otherwise(top).alias("legend"), split.alias("highlight_totals"),
    )
