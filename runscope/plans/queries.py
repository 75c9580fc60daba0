"""Registered queries of the report operators on the driver's tables, with the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators import bill_filter as bf
from runscope.operators import capacity, costs, machine_hours, normalize, runs, runtime
from runscope.operators import tasks as task_ops
from runscope.plans import driver_tables as D
from runscope.plans.report import build_report
from runscope.sources import manifest as M

Query = Callable[[SparkSession, str], DataFrame]


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def section(name: str) -> Query:
    return lambda spark, sf_dir: build_report(D.tables(spark, sf_dir))[name]


def run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_runs(D.documents(spark, sf_dir))


def included_tasks(spark: SparkSession, sf_dir: str, include_failed: bool = False) -> DataFrame:
    return runs.of_included(D.tasks(spark, sf_dir), runs.with_status(run_tables(spark, sf_dir), include_failed))


def runs_projection(spark, sf_dir):
    return run_tables(spark, sf_dir)


def tasks_projection(spark, sf_dir):
    names = "run_id group hash name process process_short status duration_ms realtime_ms cpus memory_bytes pcpu pmem rss peak_rss read_bytes write_bytes cost machine_type".split()
    return as_double(D.tasks(spark, sf_dir).select(*names), "cost")


def task_timing(spark, sf_dir):
    return D.tasks(spark, sf_dir).select("run_id", "name", "submit", "start", "complete", "wait_ms", "staging_ms")


def metrics_flatten(spark, sf_dir):
    return normalize.normalize_metrics(D.nested(spark, sf_dir)).select("run_id", "group", "process", "cpu_mean", "cpu_q2", "cpu_max", "mem_min", "mem_max", "vmem_mean")


def nested_tasks(spark, sf_dir):
    return normalize.normalize_tasks(D.nested(spark, sf_dir)).select("run_id", "group", "name", "hash", "status", "realtime_ms", "wait_ms", "staging_ms", "cost")


def progress_fallback(spark, sf_dir):
    return normalize.normalize_runs(D.nested(spark, sf_dir)).select("run_id", "cpu_efficiency", "memory_efficiency", "cpu_time_ms", "read_bytes", "write_bytes")


def bill_aggregate(spark, sf_dir):
    return as_double(costs.normalize_costs(D.bill(spark, sf_dir)), *costs.AMOUNTS)


def bill_label_resolution(spark, sf_dir):
    """With a user label that comes before the defaults and is filled for some rows only."""
    bill = D.bill(spark, sf_dir).withColumn("resource_tags_project", F.when(F.col("line_item_unblended_cost") > 30000, F.lit("big")))
    return as_double(costs.normalize_costs(bill, {"run_id": "project", "process": ["missing"]}), *costs.AMOUNTS)


def machine_summary(spark, sf_dir):
    return machine_hours.summarise_machines(D.machine_rows(spark, sf_dir))


def run_status(spark, sf_dir):
    """With failed runs taken in, and states that no class names."""
    odd = run_tables(spark, sf_dir).withColumn("status", F.when(F.col("run_id").cast("long") % 10 == 1, " submitted_late-run2x ").when(F.col("run_id").cast("long") % 10 == 2, "").otherwise(F.col("status")))
    return runs.with_status(odd, True).select("run_id", "status", "status_label", "status_category", "report_included")


def run_links(spark, sf_dir):
    return runs.run_summary(runs.with_status(run_tables(spark, sf_dir))).select("run_id", "workspace", "runUrl")


def cost_index(spark, sf_dir):
    twice = costs.normalize_costs(D.bill(spark, sf_dir))
    return as_double(costs.cost_index(twice.unionByName(twice)), *costs.AMOUNTS)


def task_cost_join(spark, sf_dir):
    t = D.tables(spark, sf_dir)
    out = costs.attribute_costs(t["tasks"], t["costs"]).select("run_id", "name", "hash", "bill_cost", "total", "used", "unused")
    return as_double(out, "bill_cost", "total", "used", "unused")


def cost_reconciliation(spark, sf_dir):
    t = D.tables(spark, sf_dir)
    return as_double(costs.reconciliation(t["costs"], costs.attribute_costs(t["tasks"], t["costs"])), "billed", "attributed")


def cost_overview(spark, sf_dir):
    return as_double(section("cost_overview")(spark, sf_dir), "total_cost", "used_cost", "unused_cost")


def process_stats(spark, sf_dir):
    out = section("process_stats")(spark, sf_dir)
    numbers = [c for c in out.columns if c.startswith(("avg_", "sd_"))]
    return as_double(out, "total_cost", *numbers).withColumns({c: F.round(c, 6) for c in numbers})


def runtime_segments(spark, sf_dir):
    t = included_tasks(spark, sf_dir)
    return runtime.segments(runtime.process_runtime(t, run_tables(spark, sf_dir))).select("pipeline", "group", "rank", "process", "runtime_ms", "pct", "highlight")


def runtime_legend(spark, sf_dir):
    t = included_tasks(spark, sf_dir)
    return runtime.legend(runtime.segments(runtime.process_runtime(t, run_tables(spark, sf_dir))))


def runtime_panels(spark, sf_dir):
    out = section("combined_task_runtime")(spark, sf_dir)
    flat = {"n_segments": F.size("segments").cast("long"), "n_legend": F.size("legend").cast("long"), "first_process": F.col("segments")[0]["process"], "last_legend": F.element_at("legend", -1)["process"]}
    flat |= {"qc_runtime_ms": F.col("highlight_totals.qc_runtime_ms"), "other_runtime_ms": F.col("highlight_totals.other_runtime_ms")}
    return out.withColumns(flat).drop("segments", "legend", "highlight_totals")


def task_table(spark, sf_dir):
    names = {"Group": "group", "Run ID": "run_id", "Taskhash": "taskhash", "Task name short": "short", "Instance type": "instance", "Realtime_ms": "realtime_ms", "Duration_ms": "duration_ms"}
    names |= {"CPUused": "cpus", "Memoryused_GB": "memory_gb", "Rss": "rss", "Task name": "name", "Status": "status", "Cost": "cost"}
    return as_double(section("task_table")(spark, sf_dir).select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), "cost")


def task_scatter(spark, sf_dir):
    out = section("task_scatter")(spark, sf_dir)
    return as_double(out, "cost").withColumns({c: F.round(c, 6) for c in ("realtime_min", "staging_min", "memory_gb")})


def task_resource_hours(spark, sf_dir):
    out = capacity.task_resource_hours(D.tasks(spark, sf_dir))
    return out.select("run_id", *[F.round(c, 6).alias(c) for c in ("req_cpu", "req_mem", "real_cpu", "real_mem")])


def has_vm(spark, sf_dir):
    return capacity.has_vm(section("run_metrics")(spark, sf_dir))


def run_metrics(spark, sf_dir):
    names = "pipeline group run_id workspace runUrl duration cpuTime pipeline_runtime cpuEfficiency memoryEfficiency readBytes writeBytes nMachines".split()
    return section("run_metrics")(spark, sf_dir).select(*names)


def capacity_decomposition(spark, sf_dir):
    """With six digits, and ties moved aside: sums of doubles in another order could fall to another side of one."""
    t = D.tables(spark, sf_dir)
    classed = runs.with_status(t["runs"])
    metrics = capacity.with_machines(runs.run_metrics(classed), t["machines"])
    out = capacity.capacity(metrics, capacity.task_resource_hours(runs.of_included(t["tasks"], classed)), 12)
    names = out.columns[out.columns.index("nMachines") + 1 :]
    return out.select("run_id", *[c if c in capacity.MACHINE_COLUMNS.values() else F.round(F.col(c) + 1e-9, 6).alias(c) for c in names])


def manifest_validation(spark, sf_dir):
    return M.validate(D.manifest(spark, sf_dir)).select("id", "workspace", "logs", F.array_join("errors", ",").alias("errors"))


def run_routing(spark, sf_dir):
    ways = zip(("api", "external", "dropped"), M.route(D.manifest(spark, sf_dir)), strict=True)
    out = None
    for name, rows in ways:
        own = M.resolve_logs(rows, "/data/in").select("id", "workspace", F.lit(name).alias("way"), "logs_path", F.when(F.col("logs").isNotNull(), F.col("logs_kind")).alias("logs_kind"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy("way", "logs_kind").agg(F.count("*").alias("n_rows"), F.min("logs_path").alias("first_path"), F.max("id").alias("last_id"))


def bill_filter(spark, sf_dir):
    named = D.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("group"))
    out = bf.filter_bill(D.bill(spark, sf_dir), named)
    return as_double(out.drop("resource_tags"), *[c for c in out.columns if c.endswith("cost")])


def bill_filter_summary(spark, sf_dir):
    named = D.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return bf.summary(bf.with_synthetic_row(bf.filter_bill(D.bill(spark, sf_dir), named)))


QUERIES: dict[str, Query] = {
    "runs_projection": runs_projection, "tasks_projection": tasks_projection, "task_timing": task_timing, "metrics_flatten": metrics_flatten, "nested_tasks": nested_tasks,
    "progress_fallback": progress_fallback, "bill_aggregate": bill_aggregate, "bill_label_resolution": bill_label_resolution, "machine_summary": machine_summary, "run_status": run_status,
    "benchmark_overview": section("benchmark_overview"), "run_summary": section("run_summary"), "run_metrics": run_metrics, "run_links": run_links, "cost_index": cost_index,
    "task_cost_join": task_cost_join, "run_costs": section("run_costs"), "cost_reconciliation": cost_reconciliation, "cost_overview": cost_overview, "process_stats": process_stats,
    "task_instance_usage": section("task_instance_usage"), "combined_runtime_segments": runtime_segments, "combined_runtime_legend": runtime_legend, "combined_runtime_panels": runtime_panels,
    "task_table": task_table, "task_scatter": task_scatter, "task_resource_hours": task_resource_hours, "capacity_decomposition": capacity_decomposition, "has_vm": has_vm,
    "manifest_validation": manifest_validation, "run_routing": run_routing, "bill_filter": bill_filter, "bill_filter_summary": bill_filter_summary,
}
