"""Task sections: process statistics, instance usage, task table and scatter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runscope.functions import scalars as S


def completed(tasks: DataFrame) -> DataFrame:
    return tasks.filter("status = 'COMPLETED'")


def kept(tasks: DataFrame) -> DataFrame:
    return tasks.filter("status in ('COMPLETED', 'CACHED')")


def process_stats(tasks: DataFrame) -> DataFrame:
    """By group and process over COMPLETED tasks: number, means and sample deviations (null for one task), total cost."""
    measures = {"staging_min": S.minutes(F.col("staging_ms")), "realtime_min": S.minutes(F.col("realtime_ms")), "runtime_min": S.minutes(F.col("duration_ms")), "cost": S.number(F.col("cost"))}
    both = [f(c).alias(f"{p}_{n}") for n, c in measures.items() for f, p in ((F.avg, "avg"), (F.stddev_samp, "sd"))]
    keys = [F.col("group"), F.col("process").alias("process_name"), F.col("process_short")]
    return completed(tasks).groupBy(*keys).agg(F.count("*").alias("n_tasks"), *both, F.sum(measures["cost"]).alias("total_cost"))


def instance_usage(tasks: DataFrame) -> DataFrame:
    """COMPLETED tasks by group and machine type."""
    return completed(tasks).filter(S.filled(F.col("machine_type")).isNotNull()).groupBy("group", "machine_type").count()


TABLE = {
    "Group": "group", "Run ID": "run_id", "Taskhash": "substring(coalesce(hash, ''), 1, 9)", "Task name short": "process_short", "Executor": "executor", "Cloudzone": "cloud_zone",
    "Instance type": "machine_type", "Realtime_min": "coalesce(realtime_ms, 0) / 60000D", "Realtime_ms": "realtime_ms", "Duration_ms": "duration_ms", "Cost": "coalesce(cost, 0)",
    "CPUused": "cpus", "Memoryused_GB": "bround(coalesce(memory_bytes, 0) / 1e9D, 0)", "Pcpu": "pcpu", "Pmem": "pmem", "Rss": "rss", "Readbytes": "read_bytes",
    "Writebytes": "write_bytes", "VolCtxt": "vol_ctxt", "InvCtxt": "inv_ctxt", "Task name": "name", "Status": "status",
}


def task_table(tasks: DataFrame) -> DataFrame:
    """Every kept task for display; its cost is its own, not the bill's."""
    return kept(tasks).select(*[F.expr(e if " " in e or "(" in e else f"`{e}`").alias(n) for n, e in TABLE.items()])


def task_scatter(tasks: DataFrame) -> DataFrame:
    """Every kept task as a point."""
    return kept(tasks).select(
        "run_id", "group", "process_short", "name", S.minutes(F.col("realtime_ms")).alias("realtime_min"), S.minutes(F.col("staging_ms")).alias("staging_min"),
        S.number(F.col("cost")).alias("cost"), "cpus", (S.number(F.col("memory_bytes")).cast("double") / S.GB).alias("memory_gb"),
    )
