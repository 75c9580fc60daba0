"""Machine rows to hours and efficiencies by run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.functions import scalars as S


def _named(column: str) -> Column:
    return S.filled(F.trim(F.col(column)))


SUMS = ("cpu", "memory", "cpu_used", "memory_used", "cpu_weight", "memory_weight", "cpu_asked", "memory_asked")


def scheduler_row(number: Callable[[str], Column], row: Callable[[str], Column]) -> dict[str, Column]:
    """Of a row with an instance_id: hours of capacity, and utilisation weighted by them."""
    cpu, memory = number("vcpus") * number("machine_hours"), number("memory_gib") * number("machine_hours")
    return {"cpu": cpu, "memory": memory, "cpu_used": S.percent(row("avg_cpu_utilization")) * cpu, "memory_used": S.percent(row("avg_memory_utilization")) * memory, "cpu_weight": cpu, "memory_weight": memory}


def batch_row(number: Callable[[str], Column]) -> dict[str, Column]:
    """Of a row with an ecs_instance_id: hours of capacity, and hours asked for."""
    asked = lambda what: F.coalesce(F.nullif(number(f"total_requested_{what}_hours"), F.lit(0.0)), number(f"requested_{what}_hours"))
    return {"cpu": number("total_vcpu_hours"), "memory": number("total_memory_gib_hours"), "cpu_asked": asked("vcpu"), "memory_asked": asked("memory_gib")}


def hours(rows: DataFrame) -> DataFrame:
    """(run_id, batch, SUMS) of each row, twice of one with both ids. Rows are read once: what a row counts as is unfolded from it."""
    number = lambda n: S.safe_double(F.col(n))
    kinds = []
    for name, batch, own in (("instance_id", False, scheduler_row(number, F.col)), ("ecs_instance_id", True, batch_row(number))):
        values = F.struct(F.trim("run_id").alias("run_id"), F.lit(batch).alias("batch"), *[own.get(n, F.lit(0.0)).alias(n) for n in SUMS])
        kinds.append(F.when(_named(name).isNotNull(), values))
    return rows.select(F.inline(F.filter(F.array(*kinds), lambda kind: kind.isNotNull())))


def summarise_machines(rows: DataFrame) -> DataFrame:
    """Machines, hours and efficiencies by run. A row with both ids counts as both; rows without a run are dropped."""
    both = hours(rows).filter(S.filled(F.col("run_id")).isNotNull())
    sums = both.groupBy("run_id").agg(F.count("*").alias("n_machines"), *[F.sum(c).alias(c) for c in SUMS], F.bool_or("batch").alias("batch"))

    def efficiency(what: str) -> Column:
        by_load = F.when(F.col(f"{what}_weight") > 0, F.col(f"{what}_used") / F.col(f"{what}_weight"))
        by_request = F.when(F.col("batch") & (F.col(what) > 0), F.col(f"{what}_asked") / F.col(what) * 100)
        return S.rounded(F.coalesce(by_load, by_request), 2)

    return sums.select(
        "run_id", "n_machines", S.rounded(F.col("cpu"), 4).alias("vm_cpu_h"), S.rounded(F.col("memory"), 4).alias("vm_mem_gib_h"),
        efficiency("cpu").alias("sched_alloc_cpu_efficiency"), efficiency("memory").alias("sched_alloc_mem_efficiency"),
    )
