"""The machine layer of run metrics: capacity split into used, overbooked, rightsized and idle hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators.runs import last_by_run


def task_resource_hours(tasks: DataFrame) -> DataFrame:
    """Requested and real CPU and memory hours of each run's COMPLETED and CACHED tasks, not rounded."""
    kept = tasks.filter(F.col("status").isin("COMPLETED", "CACHED"))
    h = S.hours(F.col("realtime_ms"))
    rss = F.coalesce(F.nullif(F.col("peak_rss"), F.lit(0)), F.col("rss"), F.lit(0))
    return kept.groupBy("run_id").agg(
        F.sum(S.number(F.col("cpus")) * h).alias("req_cpu"), F.sum(S.number(F.col("memory_bytes")) / S.GIB * h).alias("req_mem"),
        F.sum(S.number(F.col("pcpu")) / 100.0 * h).alias("real_cpu"), F.sum(rss / S.GIB * h).alias("real_mem"),
    )


MACHINE_COLUMNS = {
    "n_machines": "nMachines", "vm_cpu_h": "vmCpuH", "vm_mem_gib_h": "vmMemGibH", "sched_alloc_cpu_efficiency": "schedAllocCpuEfficiency",
    "sched_alloc_mem_efficiency": "schedAllocMemEfficiency",
}


def with_machines(metrics: DataFrame, machines: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Run metrics with the last machine row of each run."""
    own = last_by_run(machines, ordinal)
    columns = [F.col(c).alias(n) if c == "n_machines" else S.rounded(F.col(c), 2).alias(n) for c, n in MACHINE_COLUMNS.items()]
    return metrics.join(own.select("run_id", *columns), "run_id", "left")


def capacity(metrics: DataFrame, task_hours: DataFrame, digits: int = 2) -> DataFrame:
    """Run metrics with machines and the split of both capacities. Rows without tasks have no split.

    Task hours go in as they are, machine hours and efficiencies as rounded for the report.
    """
    rows = metrics.join(task_hours, "run_id", "left")
    has_tasks = F.col("req_cpu").isNotNull()
    out: dict[str, Column] = {}

    def add(name: str, value: Column) -> None:
        out[name] = F.when(has_tasks, value)

    for short, cpu_or_mem, unit in (("cpu", "Cpu", "CpuH"), ("mem", "Mem", "MemGibH")):
        requested, real, vm, busy = F.col(f"req_{short}"), F.col(f"real_{short}"), F.col(f"vm{unit}"), F.col(f"schedAlloc{cpu_or_mem}Efficiency")
        booked = S.booked_hours(vm, busy, requested)
        add(f"requested{unit}", requested)
        add(f"real{unit}", real)
        add(f"requestedVm{cpu_or_mem}Efficiency", S.of_capacity(requested, vm))
        add(f"schedulerBooked{unit}", booked)
        add(f"schedulerRightsized{unit}", S.positive_gap(requested, booked))
        add(f"schedulerOverbook{unit}", S.positive_gap(booked, real))
        add(f"vmPackingSlack{unit}", S.positive_gap(vm, booked))
        add(f"realVm{cpu_or_mem}Efficiency", S.of_capacity(real, vm))
    # rounded in a step of its own: rounding names its value several times
    return rows.withColumns(out).withColumns({n: S.rounded(F.col(n), digits) for n in out}).drop("req_cpu", "req_mem", "real_cpu", "real_mem")


def has_vm(metrics: DataFrame) -> DataFrame:
    """One row, has_vm: whether any run has machine hours."""
    return metrics.agg(F.coalesce(F.bool_or(F.col("vmCpuH") > 0), F.lit(False)).alias("has_vm"))
