"""Run documents to flat tables: runs, tasks and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.sources import schemas

KEPT_STATUS = ("COMPLETED", "CACHED")


def unwrap(task: Column) -> Column:
    """A task object, or the one that it wraps in `task`."""
    flat = F.struct(*[task[n].alias(n) for n in schemas.TASK.names])
    return F.when(task["task"].isNotNull(), task["task"]).otherwise(flat)


def task_totals(task: Column) -> dict[str, Column]:
    """What a task, wrapped or not, adds to its run's progress."""
    own = lambda name: F.when(task["task"].isNotNull(), task["task"][name]).otherwise(task[name])
    field = lambda name: S.number(own(name), 0.0)
    values = {
        "n": F.lit(1.0), "cpu_time": field("cpus") * field("realtime"), "cpu_load": field("pcpu") / 100.0 * field("realtime"),
        "rss": F.coalesce(own("peakRss"), own("rss"), F.lit(0.0)), "requested": field("memory"), "read": field("readBytes"), "written": field("writeBytes"),
    }
    return {n: F.when(own("status") == "COMPLETED", v).otherwise(0.0) for n, v in values.items()}


def progress_of_tasks(tasks: Column) -> Column:
    """A run's progress from its COMPLETED tasks, in one pass inside the row; null if there are none."""
    names = ("n", "cpu_time", "cpu_load", "rss", "requested", "read", "written")

    def add(sums: Column, task: Column) -> Column:
        own = task_totals(task)
        return F.struct(*[(sums[n] + own[n]).alias(n) for n in names])

    # finish works on the sums, so that the pass is written once in the plan
    return F.aggregate(tasks, F.struct(*[F.lit(0.0).alias(n) for n in names]), add, progress_of_sums)


def progress_of_sums(sums: Column) -> Column:
    cpu_time, cpu_load, rss, requested = (sums[n] for n in ("cpu_time", "cpu_load", "rss", "requested"))
    values = {
        "cpuEfficiency": S.rounded(F.when(cpu_time != 0, cpu_load / cpu_time * 100), 2),
        "memoryEfficiency": S.rounded(F.when(requested != 0, rss / requested * 100), 2),
        "cpuTime": F.floor(cpu_time).cast("double"),
        "cpuLoad": F.floor(cpu_load).cast("double"),
        "memoryRss": rss,
        "memoryReq": requested,
        "readBytes": sums["read"],
        "writeBytes": sums["written"],
    }
    return F.when(sums["n"] > 0, F.struct(*[values[n].alias(n) for n in schemas.PROGRESS.names]))


def is_empty(value: Column, names: list[str]) -> Column:
    """No field of a struct is given."""
    return F.coalesce(*[value[n] for n in names]).isNull()


def group_of(meta: Column) -> Column:
    return F.coalesce(S.filled(meta["group"]), F.lit("default"))


def pipeline_name(workflow: Column) -> Column:
    """projectName, else the last part of the repository, else unknown; empty strings count as missing."""
    return S.first_filled(workflow["projectName"], S.last_part(workflow["repository"], "/"), F.lit("unknown"))


def normalize_runs(raw: DataFrame) -> DataFrame:
    """One row for each document. Missing and null fields alike take the defaults. ordinal, or else file_name, tells the order of runs."""
    w, given = F.col("workflow"), F.col("progress.workflowProgress")
    p = F.when(is_empty(given, schemas.PROGRESS.names), progress_of_tasks(F.coalesce("tasks", F.array()))).otherwise(given)
    rows = raw.withColumn("_p", p)
    p, whole = F.col("_p"), lambda c: S.number(c).cast("long")
    stats = w["stats"]
    columns = {
        "run_id": w["id"], "group": group_of(F.col("meta")), "pipeline": pipeline_name(w), "run_name": S.text(w["runName"]), "username": S.text(w["userName"]),
        "status": S.text(w["status"]), "start": w["start"], "complete": w["complete"], "duration_ms": whole(w["duration"]), "succeeded": whole(stats["succeedCount"]),
        "failed": whole(stats["failedCount"]), "cached": whole(stats["cachedCount"]), "cpu_efficiency": p["cpuEfficiency"], "memory_efficiency": p["memoryEfficiency"],
        "cpu_time_ms": whole(p["cpuTime"]), "read_bytes": whole(p["readBytes"]), "write_bytes": whole(p["writeBytes"]),
        "fusion_enabled": F.coalesce(w["fusion"]["enabled"], F.lit(False)), "wave_enabled": F.coalesce(w["wave"]["enabled"], F.lit(False)),
        "command_line": S.text(w["commandLine"]), "revision": S.text(w["revision"]), "container_engine": S.text(w["containerEngine"]),
        "nextflow_version": S.text(w["nextflow"]["version"]), "executor": F.coalesce("computeEnv.executor", w["executor"], F.lit("")), "region": S.text(F.col("computeEnv.region")),
        "pipeline_version": S.text(w["revision"]), "platform_version": S.text(F.col("launch.platformVersion")), "workspace": S.text(F.col("meta.workspace")),
        "platform": S.text(F.col("meta.platform")), "run_url": S.text(S.first_filled(w["runUrl"], w["url"])),
    }
    # documents come in the order of their files, unless they tell another
    order = next((n for n in ("ordinal", "file_name") if n in raw.columns), None)
    return rows.select(*[c.alias(n) for n, c in columns.items()], *([F.col(order).alias("ordinal")] if order else []))


def task_rows(tasks: DataFrame) -> DataFrame:
    """(run_id, group, task: an unwrapped task) to the tasks table; only COMPLETED and CACHED tasks stay."""
    t = F.col("task")
    whole = lambda n: S.number(t[n]).cast("long")
    realtime = whole("realtime")
    columns = {
        "run_id": F.col("run_id"), "group": F.col("group"), "hash": S.text(t["hash"]), "name": S.text(t["name"]), "process": S.text(t["process"]),
        "process_short": S.last_part(S.text(t["process"]), ":"), "tag": t["tag"], "status": t["status"], "submit": t["submit"], "start": t["start"], "complete": t["complete"],
        "duration_ms": whole("duration"), "realtime_ms": realtime, "wait_ms": S.duration_ms(t["submit"], t["start"]),
        "staging_ms": F.greatest(F.lit(0), S.duration_ms(t["start"], t["complete"]) - realtime).cast("long"), "cpus": whole("cpus"), "memory_bytes": whole("memory"),
        "pcpu": S.number(t["pcpu"], 0.0), "pmem": S.number(t["pmem"], 0.0), "rss": whole("rss"), "peak_rss": whole("peakRss"), "read_bytes": whole("readBytes"),
        "write_bytes": whole("writeBytes"), "cost": t["cost"], "executor": S.text(t["executor"]), "machine_type": S.text(t["machineType"]), "cloud_zone": S.text(t["cloudZone"]),
        "exit_status": t["exitStatus"].cast("int"), "vol_ctxt": whole("volCtxt"), "inv_ctxt": whole("invCtxt"),
    }
    return tasks.filter(t["status"].isin(*KEPT_STATUS)).select(*[c.alias(n) for n, c in columns.items()])


def normalize_tasks(raw: DataFrame) -> DataFrame:
    """One row for each kept task; the explode follows the scan, so a large run's tasks leave its row at once."""
    keys = raw.select(F.col("workflow.id").alias("run_id"), group_of(F.col("meta")).alias("group"), F.explode("tasks").alias("_t"))
    return task_rows(keys.select("run_id", "group", unwrap(F.col("_t")).alias("task")))


def normalize_metrics(raw: DataFrame) -> DataFrame:
    """One row for each process of each run, a column for each metric and statistic; a missing one is null."""
    return metric_rows(raw.select(F.col("workflow.id").alias("run_id"), group_of(F.col("meta")).alias("group"), F.explode("metrics").alias("m")))


def metric_rows(rows: DataFrame) -> DataFrame:
    """(run_id, group, m: one process' metrics) to the metrics table."""
    stats = [F.col(f"m.{m}.{s}").alias(f"{m}_{s}") for m in schemas.METRICS for s in schemas.STATS]
    return rows.select("run_id", "group", S.text(F.col("m.process")).alias("process"), *stats)
