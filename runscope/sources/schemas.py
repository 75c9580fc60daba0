"""Fixed schemas. Numbers of run documents are read as doubles and cast later: a JSON 1.0 is no bigint to Spark."""

from __future__ import annotations

from pyspark.sql import types as T

STATS = ("mean", "min", "q1", "q2", "q3", "max")
METRICS = ("cpu", "mem", "vmem", "time", "reads", "writes", "cpuUsage", "memUsage", "timeUsage")


def struct(strings: str = "", doubles: str = "", **more: T.DataType) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in strings.split()] + [T.StructField(n, T.DoubleType()) for n in doubles.split()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in more.items()])


STAT = struct(doubles=" ".join(STATS))
TASK_FIELDS = dict(
    strings="name process hash tag status submit start complete executor machineType cloudZone",
    doubles="duration realtime cpus memory pcpu pmem rss peakRss readBytes writeBytes cost exitStatus volCtxt invCtxt",
)
TASK = struct(**TASK_FIELDS)
TASK_OR_WRAPPED = struct(**TASK_FIELDS, task=TASK)
METRIC = struct("process", **{m: STAT for m in METRICS})
ENABLED = struct(enabled=T.BooleanType())
WORKFLOW = struct(
    "id status userName repository revision projectName runName start complete commandLine containerEngine executor runUrl url",
    "duration",
    nextflow=struct("version"),
    fusion=ENABLED,
    wave=ENABLED,
    stats=struct(doubles="succeedCount failedCount cachedCount"),
)
PROGRESS = struct(doubles="cpuEfficiency memoryEfficiency cpuTime cpuLoad memoryRss memoryReq readBytes writeBytes")
META = struct("id workspace group platform token_env")
RUN = struct(
    meta=META,
    workflow=WORKFLOW,
    progress=struct(workflowProgress=PROGRESS),
    launch=struct("platformVersion"),
    computeEnv=struct("executor region"),
    tasks=T.ArrayType(TASK_OR_WRAPPED),
    metrics=T.ArrayType(METRIC),
)

RUNS = (
    "run_id string, group string, pipeline string, run_name string, username string, status string, start string, complete string, duration_ms long, succeeded long, failed long, "
    "cached long, cpu_efficiency double, memory_efficiency double, cpu_time_ms long, read_bytes long, write_bytes long, fusion_enabled boolean, wave_enabled boolean, "
    "command_line string, revision string, container_engine string, nextflow_version string, executor string, region string, pipeline_version string, platform_version string, "
    "workspace string, platform string, run_url string"
)
TASKS = (
    "run_id string, group string, hash string, name string, process string, process_short string, tag string, status string, submit string, start string, complete string, "
    "duration_ms long, realtime_ms long, wait_ms long, staging_ms long, cpus long, memory_bytes long, pcpu double, pmem double, rss long, peak_rss long, read_bytes long, "
    "write_bytes long, cost double, executor string, machine_type string, cloud_zone string, exit_status int, vol_ctxt long, inv_ctxt long"
)
METRIC_ROWS = "run_id string, group string, process string, " + ", ".join(f"{m}_{s} double" for m in METRICS for s in STATS)
COSTS = "run_id string, process string, hash string, cost double, used_cost double, unused_cost double"
MACHINES = "run_id string, n_machines long, vm_cpu_h double, vm_mem_gib_h double, sched_alloc_cpu_efficiency double, sched_alloc_mem_efficiency double"
BUNDLE = {"runs": RUNS, "tasks": TASKS, "metrics": METRIC_ROWS, "costs": COSTS, "machines": MACHINES}

MANIFEST = struct("id workspace group logs machines platform token_env")
MACHINE_ROWS = (
    "run_id instance_id vcpus memory_gib machine_hours avg_cpu_utilization avg_memory_utilization ecs_instance_id total_vcpu_hours total_memory_gib_hours "
    "total_requested_vcpu_hours total_requested_memory_gib_hours requested_vcpu_hours requested_memory_gib_hours"
).split()
