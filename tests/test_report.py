"""Report sections on small tables with known results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators import capacity, costs, runs, runtime, tasks
from runscope.plans.report import build_report, ordered
from runscope.sources import schemas


def frame(spark, schema, rows, **defaults):
    """Rows given as dicts; other columns are null or a default."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schema)


def run(run_id, group="cpu", **more):
    return {"run_id": run_id, "group": group, "pipeline": "pipe", **more}


def task(run_id, process, h="ab/cdef12", group="cpu", **more):
    base = {"run_id": run_id, "group": group, "process": process, "process_short": process.split(":")[-1], "hash": h, "name": process, "status": "COMPLETED", "cost": 0.0}
    return base | {"realtime_ms": 60000, "duration_ms": 65000, "staging_ms": 5000, "wait_ms": 0} | more


def report(spark, run_rows, task_rows, cost_rows=None, machine_rows=None, **how):
    tables = {"runs": frame(spark, schemas.RUNS, run_rows), "tasks": frame(spark, schemas.TASKS, task_rows)}
    if cost_rows is not None:
        tables["costs"] = frame(spark, schemas.COSTS, cost_rows)
    if machine_rows is not None:
        tables["machines"] = frame(spark, schemas.MACHINES, machine_rows)
    return build_report(tables, **how)


def cost(run_id, process, h, total, used, unused):
    return {"run_id": run_id, "process": process, "hash": h, "cost": total, "used_cost": used, "unused_cost": unused}


def test_ten_sections(spark):
    out = report(spark, [run("r1")], [task("r1", "A")])
    assert list(out) == [
        "benchmark_overview", "run_summary", "run_metrics", "run_costs", "process_stats", "combined_task_runtime", "task_instance_usage", "task_table", "task_scatter", "cost_overview",
    ]
    assert out["cost_overview"] is None
    assert {n: d.count() for n, d in ordered(out).items() if d is not None}["task_table"] == 1


def test_zero_cost_in_the_bill_is_a_hit(spark):
    out = report(spark, [run("r1")], [task("r1", "A", cost=9.0)], [cost("r1", "A", "abcdef12", 0.0, 0.0, 0.0)])
    assert out["run_costs"].first()["cost"] == 0.0
    assert out["cost_overview"].first()["total_cost"] == 0.0


def test_key_uses_process_and_hash(spark):
    bill = [cost("r1", "A", "abcdef12", 5.0, 4.0, 1.0), cost("r1", "B", "abcdef12", 7.0, 6.0, 1.0)]
    out = report(spark, [run("r1")], [task("r1", "A"), task("r1", "B")], bill)
    assert tuple(out["run_costs"].first()) == ("r1", "cpu", 12.0, 10.0, 2.0)
    assert {r["process_short"]: r["total_cost"] for r in out["cost_overview"].collect()} == {"A": 5.0, "B": 7.0}


def test_key_steps_and_repeated_hits(spark):
    bill = [cost("r1", "X:A", "abcdef12", 1.0, 1.0, 0.0), cost("r1", "A", "abcdef12", 2.0, 2.0, 0.0), cost("r1", "", "abcdef12", 4.0, 3.0, 1.0), cost("r2", "", "", 8.0, 8.0, 0.0)]
    rows = [task("r1", "X:A"), task("r1", "Y:A"), task("r1", "Y:A"), task("r1", "Z"), task("r1", "Z", h="ffff", cost=16.0), task("r2", "Q", h=None)]
    attributed = costs.attribute_costs(frame(spark, schemas.TASKS, rows), frame(spark, schemas.COSTS, bill))
    assert sorted((r["process"], r["total"], r["unused"]) for r in attributed.collect()) == [("Q", 8.0, 0.0), ("X:A", 1.0, 0.0), ("Y:A", 2.0, 0.0), ("Y:A", 2.0, 0.0), ("Z", 4.0, 1.0), ("Z", 16.0, 0.0)]


def test_without_a_bill_own_costs_count(spark):
    for bill in (None, []):
        out = report(spark, [run("r1"), run("r2")], [task("r1", "A", cost=4.2)], bill)
        assert {r["run_id"]: (r["cost"], r["used_cost"], r["unused_cost"]) for r in out["run_costs"].collect()} == {"r1": (4.2, None, None), "r2": (0.0, None, None)}


@pytest.mark.parametrize("failed, included", [(False, {"r1"}), (True, {"r1", "r2"})])
def test_failed_runs_join_on_request(spark, failed, included):
    rows = [run("r1", status="SUCCEEDED"), run("r2", status="FAILED"), run("r3", status="CANCELLED")]
    out = report(spark, rows, [task(r["run_id"], "A") for r in rows], include_failed_runs=failed)
    assert out["benchmark_overview"].count() == out["run_summary"].count() == 3
    for name in ("run_metrics", "run_costs", "task_scatter"):
        assert {r["run_id"] for r in out[name].collect()} == included


def test_status_classes(spark):
    states = {" failed ": "Failed", "aborted": "Cancelled", "Completed": "Succeeded", "": "Unknown", None: "Unknown", "fast_now": "Fast_Now", "run2x-late": "Run2X-Late"}
    rows = frame(spark, schemas.RUNS, [run(str(i), status=s) for i, s in enumerate(states)])
    out = {r["run_id"]: r["status_label"] for r in runs.with_status(rows).collect()}
    assert [out[str(i)] for i in range(len(states))] == list(states.values())


def test_run_links(spark):
    cases = [
        ("org/ws", "https://p.test/", "", "https://p.test/orgs/org/workspaces/ws/watch/r"), ("org/a/b", "https://p.test", None, "https://p.test/orgs/org/workspaces/a/b/watch/r"),
        ("org/ws", "https://p.test", " https://own.test/x ", "https://own.test/x"), ("org/ws", "https://p.test", "https://EXAMPLE.invalid/x", "https://p.test/orgs/org/workspaces/ws/watch/r"),
        ("external", "https://p.test", None, ""), (None, None, None, ""), ("org/ws", " ", "", ""),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "n int, workspace string, platform string, given string, want string")
    made = rows.withColumn("made", runs.run_link(F.lit("r"), F.col("workspace"), F.col("platform"), F.col("given")))
    assert made.filter(~F.col("made").eqNullSafe(F.col("want"))).collect() == []


def test_panels(spark):
    run_rows = [run("r1", "a"), run("r2", "b"), {**run("r3", "a"), "pipeline": "other"}]
    rows = [
        task("r1", "MULTIQC", group="a", realtime_ms=60000, wait_ms=10000), task("r1", "ALIGN", group="a", realtime_ms=120000, wait_ms=20000), task("r1", "ALIGN", group="a", status="CACHED"),
        task("r2", "ALIGN", group="b", realtime_ms=5000), task("r3", "", group="a", process_short="", realtime_ms=1000), task("r3", "NONE", group="z", realtime_ms=0),
    ]
    out = {r["panel_id"]: r for r in report(spark, run_rows, rows)["combined_task_runtime"].collect()}
    assert set(out) == {"pipe::a", "pipe::b", "other::a"}
    first = out["pipe::a"]
    assert (first["total_runtime_ms"], first["scheduling_runtime_ms"], first["total_duration_ms"], first["total_tasks"]) == (180000, 30000, 210000, 2)
    assert [(s["process"], s["pct"], s["highlight"]) for s in first["segments"]] == [("ALIGN", 66.67, False), ("MULTIQC", 33.33, True)]
    assert tuple(first["highlight_totals"]) == (60000, 120000)
    assert out["other::a"]["segments"][0]["process"] == "unknown"


def test_legend_rolls_up_small_processes(spark):
    rows = [task("r1", f"P{i:02}", realtime_ms=22000 - i, wait_ms=100 * i) for i in range(22)]
    panel = report(spark, [run("r1")], rows)["combined_task_runtime"].first()
    assert panel["unique_processes"] == len(panel["segments"]) == 22 and len(panel["legend"]) == 21
    last = panel["legend"][-1]
    assert (last["process"], last["runtime_ms"], last["highlight"]) == ("Other (2 small processes)", 22000 - 20 + 22000 - 21, False)
    twenty = runtime.legend(runtime.segments(runtime.process_runtime(frame(spark, schemas.TASKS, rows[:20]), frame(spark, schemas.RUNS, [run("r1")]))))
    assert twenty.count() == 20 and twenty.filter("process like 'Other%'").count() == 0


GIB = 1 << 30


def test_capacity_with_machines(spark):
    rows = [task("r1", "A", cpus=4, realtime_ms=3600000, pcpu=200.0, memory_bytes=8 * GIB, peak_rss=4 * GIB)]
    machine = [{"run_id": "r1", "n_machines": 2, "vm_cpu_h": 10.0, "vm_mem_gib_h": 20.0, "sched_alloc_cpu_efficiency": 80.0, "sched_alloc_mem_efficiency": 60.0}]
    r = report(spark, [run("r1")], rows, machine_rows=machine)["run_metrics"].first()
    assert (r["schedulerBookedCpuH"], r["schedulerBookedMemGibH"]) == (8.0, 12.0)
    assert (r["schedulerOverbookCpuH"], r["schedulerOverbookMemGibH"]) == (6.0, 8.0)
    assert (r["vmPackingSlackCpuH"], r["vmPackingSlackMemGibH"]) == (2.0, 8.0)
    assert (r["requestedVmCpuEfficiency"], r["requestedVmMemEfficiency"], r["realVmCpuEfficiency"], r["realVmMemEfficiency"]) == (40.0, 40.0, 20.0, 20.0)


def test_capacity_without_machines_or_tasks(spark):
    rows = [task("r1", "A", cpus=2, realtime_ms=3600000, pcpu=100.0, memory_bytes=4 * GIB, peak_rss=0, rss=2 * GIB)]
    out = {r["run_id"]: r for r in report(spark, [run("r1"), run("r2")], rows)["run_metrics"].collect()}
    assert (out["r1"]["schedulerBookedCpuH"], out["r1"]["schedulerBookedMemGibH"], out["r1"]["realMemGibH"]) == (2.0, 4.0, 2.0)
    assert out["r1"]["vmCpuH"] is None and out["r1"]["vmPackingSlackCpuH"] is None
    assert out["r2"]["requestedCpuH"] is None


def test_batch_and_scheduler_runs(spark):
    rows = [task(r, "A", cpus=4, realtime_ms=3600000, pcpu=p) for r, p in (("b", 300.0), ("s", 200.0))]
    machine = [
        {"run_id": "b", "n_machines": 1, "vm_cpu_h": 4.0, "vm_mem_gib_h": 8.0, "sched_alloc_cpu_efficiency": 100.0, "sched_alloc_mem_efficiency": 100.0},
        {"run_id": "s", "n_machines": 1, "vm_cpu_h": 6.0, "vm_mem_gib_h": 8.0, "sched_alloc_cpu_efficiency": 50.0, "sched_alloc_mem_efficiency": 50.0},
    ]
    out = {r["run_id"]: r for r in report(spark, [run("b"), run("s")], rows, machine_rows=machine)["run_metrics"].collect()}
    names = ("schedulerBookedCpuH", "schedulerRightsizedCpuH", "schedulerOverbookCpuH", "vmPackingSlackCpuH", "realVmCpuEfficiency")
    assert [out["b"][n] for n in names] == [4.0, 0.0, 1.0, 0.0, 75.0]
    assert [out["s"][n] for n in names] == [3.0, 1.0, 1.0, 3.0, 33.33]


def test_last_rows_win(spark):
    machines = spark.createDataFrame([("r1", 1, 1.0, 0), ("r1", 2, 2.0, 1)], "run_id string, n_machines long, vm_cpu_h double, at int")
    assert runs.last_by_run(machines, "at").first()["n_machines"] == 2


def test_last_rows_win_by_default(spark):
    late = [run("r1") | {"pipeline": "late"}, run("r1") | {"pipeline": "early"}]
    table = frame(spark, schemas.RUNS, late).withColumn("ordinal", F.when(F.col("pipeline") == "late", 2).otherwise(1))
    machines = spark.createDataFrame([("r1", 2, 2.0, 9), ("r1", 1, 1.0, 1)], "run_id string, n_machines long, vm_cpu_h double, ordinal int")
    assert runs.last_by_run(machines).first()["n_machines"] == 2
    out = build_report({"runs": table, "tasks": frame(spark, schemas.TASKS, [task("r1", "A", realtime_ms=1000)]), "costs": None})
    assert [r["pipeline"] for r in out["combined_task_runtime"].collect()] == ["late"]
    # ties keep the input's order; the order itself is no column of the report
    rows = ordered({"run_summary": out["run_summary"]})["run_summary"]
    assert [r["pipeline"] for r in rows.collect()] == ["early", "late"] and "ordinal" not in rows.columns
    assert ordered({"run_costs": out["run_costs"]})["run_costs"].count() == 1 and out["cost_overview"] is None


def test_rounding_is_that_of_the_binary_value(spark):
    r = random.Random(1)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, -2.5, 1e300, -0.5, 0.0, 1e15 + 0.5, 4503599627370497.5, 1.15, 1.25, 1.35]
    values += [r.randrange(10**6) / 1000 for _ in range(2000)] + [math.nextafter(r.randrange(10**5) / 200, r.choice([-1e9, 1e9])) for _ in range(2000)] + [r.uniform(-1e6, 1e6) for _ in range(500)]
    table = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    for digits in (0, 1, 2, 4):
        rows = table.select("x", S.rounded(F.col("x"), digits).alias("y")).collect()
        assert [x["y"] for x in rows] == [None if x["x"] is None else float(round(x["x"], digits)) for x in rows]


def test_process_stats_and_usage(spark):
    rows = [task("r1", "A", realtime_ms=60000, machine_type="m5"), task("r1", "A", realtime_ms=180000, machine_type=""), task("r1", "B", machine_type="m5"), task("r1", "B", status="CACHED")]
    table = frame(spark, schemas.TASKS, rows)
    out = {r["process_name"]: r for r in tasks.process_stats(table).collect()}
    assert out["A"]["n_tasks"] == 2 and out["A"]["avg_realtime_min"] == 2.0 and abs(out["A"]["sd_realtime_min"] - 2**0.5) < 1e-12
    assert out["B"]["n_tasks"] == 1 and out["B"]["sd_cost"] is None
    assert {tuple(r) for r in tasks.instance_usage(table).collect()} == {("cpu", "m5", 2)}


def test_task_table_keeps_raw_hash_and_own_cost(spark):
    row = tasks.task_table(frame(spark, schemas.TASKS, [task("r1", "A", h="ab/cdef1234", cost=3.0, memory_bytes=2_500_000_000)])).first()
    assert row["Taskhash"] == "ab/cdef12" and row["Cost"] == 3.0 and row["Memoryused_GB"] == 2.0
    assert len(row) == 22


def test_helpers(spark):
    one = spark.range(1)
    gap = lambda a, b: one.select(S.positive_gap(F.lit(a).cast("double"), F.lit(b).cast("double"))).first()[0]
    assert (gap(3, 1), gap(1, 3), gap(None, 1), gap(1, None)) == (2.0, 0.0, None, None)
    booked = lambda *x: one.select(S.booked_hours(*[F.lit(v).cast("double") for v in x])).first()[0]
    assert (booked(10, 80, 3), booked(10, 120, 3), booked(10, -5, 3), booked(None, 80, 3), booked(10, None, -3), booked(None, None, None)) == (8.0, 10.0, 0.0, 3.0, 0.0, None)
    ms = lambda a, b: one.select(S.duration_ms(F.lit(a), F.lit(b))).first()[0]
    assert ms("2024-01-01T00:00:00Z", "2024-01-01T00:00:10.500Z") == 10500
    assert ms("20240101T000000Z", "2024-01-01T01:00:00+01:00") == 0
    assert (ms(None, "2024-01-01T00:00:00Z"), ms("x", ""), ms("2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z")) == (0, 0, 0)
    value = lambda c: one.select(c).first()[0]
    assert (value(S.percent(F.lit(" 65% "))), value(S.percent(F.lit("x"))), value(S.safe_double(F.lit(None)))) == (65.0, 0.0, 0.0)
    assert value(S.normalized_hash(F.lit("ab/cdef1234"))) == "abcdef12"


def test_has_vm(spark):
    rows = spark.createDataFrame([(None,), (0.0,)], "vmCpuH double")
    assert capacity.has_vm(rows).first()[0] is False and capacity.has_vm(rows.limit(0)).first()[0] is False
    assert capacity.has_vm(rows.unionByName(spark.createDataFrame([(1.0,)], "vmCpuH double"))).first()[0] is True


def test_no_python_on_the_hot_path(spark):
    out = report(spark, [run("r1")], [task("r1", "A")], [cost("r1", "A", "abcdef12", 1.0, 1.0, 0.0)])
    for section in out.values():
        plan = section._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
