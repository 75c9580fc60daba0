"""The ten report sections from the normalized tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runscope.operators import capacity, costs, runs, runtime, tasks

# The order of each section's rows; of equal ones the input's order holds where it is known.
ORDERS = {
    "benchmark_overview": ["pipeline", "group", "ordinal", "run_id"], "run_summary": ["group", "ordinal", "run_id"], "run_metrics": ["group", "ordinal", "run_id"],
    "run_costs": ["group", "ordinal", "run_id"], "process_stats": ["-avg_runtime_min", "group", "process_name", "process_short"], "combined_task_runtime": ["pipeline", "group"],
    "task_instance_usage": ["group", "-count", "machine_type"], "task_table": ["Group", "Task name short", "Task name", "Run ID", "Taskhash"], "task_scatter": ["process_short", "run_id", "name"],
    "cost_overview": ["-total_cost", "group", "process_short"],
}


Keep = Callable[[DataFrame, str], DataFrame]


class Report(Mapping):
    """Sections by name, each planned when it is asked for: only the two about costs need to know whether there are any."""

    def __init__(self, tables: dict[str, DataFrame | None], include_failed_runs: bool = False, ordinal: str | None = None, keep: Keep | None = None):
        self.tables, self.ordinal, self.include_failed_runs, self.keep = tables, ordinal, include_failed_runs, keep or (lambda rows, name: rows)
        self.sections: dict[str, Callable[[], DataFrame | None]] = {
            "benchmark_overview": lambda: runs.benchmark_overview(self.classed),
            "run_summary": lambda: runs.run_summary(self.classed),
            "run_metrics": self.run_metrics,
            "run_costs": lambda: costs.run_costs(runs.included(self.classed), self.attributed, self.has_costs),
            "process_stats": lambda: tasks.process_stats(self.own),
            "combined_task_runtime": lambda: runtime.combined_runtime(runtime.process_runtime(self.own, self.classed, ordinal)),
            "task_instance_usage": lambda: tasks.instance_usage(self.own),
            "task_table": lambda: tasks.task_table(self.own),
            "task_scatter": lambda: tasks.task_scatter(self.own),
            "cost_overview": lambda: costs.cost_overview(self.attributed, self.has_costs),
        }

    @cached_property
    def classed(self) -> DataFrame:
        return self.keep(runs.with_status(self.tables["runs"], self.include_failed_runs), "classed-runs")

    @cached_property
    def own(self) -> DataFrame:
        return self.keep(runs.of_included(self.tables["tasks"], self.classed), "own-tasks")

    @cached_property
    def has_costs(self) -> bool:
        return costs.has_rows(self.tables.get("some_bill_rows"), self.tables.get("bill_rows", self.tables.get("costs")))

    @cached_property
    def attributed(self) -> DataFrame:
        return self.keep(costs.attribute_costs(self.own, self.tables["costs"] if self.has_costs else None), "attributed-tasks")

    def run_metrics(self) -> DataFrame:
        metrics, machines = runs.run_metrics(self.classed), self.tables.get("machines")
        if machines is not None:
            metrics = capacity.with_machines(metrics, machines, self.ordinal)
        else:
            kinds = {n: "long" if n == "nMachines" else "double" for n in capacity.MACHINE_COLUMNS.values()}
            metrics = metrics.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items()})
        return capacity.capacity(metrics, capacity.task_resource_hours(self.own))

    def __getitem__(self, name: str) -> DataFrame | None:
        return self.sections[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.sections)

    def __len__(self) -> int:
        return len(self.sections)


def build_report(tables: dict[str, DataFrame | None], include_failed_runs: bool = False, ordinal: str | None = None, keep: Keep | None = None) -> Report:
    """Sections by name. tables: runs, tasks, costs, machines; costs or machines may be missing. Rows come in no order (see ordered).

    bill_rows, if given, are what costs were summed from: cheaper to ask whether there are any; some_bill_rows, a few of them, are asked first. ordinal: a column of runs and machines
    that tells their order, by default `ordinal` where they have it; of runs and machines in several rows the last counts.
    keep: stores the tables (given with a name) that several sections read, for reports of many sections; without it each section works them out again.
    """
    return Report(tables, include_failed_runs, ordinal, keep)


def ordered(sections: Mapping[str, DataFrame | None]) -> dict[str, DataFrame | None]:
    """Sections in the report's order: a range sort each, for those who need it."""

    def by(name: str):
        return F.desc(name[1:]) if name.startswith("-") else F.asc_nulls_last(f"`{name}`") if name == "ordinal" else F.asc(f"`{name}`")

    out = {}
    for name in sections:
        rows = sections[name]
        out[name] = rows if rows is None else rows.orderBy(*[by(c) for c in ORDERS[name] if c != "ordinal" or c in rows.columns]).drop("ordinal")
    return out
