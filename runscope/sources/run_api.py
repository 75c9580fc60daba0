"""Runs from a web API: whole, as a Python data source with a partition for each run, or by pages.

For each run: its workflow with progress, its metrics, and its tasks in pages of 100 until a page is short. The transport is any
callable (url) -> dict that can be pickled, so tests need no network.

By pages (`read_headers`, `read_tasks`), a run's document without its tasks is fetched first, with the number of its pages; then ranges
of pages are dealt to tasks, which hold a page at a time, so a run of a million tasks is spread over the cluster. Both start from a
table of runs, so a filter on it is a filter on what is asked of the API. Each task keeps to a rate of requests (`Bucket`).
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 100


@dataclass(frozen=True)
class Http:
    """GET of a JSON document with a bearer token, tried `attempts` times."""

    token: str = ""
    attempts: int = 3

    def __call__(self, url: str) -> dict:
        for attempt in range(self.attempts):
            try:
                request = urllib.request.Request(url, headers={"Authorization": f"Bearer {self.token}", "Accept": "application/json"})
                with urllib.request.urlopen(request, timeout=60) as answer:
                    return json.load(answer)
            except OSError:
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(2**attempt)
        raise ValueError("attempts must be at least 1")


def fetch_tasks(get: Callable[[str], dict], base: str, workspace_id: int) -> list[dict]:
    """All tasks of a run, page after page."""
    tasks: list[dict] = []
    while True:
        page = get(f"{base}/tasks?workspaceId={workspace_id}&max={PAGE}&offset={len(tasks)}").get("tasks", [])
        tasks += page
        if len(page) < PAGE:
            return tasks


def fetch_run(get: Callable[[str], dict], endpoint: str, run_id: str, workspace_id: int) -> dict:
    """The run's document without meta."""
    return fetch_header(get, endpoint, run_id, workspace_id) | {"tasks": fetch_tasks(get, base_of(endpoint, run_id), workspace_id)}


def base_of(endpoint: str, run_id: str) -> str:
    return f"{endpoint.rstrip('/')}/workflow/{run_id}"


def fetch_header(get: Callable[[str], dict], endpoint: str, run_id: str, workspace_id: int) -> dict:
    """The run's document without meta and tasks."""
    base, at = base_of(endpoint, run_id), f"?workspaceId={workspace_id}"
    run = get(base + at)
    return {
        "workflow": run.get("workflow", {}), "launch": run.get("launch") or {}, "computeEnv": run.get("computeEnv") or {}, "metrics": get(f"{base}/metrics{at}").get("metrics", []),
        "progress": get(f"{base}/progress{at}").get("progress", {}),
    }


@dataclass
class Bucket:
    """At most `rate` requests a second in the long run, and `burst` at once; a rate of 0 is no limit."""

    rate: float = 0.0
    burst: int = 5
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    left: float = field(init=False)
    seen: float = field(init=False)

    def __post_init__(self):
        self.left, self.seen = float(self.burst), self.clock()

    def wait(self) -> None:
        if not self.rate:
            return
        now = self.clock()
        self.left, self.seen = min(self.burst, self.left + (now - self.seen) * self.rate), now
        if self.left < 1:
            self.sleep((1 - self.left) / self.rate)
            self.left, self.seen = 1.0, self.clock()
        self.left -= 1


def limited(get: Callable[[str], dict], rate: float) -> Callable[[str], dict]:
    """get, no faster than rate."""
    bucket = Bucket(rate)

    def run(url: str) -> dict:
        bucket.wait()
        return get(url)

    return run


def fetch_page(get: Callable[[str], dict], base: str, workspace_id: int, page: int) -> list[dict]:
    return get(f"{base}/tasks?workspaceId={workspace_id}&max={PAGE}&offset={page * PAGE}").get("tasks") or []


def count_pages(get: Callable[[str], dict], base: str, workspace_id: int) -> int:
    """Pages of a run up to the first short one, found in about twice the logarithm of their number of requests: the API names no total."""
    full = lambda page: len(fetch_page(get, base, workspace_id, page)) == PAGE
    beyond = 1
    while full(beyond - 1):
        beyond *= 2
    low, high = beyond // 2, beyond - 1  # pages before low are full, high is not
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if full(middle) else (low, middle)
    return low + 1


def read_headers(runs: DataFrame, get: Callable[[str], dict], rate: float = 0.0) -> DataFrame:
    """runs (run_id, workspace_id, endpoint) with body, the run's document without tasks as JSON, and pages. Keep the result: reading it again asks again."""

    def run(batches):
        asked = limited(get, rate)
        for batch in batches:
            bodies, pages = [], []
            for row in batch.to_pylist():
                bodies.append(json.dumps(fetch_header(asked, row["endpoint"], row["run_id"], row["workspace_id"])))
                pages.append(count_pages(asked, base_of(row["endpoint"], row["run_id"]), row["workspace_id"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.string()), pa.array(pages, pa.int64())], names=[*batch.schema.names, "body", "pages"])

    own = runs.select(F.col("run_id").cast("string"), F.col("workspace_id").cast("long"), F.col("endpoint").cast("string"))
    return own.mapInArrow(run, "run_id string, workspace_id long, endpoint string, body string, pages long")


def read_tasks(headers: DataFrame, get: Callable[[str], dict], pages_together: int = 50, rate: float = 0.0) -> DataFrame:
    """(run_id, page, body: a task's JSON) of all runs of read_headers; ranges of pages_together pages are dealt over the cluster.

    The last range of a run goes on until a page is short, should tasks have been added since its pages were counted.
    """

    def run(batches):
        asked = limited(get, rate)
        for batch in batches:
            for row in batch.to_pylist():
                base, page = base_of(row["endpoint"], row["run_id"]), row["first"]
                while True:
                    tasks = fetch_page(asked, base, row["workspace_id"], page)
                    n = len(tasks)
                    yield pa.RecordBatch.from_arrays([pa.array([row["run_id"]] * n, pa.string()), pa.array([page] * n, pa.int64()), pa.array([json.dumps(t) for t in tasks], pa.string())], names=["run_id", "page", "body"])
                    page += 1
                    if n < PAGE or (page == row["first"] + pages_together and not row["last"]):
                        break

    ranges = headers.withColumn("first", F.explode(F.expr(f"sequence(0L, pages - 1, {pages_together}L)"))).withColumn("last", F.col("first") + pages_together >= F.col("pages"))
    dealt = ranges.select("run_id", "workspace_id", "endpoint", "first", "last")
    # as many tasks as the session shuffles to: rows of ranges are small, and adaptive execution would put them all into one
    dealt = dealt.repartition(int(headers.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("run_id", "first"))
    return dealt.mapInArrow(run, "run_id string, page long, body string")


@dataclass
class OneRun(InputPartition):
    run_id: str
    workspace_id: int
    endpoint: str


def run_source(get: Callable[[str], dict]) -> type[DataSource]:
    """A data source named `runs` that asks `get`; option runs: JSON list of [run id, workspace id, endpoint]."""

    class Reader(DataSourceReader):
        def __init__(self, runs: list):
            self.runs = runs

        def partitions(self):
            return [OneRun(*r) for r in self.runs]

        def read(self, partition) -> Iterator[tuple]:
            if partition is not None and getattr(partition, "run_id", None):
                yield partition.run_id, json.dumps(fetch_run(get, partition.endpoint, partition.run_id, partition.workspace_id))

    class Runs(DataSource):
        @classmethod
        def name(cls) -> str:
            return "runs"

        def schema(self) -> str:
            return "run_id string, body string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(json.loads(self.options["runs"]))

    return Runs


def workspace_ids(manifest: DataFrame, workspaces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(API runs with workspace_id, rows whose workspace is unknown). workspaces: org, workspace, workspace_id."""
    parts = F.split("workspace", "/", 2)
    rows = manifest.withColumns({"_org": parts[0], "_name": F.get(parts, 1)})
    known = workspaces.select(F.col("org").alias("_org"), F.col("workspace").alias("_name"), "workspace_id").dropDuplicates(["_org", "_name"])
    found = rows.join(known, ["_org", "_name"]).drop("_org", "_name")
    return found, rows.join(known, ["_org", "_name"], "left_anti").drop("_org", "_name")
