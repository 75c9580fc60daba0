"""The run API by pages, over HTTP."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from runscope.operators import normalize
from runscope.sources import run_api, schemas

SIZES = {"big": 100_000, "none": 0, "one": 1, "full": 100, "odd": 2050}


class Answers(BaseHTTPRequestHandler):
    asked: list[str] = []

    def do_GET(self):
        Answers.asked.append(self.path)
        url = urlparse(self.path)
        _, _, run, *what = url.path.split("/")
        if what == ["tasks"]:
            q = {k: int(v[0]) for k, v in parse_qs(url.query).items()}
            body = {"tasks": [{"task": {"name": f"{run} {i}", "status": "COMPLETED", "realtime": i}} for i in range(q["offset"], min(SIZES[run], q["offset"] + q["max"]))]}
        else:
            body = {"metrics": []} if what == ["metrics"] else {"progress": {"workflowProgress": {"cpuTime": 5}}} if what else {"workflow": {"id": run, "status": "SUCCEEDED"}}
        raw = json.dumps(body).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def endpoint():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


@pytest.fixture(scope="module")
def headers(spark, endpoint, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("headers") / "h")
    runs = spark.createDataFrame([(r, 7, endpoint) for r in SIZES], "run_id string, workspace_id long, endpoint string")
    run_api.read_headers(runs, run_api.Http()).write.parquet(path)
    return spark.read.parquet(path)


def test_pages_are_counted_in_few_requests(headers):
    assert {r["run_id"]: r["pages"] for r in headers.collect()} == {"big": 1001, "none": 1, "one": 1, "full": 2, "odd": 21}
    assert sum("big/tasks" in p for p in Answers.asked) < 25
    row = headers.filter("run_id = 'odd'").first()
    assert json.loads(row["body"])["progress"] == {"workflowProgress": {"cpuTime": 5}}


def test_a_large_run_is_spread_over_tasks(spark, headers):
    tasks = run_api.read_tasks(headers, run_api.Http())
    own = tasks.select("run_id", F.lit("g").alias("group"), normalize.unwrap(F.from_json("body", schemas.TASK_OR_WRAPPED)).alias("task"), F.spark_partition_id().alias("at")).cache()
    got = {r["run_id"]: r for r in own.groupBy("run_id").agg(F.count("*").alias("n"), F.count_distinct("task.name").alias("names"), F.sum("task.realtime").alias("s"), F.count_distinct("at").alias("parts")).collect()}
    assert {k: (r["n"], r["names"], r["s"]) for k, r in got.items()} == {k: (n, n, n * (n - 1) / 2) for k, n in SIZES.items() if n}
    assert got["big"]["parts"] > 1
    assert normalize.task_rows(own.select("run_id", "group", "task")).count() == sum(SIZES.values())
    own.unpersist()


def test_only_the_runs_of_a_filter_are_asked_for(headers):
    Answers.asked.clear()
    assert run_api.read_tasks(headers.filter("run_id = 'full'"), run_api.Http()).count() == 100
    assert {p.split("/")[2] for p in Answers.asked} == {"full"} and len(Answers.asked) == 2


def test_tasks_added_since_are_read(spark, headers, endpoint):
    few = headers.filter("run_id = 'odd'").withColumn("pages", F.lit(3).cast("long"))
    assert run_api.read_tasks(few, run_api.Http(), pages_together=2).count() == SIZES["odd"]


def test_bucket_keeps_the_rate():
    now = [0.0]
    bucket = run_api.Bucket(2.0, 3, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    at = []
    for _ in range(9):
        bucket.wait()
        at.append(now[0])
    assert at == [0, 0, 0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0]
    now[0] = 100
    bucket.wait()
    assert now[0] == 100 and bucket.left == 2
