"""Readers, normalization, bill labels, manifest, archives, API and sinks."""

import io
import json
import sys
import tarfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from runscope.operators import bill_filter as bf
from runscope.operators import costs, machine_hours, normalize
from runscope.sources import bill as B
from runscope.sources import bundle, documents, folders, machines, manifest, run_api, schemas
from runscope.sources.order import file_order, numbered
from runscope.streaming import landing


def one_task(**more):
    base = {"name": "PROCESS_A", "process": "X:PROCESS_A", "hash": "ab/cd1234", "status": "COMPLETED", "cpus": 4, "memory": 8000000000, "peakRss": 4000000000, "realtime": 60000, "duration": 65000}
    return base | {"cost": 1.5, "submit": "2024-01-01T00:00:00Z", "start": "2024-01-01T00:00:10Z", "complete": "2024-01-01T00:01:20Z"} | more


def one_run(run_id="run1", tasks=(), progress=None, **workflow):
    base = {"id": run_id, "status": "SUCCEEDED", "repository": "https://host.test/org/pipe", "duration": 3600000, "revision": "main", "stats": {"succeedCount": 1, "failedCount": 0, "cachedCount": 2}}
    return {"meta": {"workspace": "org/ws", "group": "cpu"}, "workflow": base | workflow, "progress": {"workflowProgress": progress or {}}, "tasks": list(tasks), "metrics": [{"process": "A", "cpu": {"mean": 1, "max": 2.5}}]}


def write(folder, *runs):
    for i, r in enumerate(runs):
        (folder / f"run_{i}.json").write_text(json.dumps(r, indent=1))
    return str(folder)


def test_runs_from_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/no.json").write_text("{}")
    path = write(tmp_path, one_run(progress={"cpuEfficiency": 50.0, "cpuTime": 1000}, fusion={"enabled": True}, projectName=""), one_run("run2", [one_task(), one_task(status="FAILED", cpus=100)], nextflow={"version": "24"}))
    rows = {r["run_id"]: r for r in normalize.normalize_runs(documents.read_runs(spark, path)).collect()}
    assert set(rows) == {"run1", "run2"} and len(rows["run1"]) == 31  # and the ordinal
    first, second = rows["run1"], rows["run2"]
    assert (first["pipeline"], first["cached"], first["cpu_efficiency"], first["cpu_time_ms"], first["fusion_enabled"], first["run_url"], first["executor"]) == ("pipe", 2, 50.0, 1000, True, "", "")
    assert (second["cpu_time_ms"], second["memory_efficiency"], second["cpu_efficiency"], second["nextflow_version"]) == (240000, 50.0, 0.0, "24")


def test_tasks_from_documents(spark, tmp_path):
    tasks = [one_task(), {"task": one_task(status="CACHED", hash=None, process="")}, one_task(status="FAILED"), one_task(start=None, realtime=None)]
    rows = normalize.normalize_tasks(documents.read_runs(spark, write(tmp_path, one_run(tasks=tasks)))).collect()
    assert len(rows) == 3 and len(rows[0]) == 30
    by = {(r["status"], r["realtime_ms"]): r for r in rows}
    assert (by["COMPLETED", 60000]["wait_ms"], by["COMPLETED", 60000]["staging_ms"], by["COMPLETED", 60000]["process_short"]) == (10000, 10000, "PROCESS_A")
    assert (by["CACHED", 60000]["hash"], by["CACHED", 60000]["process_short"]) == ("", "")
    assert (by["COMPLETED", 0]["wait_ms"], by["COMPLETED", 0]["staging_ms"]) == (0, 0)


def test_metrics_from_documents(spark, tmp_path):
    row = normalize.normalize_metrics(documents.read_runs(spark, write(tmp_path, one_run()))).first()
    assert len(row) == 57 and (row["cpu_mean"], row["cpu_max"], row["cpu_q1"], row["timeUsage_max"]) == (1.0, 2.5, None, None)


def test_archives_and_merge(spark, tmp_path):
    path = tmp_path / "logs.tar.gz"
    with tarfile.open(path, "w:gz") as archive:
        for name, body in (("run1/a.json", one_run("inner")), ("run1/deep/b.json", one_run("deep")), ("run1/c.txt", "x")):
            data = json.dumps(body).encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    found = documents.read_archives(spark, str(path))
    assert [(r["file_name"], r["workflow"]["id"]) for r in found.collect()] == [("a.json", "inner")]
    (tmp_path / "dir").mkdir()
    (tmp_path / "dir/a.json").write_text(json.dumps(one_run("outer")))
    both = documents.merge(documents.read_runs(spark, str(tmp_path / "dir")), found)
    assert [r["workflow"]["id"] for r in both.collect()] == ["outer"]


FLAT = "resource_tags_user_unique_run_id string, resource_tags_user_pipeline_process string, resource_tags_user_task_hash string, split_line_item_split_cost double, split_line_item_unused_cost double"


def test_bill_of_flat_columns(spark):
    rows = [("run1", "PROC_A", "abcdef1234", 1.25, 0.25), ("run1", "PROC_A", "abcdef12zz", 2.75, 0.75), ("", "P", "x", 9.0, 9.0), (None, "P", "x", 9.0, 9.0)]
    out = costs.normalize_costs(spark.createDataFrame(rows, FLAT)).collect()
    assert [tuple(r) for r in out] == [("run1", "PROC_A", "abcdef12", 5.0, 4.0, 1.0)]


def test_bill_of_tag_pairs_and_maps(spark):
    names = {"run_id": "manual_run", "process": ["manual_process"], "task_hash": "manual_hash"}
    pairs = [["manual_run", "old"], ["manual_run", "run-map"], ["manual_process", "PROC_MAP"], ["manual_hash", "aa11bb22cc33"], ["odd"]]
    as_pairs = spark.createDataFrame([(pairs, 2.5, 0.5)], "resource_tags array<array<string>>, split_line_item_split_cost double, split_line_item_unused_cost double")
    assert [tuple(r) for r in costs.normalize_costs(as_pairs, names).collect()] == [("run-map", "PROC_MAP", "aa11bb22", 3.0, 2.5, 0.5)]
    as_map = spark.createDataFrame([({"user_unique_run_id": "r1"}, None, 2.0, 10.0)], "resource_tags map<string,string>, split_line_item_split_cost double, split_line_item_unused_cost double, line_item_unblended_cost double")
    assert [tuple(r) for r in costs.normalize_costs(as_map).collect()] == [("r1", "", "", 12.0, 10.0, 2.0)]
    structs = spark.createDataFrame([([("user_unique_run_id", "r1")], 1.0)], "resource_tags array<struct<key:string,value:string>>, split_line_item_split_cost double")
    assert costs.normalize_costs(structs).count() == 0


def test_label_map_rules(spark):
    assert B.label_aliases({"run_id": [" x ", "x", "user_unique_run_id"]})["run_id"] == ["x", "user_unique_run_id", "user_nf_unique_run_id"]
    for wrong in ({"unexpected": "v"}, {"run_id": 3}, {"run_id": ["a", 1]}, ["run_id"]):
        with pytest.raises(ValueError, match="unsupported fields|must be"):
            B.label_aliases(wrong)
    both = spark.createDataFrame([("default", "run-custom", 1.0)], "resource_tags_user_unique_run_id string, resource_tags_own string, split_line_item_split_cost double")
    assert costs.normalize_costs(both, {"run_id": "own"}).first()["run_id"] == "run-custom"


def test_bill_filter(spark, tmp_path):
    rows = [("r1", [["own", "r2"]], 1.0), ("r3", [["x", "y"]], 2.0), (None, None, 4.0)]
    bill = spark.createDataFrame(rows, "resource_tags_user_unique_run_id string, resource_tags array<array<string>>, line_item_unblended_cost double")
    named = spark.createDataFrame([("r1", "a", 0), ("r2", "b", 0), ("r2", "c", 1)], "id string, group string, at int")
    out = bf.filter_bill(bill, named, {"run_id": "own"}, "at")
    assert [(r["fixture_run_id"], r["fixture_group"], r["fixture_run_id_source"], r["line_item_unblended_cost"]) for r in out.collect()] == [("r2", "c", "resource_tags_user_unique_run_id", 1.0)]
    more = bf.with_synthetic_row(out)
    assert {tuple(r) for r in bf.summary(more).collect()} == {("r2", 1), ("red-herring-run-id", 1)}
    bf.write_filtered(out, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(ValueError, match="no bill rows"):
        bf.write_filtered(out.limit(0), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no run-id column"):
        bf.filter_bill(bill.select("line_item_unblended_cost"), named)


def test_machine_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("run_id,instance_id,vcpus,memory_gib,machine_hours,avg_cpu_utilization,avg_memory_utilization\nsched1,i-123,8,32,2,50%,25\n,i-9,8,32,2,50,25\n")
    (tmp_path / "b.csv").write_text("run_id,ecs_instance_id,total_vcpu_hours,total_memory_gib_hours,total_requested_vcpu_hours,requested_memory_gib_hours\nbatch1,ecs-456,6,24,3,12\n")
    (tmp_path / "c.csv").write_text("run_id,instance_id,ecs_instance_id,vcpus,memory_gib,machine_hours,avg_cpu_utilization,total_vcpu_hours\nboth,i-1,e-1,2,1,1,10,6\n")
    out = {r["run_id"]: r for r in machine_hours.summarise_machines(machines.read_machines(spark, str(tmp_path))).collect()}
    assert set(out) == {"sched1", "batch1", "both"}
    assert tuple(out["sched1"])[1:] == (1, 16.0, 64.0, 50.0, 25.0)
    assert tuple(out["batch1"])[1:] == (1, 6.0, 24.0, 50.0, 50.0)
    assert tuple(out["both"])[1:5] == (2, 8.0, 1.0, 10.0)


def test_manifest(spark, tmp_path):
    path = tmp_path / "runs.csv"
    path.write_text("id,workspace,group,logs\nrunAAAAAAAA1,external,cpu,logs/a.tar.gz\nrunAAAAAAAA2,org/ws,,\nx,org/ws,cpu,\nrunAAAAAAAA3,external,cpu,\nrunAAAAAAAA4,bad,cpu,\nrunAAAAAAAA5,external,g,/abs/dir\n")
    valid, rejected = manifest.read_manifest(spark, str(path))
    assert {r["id"]: r["errors"] for r in rejected.collect()} == {"x": ["id"], "runAAAAAAAA4": ["workspace"]}
    api, external, dropped = manifest.route(valid)
    assert [[r["id"][-1] for r in x.orderBy("id").collect()] for x in (api, external, dropped)] == [["2"], ["1", "5"], ["3"]]
    assert manifest.idle_api_runs(valid).first()[0] == 1
    paths = {r["id"][-1]: (r["logs_path"], r["logs_kind"]) for r in manifest.resolve_logs(external, "/data/").collect()}
    assert paths == {"1": ("/data/logs/a.tar.gz", "archive"), "5": ("/abs/dir", "directory")}


class Answers:
    """A transport with 130 tasks."""

    def __call__(self, url):
        if "/tasks?" in url:
            offset = int(url.rsplit("=", 1)[1])
            return {"tasks": [{"task": one_task(name=f"t{i}")} for i in range(offset, min(offset + 100, 130))]}
        if "/metrics" in url:
            return {"metrics": []}
        if "/progress" in url:
            return {"progress": {"workflowProgress": {"cpuTime": 7}}}
        return {"workflow": {"id": url.split("/workflow/")[1].split("?")[0], "status": "SUCCEEDED"}}


def test_run_api_source(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file
    spark.dataSource.register(run_api.run_source(Answers()))
    runs = json.dumps([["r1", 5, "https://api.test"], ["r2", 5, "https://api.test"]])
    raw = spark.read.format("runs").option("runs", runs).load().select(F.from_json("body", schemas.RUN).alias("r")).select("r.*")
    named = manifest.attach_meta(raw, spark.createDataFrame([("r1", "org/ws", "", None, None), ("r2", "org/ws", "g", None, None)], "id string, workspace string, group string, platform string, token_env string"))
    rows = {r["run_id"]: r for r in normalize.normalize_runs(named).collect()}
    assert (rows["r1"]["group"], rows["r2"]["group"], rows["r1"]["cpu_time_ms"]) == ("default", "g", 7)
    assert normalize.normalize_tasks(named).count() == 260
    known = spark.createDataFrame([("org", "ws", 5)], "org string, workspace string, workspace_id long")
    rows = spark.createDataFrame([("r1", "org/ws"), ("r2", "org/none")], "id string, workspace string")
    found, missing = run_api.workspace_ids(rows, known)
    assert [r["workspace_id"] for r in found.collect()] == [5] and [r["id"] for r in missing.collect()] == ["r2"]


def test_bundle_round_trip(spark, tmp_path):
    raw = documents.read_runs(spark, write(tmp_path, one_run(tasks=[one_task(cost=None)])))
    out = str(tmp_path / "bundle")
    bundle.write_bundle({"runs": normalize.normalize_runs(raw), "tasks": normalize.normalize_tasks(raw), "costs": None}, out)
    text = spark.read.text(f"{out}/tasks.jsonl").first()[0]
    assert json.loads(text)["cost"] is None and '"cost"' in text
    tables = bundle.read_bundle(spark, out)
    assert (tables["runs"].count(), tables["tasks"].count(), tables["costs"].count()) == (1, 1, 0)
    document = json.loads(bundle.report_document({"runs": tables["runs"], "cost_overview": None}))
    assert document["cost_overview"] is None and document["runs"][0]["run_id"] == "run1"
    with pytest.raises(ValueError, match="more than"):
        bundle.report_document({"runs": tables["runs"]}, most_rows=0)
    bundle.write_sections({"runs": tables["runs"], "none": None}, str(tmp_path / "sections"))
    assert spark.read.parquet(str(tmp_path / "sections/runs")).count() == 1


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    out = str(tmp_path / "rows")
    spark.range(1000).withColumn("key", F.xxhash64("id")).orderBy("key").write.parquet(out)
    rows = numbered(spark.read.parquet(out).withColumn("ordinal", file_order())).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["row_number"])] == [r["id"] for r in sorted(rows, key=lambda r: r["key"])]
    assert sorted(r["row_number"] for r in rows) == list(range(1, 1001))


def test_bundle_keeps_its_order_and_refuses_broken_lines(spark, tmp_path):
    runs = normalize.normalize_runs(documents.read_runs(spark, write(tmp_path, *(one_run(f"r{i}") for i in range(5)))))
    bundle.write_bundle({"runs": runs.withColumn("ordinal", -F.substring("run_id", 2, 1).cast("int"))}, str(tmp_path / "out"))
    back = bundle.read_bundle(spark, str(tmp_path / "out"))["runs"]
    assert [r["run_id"] for r in back.orderBy("ordinal").collect()] == ["r4", "r3", "r2", "r1", "r0"]
    broken = tmp_path / "broken" / "runs.jsonl"
    broken.mkdir(parents=True)
    (broken / "part-0.json").write_text("{not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        bundle.read_bundle(spark, str(tmp_path / "broken"))["runs"].collect()


def test_shared_folder_on_a_cluster_must_be_named():
    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        folders.shared_folder(Session())


def test_streamed_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "in", one_run(tasks=[one_task()]), one_run("run2", [one_task(), one_task()]))
    query = landing.normalized(landing.stream_runs(spark, path), "tasks").writeStream.format("memory").queryName("streamed_tasks").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("streamed_tasks").groupBy("run_id").count().orderBy("run_id").collect() == [("run1", 1), ("run2", 2)]


def test_entry_works_without_the_subpackage(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "run_costs" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(entry.oracle_sql()) <= names


def test_machine_headers_are_looked_up_in_tasks(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("\ufeffvcpus,run_id,vcpus,unknown\r\n".encode() + b'1,r1,"2",x\r\n\r\n3,"r,2"\r\n4,r3,5,6,7,8\r\n')
    (tmp_path / "only_header.csv").write_text("run_id,vcpus\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.txt").write_text("run_id\nno\n")
    (tmp_path / "same.csv").write_text("run_id,vcpus\nrun_id,vcpus\n")  # a row that looks like the header
    rows = machines.read_machines(spark, str(tmp_path))
    assert rows.columns == schemas.MACHINE_ROWS
    assert sorted((r["run_id"], r["vcpus"] or "") for r in rows.collect()) == [("r,2", ""), ("r1", "2"), ("r3", "5"), ("run_id", "vcpus")]


def test_many_machine_files_of_few_headers(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"m{i}.csv").write_text(["run_id,vcpus\n{0},1\n", "vcpus,run_id\n2,{0}\n", "x,y,run_id,vcpus\n,,{0},3\n"][i % 3].format(f"r{i}"))
    rows = machines.read_machines(spark, str(tmp_path))
    assert {(r["run_id"], r["vcpus"]) for r in rows.collect()} == {(f"r{i}", str(i % 3 + 1)) for i in range(300)}


def test_report_is_one_object_written_in_parts(spark, tmp_path):
    path = str(tmp_path / "report.json")
    many = spark.range(0, 5000, 1, 7).select("id", F.concat(F.lit('ü"\\\n,'), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 2 == 0, F.col("id") / 4).alias("half"))
    sections = {"many": many.orderBy(F.desc("id")), "none": None, "empty": many.limit(0), "one": many.filter("id = 7"), 'odd "name': many.filter("id < 2").orderBy("id").select(F.array("id").alias("list"), F.struct("id").alias("s"))}
    bundle.write_report(sections, path)
    with open(path) as file:
        got = json.load(file)
    assert list(got) == list(sections) and got["none"] is None and got["empty"] == [] and got["one"] == [{"id": 7, "text": 'ü"\\\n,7', "half": None}]
    assert [r["id"] for r in got["many"]] == list(range(4999, -1, -1)) and got["many"][-3] == {"id": 2, "text": 'ü"\\\n,2', "half": 0.5}
    assert got['odd "name'] == [{"list": [0], "s": {"id": 0}}, {"list": [1], "s": {"id": 1}}]
    rows = bundle.read_report(spark, path).collect()
    assert [(r["section"], r["place"], json.loads(r["body"])) for r in rows] == [(n, i, x) for n, v in got.items() for i, x in enumerate([None] if v is None else v, 1)]
    bundle.write_report({"one": many.filter("id = 8")}, path)  # takes the place of the other
    with open(path) as file:
        assert [r["id"] for r in json.load(file)["one"]] == [8]
    assert [p.name for p in tmp_path.iterdir()] == ["report.json"]


def test_a_filtered_bill_is_read_once_and_takes_its_place_when_it_has_rows(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    bill = spark.range(10).select(F.udf(seen, "long")("id").alias("id"))
    path = str(tmp_path / "bill")
    bf.write_filtered(bill, path)
    assert read.value == 10 and spark.read.parquet(path).count() == 10
    with pytest.raises(ValueError, match="no bill rows"):
        bf.write_filtered(bill.filter("id > 100"), path)
    assert spark.read.parquet(path).count() == 10
    bf.write_filtered(bill.filter("id > 7"), path)
    assert spark.read.parquet(path).count() == 2 and len(list(tmp_path.iterdir())) == 1


def test_folders_of_an_application_are_below_one(spark):
    one, two = folders.new_folder(spark, "a"), folders.new_folder(spark, "a")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0] and spark.sparkContext.applicationId in one
