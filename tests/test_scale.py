"""What keeps the report's inputs and outputs from growing faster than their rows."""

import gzip
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators import costs, machine_hours
from runscope.plans import driver_tables, io_queries, report
from runscope.sources import bundle, documents, files, parts, run_api, schemas


def test_a_bundle_is_packed(spark, tmp_path):
    rows = spark.range(2000).select(F.lit("r1").alias("run_id"), F.lit("g").alias("group"), F.lit("p").alias("process"))
    nulls = [F.lit(None).cast("double").alias(f"{m}_{s}") for m in schemas.METRICS for s in schemas.STATS]
    bundle.write_bundle({"metrics": rows.select("*", *nulls)}, str(tmp_path))
    files_ = [p for p in (tmp_path / "metrics.jsonl").iterdir() if p.name.startswith("part-")]
    assert sum(p.stat().st_size for p in files_) < 200_000  # 2.6 MB as plain text
    assert bundle.read_bundle(spark, str(tmp_path))["metrics"].count() == 2000


def test_documents_in_lines(spark, tmp_path):
    rows = [json.dumps({"workflow": {"id": f"r{i}"}, "meta": {"group": "g"}}) for i in range(50)]
    docs = spark.createDataFrame([(r,) for r in rows], "body string").select(F.from_json("body", schemas.RUN).alias("d")).select("d.*")
    documents.write_lines(docs.coalesce(2), str(tmp_path / "docs"))
    assert len([p for p in (tmp_path / "docs").iterdir() if p.name.startswith("part-")]) <= 2
    got = documents.read_lines(spark, str(tmp_path / "docs"))
    assert {(r["workflow"]["id"], r["file_name"]) for r in got.collect()} == {(f"r{i}", f"r{i}.json") for i in range(50)}
    assert documents.merge(got, got).count() == 50
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken/a.json").write_text('{"workflow": {"id": "r1"}}\n{"workflow"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.read_lines(spark, str(tmp_path / "broken")).collect()


def test_packed_documents_are_streams_too(spark, tmp_path):
    body = json.dumps({"workflow": {"id": "r1"}, "meta": {"group": "g"}, "tasks": [{"name": f"t{i}", "status": "COMPLETED"} for i in range(300)]})
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "b.json").write_text(body)
    got = parts.read_parts(spark, [str(tmp_path)])
    assert {(r["file_name"], r["count"]) for r in got.groupBy("file_name").count().collect()} == {("a.json", 301), ("b.json", 301)}
    sizes = dict((Path(p).name, n) for p, n in files.documents_in(str(tmp_path)))
    assert sizes["a.json.gz"] == (tmp_path / "a.json.gz").stat().st_size * files.UNPACKED


def test_ranges_of_pages_are_dealt_to_all_tasks(spark):
    """Their rows are small: adaptive execution would put all of them into one task."""
    headers = spark.createDataFrame([(f"r{i}", 1, "https://api.test", 400) for i in range(5)], "run_id string, workspace_id long, endpoint string, pages long")
    tasks = run_api.read_tasks(headers, lambda url: {"tasks": [{"name": url}]}, pages_together=10)
    assert len({r["p"] for r in tasks.select(F.spark_partition_id().alias("p")).collect()}) > 1


def test_a_machine_row_is_read_once(spark):
    rows = spark.createDataFrame([("r1", "i-1", "2", "3", "e-1", "5"), ("r1", None, None, None, "e-2", "7"), ("", "i-2", "1", "1", None, None)], "run_id string, instance_id string, vcpus string, machine_hours string, ecs_instance_id string, total_vcpu_hours string")
    rows = rows.select("*", *[F.lit(None).cast("string").alias(n) for n in schemas.MACHINE_ROWS if n not in rows.columns])
    out = machine_hours.summarise_machines(rows)
    assert [(r["run_id"], r["n_machines"], r["vm_cpu_h"]) for r in out.collect()] == [("r1", 3, 18.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("LogicalRDD") == 1


def test_rounding_off_ties_is_short(spark):
    """Generated code beyond 8,000 bytes is not compiled by the JVM: the error of a product is left to a variable, for ties alone."""
    rows = spark.createDataFrame([(2.675,), (-0.001,), (0.125,), (-2.5,), (None,), (float("inf"),)], "x double")
    out = rows.select(S.rounded(F.col("x"), 2).alias("r"))
    assert [str(r["r"]) for r in out.collect()] == ["2.67", "0.0", "0.12", "-2.5", "None", "inf"]
    assert out._jdf.queryExecution().optimizedPlan().toString().split("lambdafunction")[0].count("x#") <= 12


def test_costs_are_dealt_once_for_their_sums_and_maps(spark):
    tasks = spark.createDataFrame([("r1", "a:B", "B", "ab/cdef12", 1.0)], "run_id string, process string, process_short string, hash string, cost double")
    bill = spark.createDataFrame([("r1", "B", "abcdef12", 2.0, 2.0, 0.0), ("r1", "B", "abcdef12", 3.0, 3.0, 0.0)], "run_id string, process string, hash string, cost double, used_cost double, unused_cost double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = costs.attribute_costs(tasks, bill)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # the tasks' and the costs'
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r["total"] for r in out.collect()] == [5.0]


def test_few_bill_rows_are_asked_first(spark):
    asked = spark.sparkContext.accumulator(0)
    seen = spark.createDataFrame([("r1",)], "run_id string").rdd.map(lambda r: asked.add(1) or r).toDF("run_id string")
    assert costs.has_rows(spark.range(1), seen) and asked.value == 0
    assert costs.has_rows(None, spark.range(0), seen) and not costs.has_rows(None, spark.range(0))


def test_a_report_is_read_by_blocks(spark, tmp_path):
    """Each task reads lines of its own block of the file, whatever sections it holds."""
    path, rows = str(tmp_path / "report.json"), spark.range(0, 4000, 1, 3).select("id", F.repeat(F.lit("x"), 50).alias("text"))
    sections = {"first": rows.orderBy("id"), "none": None, "empty": rows.limit(0), "last": rows.orderBy(F.desc("id"))}
    bundle.write_report(sections, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = bundle.read_report(spark, path)
        assert got.rdd.getNumPartitions() > 10
        found = [(r["section"], r["place"], None if r["body"] == "null" else json.loads(r["body"])["id"]) for r in got.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(found[:], key=lambda r: r[:2]) == [("first", i + 1, i) for i in range(4000)] + [("last", i + 1, 3999 - i) for i in range(4000)] + [("none", 1, None)]


def test_tables_of_several_sections_are_kept_once(spark):
    names = []
    tables = driver_tables.tables(spark, "/root/testdata/sf0.001")
    sections = report.build_report(tables, keep=lambda rows, name: names.append(name) or rows)
    assert names == [] and all(rows is not None for rows in sections.values())
    assert sorted(names) == ["attributed-tasks", "classed-runs", "own-tasks"]


def test_stamps_of_other_forms_add_little_code(spark):
    """What reads them is in the plan once for each use, as a function of a variable."""
    rows = spark.createDataFrame([("1995-W10-3T05,25+0130",), ("19950102T030405-0830",), ("1995-02-30",), (",,,,,,,,,,,,,,",), (None,)], "s string")
    out = rows.select(F.unix_micros(S.parse_timestamp(F.col("s"))).alias("m"))
    assert [r["m"] for r in out.collect()] == [794633400250000, 789046445000000, None, None, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().split("transform(")[0].count("s#") <= 8


def test_exact_costs_are_two_sums(spark):
    """The sum of both amounts follows from theirs; that of doubles is summed by itself, as its roundings differ."""
    for kind, sums in (("decimal(18,4)", 2), ("double", 3)):
        bill = spark.createDataFrame([("r1", "1.5", "0.25"), ("r1", None, "0.5")], "resource_tags_user_unique_run_id string, split string, unused string")
        bill = bill.select("resource_tags_user_unique_run_id", F.col("split").cast(kind).alias("split_line_item_split_cost"), F.col("unused").cast(kind).alias("split_line_item_unused_cost"), F.lit(2).cast(kind).alias("line_item_unblended_cost"))
        out = costs.normalize_costs(bill)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("sum(") == sums
        assert [tuple(map(float, r)) for r in out.select(*costs.AMOUNTS).collect()] == [(4.25, 3.5, 0.75)]


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for i in range(blocks.size()) if (n := str(blocks.apply(i))).startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark, tmp_path):
    """They would stay until the driver collects its garbage, those of all tables of a bundle at once."""
    before = shuffle_files(spark)
    run = F.concat(F.lit("r"), (F.col("id") % 50).cast("string")).alias("id")
    docs = spark.range(5000).select(F.struct(run).alias("workflow")).groupBy("workflow").count()
    held = [docs.repartition(3)]
    documents.write_lines(held[0], str(tmp_path / "docs"))
    bundle.write_bundle({"runs": docs.select("workflow.id")}, str(tmp_path / "bundle"))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert documents.read_lines(spark, str(tmp_path / "docs")).count() == 50


def test_runs_are_merged_without_their_tasks(spark, monkeypatch):
    """Of each document only its row is dealt by the file's name."""
    merged = documents.merge
    monkeypatch.setattr(documents, "merge", lambda *sources: [s for s in sources if {"tasks", "metrics"} & set(s.columns)] or merged(*sources))
    out = io_queries.run_merge(spark, "/root/testdata/sf0.001")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert out.count() == orders == out.select("run_id").distinct().count()


def test_a_packed_report_is_read_by_members(spark, tmp_path, monkeypatch):
    """It is one gzip file and one JSON object, its parts are packed too and go, and tasks read members of it."""
    monkeypatch.setattr(bundle, "MEMBER", 10_000)
    path, rows = str(tmp_path / "report.json.gz"), spark.range(0, 4000, 1, 3).select("id", F.repeat(F.lit("x,\n\"]é"), 50).alias("text"), F.lit(None).cast("string").alias("a b"))
    sections = {"first": rows.orderBy("id"), "none": None, "empty": rows.limit(0), "one \"": rows.filter("id = 7"), "last": rows.orderBy(F.desc("id"))}
    homes = set(Path(bundle.new_folder(spark, "x")).parent.iterdir())
    bundle.write_report(sections, path)
    assert set(Path(bundle.new_folder(spark, "x")).parent.iterdir()) == homes and [p.name for p in tmp_path.iterdir()] == ["report.json.gz"]
    whole = json.loads(gzip.decompress(Path(path).read_bytes()))
    assert list(whole) == list(sections) and [r["id"] for r in whole["last"]] == list(range(3999, -1, -1)) and whole["none"] is None and whole["empty"] == []
    assert whole["one \""] == [{"id": 7, "text": "x,\n\"]é" * 50, "a b": None}] and Path(path).stat().st_size < 200_000
    got = bundle.read_report(spark, path)
    found = sorted((r["section"], r["place"], None if r["body"] == "null" else json.loads(r["body"])) for r in got.filter("section <> 'none'").collect())
    assert found == sorted((n, i + 1, r) for n, own in whole.items() for i, r in enumerate(own or ()))
    assert [(r["place"], r["body"]) for r in got.filter("section = 'none'").collect()] == [(1, "null")]
    assert "RoundRobinPartitioning" in got._jdf.queryExecution().executedPlan().toString()
