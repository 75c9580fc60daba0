"""Star-schema tables as run documents, bill and machine rows: only names and derived columns, no rules of the report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.operators import costs, machine_hours, normalize
from runscope.sources import schemas

Which = Callable[[Column], Column]
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _struct(kind, **values: Column) -> Column:
    """A struct of a fixed type; fields that are not given are null."""
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.fields])


def orders(spark: SparkSession, sf_dir: str, which: Which | None = None) -> DataFrame:
    """Each order with its run's document, without tasks and metrics. which: a condition on the order's key."""
    o = table(spark, sf_dir, "orders")
    o = (o if which is None else o.filter(which(F.col("o_orderkey")))).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    double = lambda c: c.cast("double")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "O", "FAILED").otherwise("CANCELLED")
    workflow = _struct(
        schemas.WORKFLOW, id=key.cast("string"), status=status, userName=F.col("c_name"), projectName=F.when(key % 4 != 0, F.col("c_mktsegment")).otherwise(""),
        repository=F.concat(F.lit("https://host.test/org/"), F.col("c_mktsegment")), revision=F.concat(F.lit("r"), (key % 7).cast("string")), start=F.date_format("o_orderdate", ISO),
        duration=double((key % 1000) * 60000), containerEngine=F.lit("docker"), executor=F.lit("batch"), runUrl=F.when(key % 6 == 0, F.concat(F.lit("https://x.example.invalid/"), key.cast("string"))),
        url=F.when(key % 9 == 0, F.concat(F.lit("https://host.test/run/"), key.cast("string"))), nextflow=_struct(schemas.WORKFLOW["nextflow"].dataType, version=F.lit("25.04")),
        fusion=_struct(schemas.ENABLED, enabled=key % 2 == 0), stats=_struct(schemas.WORKFLOW["stats"].dataType, succeedCount=double(key % 10), failedCount=double(key % 3), cachedCount=double(customer % 5)),
    )
    progress = _struct(schemas.PROGRESS, cpuEfficiency=double(customer % 1000) / 10, memoryEfficiency=double(key % 997) / 10, cpuTime=double(customer * 12345), readBytes=double(key * 1000003), writeBytes=double(customer * 777777))
    meta = _struct(
        schemas.META, id=key.cast("string"), workspace=F.when(key % 5 == 0, "external").otherwise(F.concat(F.lit("org"), (customer % 3).cast("string"), F.lit("/ws"))),
        group=F.col("o_orderpriority"), platform=F.lit("https://platform.test/"),
    )
    engine = _struct(schemas.RUN["computeEnv"].dataType, executor=F.when(key % 3 == 0, "k8s"), region=F.lit("r1"))
    return o.select("o_orderkey", meta.alias("meta"), workflow.alias("workflow"), F.struct(progress.alias("workflowProgress")).alias("progress"), _struct(schemas.RUN["launch"].dataType).alias("launch"), engine.alias("computeEnv"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run documents without tasks."""
    out = orders(spark, sf_dir)
    return out.select("meta", "workflow", "progress", "launch", "computeEnv", F.lit(None).cast(schemas.RUN["tasks"].dataType).alias("tasks"), F.lit(None).cast(schemas.RUN["metrics"].dataType).alias("metrics"))


#: So many line items tell whether there is a bill, unless all of them lack a partner: then all are asked.
PROBED = 1000


def lines(spark: SparkSession, sf_dir: str, first: int | None = None, which: Which | None = None) -> DataFrame:
    """Each line item with what its task needs of order, part and supplier; orders come last, so rows are left dealt by their order.

    first: of so many line items only; which: a condition on the order's key, asked before rows are dealt.
    """
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    l = l if first is None else l.limit(first)  # noqa: E741
    l = l if which is None else l.filter(which(F.col("l_orderkey")))  # noqa: E741
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey).join(o, l.l_orderkey == o.o_orderkey)
    return rows.withColumns({"process": F.concat_ws(":", "p_type", "p_brand"), "md5": line_hash()})


def line_hash(of: Callable[[str], Column] = F.col) -> Column:
    return F.md5(F.concat_ws("-", of("l_orderkey").cast("string"), of("l_linenumber").cast("string")))


def task_object(line: Column) -> Column:
    """The task of a line (a struct of LINE_FIELDS) as documents hold it: that of every other one is wrapped."""
    flat = task_struct(line["l_extendedprice"], lambda name: line[name])
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TASK.fields]
    plain = lambda task: F.struct(*[task[f.name].alias(f.name) for f in schemas.TASK.fields], F.lit(None).cast(schemas.TASK).alias("task"))
    wrapped = lambda task: F.struct(*none, task.alias("task"))
    # a variable for the task, so that the plan names it and doesn't repeat it for each field
    return F.transform(F.array(flat), lambda task: F.when(line["l_linenumber"] % 2 == 0, wrapped(task)).otherwise(plain(task)))[0]


#: What a line's task and metric are made of: lists of lines hold these, not the wide objects.
LINE_FIELDS = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_returnflag l_shipdate o_orderdate p_size s_name process".split()


def task_struct(cost: Column, of: Callable[[str], Column] = F.col) -> Column:
    """The task object of a line; cost as given, decimal for exact sums. of: a field of the line, by name."""
    number = of("l_linenumber")
    ms = of("l_quantity") * 60000
    status = F.when(of("l_returnflag") == "R", "COMPLETED").when(of("l_returnflag") == "A", "CACHED").otherwise("FAILED")
    none = F.lit(0)
    complete = of("l_shipdate") + F.make_dt_interval(none, none, none, (of("l_quantity") * 60 + number * F.lit(0.5)).cast("decimal(18,6)"))
    md5 = line_hash(of)
    double = lambda c: c.cast("double")
    values = {
        "name": F.concat(of("process"), F.lit(" ("), number.cast("string"), F.lit(")")), "process": of("process"), "hash": F.concat(F.substring(md5, 1, 2), F.lit("/"), F.substring(md5, 3, 30)),
        "status": status, "submit": F.date_format(of("o_orderdate"), ISO), "start": F.date_format(of("l_shipdate"), ISO), "complete": F.date_format(complete, ISO), "executor": F.lit("batch"),
        "machineType": F.when(of("l_suppkey") % 10 == 0, "").otherwise(of("s_name")), "duration": ms + number * 1000, "realtime": ms, "cpus": double(number),
        "memory": of("p_size") * double(F.lit(1 << 30)), "pcpu": number * 100.0 / 7, "pmem": double(of("p_size")), "rss": of("p_size") * 5e8,
        "peakRss": F.when(number % 3 == 0, 0.0).otherwise(of("p_size") * 6e8), "readBytes": double(of("l_partkey") * 1000), "writeBytes": double(of("l_suppkey") * 1000), "cost": cost,
    }
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.TASK.fields])


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks table, costs in cents as decimals."""
    cost = F.col("l_extendedprice").cast("decimal(12,2)")
    rows = lines(spark, sf_dir).select(F.col("l_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("group"), task_struct(cost).alias("task"))
    return normalize.task_rows(rows)


def nested(spark: SparkSession, sf_dir: str, which: Which | None = None) -> DataFrame:
    """Run documents with tasks, every other one wrapped, and without progress. which: a condition on the order's key."""
    stat = lambda c: F.struct(*[(c + k).cast("double").alias(s) for k, s in enumerate(schemas.STATS)])
    metric = lambda line: _struct(schemas.METRIC, process=line["process"], cpu=stat(line["l_quantity"]), mem=stat(line["l_linenumber"]))
    arrays = lines(spark, sf_dir, which=which).groupBy("l_orderkey").agg(F.collect_list(F.struct(*[F.col(c) for c in LINE_FIELDS])).alias("_lines"))
    runs = orders(spark, sf_dir, which).withColumn("progress", F.lit(None).cast(schemas.RUN["progress"].dataType))
    docs = runs.join(arrays, runs.o_orderkey == arrays.l_orderkey, "left")
    return docs.withColumns({"tasks": F.transform("_lines", task_object), "metrics": F.transform("_lines", metric)}).drop("o_orderkey", "l_orderkey", "_lines")


def bill(spark: SparkSession, sf_dir: str, first: int | None = None) -> DataFrame:
    """A bill row for each line, with tags in flat columns and in a map; a third of the suppliers' rows carry a hash that no task has."""
    l = lines(spark, sf_dir, first).withColumn("md5", F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("z"), F.substring("md5", 2, 31))).otherwise(F.col("md5")))  # noqa: E741
    price, part = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_partkey") % 3
    run = F.col("l_orderkey").cast("string")
    process = F.when(part == 0, F.col("process")).when(part == 1, F.col("p_brand")).otherwise("")
    own = F.when(F.col("l_linenumber") % 2 == 0, run).otherwise("")
    return l.select(
        own.alias("resource_tags_user_unique_run_id"), process.alias("resource_tags_user_pipeline_process"), F.substring("md5", 1, 12).alias("resource_tags_user_task_hash"),
        F.create_map(F.lit("user_nf_unique_run_id"), run, F.lit("project"), F.lit("p1")).alias("resource_tags"), F.lit("Usage").alias("line_item_line_item_type"),
        F.when(F.col("l_linenumber") != 3, (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")).alias("split_line_item_split_cost"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("split_line_item_unused_cost"), price.cast("decimal(18,4)").alias("line_item_unblended_cost"),
    )


def machine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows, all strings: scheduler rows of odd lines, batch rows of even ones, both of each tenth."""
    l = lines(spark, sf_dir)  # noqa: E741
    number, text = F.col("l_linenumber"), lambda c: c.cast("string")
    scheduler = (number % 2 == 1) | (number % 10 == 0)
    values = {
        "run_id": F.concat(F.lit(" "), text(F.col("l_orderkey"))), "instance_id": F.when(scheduler, F.concat(F.lit("i-"), text(F.col("l_suppkey")))), "vcpus": text(number * 2),
        "memory_gib": text(number * 8), "machine_hours": text(F.col("l_quantity")), "avg_cpu_utilization": F.concat(text((F.col("l_discount") * 100).cast("decimal(6,0)")), F.lit("%")),
        "avg_memory_utilization": text((F.col("l_tax") * 100).cast("decimal(6,0)")), "ecs_instance_id": F.when(number % 2 == 0, F.concat(F.lit("e-"), text(F.col("l_suppkey")))),
        "total_vcpu_hours": text(F.col("l_quantity") * 2), "total_memory_gib_hours": text(F.col("l_quantity") * 4), "total_requested_vcpu_hours": F.when(number % 4 == 0, text(F.col("l_quantity"))).otherwise(""),
        "total_requested_memory_gib_hours": text(F.col("l_quantity") * 3), "requested_vcpu_hours": text(F.col("l_quantity") * 1.5), "requested_memory_gib_hours": F.lit("0"),
    }
    return l.select(*[c.alias(n) for n, c in values.items()])


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows of all orders, some of them malformed."""
    o = table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    return o.select(
        F.when(key % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("run"), F.lpad(text, 9, "0"))).alias("id"),
        F.when(key % 4 == 0, "external").when(key % 13 == 0, "no workspace").otherwise("org/ws").alias("workspace"), F.regexp_replace("o_orderpriority", "[^A-Za-z0-9 -]", "").alias("group"),
        F.when(key % 8 == 0, F.concat(F.lit("logs/"), text, F.lit(".tar.gz"))).when(key % 12 == 0, F.lit("a b")).alias("logs"), F.lit(None).cast("string").alias("machines"),
        F.when(key % 5 == 0, "ftp://platform.test").alias("platform"), F.lit("TOKEN_1").alias("token_env"),
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The normalized tables that a report is built from."""
    own = bill(spark, sf_dir)
    return {
        "runs": normalize.normalize_runs(documents(spark, sf_dir)),
        "tasks": tasks(spark, sf_dir),
        "costs": costs.normalize_costs(own),
        "bill_rows": costs.bill_rows(own),
        "some_bill_rows": costs.bill_rows(bill(spark, sf_dir, PROBED)),
        "machines": machine_hours.summarise_machines(machine_rows(spark, sf_dir)),
    }
