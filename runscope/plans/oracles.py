"""DuckDB SQL of the registered report queries, on the driver's tables. Common tables come as a prefix."""

from __future__ import annotations


def half_even(value: str, digits: int) -> str:
    """SQL that rounds the binary value of a double half to even: formatting does that."""
    return f"CAST(format('{{:.{digits}f}}', CAST({value} AS DOUBLE)) AS DOUBLE)"


ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"

TABLES = f"""
WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS "group", c_mktsegment AS pipeline, '' AS run_name, c_name AS username,
    CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'FAILED' ELSE 'CANCELLED' END AS status, strftime(o_orderdate, {ISO}) AS "start", CAST(NULL AS VARCHAR) AS complete,
    (o_orderkey % 1000) * 60000 AS duration_ms, o_orderkey % 10 AS succeeded, o_orderkey % 3 AS failed, o_custkey % 5 AS cached, (o_custkey % 1000) / 10 AS cpu_efficiency,
    (o_orderkey % 997) / 10 AS memory_efficiency, o_custkey * 12345 AS cpu_time_ms, o_orderkey * 1000003 AS read_bytes, o_custkey * 777777 AS write_bytes, o_orderkey % 2 = 0 AS fusion_enabled,
    false AS wave_enabled, '' AS command_line, 'r' || (o_orderkey % 7) AS revision, 'docker' AS container_engine, '25.04' AS nextflow_version,
    CASE WHEN o_orderkey % 3 = 0 THEN 'k8s' ELSE 'batch' END AS executor, 'r1' AS region, 'r' || (o_orderkey % 7) AS pipeline_version, '' AS platform_version,
    CASE WHEN o_orderkey % 5 = 0 THEN 'external' ELSE 'org' || (o_custkey % 3) || '/ws' END AS workspace, 'https://platform.test/' AS platform,
    CASE WHEN o_orderkey % 6 = 0 THEN 'https://x.example.invalid/' || o_orderkey WHEN o_orderkey % 9 = 0 THEN 'https://host.test/run/' || o_orderkey ELSE '' END AS run_url
  FROM o),
classed AS (
  SELECT *, CASE status WHEN 'SUCCEEDED' THEN 'Succeeded' WHEN 'FAILED' THEN 'Failed' ELSE 'Cancelled' END AS status_label,
    CASE status WHEN 'SUCCEEDED' THEN 'success' WHEN 'FAILED' THEN 'failed' ELSE 'cancelled' END AS status_category, status = 'SUCCEEDED' AS report_included,
    CASE WHEN run_url <> '' AND NOT contains(run_url, 'example.invalid') THEN run_url WHEN contains(workspace, '/')
      THEN 'https://platform.test/orgs/' || split_part(workspace, '/', 1) || '/workspaces/' || split_part(workspace, '/', 2) || '/watch/' || run_id ELSE '' END AS "runUrl" FROM runs),
l AS (
  SELECT *, p_type || ':' || p_brand AS process, md5(l_orderkey || '-' || l_linenumber) AS h, CAST(l_orderkey AS VARCHAR) AS run_id, o_orderpriority AS "group",
    p_type || ':' || p_brand || ' (' || l_linenumber || ')' AS name, CAST(l_extendedprice AS DECIMAL(12, 2)) AS price, CAST(l_quantity AS BIGINT) AS q,
    CASE l_returnflag WHEN 'R' THEN 'COMPLETED' WHEN 'A' THEN 'CACHED' ELSE 'FAILED' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
tasks AS (
  SELECT run_id, "group", substr(h, 1, 2) || '/' || substr(h, 3, 30) AS hash, substr(h, 1, 8) AS h8, name, process, p_brand AS process_short, status, q * 60000 + l_linenumber * 1000 AS duration_ms,
    q * 60000 AS realtime_ms, greatest(0, epoch_ms(l_shipdate) - epoch_ms(o_orderdate)) AS wait_ms, l_linenumber * 500 AS staging_ms, CAST(l_linenumber AS BIGINT) AS cpus,
    CAST(p_size AS BIGINT) * 1073741824 AS memory_bytes, l_linenumber * 100.0::DOUBLE / 7 AS pcpu, CAST(p_size AS DOUBLE) AS pmem, CAST(p_size AS BIGINT) * 500000000 AS rss,
    CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE CAST(p_size AS BIGINT) * 600000000 END AS peak_rss, l_partkey * 1000 AS read_bytes, l_suppkey * 1000 AS write_bytes, price AS cost,
    CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE s_name END AS machine_type, o_orderdate, l_shipdate, l_linenumber
  FROM l WHERE status <> 'FAILED'),
own AS (SELECT * FROM tasks WHERE run_id IN (SELECT run_id FROM classed WHERE report_included)),
bill AS (
  SELECT run_id, CASE l_partkey % 3 WHEN 0 THEN process WHEN 1 THEN p_brand ELSE '' END AS process, CASE WHEN l_suppkey % 3 = 0 THEN 'z' || substr(h, 2, 7) ELSE substr(h, 1, 8) END AS hash, l_linenumber, price,
    CASE WHEN l_linenumber <> 3 THEN CAST(price * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS DECIMAL(18, 4)) END AS split,
    CAST(price * CAST(l_tax AS DECIMAL(4, 2)) AS DECIMAL(18, 4)) AS unused FROM l),
costs AS (SELECT run_id, process, hash, sum(coalesce(split, price) + unused) AS cost, sum(coalesce(split, price)) AS used_cost, sum(unused) AS unused_cost FROM bill GROUP BY ALL),
attributed AS (
  SELECT t.*, coalesce(a.cost, b.cost, c.cost) AS bill_cost, coalesce(a.used_cost, b.used_cost, c.used_cost) AS bill_used, coalesce(a.unused_cost, b.unused_cost, c.unused_cost) AS bill_unused
  FROM tasks t LEFT JOIN costs a ON a.run_id = t.run_id AND a.hash = h8 AND a.process = t.process
  LEFT JOIN costs b ON b.run_id = t.run_id AND b.hash = h8 AND b.process = t.process_short LEFT JOIN costs c ON c.run_id = t.run_id AND c.hash = h8 AND c.process = ''),
counted AS (SELECT *, coalesce(bill_cost, cost) AS total, coalesce(bill_used, cost) AS used, coalesce(bill_unused, 0) AS unused FROM attributed),
mine AS (SELECT * FROM counted WHERE run_id IN (SELECT run_id FROM classed WHERE report_included)),
machine_rows AS (
  SELECT run_id, false AS batch, 2.0::DOUBLE * l_linenumber * q AS cpu, 8.0::DOUBLE * l_linenumber * q AS mem, CAST(round(l_discount * 100) AS DOUBLE) * 2 * l_linenumber * q AS cpu_used,
    CAST(round(l_tax * 100) AS DOUBLE) * 8 * l_linenumber * q AS mem_used, 2.0::DOUBLE * l_linenumber * q AS cpu_w, 8.0::DOUBLE * l_linenumber * q AS mem_w, 0.0::DOUBLE AS cpu_ask, 0.0::DOUBLE AS mem_ask
  FROM l WHERE l_linenumber % 2 = 1 OR l_linenumber % 10 = 0
  UNION ALL
  SELECT run_id, true, q * 2, q * 4, 0, 0, 0, 0, CASE WHEN l_linenumber % 4 = 0 THEN q ELSE q * 1.5 END, q * 3 FROM l WHERE l_linenumber % 2 = 0),
machine_sums AS (SELECT run_id, count(*) AS n_machines, sum(cpu) AS cpu, sum(mem) AS mem, sum(cpu_used) AS cu, sum(mem_used) AS mu, sum(cpu_w) AS cw, sum(mem_w) AS mw, sum(cpu_ask) AS ca, sum(mem_ask) AS ma, bool_or(batch) AS batch FROM machine_rows GROUP BY run_id),
machines AS (
  SELECT run_id, n_machines, cpu AS vm_cpu_h, mem AS vm_mem_gib_h, CASE WHEN cw > 0 THEN {half_even("cu / cw", 2)} WHEN batch AND cpu > 0 THEN {half_even("ca / cpu * 100", 2)} END AS sched_alloc_cpu_efficiency,
    CASE WHEN mw > 0 THEN {half_even("mu / mw", 2)} WHEN batch AND mem > 0 THEN {half_even("ma / mem * 100", 2)} END AS sched_alloc_mem_efficiency FROM machine_sums),
hours AS (
  SELECT run_id, sum(cpus * realtime_ms / 3600000) AS req_cpu, sum(memory_bytes / 1073741824 * realtime_ms / 3600000) AS req_mem, sum(pcpu / 100 * realtime_ms / 3600000) AS real_cpu,
    sum(CASE WHEN peak_rss <> 0 THEN peak_rss ELSE rss END / 1073741824 * realtime_ms / 3600000) AS real_mem FROM tasks GROUP BY run_id),
runtime AS (
  SELECT pipeline, t."group", process, sum(realtime_ms) AS runtime_ms, sum(wait_ms) AS wait_ms, count(*) AS n_tasks FROM own t JOIN runs USING (run_id) WHERE t.status = 'COMPLETED' GROUP BY ALL),
segments AS (
  SELECT *, sum(runtime_ms) OVER (PARTITION BY pipeline, "group") AS total, row_number() OVER (PARTITION BY pipeline, "group" ORDER BY runtime_ms DESC, process) AS rank,
    regexp_matches(lower(process), 'qc|qualimap|multiqc|rseqc|dupradar') AS highlight FROM runtime),
legend AS (
  SELECT pipeline, "group", least(rank, 21) AS rank, CASE WHEN least(rank, 21) = 21 THEN 'Other (' || count(*) || ' small processes)' ELSE min(process) END AS process,
    sum(runtime_ms) AS runtime_ms, any_value(total) AS total, least(rank, 21) < 21 AND bool_or(highlight) AS highlight FROM segments GROUP BY pipeline, "group", least(rank, 21)),
manifest AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'run' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS id,
    CASE WHEN o_orderkey % 4 = 0 THEN 'external' WHEN o_orderkey % 13 = 0 THEN 'no workspace' ELSE 'org/ws' END AS workspace, regexp_replace(o_orderpriority, '[^A-Za-z0-9 -]', '', 'g') AS "group",
    CASE WHEN o_orderkey % 8 = 0 THEN 'logs/' || o_orderkey || '.tar.gz' WHEN o_orderkey % 12 = 0 THEN 'a b' END AS logs, CASE WHEN o_orderkey % 5 = 0 THEN 'ftp://platform.test' END AS platform FROM orders)
"""


def big(names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names.split())


def double(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def _capacity(shown, vm_digits: int | None = None) -> str:
    """The split of both capacities; shown: how a value is rounded; vm_digits: how machine hours and efficiencies are before."""
    out = []
    for short, kind, unit, vm, busy in (("cpu", "Cpu", "CpuH", "vm_cpu_h", "sched_alloc_cpu_efficiency"), ("mem", "Mem", "MemGibH", "vm_mem_gib_h", "sched_alloc_mem_efficiency")):
        if vm_digits is not None:
            vm, busy = half_even(vm, vm_digits), half_even(busy, vm_digits)
        req, real = f"req_{short}", f"real_{short}"
        booked = f"(CASE WHEN {vm} IS NOT NULL AND {busy} IS NOT NULL THEN least({vm}, greatest(0, {vm} * {busy} / 100)) ELSE greatest({req}, 0) END)"
        gap = lambda a, b: f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN greatest({a} - {b}, 0) END"
        values = {
            f"requested{unit}": req, f"real{unit}": real, f"requestedVm{kind}Efficiency": f"CASE WHEN {vm} > 0 THEN {req} / {vm} * 100 END", f"schedulerBooked{unit}": booked,
            f"schedulerRightsized{unit}": gap(req, booked), f"schedulerOverbook{unit}": gap(booked, real), f"vmPackingSlack{unit}": gap(vm, booked),
            f"realVm{kind}Efficiency": f"CASE WHEN {vm} > 0 THEN {real} / {vm} * 100 END",
        }
        out += [f'CASE WHEN req_cpu IS NOT NULL THEN {shown(e)} END AS "{n}"' for n, e in values.items()]
    return ", ".join(out)


STATS = ", ".join(
    f"round({f}({e}), 6) AS {p}_{n}"
    for n, e in {"staging_min": "staging_ms / 60000", "realtime_min": "realtime_ms / 60000", "runtime_min": "duration_ms / 60000", "cost": "CAST(cost AS DOUBLE)"}.items()
    for f, p in (("avg", "avg"), ("stddev_samp", "sd"))
)
ERRORS = """array_to_string(list_filter([CASE WHEN NOT regexp_full_match(id, '[A-Za-z0-9]{9,14}') THEN 'id' END,
  CASE WHEN workspace <> 'external' AND NOT regexp_full_match(workspace, '[a-zA-Z0-9][a-zA-Z0-9-_]{0,38}/[a-zA-Z0-9][a-zA-Z0-9-_]{0,38}') THEN 'workspace' END,
  CASE WHEN "group" <> '' AND NOT regexp_full_match("group", '[a-zA-Z0-9][-a-zA-Z0-9_ ]{0,37}') THEN 'group' END, CASE WHEN logs <> '' AND NOT regexp_full_match(logs, '\\S+') THEN 'logs' END,
  CASE WHEN platform <> '' AND NOT regexp_full_match(platform, 'https?://.*') THEN 'platform' END], lambda x: x IS NOT NULL), ',')"""

BODIES: dict[str, str] = {
    "runs_projection": f"SELECT * EXCLUDE (duration_ms, succeeded, failed, cached, cpu_time_ms, read_bytes, write_bytes), {big('duration_ms succeeded failed cached cpu_time_ms read_bytes write_bytes')} FROM runs",
    "tasks_projection": f'SELECT run_id, "group", hash, name, process, process_short, status, pcpu, pmem, machine_type, {big("duration_ms realtime_ms cpus memory_bytes rss peak_rss read_bytes write_bytes")}, {double("cost")} FROM tasks',
    "task_timing": f"""SELECT run_id, name, strftime(o_orderdate, {ISO}) AS submit, strftime(l_shipdate, {ISO}) AS "start",
      strftime(l_shipdate + to_milliseconds(realtime_ms + staging_ms), {ISO}) AS complete, {big("wait_ms staging_ms")} FROM tasks""",
    "metrics_flatten": """SELECT run_id, "group", process, CAST(q AS DOUBLE) AS cpu_mean, CAST(q + 3 AS DOUBLE) AS cpu_q2, CAST(q + 5 AS DOUBLE) AS cpu_max, CAST(l_linenumber + 1 AS DOUBLE) AS mem_min,
      CAST(l_linenumber + 5 AS DOUBLE) AS mem_max, CAST(NULL AS DOUBLE) AS vmem_mean FROM l""",
    "nested_tasks": f'SELECT run_id, "group", name, hash, status, {big("realtime_ms wait_ms staging_ms")}, {double("cost")} FROM tasks',
    "progress_fallback": f"""SELECT run_id, CASE WHEN ct <> 0 THEN {half_even("cl / ct * 100", 2)} END AS cpu_efficiency, CASE WHEN mq <> 0 THEN {half_even("rss / mq * 100", 2)} END AS memory_efficiency,
      CAST(coalesce(floor(ct), 0) AS BIGINT) AS cpu_time_ms, CAST(coalesce(rb, 0) AS BIGINT) AS read_bytes, CAST(coalesce(wb, 0) AS BIGINT) AS write_bytes
      FROM runs LEFT JOIN (SELECT run_id, sum(cpus * realtime_ms) AS ct, sum(pcpu / 100 * realtime_ms) AS cl, sum(peak_rss) AS rss, sum(memory_bytes) AS mq, sum(read_bytes) AS rb, sum(write_bytes) AS wb
      FROM tasks WHERE status = 'COMPLETED' GROUP BY run_id) p USING (run_id)""",
    "bill_aggregate": f"SELECT run_id, process, hash, {double('cost', 'used_cost', 'unused_cost')} FROM costs",
    "bill_label_resolution": """SELECT CASE WHEN price > 30000 THEN 'big' ELSE 'p1' END AS run_id, process, hash, CAST(sum(coalesce(split, price) + unused) AS DOUBLE) AS cost,
      CAST(sum(coalesce(split, price)) AS DOUBLE) AS used_cost, CAST(sum(unused) AS DOUBLE) AS unused_cost FROM bill GROUP BY 1, 2, 3""",
    "machine_summary": "SELECT * FROM machines",
    "run_status": """SELECT run_id, st AS status, CASE WHEN st LIKE ' sub%' THEN 'Submitted_Late-Run2X' WHEN st = '' THEN 'Unknown' ELSE status_label END AS status_label,
      CASE WHEN st LIKE ' sub%' THEN 'other' WHEN st = '' THEN 'unknown' ELSE status_category END AS status_category, st <> 'CANCELLED' AS report_included
      FROM (SELECT *, CASE CAST(run_id AS BIGINT) % 10 WHEN 1 THEN ' submitted_late-run2x ' WHEN 2 THEN '' ELSE status END AS st FROM classed)""",
    "benchmark_overview": 'SELECT pipeline, "group", run_id, status, status_label, status_category, report_included FROM classed',
    "run_summary": f"""SELECT pipeline, "group", run_id, workspace, "runUrl", username, status, status_label, status_category, report_included, pipeline_version AS "Version",
      nextflow_version AS "Nextflow_version", platform_version, CAST(succeeded AS BIGINT) AS "succeedCount", CAST(failed AS BIGINT) AS "failedCount", CAST(cached AS BIGINT) AS "cachedCount", executor, region,
      fusion_enabled, wave_enabled, container_engine FROM classed""",
    "run_metrics": f"""SELECT pipeline, "group", run_id, workspace, "runUrl", CAST(duration_ms AS BIGINT) AS duration, {half_even("cpu_time_ms / 3600000.0::DOUBLE", 1)} AS "cpuTime",
      CAST(cpu_time_ms AS BIGINT) AS pipeline_runtime, {half_even("cpu_efficiency", 0)} AS "cpuEfficiency", {half_even("memory_efficiency", 2)} AS "memoryEfficiency",
      {half_even("read_bytes / 1e9", 0)} AS "readBytes", {half_even("write_bytes / 1e9", 0)} AS "writeBytes", n_machines AS "nMachines" FROM classed LEFT JOIN machines USING (run_id) WHERE report_included""",
    "run_links": 'SELECT run_id, workspace, "runUrl" FROM classed',
    "cost_index": "SELECT run_id, process, hash, CAST(2 * cost AS DOUBLE) AS cost, CAST(2 * used_cost AS DOUBLE) AS used_cost, CAST(2 * unused_cost AS DOUBLE) AS unused_cost FROM costs",
    "task_cost_join": f"SELECT run_id, name, hash, {double('bill_cost', 'total', 'used', 'unused')} FROM counted",
    "run_costs": f"""SELECT r.run_id, r."group", {half_even("coalesce(sum(total), 0)", 2)} AS cost, {half_even("coalesce(sum(used), 0)", 2)} AS used_cost,
      {half_even("coalesce(sum(unused), 0)", 2)} AS unused_cost FROM classed r LEFT JOIN mine m USING (run_id) WHERE report_included GROUP BY r.run_id, r."group" """,
    "cost_reconciliation": """SELECT coalesce(b.run_id, a.run_id) AS run_id, CAST(coalesce(billed, 0) AS DOUBLE) AS billed, CAST(coalesce(att, 0) AS DOUBLE) AS attributed
      FROM (SELECT run_id, sum(cost) AS billed FROM costs GROUP BY 1) b FULL JOIN (SELECT run_id, sum(bill_cost) AS att FROM counted GROUP BY 1) a ON a.run_id = b.run_id""",
    "cost_overview": 'SELECT "group", process_short, CAST(sum(total) AS DOUBLE) AS total_cost, CAST(sum(used) AS DOUBLE) AS used_cost, CAST(sum(unused) AS DOUBLE) AS unused_cost, count(*) AS n_tasks FROM mine GROUP BY 1, 2',
    "process_stats": f"""SELECT "group", process AS process_name, process_short, count(*) AS n_tasks, {STATS}, CAST(sum(cost) AS DOUBLE) AS total_cost FROM own WHERE status = 'COMPLETED' GROUP BY 1, 2, 3""",
    "task_instance_usage": """SELECT "group", machine_type, count(*) AS count FROM own WHERE status = 'COMPLETED' AND machine_type <> '' GROUP BY 1, 2""",
    "combined_runtime_segments": f'SELECT pipeline, "group", CAST(rank AS INTEGER) AS rank, process, CAST(runtime_ms AS BIGINT) AS runtime_ms, {half_even("runtime_ms / total * 100", 2)} AS pct, highlight FROM segments WHERE total > 0',
    "combined_runtime_legend": f'SELECT pipeline, "group", CAST(rank AS INTEGER) AS rank, process, CAST(runtime_ms AS BIGINT) AS runtime_ms, {half_even("runtime_ms / total * 100", 2)} AS pct, highlight FROM legend WHERE total > 0',
    "combined_runtime_panels": """SELECT s.pipeline, s."group", s.pipeline || '::' || s."group" AS panel_id, CAST(sum(runtime_ms) AS BIGINT) AS total_runtime_ms, CAST(sum(wait_ms) AS BIGINT) AS scheduling_runtime_ms,
      CAST(sum(runtime_ms + wait_ms) AS BIGINT) AS total_duration_ms, CAST(sum(n_tasks) AS BIGINT) AS total_tasks, count(*) AS unique_processes, count(*) AS n_segments, least(count(*), 21) AS n_legend,
      arg_min(process, rank) AS first_process, (SELECT arg_max(process, rank) FROM legend g WHERE g.pipeline = s.pipeline AND g."group" = s."group") AS last_legend,
      CAST(coalesce(sum(runtime_ms) FILTER (highlight), 0) AS BIGINT) AS qc_runtime_ms, CAST(sum(runtime_ms) - coalesce(sum(runtime_ms) FILTER (highlight), 0) AS BIGINT) AS other_runtime_ms
      FROM segments s WHERE total > 0 GROUP BY 1, 2""",
    "task_table": f"""SELECT "group", run_id, substr(hash, 1, 9) AS taskhash, process_short AS short, machine_type AS instance, {big("realtime_ms duration_ms cpus rss")},
      {half_even("memory_bytes / 1e9", 0)} AS memory_gb, name, status, {double("cost")} FROM own""",
    "task_scatter": f"""SELECT run_id, "group", process_short, name, round(realtime_ms / 60000, 6) AS realtime_min, round(staging_ms / 60000, 6) AS staging_min, {double("cost")}, cpus,
      round(memory_bytes / 1e9, 6) AS memory_gb FROM own""",
    "task_resource_hours": "SELECT run_id, round(req_cpu, 6) AS req_cpu, round(req_mem, 6) AS req_mem, round(real_cpu, 6) AS real_cpu, round(real_mem, 6) AS real_mem FROM hours",
    "capacity_decomposition": f"""SELECT c.run_id, vm_cpu_h AS "vmCpuH", vm_mem_gib_h AS "vmMemGibH", sched_alloc_cpu_efficiency AS "schedAllocCpuEfficiency", sched_alloc_mem_efficiency AS "schedAllocMemEfficiency",
      {_capacity(lambda e: f'round({e} + 1e-9, 6)')} FROM classed c LEFT JOIN machines USING (run_id) LEFT JOIN hours USING (run_id) WHERE report_included""",
    "has_vm": "SELECT coalesce(bool_or(vm_cpu_h > 0), false) AS has_vm FROM classed JOIN machines USING (run_id) WHERE report_included",
    "manifest_validation": f"SELECT id, workspace, logs, {ERRORS} AS errors FROM manifest",
    "run_routing": """SELECT way, CASE WHEN logs IS NULL THEN NULL WHEN ends_with(logs, '.tar.gz') THEN 'archive' ELSE 'directory' END AS logs_kind, count(*) AS n_rows, min('/data/in/' || logs) AS first_path, max(id) AS last_id
      FROM (SELECT *, CASE WHEN workspace <> 'external' THEN 'api' WHEN coalesce(logs, '') <> '' THEN 'external' ELSE 'dropped' END AS way FROM manifest) GROUP BY 1, 2""",
    "bill_filter": """SELECT b.run_id AS fixture_run_id, o_orderpriority AS fixture_group, 'resource_tags_user_unique_run_id' AS fixture_run_id_source, 'Usage' AS line_item_line_item_type,
      CAST(split AS DOUBLE) AS split_line_item_split_cost, CAST(unused AS DOUBLE) AS split_line_item_unused_cost, CAST(price AS DOUBLE) AS line_item_unblended_cost
      FROM bill b JOIN orders ON b.run_id = CAST(o_orderkey AS VARCHAR) WHERE o_orderstatus = 'F'""",
    "bill_filter_summary": "SELECT run_id, count(*) AS n_rows FROM bill GROUP BY 1 UNION ALL SELECT 'red-herring-run-id', 1",
}

EXACT_HOURS = """(SELECT run_id, sum(cpus * h) AS req_cpu, sum(memory_bytes / 1073741824 * h) AS req_mem, sum(cpus / 8 * h) AS real_cpu,
      sum(CASE WHEN peak_rss <> 0 THEN peak_rss ELSE rss END / 1073741824 * h) AS real_mem FROM (SELECT *, realtime_ms / 60000 / 16 AS h FROM tasks) GROUP BY run_id)"""
INPUT_ORDER = "reverse(lpad(run_id, 12, '0'))"


def in_order(columns: str, by: str, rows: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {by}) AS row_number, {columns} FROM {rows}"


def documents_of(progress: str, tasks: str) -> str:
    return f"""SELECT run_id, "group", pipeline, status, workspace, CAST(duration_ms AS BIGINT) AS duration_ms, CAST(cached AS BIGINT) AS cached, executor, CAST({progress} AS BIGINT) AS cpu_time_ms, fusion_enabled,
      CAST({tasks} AS BIGINT) AS n_tasks, CAST({tasks} AS BIGINT) AS n_metrics FROM runs LEFT JOIN (SELECT run_id, sum(cpus * realtime_ms) AS ct FROM tasks WHERE status = 'COMPLETED' GROUP BY 1) p USING (run_id)
      LEFT JOIN (SELECT run_id, count(*) AS n FROM l GROUP BY 1) n USING (run_id)"""


_DOUBLES = ", ".join(f"{half_even(c, 2)} AS \"{n}\"" for c, n in (("vm_cpu_h", "vmCpuH"), ("vm_mem_gib_h", "vmMemGibH"), ("sched_alloc_cpu_efficiency", "schedAllocCpuEfficiency"), ("sched_alloc_mem_efficiency", "schedAllocMemEfficiency")))
BODIES |= {
    "manifest_scan": f"SELECT nullif(id, '') AS id, workspace, \"group\", logs, platform, 'TOKEN_1' AS token_env, {ERRORS} AS errors FROM manifest",
    "idle_runs": f"SELECT count(*) AS n_api_runs FROM (SELECT *, {ERRORS} AS errors FROM manifest) WHERE errors = '' AND workspace <> 'external'",
    "run_documents": documents_of("coalesce(floor(ct), 0)", "coalesce(n, 0)"),
    "run_merge": documents_of("coalesce(floor(ct), 0)", "coalesce(n, 0)"),
    "run_archives": documents_of("cpu_time_ms", "0"),
    "attached_meta": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'org/later' ELSE 'org/ws' END AS workspace, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0 THEN o_orderpriority ELSE 'default' END AS "group",
      CASE WHEN o_orderkey % 3 = 0 THEN 'https://own.test' ELSE 'https://default.test' END AS platform, 'T' AS token_env FROM orders""",
    "workspace_lookup": """SELECT c_name AS id, 'org' || (c_custkey % 7) || '/' || c_mktsegment AS workspace, CASE WHEN c_custkey % 7 < 5 THEN CAST(c_custkey % 7 * 100 + length(c_mktsegment) AS BIGINT) END AS workspace_id FROM customer""",
    "machine_files": "SELECT * FROM machines",
    "bundle_runs": f"SELECT * EXCLUDE (duration_ms, succeeded, failed, cached, cpu_time_ms, read_bytes, write_bytes), {big('duration_ms succeeded failed cached cpu_time_ms read_bytes write_bytes')}, CAST(NULL AS BIGINT) AS n_machines FROM runs",
    "bundle_tables": """SELECT 'runs' AS "table", count(*) AS n_rows, count(DISTINCT run_id) AS n_runs, CAST(sum(duration_ms) AS DOUBLE) AS amount FROM runs
      UNION ALL SELECT 'tasks', count(*), count(DISTINCT run_id), CAST(sum(realtime_ms) AS DOUBLE) FROM tasks UNION ALL SELECT 'metrics', count(*), count(DISTINCT run_id), CAST(sum(q) AS DOUBLE) FROM l
      UNION ALL SELECT 'costs', count(*), count(DISTINCT run_id), CAST(sum(cost) AS DOUBLE) FROM costs UNION ALL SELECT 'machines', 0, 0, 0""",
    "bundle_report": BODIES["task_instance_usage"],
    "bill_scan": BODIES["bill_aggregate"],
    "bill_sink": BODIES["bill_filter"].replace("o_orderpriority AS", "CASE WHEN o_orderkey % 3 = 0 THEN 'A late group' ELSE o_orderpriority END AS"),
    "last_machine_row": f"""SELECT c.run_id, c.pipeline, n_machines + CASE WHEN CAST(c.run_id AS BIGINT) % 2 = 0 THEN 100 ELSE 0 END AS "nMachines", {half_even("vm_cpu_h * CASE WHEN CAST(c.run_id AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END", 2)} AS "vmCpuH"
      FROM (SELECT run_id, pipeline FROM classed WHERE report_included UNION ALL SELECT run_id, 'late ' || pipeline FROM classed WHERE report_included AND CAST(run_id AS BIGINT) % 3 = 0) c LEFT JOIN machines USING (run_id)""",
    "last_pipeline_row": """SELECT CASE WHEN CAST(run_id AS BIGINT) % 3 = 0 THEN 'late ' ELSE '' END || pipeline AS pipeline, t."group", process, CAST(sum(realtime_ms) AS BIGINT) AS runtime_ms, CAST(sum(wait_ms) AS BIGINT) AS wait_ms,
      count(*) AS n_tasks FROM own t JOIN runs USING (run_id) WHERE t.status = 'COMPLETED' GROUP BY 1, 2, 3""",
    "rounding": f"""SELECT l_orderkey, l_linenumber, {half_even("k / 10.0::DOUBLE", 0)} AS r0, {half_even("k / 100.0::DOUBLE", 1)} AS r1, {half_even("k / 1000.0::DOUBLE", 2)} AS r2, {half_even("k / 100000.0::DOUBLE", 4)} AS r4,
      {half_even("-(k / 1000.0::DOUBLE)", 2)} AS negative, CAST(NULL AS DOUBLE) AS none FROM (SELECT *, CAST(trunc(l_extendedprice * 100) AS BIGINT) * 10 + 5 AS k FROM lineitem)""",
    "capacity_report": f"""SELECT c.run_id, {_DOUBLES}, {_capacity(lambda e: half_even(e, 2), 2)} FROM classed c LEFT JOIN machines USING (run_id) LEFT JOIN {EXACT_HOURS} h USING (run_id) WHERE report_included""",
    "ordered_overview": in_order('pipeline, "group", run_id, status', f'pipeline, "group", {INPUT_ORDER}', "classed"),
    "ordered_summary": in_order('"group", run_id, workspace', f'"group", {INPUT_ORDER}', "classed"),
    "ordered_metrics": in_order('"group", run_id, CAST(duration_ms AS BIGINT) AS duration', f'"group", {INPUT_ORDER}', "classed WHERE report_included"),
    "ordered_costs": in_order('"group", run_id, cost', f'"group", {INPUT_ORDER}', f"({BODIES['run_costs']})"),
    "ordered_process_stats": in_order('"group", process_name, n_tasks', 'a DESC, "group", process_name', """(SELECT "group", process AS process_name, count(*) AS n_tasks, avg(realtime_ms / 60000) AS a FROM own WHERE status = 'COMPLETED' GROUP BY 1, 2)"""),
    "ordered_instance_usage": in_order('"group", machine_type, "count"', '"group", "count" DESC, machine_type', f"({BODIES['task_instance_usage']})"),
    "ordered_task_table": in_order('"group", short, name, run_id, hash', '"group", short, name, run_id', '(SELECT "group", process_short AS short, name, run_id, substr(hash, 1, 9) AS hash FROM own)'),
    "ordered_scatter": in_order("process_short, run_id, name, cpus", "process_short, run_id, name", "own"),
    "ordered_cost_overview": in_order('"group", process_short, total_cost', 'total_cost DESC, "group", process_short', f"({BODIES['cost_overview']})"),
    "ordered_panels": in_order('pipeline, "group", CAST(n AS BIGINT) AS total_tasks', 'pipeline, "group"', "(SELECT pipeline, \"group\", sum(n_tasks) AS n FROM segments WHERE total > 0 GROUP BY 1, 2)"),
}


def _object() -> str:
    """The rows of all sections with their place and key."""
    kept = {
        "benchmark_overview": ("concat_ws('|', pipeline, \"group\", run_id, status)", f'pipeline, "group", {INPUT_ORDER}', "classed"),
        "run_summary": ("concat_ws('|', \"group\", run_id, workspace)", f'"group", {INPUT_ORDER}', "classed"),
        "run_metrics": ("concat_ws('|', \"group\", run_id, CAST(duration_ms AS BIGINT))", f'"group", {INPUT_ORDER}', "classed WHERE report_included"),
        "run_costs": ("concat_ws('|', \"group\", run_id)", f'"group", {INPUT_ORDER}', f"({BODIES['run_costs']})"),
        "process_stats": ("concat_ws('|', \"group\", process_name, n_tasks)", 'a DESC, "group", process_name', """(SELECT "group", process AS process_name, count(*) AS n_tasks, avg(realtime_ms / 60000) AS a FROM own WHERE status = 'COMPLETED' GROUP BY 1, 2)"""),
        "task_instance_usage": ("concat_ws('|', \"group\", machine_type, \"count\")", '"group", "count" DESC, machine_type', f"({BODIES['task_instance_usage']})"),
        "task_table": ("concat_ws('|', \"group\", name, run_id)", '"group", process_short, name, run_id', "own"),
        "task_scatter": ("concat_ws('|', process_short, run_id, name)", "process_short, run_id, name", "own"),
        "cost_overview": ("concat_ws('|', \"group\", process_short)", 'total_cost DESC, "group", process_short', f"({BODIES['cost_overview']})"),
        "combined_task_runtime": ("concat_ws('|', pipeline, \"group\", n)", 'pipeline, "group"', '(SELECT pipeline, "group", count(*) AS n FROM segments WHERE total > 0 GROUP BY 1, 2)'),
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS section, row_number() OVER (ORDER BY {by}) AS row_number, {key} AS \"key\" FROM {rows}" for name, (key, by, rows) in kept.items())


BODIES["report_object"] = _object()
BODIES["panel_fields"] = " UNION ALL ".join(
    f"""SELECT pipeline || '::' || "group" AS panel_id, '{name}' AS list, CAST(rank - 1 AS BIGINT) AS place, process, CAST(runtime_ms AS BIGINT) AS runtime_ms, {half_even("runtime_ms / total * 100", 2)} AS pct, highlight
      FROM {rows} WHERE total > 0""" for name, rows in (("segments", "segments"), ("legend", "legend"))
)
ORACLES = {name: TABLES + body for name, body in BODIES.items()}
