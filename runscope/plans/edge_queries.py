"""Registered queries of odd texts: states, stamps and numbers as documents and telemetry can hold them, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.operators import runs
from runscope.plans import driver_tables as D


def chosen(by: Column, *values: Column | str | None) -> Column:
    """The by-th of the values."""
    out = F.lit(None).cast("string")
    for i, value in enumerate(values):
        out = F.when(by == i, F.lit(value) if isinstance(value, str) or value is None else value).otherwise(out)
    return out


def odd_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States with blanks of all kinds around them, failed runs left out of the report."""
    o = D.table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 8
    status = chosen(kind, "FAILED\n", "\tcompleted\r\n", " aborted　", "\x1cError\x1f", "\n \t", "half done\n", " Succeeded\x85", "\x0bfailing\x0c")
    out = runs.with_status(o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("run_id"), status.alias("status")))
    link = runs.run_link(F.col("run_id"), F.concat(F.lit("org/ws"), chosen(kind, "\n", "\t", " ", "", "\x0b", " ", "", "\r")), F.lit(" https://p.test//\n"), chosen(kind, "\n", " https://own.test\t"))
    return out.select("run_id", kind.cast("int").alias("kind"), "status_label", "status_category", "report_included", link.alias("run_link"))


def _stamp(row: Column) -> Column:
    """Of a line item's day and numbers, in the form of its kind."""
    day, two = row["day"], lambda c: F.lpad(c.cast("string"), 2, "0")
    hour, minute, second, ms = two(row["l_partkey"] % 24), two(row["l_suppkey"] % 60), two(row["l_orderkey"] % 60), F.lpad((row["l_partkey"] % 1000).cast("string"), 3, "0")
    d, basic = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyyMMdd")
    week_year, week, week_day = F.extract(F.lit("YEAROFWEEK"), day).cast("string"), two(F.weekofyear(day)), (F.weekday(day) + 1).cast("string")
    clock, plain = F.concat_ws(":", hour, minute, second), F.concat(hour, minute, second)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return chosen(
        row["kind"], text(d, "T", clock, ".", ms, "Z"), text(d, " ", clock), basic, text(basic, "T", plain), text(week_year, "-W", week, "-", week_day), text(week_year, "W", week, week_day, "T", hour, minute), text(d, "T", clock, ".", ms, "+05:30"),
        text(basic, "T", plain, "-0830"), text(d, "T", clock, ",", ms, "999999"), text("T", hour, ":00"), clock, F.substring(d, 1, 4), F.substring(d, 1, 7), text(d, " "), text(d, "T24:00"), text(F.substring(d, 1, 4), "-13-01"), "", None,
        text(d, "T", clock, "z"), text(d, "Z"), text(week_year, "-W", week), text(d, "_", hour), text(F.substring(d, 1, 4), "-02-30"), "now",
    )


def odd_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day and time of each line item in forms that are stamps and in forms that are none."""
    line = D.table(spark, sf_dir, "lineitem")
    kind = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24
    # the forms are left to a function of a variable: as generated code they take more than the 8,000 bytes that the JVM compiles
    stamp = S.let(F.struct(kind.alias("kind"), F.to_date("l_shipdate").alias("day"), "l_partkey", "l_suppkey", "l_orderkey"), _stamp)
    # a stamp is read once, for both columns
    rows = line.select("l_orderkey", "l_linenumber", kind.cast("int").alias("kind"), stamp.alias("stamp"))
    rows = rows.select("l_orderkey", "l_linenumber", "kind", S.parse_timestamp(F.col("stamp")).alias("at"))
    return rows.select("l_orderkey", "l_linenumber", "kind", F.unix_micros("at").alias("micros"), S.gap_ms(S.parse_timestamp(F.lit("1995-01-01T00:00:00Z")), F.col("at")).alias("wait_ms"))


def odd_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line item's quantity in forms that are numbers and in forms that are none."""
    line = D.table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long").cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    kind = (F.col("l_orderkey") + F.col("l_linenumber") * 3) % 22
    value = chosen(
        kind, q, text(" ", q, "\t"), text(q, "d"), text(q, "%\t"), text(q, " %"), text("1_", q), text("_", q), text(q, "."), text(".", q), text(q, "e2"), text("--", q), "", None, text(q, ",5"), text("0x", q), text(q, "F"), F.translate(q, "0123456789", "０１２３４５６７８９"),
        text("\xa0", q, "　"), text("+", q, ".25"), text("1__", q), text(q, "%%"), text("\x1c", q),
    )
    return line.select("l_orderkey", "l_linenumber", kind.cast("int").alias("kind"), S.safe_double(value).alias("number"), S.percent(value).alias("percent"))


QUERIES = {"odd_statuses": odd_statuses, "odd_stamps": odd_stamps, "odd_numbers": odd_numbers}

ORACLES = {
    "odd_statuses": """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(k AS INTEGER) AS kind,
      CASE k WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Cancelled' WHEN 3 THEN 'Failed' WHEN 4 THEN 'Unknown' WHEN 5 THEN 'Half Done' WHEN 6 THEN 'Succeeded' ELSE 'Failed' END AS status_label,
      CASE k WHEN 0 THEN 'failed' WHEN 1 THEN 'success' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'failed' WHEN 4 THEN 'unknown' WHEN 5 THEN 'other' WHEN 6 THEN 'success' ELSE 'failed' END AS status_category,
      k IN (1, 4, 5, 6) AS report_included, CASE WHEN k = 1 THEN 'https://own.test' ELSE 'https://p.test/orgs/org/workspaces/ws/watch/' || o_orderkey END AS run_link
      FROM (SELECT *, o_orderkey % 8 AS k FROM orders)""",
    "odd_stamps": """WITH t AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 7 + l_linenumber) % 24 AS k, epoch_us(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS d, CAST(l_shipdate AS DATE) AS day,
        (l_partkey % 24) * 3600000000 AS h, (l_suppkey % 60) * 60000000 AS m, (l_orderkey % 60) * 1000000 AS s, (l_partkey % 1000) * 1000 AS f FROM lineitem),
      x AS (SELECT *, CASE k WHEN 0 THEN d + h + m + s + f WHEN 1 THEN d + h + m + s WHEN 2 THEN d WHEN 3 THEN d + h + m + s WHEN 4 THEN d WHEN 5 THEN d + h + m WHEN 6 THEN d + h + m + s + f - 19800000000
        WHEN 7 THEN d + h + m + s + 30600000000 WHEN 8 THEN d + h + m + s + f + 999 WHEN 19 THEN d WHEN 20 THEN epoch_us(CAST(date_trunc('week', day) AS TIMESTAMP)) WHEN 21 THEN d + h END AS micros FROM t)
      SELECT l_orderkey, l_linenumber, CAST(k AS INTEGER) AS kind, CAST(micros AS BIGINT) AS micros,
        CAST(greatest(0, coalesce(floor(CAST(micros - epoch_us(TIMESTAMP '1995-01-01 00:00:00') AS DOUBLE) / 1e6::DOUBLE * 1000), 0)) AS BIGINT) AS wait_ms FROM x""",
    "odd_numbers": """WITH t AS (SELECT l_orderkey, l_linenumber, (l_orderkey + l_linenumber * 3) % 22 AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
      x AS (SELECT *, CASE WHEN k IN (0, 1, 7, 16, 17) THEN CAST(q AS DOUBLE) WHEN k = 5 THEN CAST('1' || q AS DOUBLE) WHEN k = 8 THEN CAST('0.' || q AS DOUBLE) WHEN k = 9 THEN q * 100.0::DOUBLE WHEN k = 18 THEN q + 0.25::DOUBLE ELSE 0 END AS n FROM t)
      SELECT l_orderkey, l_linenumber, CAST(k AS INTEGER) AS kind, n AS number, CASE WHEN k IN (3, 4, 20, 21) THEN CAST(q AS DOUBLE) ELSE n END AS percent FROM x""",
}
