"""Bill rows to costs by task key, and costs to tasks, runs and processes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runscope.functions import scalars as S
from runscope.sources import bill as B

KEY = ("run_id", "process", "hash")
AMOUNTS = ("cost", "used_cost", "unused_cost")


def bill_rows(bill: DataFrame, label_map: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """(run_id, process, hash, used, unused) of the bill's rows that name a run. hash: 8 characters as they are."""
    aliases = B.label_aliases(label_map)
    rows = bill.select(
        B.label(bill, aliases["run_id"]).alias("run_id"),
        S.text(B.label(bill, aliases["process"])).alias("process"),
        F.substring(S.text(B.label(bill, aliases["task_hash"])), 1, 8).alias("hash"),
        B.amount(bill, B.SPLIT_COST, B.UNBLENDED_COST).alias("used"),
        B.amount(bill, B.UNUSED_COST).alias("unused"),
    )
    return rows.filter(S.filled(F.col("run_id")).isNotNull())


def normalize_costs(bill: DataFrame, label_map: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """Costs by run, process and hash; unique on the three."""
    rows = bill_rows(bill, label_map)
    kinds = [rows.schema[n].dataType for n in ("used", "unused")]
    if all(isinstance(k, T.DecimalType) and k.precision <= 27 for k in kinds):
        # exact sums: that of both follows from the two, so only these are shuffled
        sums = rows.groupBy(*KEY).agg(F.sum("used").alias("used_cost"), F.sum("unused").alias("unused_cost"))
        sums = sums.withColumn("cost", F.col("used_cost") + F.col("unused_cost"))
    else:
        sums = rows.groupBy(*KEY).agg(F.sum(F.col("used") + F.col("unused")).alias("cost"), F.sum("used").alias("used_cost"), F.sum("unused").alias("unused_cost"))
    return sums.select(*KEY, *AMOUNTS)


def cost_index(costs: DataFrame, texts: bool = False) -> DataFrame:
    """Costs once more summed by key, so that a join never repeats a task. texts: no key is null."""
    keys = KEY if texts else [S.text(F.col(k)).alias(k) for k in KEY]
    return costs.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(a), F.lit(0))).alias(a) for a in AMOUNTS])


def attribute_costs(tasks: DataFrame, costs: DataFrame | None) -> DataFrame:
    """tasks with bill_cost, bill_used_cost, bill_unused_cost (null: no hit) and what counts: total, used, unused.

    A task's hit is the first of (run, process, hash), (run, short process, hash) and (run, no process, hash) that the bill has; a
    bill row counts for every task that hits it. Without a hit the task's own cost counts, as used.
    """
    rows = tasks.withColumn("_h", S.normalized_hash(F.col("hash")))
    own = F.coalesce(F.col("cost"), F.lit(0))
    if costs is None:
        rows = rows.withColumns({f"bill_{a}": F.lit(None).cast("double") for a in AMOUNTS})
    else:
        # keys are dealt by run and hash before they are summed, so that the sums and the maps below need no shuffle of their own
        index = cost_index(costs.select(*[S.text(F.col(k)).alias(k) for k in KEY], *AMOUNTS).repartition("run_id", "hash"), texts=True)
        # one join: all keys of a run and hash that any step may hit, by step; the key (run, hash) deals tasks evenly
        by_hash = index.select(F.col("run_id").alias("_r"), F.col("hash").alias("_k"), F.col("process").alias("_p"), F.struct(*AMOUNTS).alias("_c"))
        per_hash = by_hash.groupBy("_r", "_k").agg(F.map_from_entries(F.collect_list(F.struct("_p", "_c"))).alias("_m"))
        rows = rows.join(per_hash, (F.col("run_id") == F.col("_r")) & (F.col("_h") == F.col("_k")), "left")
        hit = F.coalesce(*[F.try_element_at("_m", S.text(p)) for p in (F.col("process"), F.col("process_short"), F.lit(""))])
        rows = rows.withColumn("_hit", hit).withColumns({f"bill_{a}": F.col("_hit")[a] for a in AMOUNTS}).drop("_r", "_k", "_m", "_hit")
    missed = F.col("bill_cost").isNull()
    return rows.drop("_h").withColumns({
        "total": F.when(missed, own).otherwise(F.col("bill_cost")),
        "used": F.when(missed, own).otherwise(F.col("bill_used_cost")),
        "unused": F.when(missed, F.lit(0)).otherwise(F.col("bill_unused_cost")),
    })


def has_rows(*tables: DataFrame | None) -> bool:
    """Whether any table has rows, asked one after the other. Best asked of bill_rows, which are not summed: then it ends at the first row."""
    return any(table is not None and not table.isEmpty() for table in tables)


def run_costs(included: DataFrame, attributed: DataFrame, has_costs: bool) -> DataFrame:
    """(run_id, group, cost, used_cost, unused_cost): every included run has a row, with 0 if it has no tasks; rounded to cents.

    used_cost and unused_cost are null if the bill had no rows at all.
    """
    order = ["ordinal"] if "ordinal" in included.columns else []
    runs = included.groupBy("run_id", "group").agg(F.min("ordinal").alias("ordinal")) if order else included.select("run_id", "group").distinct()
    # tasks are read once: their sums have the pairs of run and group that no run has
    sums = attributed.groupBy("run_id", "group").agg(F.sum("total").alias("cost"), F.sum("used").alias("used_cost"), F.sum("unused").alias("unused_cost"))
    known = lambda c: S.rounded(F.coalesce(F.col(c), F.lit(0)), 2).cast("double")
    shown = lambda c: (known(c) if has_costs else F.lit(None).cast("double")).alias(c)
    return runs.join(sums, ["run_id", "group"], "full").select("run_id", "group", known("cost").alias("cost"), shown("used_cost"), shown("unused_cost"), *order)


def cost_overview(attributed: DataFrame, has_costs: bool) -> DataFrame | None:
    """Costs and number of tasks by group and short process; None without a bill."""
    if not has_costs:
        return None
    sums = [F.sum(c).alias(n) for c, n in (("total", "total_cost"), ("used", "used_cost"), ("unused", "unused_cost"))]
    return attributed.groupBy("group", "process_short").agg(*sums, F.count("*").alias("n_tasks"))


def reconciliation(costs: DataFrame, attributed: DataFrame) -> DataFrame:
    """Run by run: what the bill has, and what the tasks were given of it (a bill row can count for several tasks, or for none)."""
    billed = costs.groupBy("run_id").agg(F.sum("cost").alias("billed"))
    given = attributed.groupBy("run_id").agg(F.sum("bill_cost").alias("attributed"))
    return billed.join(given, "run_id", "full").select("run_id", F.coalesce("billed", F.lit(0)).alias("billed"), F.coalesce("attributed", F.lit(0)).alias("attributed"))
