"""The rows of a bill that belong to given runs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from runscope.functions import scalars as S
from runscope.sources import bill as B
from runscope.sources.order import ordinal_of

# The columns that a filtered bill keeps.
KEEP = [
    "line_item_usage_start_date", "line_item_usage_end_date", "line_item_product_code", "line_item_line_item_type", "line_item_resource_id", "product_instance_type",
    "product_product_family", "resource_tags", "line_item_unblended_cost", "line_item_net_unblended_cost", "split_line_item_split_cost", "split_line_item_net_split_cost",
    "split_line_item_unused_cost", "split_line_item_net_unused_cost",
]


def run_id_source(bill: DataFrame, aliases: Sequence[str]) -> str:
    """What a row's run id is said to come from: the first alias that has a flat column, else the tags."""
    flat = [f"{B.TAGS}_{a}" for a in aliases]
    if not any(n in bill.columns for n in [*flat, B.TAGS]):
        raise ValueError("the bill has no run-id column and no tags column")
    return next((n for n in flat if n in bill.columns), f"{B.TAGS}." + "|".join(aliases))


def filter_bill(bill: DataFrame, manifest: DataFrame, label_map: Mapping[str, str | Sequence[str]] | None = None, ordinal: str | None = None) -> DataFrame:
    """Bill rows of the manifest's runs, with the run's id, group and the id's source; of a run's manifest rows the last by ordinal counts.

    ordinal: by default the column of that name, which read_manifest gives; without one the greatest group counts.
    """
    ordinal = ordinal_of(manifest, ordinal)
    aliases = B.label_aliases(label_map)["run_id"]
    source = run_id_source(bill, aliases)
    group = F.coalesce(F.col("group"), F.lit("default")) if "group" in manifest.columns else F.lit("default")
    runs = manifest.select(F.col("id").alias("_id"), group.alias("_g"), (F.col(ordinal) if ordinal else F.lit(0)).alias("_o")).filter("_id is not null")
    runs = runs.groupBy("_id").agg(F.max_by("_g", F.struct("_o", "_g")).alias("_g"))
    kept = [c for c in KEEP if c in bill.columns]
    rows = bill.select(B.label(bill, aliases).alias("_run"), *kept).join(runs, F.col("_run") == F.col("_id"))
    return rows.select(F.col("_run").alias("fixture_run_id"), F.col("_g").alias("fixture_group"), F.lit(source).alias("fixture_run_id_source"), *kept)


def with_synthetic_row(filtered: DataFrame) -> DataFrame:
    """filtered and one made-up row of a run that no manifest names, to test later filters."""
    spark = filtered.sparkSession
    values = {"fixture_run_id": "red-herring-run-id", "fixture_group": "red-herring", "fixture_run_id_source": "synthetic", "line_item_product_code": "SyntheticCost"}
    amounts = {c: 0.123456789 for c in KEEP if c.endswith("cost") and "unused" not in c} | {c: 1e-9 for c in KEEP if c.endswith("unused_cost")}
    values |= {"line_item_line_item_type": "Usage", "line_item_resource_id": "synthetic:red-herring", "product_product_family": "Synthetic"} | amounts
    one = spark.range(1).select(*[F.lit(v).cast(filtered.schema[n].dataType if n in filtered.columns else "double" if n in amounts else "string").alias(n) for n, v in values.items()])
    return filtered.unionByName(one, allowMissingColumns=True)


def write_filtered(filtered: DataFrame, path: str) -> None:
    """The rows as Parquet, in place of what path held; none at all is an error, and path stays as it was.

    The bill is read once: rows are counted while they are written beside path, and the folder is renamed if there are any.
    """
    seen = Observation("rows")
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    filtered.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(beside)
    context = filtered.sparkSession.sparkContext
    at = lambda p: context._jvm.org.apache.hadoop.fs.Path(p)
    store = at(path).getFileSystem(context._jsc.hadoopConfiguration())
    if not seen.get["n"]:
        store.delete(at(beside), True)
        raise ValueError("no bill rows match the runs")
    store.delete(at(path), True)
    if not store.rename(at(beside), at(path)):
        raise OSError(f"{beside} was written, but can't be renamed to {path}")


def summary(filtered: DataFrame) -> DataFrame:
    """Rows by run id."""
    return filtered.groupBy(S.text(F.col("fixture_run_id")).alias("run_id")).agg(F.count("*").alias("n_rows"))
