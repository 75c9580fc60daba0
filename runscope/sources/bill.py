"""The cloud bill: labels of its rows, in flat columns or in one tags column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runscope.functions import scalars as S

# The labels that stand for each field unless a label map says otherwise.
DEFAULT_ALIASES = {
    "run_id": ("user_unique_run_id", "user_nf_unique_run_id"),
    "process": ("user_pipeline_process",),
    "task_hash": ("user_task_hash",),
}
TAGS = "resource_tags"
SPLIT_COST, UNUSED_COST, UNBLENDED_COST = "split_line_item_split_cost", "split_line_item_unused_cost", "line_item_unblended_cost"


def label_aliases(label_map: Mapping[str, str | Sequence[str]] | None = None) -> dict[str, list[str]]:
    """Aliases of each field: the map's first, then the defaults, each once and without blanks."""
    label_map = {} if label_map is None else label_map
    if not isinstance(label_map, Mapping):
        raise ValueError("cost label map must be a mapping")
    if unknown := sorted(set(label_map) - set(DEFAULT_ALIASES)):
        raise ValueError(f"cost label map has unsupported fields: {', '.join(unknown)}")
    out = {}
    for field, defaults in DEFAULT_ALIASES.items():
        own = label_map.get(field, [])
        own = [own] if isinstance(own, str) else own
        if not isinstance(own, Sequence) or not all(isinstance(a, str) for a in own):
            raise ValueError(f"cost label map field '{field}' must be a string or a list of strings")
        out[field] = list(dict.fromkeys(a.strip() for a in [*own, *defaults] if a.strip()))
    return out


def read_label_map(path: str) -> dict[str, list[str]]:
    """label_aliases of a YAML file: a small configuration, read on the driver."""
    import yaml

    with open(path) as file:
        return label_aliases(yaml.safe_load(file) or {})


def tag(bill: DataFrame, alias: str) -> Column | None:
    """The value of one tag as a string; of repeated tags the last. None if the bill's tags have a form without such values."""
    if TAGS not in bill.columns:
        return None
    kind, tags = bill.schema[TAGS].dataType, F.col(TAGS)
    if isinstance(kind, T.MapType):
        return F.try_element_at(tags, F.lit(alias)).cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        pairs = F.filter(tags, lambda x: (F.size(x) == 2) & (x[0].cast("string") == alias))
        return F.get(F.try_element_at(pairs, F.lit(-1)), F.lit(1)).cast("string")
    if isinstance(kind, T.StructType) and alias in kind.names:
        return tags[alias].cast("string")
    return None


def label(bill: DataFrame, aliases: Sequence[str]) -> Column:
    """The first filled value: for each alias in turn its flat column, then its tag."""
    values = []
    for alias in aliases:
        if (flat := f"{TAGS}_{alias}") in bill.columns:
            values.append(F.col(f"`{flat}`").cast("string"))
        if (own := tag(bill, alias)) is not None:
            values.append(own)
    return S.first_filled(*values) if values else F.lit(None).cast("string")


def amount(bill: DataFrame, *names: str) -> Column:
    """The first of these amounts that the row has, else 0."""
    own = [F.col(n) if isinstance(bill.schema[n].dataType, T.NumericType) else F.col(n).try_cast("double") for n in names if n in bill.columns]
    return F.coalesce(*own, F.lit(0))
