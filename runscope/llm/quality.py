"""Quality classifier: a sparse rule ensemble over text statistics, compiled into Spark column expressions.

Tree paths of a random forest become rules, conjunctions of bounds on statistics; a lasso logistic regression over the rules keeps
few of them; what is left is one Column: score = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold))).

The fit uses at most `most_rows` labelled rows (the first by a hash of their doc_id); statistics are taken from whole texts
and all rows are scored. Labels, lang, source and doc_id are no statistics.

Defined cases: null or empty texts have all statistics zero and are scored by them; labels that are null, or have no
document, are passed over; of repeated labels each counts; without labels of both kinds the score is the share of label 1 (0.5
without any); other columns are ignored or carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runscope.llm import arrays as A
from runscope.llm.shared import beside_text, discard, landed, ship, together

#: Shares are of the text's bytes, words or lines.
STATISTICS = (
    "n_bytes", "n_words", "n_lines", "word_bytes", "line_words", "upper_share", "digit_share", "symbol_share", "stop_share",
    "wide_share", "blank_share", "repeated_word_share", "different_word_share", "different_line_share", "bare_word_share", "long_word_share",
)
SLICE = 1 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


UPPER, DIGIT, WIDE = _class((0x41, 0x5A)), _class((0x30, 0x39)), _class((0x80, 0xFF))
STOP = _class((0x2C, 0x2C), (0x2E, 0x2E))
SYMBOL = _class((0x21, 0x2B), (0x2D, 0x2D), (0x2F, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def statistics_of(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[rows, statistics] of a text buffer."""
    n, edges = len(offsets) - 1, offsets

    def in_rows(flags: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(flags, dtype=np.int64))
        return sums[edges[1:]] - sums[edges[:-1]]

    def different(values: np.ndarray, row: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, row))
        v, r = values[order], row[order]
        new = np.append(True, (v[1:] != v[:-1]) | (r[1:] != r[:-1]))[: len(v)]
        return np.bincount(r[new], minlength=n)

    size = np.diff(edges)
    begins, ends = A.words(buffer, edges, ~A.SPACE)
    row = np.searchsorted(edges, begins, side="right") - 1
    words = np.bincount(row, minlength=n)
    values = A.range_hashes(A.BYTE_VALUES[buffer], begins, ends)
    again = np.append(False, (values[1:] == values[:-1]) & (row[1:] == row[:-1]))[: len(values)]
    symbol = SYMBOL[buffer]
    marks = np.append(0, np.cumsum(symbol))
    bare = marks[ends] - marks[begins] == ends - begins
    line_begins, line_ends = A.words(buffer, edges, ~_class((0x0A, 0x0A)))
    line_row = np.searchsorted(edges, line_begins, side="right") - 1
    lines = np.bincount(line_row, minlength=n)
    line_values = A.range_hashes(A.BYTE_VALUES[buffer], line_begins, line_ends)
    per_byte, per_word, per_line = np.maximum(size, 1), np.maximum(words, 1), np.maximum(lines, 1)
    columns = (
        size, words, lines, in_rows(~A.SPACE[buffer]) / per_word, words / per_line, in_rows(UPPER[buffer]) / per_byte, in_rows(DIGIT[buffer]) / per_byte,
        in_rows(symbol) / per_byte, in_rows(STOP[buffer]) / per_word, in_rows(WIDE[buffer]) / per_byte, in_rows(A.SPACE[buffer]) / per_byte,
        np.bincount(row[again], minlength=n) / per_word, different(values, row) / per_word, different(line_values, line_row) / per_line,
        np.bincount(row[bare], minlength=n) / per_word, np.bincount(row[ends - begins > 20], minlength=n) / per_word,
    )
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buffer, offsets = A.texts(batch.column("text"))
        parts = [np.zeros((0, len(STATISTICS)))]
        for first, last in A.slices(offsets, SLICE):
            at = offsets[first : last + 1]
            parts.append(statistics_of(buffer[at[0] : at[-1]], at - at[0]))
        values = np.concatenate(parts)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c) for c in values.T)], names=[*batch.schema.names[:-1], *STATISTICS])


def statistics(docs: DataFrame, row: Column, row_type: str, text: str = "text") -> DataFrame:
    """(row, statistics...) for every document; row: what to carry along."""
    ship(docs.sparkSession)
    own = docs.select(row.alias("row"), F.col(text).cast("binary").alias("text"))
    return own.mapInArrow(_statistics, f"row {row_type}, " + ", ".join(f"{s} double" for s in STATISTICS))


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As _statistics, and the text once more behind them."""
    for batch in batches:
        (out,) = _statistics(iter([batch]))
        yield pa.RecordBatch.from_arrays([*out.columns, batch.column("text")], names=[*out.schema.names, "text"])


#: A bound on a statistic: (statistic, True for at most and False for more than, threshold).
Bound = tuple[str, bool, float]


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions of bounds."""

    intercept: float
    rules: tuple[tuple[tuple[Bound, ...], float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: tuple[Bound, ...]) -> Column:
    out = F.lit(True)
    for name, at_most, threshold in rule:
        out = out & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
    return out


def tree_paths(description: str) -> set[tuple[Bound, ...]]:
    """Every path from a root, as its bounds, in a forest's toDebugString."""
    found, path = set(), []
    for line in description.splitlines():
        if not (m := re.match(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.E]+)\)", line)):
            continue
        depth = len(m[1])
        path = [x for x in path if x[0] < depth] + [(depth, (STATISTICS[int(m[3])], m[4] == "<=", float(m[5])))]
        bounds: dict[tuple[str, bool], float] = {}
        for _, (name, at_most, threshold) in path:
            tighter = min if at_most else max
            bounds[name, at_most] = tighter(threshold, bounds.get((name, at_most), threshold))
        found.add(tuple(sorted((*k, v) for k, v in bounds.items())))
    return found


def fit(labelled: DataFrame, trees: int = 40, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> RuleModel:
    """Rules for (statistics..., label 0 or 1): a bounded table."""
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        share = ones / (zeros + ones) if zeros + ones else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(float(np.log(share / (1 - share))), ())
    data = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled.withColumn("label", F.col("label").cast("double")))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed, featureSubsetStrategy="onethird").fit(data)
    rules = sorted(tree_paths(forest.toDebugString))
    if not rules:
        return RuleModel(float(np.log(ones / zeros)), ())
    flags = data.select("label", F.array(*[F.when(holds(r), 1.0).otherwise(0.0) for r in rules]).alias("flags"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60).fit(flags.select("label", array_to_vector("flags").alias("features")))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def train(docs: DataFrame, labels: DataFrame, use: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most_rows: int = 20_000) -> RuleModel:
    """Fits on the labelled documents, most_rows at most; use: which labels may be learned from."""
    own = labels.filter(use) if use is not None else labels
    own = own.select(F.col(doc_id).alias("doc"), F.col(label).cast("int").alias("label")).filter("doc is not null and label in (0, 1)")
    sample = landed(own.orderBy(F.xxhash64("doc"), "doc", "label").limit(most_rows), "labels")
    # most_rows ids at most: small enough to send to every task
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(F.broadcast(sample), "doc")
    rows = statistics(texts, F.col("label"), "int").withColumnRenamed("row", "label")
    rows = landed(rows, "labelled-statistics")
    model = fit(rows)
    discard(sample)
    discard(rows)
    return model


def score(docs: DataFrame, model: RuleModel, row: Column, row_type: str, text: str = "text") -> DataFrame:
    """(row, statistics..., score) for every document."""
    return statistics(docs, row, row_type, text).withColumn("score", model.score())


def keep_good(docs: DataFrame, model: RuleModel, text: str = "text", least: float = 0.3) -> DataFrame:
    """The documents, with all their columns, that score at least `least`."""
    ship(docs.sparkSession)
    row, kind = beside_text(docs, text)
    own = docs.select(row.alias("row"), F.col(text).cast("binary").alias("text"))
    scored = own.mapInArrow(_with_text, f"row {kind}, " + ", ".join(f"{s} double" for s in STATISTICS) + ", text binary")
    return together(docs, scored.filter(model.score() >= least), text)
