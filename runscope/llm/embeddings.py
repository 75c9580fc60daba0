"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside cells, one representative for each group.

Equal vectors are one class, compared once; vectors of different lengths never link, so all that follows is done for each length by
itself. Cells are of directions from the common mean: embeddings mostly share one, and without it they all look alike. K-means with
cosine distance is fitted on those directions of at most `sample_rows` classes, for `most_centres` centres at most. Centres within the
`margin` of an earlier one are a cell with it, so that a large group of near copies, which k-means splits over many almost equal centres,
stays together; they are not chained. Every class is assigned to the cell of its nearest centre and to the cells with a centre nearly as
near (cosine at most `margin` less, divided by the share of a vector's square that the mean leaves), so that pairs on both sides of a
border meet, but to no more than `most_cells` of them, the nearest. A cell with more than `large` times `cell_rows` classes is parted in
the same way by centres of its own, fitted on at most `sample_rows` of its classes; so cells stay small as the table grows, up to
most_centres^2 of them. A cell is cut into blocks of `part_rows`, and each pair of blocks is a task of its own, so a cell that holds most
rows is spread over the cluster. A pair that meets in several cells counts in the first of them only. Products are of the vectors
themselves, in double precision: no pair below the threshold is linked. Pairs are found with high probability, not surely; inside a group
of near copies the work is the number of its pairs, which n_links counts.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; a null vec_id takes part in
links, but is a component's id only if all of its ids are null; repeated rows are vectors of their own; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm.components import connected_components
from runscope.llm.shared import discard, landed, ship
from runscope.llm.simhash import forest


def classes_of(vectors: DataFrame) -> DataFrame:
    """(class: a hash, vector, vec_id, copies): each different linkable vector once."""
    usable = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    own = vectors.filter(usable).groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    return own.withColumn("class", F.xxhash64("vector"))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds unit: the vector in doubles, of length one. Scaled by its largest component first, so squares neither overflow nor vanish."""
    for batch in batches:
        column = batch.column("vector")
        sizes = column.value_lengths().to_numpy()
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        first = np.cumsum(sizes) - sizes
        if len(values):
            values = values / np.repeat(np.maximum(np.maximum.reduceat(np.abs(values), first), 1e-320), sizes)
            values /= np.repeat(np.sqrt(np.add.reduceat(values * values, first)), sizes)
        unit = pa.ListArray.from_arrays(np.append(first, len(values)).astype(np.int32), values)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "class", "copies")), pa.array(sizes.astype(np.int32)), unit], names=["id", "class", "copies", "width", "unit"])


@dataclass
class Cells:
    """Of a width: the common mean, how near a cell is near enough, unit centres of the directions from the mean, and the cell of each centre."""

    mean: np.ndarray
    margin: float
    centre: np.ndarray
    cell: np.ndarray

    def near(self, units: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        return cells_near(away(units, self.mean), self.centre, self.cell, self.margin, most)


def away(units: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Directions of unit rows from a mean; the mean itself has none and stays zero."""
    return unit_rows(units - mean)


def cells_for(classes: DataFrame, cells: int, sample_rows: int, margin: float, seed: int) -> Cells:
    """Cells of spherical k-means on a bounded sample, the first by a hash."""
    sample = landed(classes.orderBy(F.xxhash64("class", F.lit(seed)), "class").limit(sample_rows).select("unit"), "vector-sample")
    mean = np.array(sample.select(Summarizer.mean(array_to_vector("unit"))).first()[0].toArray())
    apart = F.zip_with("unit", F.array(*[F.lit(float(x)) for x in mean]), lambda a, b: a - b)
    rows = sample.select(apart.alias("unit")).filter(F.exists("unit", lambda x: x != 0)).select(array_to_vector("unit").alias("features"))
    if rows.isEmpty():  # all alike
        return Cells(mean, margin, np.zeros((1, len(mean))), np.zeros(1, np.int64))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=8, seed=seed).fit(rows)
    discard(sample)
    centre = unit_rows(np.array(model.clusterCenters()))
    return Cells(mean, margin / max(1 - float(mean @ mean), 1e-6), centre, cells_of(centre, margin))


def unit_rows(values: np.ndarray) -> np.ndarray:
    return values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-300)


def own_centres(values: np.ndarray, cells: int, seed: int, rounds: int = 8) -> np.ndarray:
    """The same inside a task, for a bounded number of unit rows."""
    centre = values[np.random.default_rng(seed).permutation(len(values))[:cells]]
    for _ in range(rounds):
        nearest = np.concatenate([(values[i : i + 1024] @ centre.T).argmax(1) for i in range(0, len(values), 1024)])
        sums = np.zeros_like(centre)
        np.add.at(sums, nearest, values)
        some = np.bincount(nearest, minlength=len(centre)) > 0
        centre[some] = unit_rows(sums[some])
    return centre


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def cells_of(centre: np.ndarray, margin: float) -> np.ndarray:
    """The cell of each centre: that of the first centre within the margin which has a cell of its own, else its own."""
    near = centre @ centre.T >= 1 - margin
    cell = np.arange(len(centre))
    for i in range(1, len(centre)):
        own = np.flatnonzero(near[i, :i] & (cell[:i] == np.arange(i)))
        cell[i] = own[0] if len(own) else i
    return cell


def _roots(parent: np.ndarray) -> np.ndarray:
    while (up := parent[parent]).tolist() != parent.tolist():
        parent = up
    return parent


def cells_near(values: np.ndarray, centre: np.ndarray, cell: np.ndarray, margin: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for each unit row and each cell with a centre at most `margin` of cosine farther than its nearest, the `most` nearest at most, in the order of rows."""
    order = np.argsort(cell, kind="stable")
    named, first = np.unique(cell[order], return_index=True)
    rows, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(values), 1024):
        near = values[i : i + 1024] @ centre.T
        best = np.maximum.reduceat(near[:, order], first, axis=1)  # of a cell's centres
        inside = best >= near.max(1, keepdims=True) - margin
        if best.shape[1] > most:
            beyond = np.argpartition(-best, most, axis=1)[:, most:]
            inside[np.arange(len(best))[:, None], beyond] = False
        row, own = np.nonzero(inside)
        rows.append(row + i)
        cells.append(named[own])
    return np.concatenate(rows), np.concatenate(cells)


#: A cell's number: width, cell, and cell inside it in its bits.
WIDTH, CELL = 40, 20
ROW = "id long, copies long, unit array<double>"


def _assigned(sent, most_cells: int):
    """(id, copies, width, unit) -> (id, copies, unit, cell): a row for each cell; a width without centres is one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                row, cell = np.arange(len(at)), np.zeros(len(at), np.int64)
                if width in sent.value:
                    row, cell = sent.value[width].near(_matrix(batch.column("unit").take(pa.array(at)), width), most_cells)
                own = batch.take(pa.array(at[row])).select(["id", "copies", "unit"])
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array((width << WIDTH) + (cell << CELL))], names=["id", "copies", "unit", "cell"])

    return run


def _fitted(sent, cell_rows: int, most_centres: int, seed: int):
    """A cell's sample (unit, count: of its rows) -> its centres, one row each."""

    def run(key, table):
        cell = key[0].as_py()
        width, count = cell >> WIDTH, table["count"][0].as_py()
        values = away(_matrix(table["unit"].combine_chunks(), width), sent.value[width].mean)
        found = own_centres(values, min(most_centres, len(values), count // cell_rows), seed)
        unit = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * width, found.ravel())
        return pa.table({"cell": pa.array(np.full(len(found), cell)), "centre": unit})

    return run


def _parted(sent, margin: float, most_cells: int):
    """The rows of a large cell (a part of them) and its centres -> its rows by cells inside it."""

    def run(key, rows, table):
        cell = key[0].as_py()
        if not rows.num_rows:
            return rows.select(["id", "copies", "unit", "cell"])
        width = cell >> WIDTH
        centre = _matrix(table["centre"].combine_chunks(), width)
        known = sent.value[width]
        row, own = Cells(known.mean, known.margin, centre, cells_of(centre, margin)).near(_matrix(rows["unit"].combine_chunks(), width), most_cells)
        return rows.select(["id", "copies", "unit"]).take(pa.array(row)).append_column("cell", pa.array(cell + own + 1))

    return run


def small_cells(assigned: DataFrame, sent, most_cells: int, cell_rows: int, most_centres: int, sample_rows: int, margin: float, seed: int, large: int = 20, together: int = 20_000) -> DataFrame:
    """assigned (id, copies, unit, cell) with the cells of more than large * cell_rows rows parted by centres of their own; together: rows parted in one task."""
    sizes = assigned.groupBy("cell").count()
    big = landed(sizes.filter(F.col("count") > large * cell_rows), "large-cells")
    if big.isEmpty():
        return assigned
    big = big.withColumn("salts", F.ceil(F.col("count") / together).cast("int"))  # most_centres rows a width at most
    rows = assigned.join(F.broadcast(big), "cell")
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.floor(F.col("count") / sample_rows))) == 0)
    found = landed(sample.select("cell", "unit", "count").groupBy("cell").applyInArrow(_fitted(sent, cell_rows, most_centres, seed), "cell long, centre array<double>"), "cell-centres")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "id"), F.col("salts")).cast("int")).select("cell", "salt", "id", "copies", "unit")
    for_each = found.join(F.broadcast(big.select("cell", "salts")), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "centre")
    parted = dealt.groupBy("cell", "salt").cogroup(for_each.groupBy("cell", "salt")).applyInArrow(_parted(sent, margin, most_cells), f"{ROW}, cell long")
    return assigned.join(F.broadcast(big.select("cell")), "cell", "left_anti").select("id", "copies", "unit", "cell").unionByName(parted)


def _earlier(columns: list, cell: int) -> list[np.ndarray]:
    """For each side, which of its classes are in which cells before this one; only cells that both sides have."""
    sides = []
    for column in columns:
        column = column.combine_chunks()
        row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
        own = column.flatten().to_numpy()
        sides.append((len(column), row[own < cell], own[own < cell]))
    both = np.intersect1d(sides[0][2], sides[-1][2])
    out = []
    for size, row, own in sides:
        member = np.zeros((size, len(both)), np.float32)
        known = np.isin(own, both)
        member[row[known], np.searchsorted(both, own[known])] = 1
        out.append(member)
    return out


def _join(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Joins what a block links (row, column) to a forest, one link of each row at a time: each round at least halves the open trees."""
    joined = []
    while True:
        parent = _roots(parent)
        open_ = linked & (parent[rows][:, None] != parent[columns][None, :])
        some = np.flatnonzero(open_.any(1))
        if not len(some):
            return parent, joined
        across = np.flatnonzero(open_.any(0))  # and one of each column
        a = np.concatenate([rows[some], rows[open_[:, across].argmax(0)]])
        b = np.concatenate([columns[open_[some].argmax(1)], columns[across]])
        parent, new = forest(len(parent), a, b, parent)
        joined += new


def _pairs(threshold: float, rows: int = 1024):
    """Links between two parts of a cell: how many vectors each class links to here, and a spanning forest of the links."""

    def run(key, left, right):
        cell, first, second = (k.as_py() for k in key)
        same, width = first == second, cell >> WIDTH
        if not left.num_rows or not (same or right.num_rows):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        sides = [left] if same else [left, right]
        ids = [t["id"].to_numpy() for t in sides]
        copies = [t["copies"].to_numpy() for t in sides]
        units = [_matrix(t["unit"].combine_chunks(), width) for t in sides]
        earlier = _earlier([t["cells"] for t in sides], cell)
        counts = [np.zeros(len(i), np.int64) for i in ids]
        parent, joined = np.arange(sum(map(len, ids))), []
        columns = np.arange(len(ids[-1])) + (0 if same else len(ids[0]))
        for i in range(0, len(ids[0]), rows):
            at = np.arange(i, min(i + rows, len(ids[0])))
            linked = units[0][at] @ units[-1].T >= threshold
            if same:
                linked &= at[:, None] < columns[None, :]
            # only in the first cell that both are in
            if earlier[0].shape[1]:
                linked &= earlier[0][at] @ earlier[-1].T == 0
            counts[0][at] += linked @ copies[-1]
            counts[-1] += copies[0][at] @ linked
            parent, new = _join(linked, at, columns, parent)
            joined += new
        every, total = np.concatenate(ids), np.concatenate(counts)
        some = np.flatnonzero(total)
        pairs = np.array(joined, np.int64).reshape(-1, 2)
        return pa.table({
            "a": pa.array(np.concatenate([every[pairs[:, 0]], every[some]])),
            "b": pa.concat_arrays([pa.array(every[pairs[:, 1]]), pa.nulls(len(some), pa.int64())]),
            "links": pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(total[some])]),
        })

    return run


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, cell_rows: int = 500, most_centres: int = 1024, sample_rows: int = 20_000, margin: float = 0.12, most_cells: int = 8, part_rows: int = 4_000, large: int = 20, seed: int = 11
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    classes = landed(classes_of(rows).withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    usable = landed(classes.select("id", "class", "copies", "vector").mapInArrow(_units, "id long, class long, copies long, width int, unit array<double>"), "vector-units")
    counts = {r["width"]: r["count"] for r in usable.groupBy("width").count().filter(F.col("count") >= 2 * cell_rows).collect()}
    found = {}
    for width, count in counts.items():  # lengths that are common
        found[width] = cells_for(usable.filter(F.col("width") == width), min(most_centres, count // cell_rows), sample_rows, margin, seed)
    sent = spark.sparkContext.broadcast(found)  # most_centres rows a length at most
    assigned = landed(usable.select("id", "copies", "width", "unit").mapInArrow(_assigned(sent, most_cells), f"{ROW}, cell long"), "vector-cells")
    in_cell = small_cells(assigned, sent, most_cells, cell_rows, most_centres, sample_rows, margin, seed, large)
    in_cell = landed(in_cell.withColumn("cells", F.collect_list("cell").over(Window.partitionBy("id"))), "vector-cells")
    discard(usable)
    discard(assigned)
    parts = in_cell.groupBy("cell").count().select("cell", F.ceil(F.col("count") / part_rows).cast("int").alias("parts"))
    several = F.broadcast(parts.filter("parts > 1"))  # one in part_rows rows at most
    dealt = in_cell.join(several, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    pairs = F.sequence(F.lit(0), F.col("parts") - 1)
    left = dealt.withColumn("other", F.explode(pairs)).filter("part <= other").selectExpr("cell", "part as first", "other as second", "id", "copies", "unit", "cells")
    right = dealt.withColumn("other", F.explode(pairs)).filter("other < part").selectExpr("cell", "other as first", "part as second", "id", "copies", "unit", "cells")
    right = right.toDF(*right.columns)  # columns of its own, as both sides stem from one table
    key = ["cell", "first", "second"]
    found = landed(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pairs(threshold), "a long, b long, links long"), "vector-links")
    discard(in_cell)
    links = found.filter("links is not null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    component = connected_components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    named = classes.select("id", "vector", "vec_id", "copies").join(links, "id", "left").join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("least"))
    by_class = named.join(least, "component").select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "least")
    out = rows.join(by_class, "vector", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
