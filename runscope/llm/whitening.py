"""Embedding whitening: eigenvectors by incremental rank-one updates in partitions, merged spectra, and a distributed Rayleigh-Ritz step.

Every component c of a vector becomes the integer x = floor(`scale` * c) + `shift`. A partition keeps the count, the mean and the
eigenpairs of the scatter of its vectors and updates them for each vector: with k vectors before it, the scatter gains
k / (k + 1) times the outer product of the vector's distance from the mean. That is a diagonal plus a rank-one matrix in the basis of
the eigenvectors (`rank_one`): parts of the update that are negligible, or that lie along equal eigenvalues but for one reflected
direction, are deflated; each other eigenvalue is the root of the secular equation between two poles; eigenvectors come from a vector
that is recomputed from the roots (Gu and Eisenstat), so they are orthogonal however near the roots are. Two partitions' spectra are
merged by the same updates, one for each eigenpair of the second and one for the distance of the means, in a tree of tasks that read
`fan` spectra each; so neither the driver nor a task holds more than a few d x d matrices.

The basis so found is refined once: partitions project their centred vectors on it and sum the outer products (d x d, merged in the same
tree), and the Ritz pairs of that matrix, which is diagonal but for rounding, are the components. Means are of exact integer sums.

Defined cases: vectors that are null, empty or hold null or non-finite entries are left out; vectors of each other length are whitened
among themselves (n, components and identity_error are theirs); repeated rows and null ids are vectors each; components without variance
(eigenvalue up to 1e-12 of the trace: a single vector, equal vectors, more dimensions than vectors) are not returned, so a vector can have
fewer components than `components` or none; a deviation beyond decimal(38,0) is not reached in practice and would be null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runscope.llm.shared import discard, landed, ship

EPS = float(np.finfo(np.float64).eps)


def _roots(d: np.ndarray, zz: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(zz / (d - x)) for ascending, different d: the pole that each is nearest to, and its distance from it.

    The i-th root lies between d[i] and d[i + 1], the last below d[-1] + rho * sum(zz). All are found at once: a step solves the equation
    with one pole on either side in place of all; a step that leaves the bracket bisects it.
    """
    k = len(d)
    width = np.append(np.diff(d), rho * zz.sum())
    right = np.append(np.arange(1, k), k - 1)
    middle = 1 + rho * (zz / (d[None, :] - (d + width / 2)[:, None])).sum(1)
    origin = np.where((middle < 0) & (np.arange(k) < k - 1), right, np.arange(k))
    delta = d[None, :] - d[origin][:, None]  # the poles as seen from the origin
    above = origin != np.arange(k)
    low = np.where(above, -width / 2, np.where(middle < 0, width / 2, 0.0))
    high = np.where(above, 0.0, np.where(middle < 0, width, width / 2))
    x = (low + high) / 2
    left_pole, right_pole = np.diagonal(delta), np.append(delta[np.arange(k - 1), right[:-1]], 2 * high[-1])  # no pole is beyond the last root
    below = np.tri(k)  # poles up to the left one
    beyond, weight = 1 - below, rho * zz
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(80):
            gap = delta - x[:, None]
            part = weight / gap
            slope = part / gap
            psi, dpsi, phi, dphi = (np.einsum("ij,ij->i", m, half) for half in (below, beyond) for m in (part, slope))
            f = 1 + psi + phi
            done = np.abs(f) <= 8 * k * EPS * (1 - psi + phi)
            if done.all():
                break
            rising = f > 0  # f rises between poles
            high, low = np.where(rising, x, high), np.where(rising, low, x)
            # psi is taken as r + p / (a - y), phi as t + q / (b - y), both exact in value and slope at y = 0; the step solves c + p / (a - y) + q / (b - y) = 0
            a, b = left_pole - x, right_pole - x
            p, q = dpsi * a, dphi * b
            c = f - p - q
            p, q = p * a, q * b
            B, C = c * (a + b) + p + q, c * a * b + p * b + q * a
            root = np.sqrt(np.maximum(B * B - 4 * c * C, 0))
            new = x + np.where(B > 0, 2 * C / (B + root), (B - root) / (2 * c))
            x = np.where(done, x, np.where((new > low) & (new < high), new, (low + high) / 2))
            if (low >= high).all():
                break
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of vectors @ diag(values) @ vectors.T + rho * outer(v, v), for ascending values and rho > 0; vectors: one a column."""
    z = v @ vectors
    length = float(np.sqrt(z @ z))
    if rho <= 0 or length == 0:
        return values, vectors
    rho, z = rho * length * length, z / length
    tol = 8 * EPS * max(float(np.abs(values).max()), rho)
    vectors = vectors.copy()
    # along nearly equal values: a reflection leaves one direction with all of z
    starts = np.flatnonzero(np.append(True, np.diff(values) > tol))
    for first, end in zip(starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True):
        if end - first > 1 and (own := float(np.sqrt(z[first:end] @ z[first:end]))) > 0:
            mirror = z[first:end].copy()
            mirror[-1] += own if mirror[-1] >= 0 else -own
            part = vectors[:, first:end]
            vectors[:, first:end] = part - np.outer(part @ mirror, mirror) * (2 / (mirror @ mirror))
            z[end - 1] = -own if z[end - 1] >= 0 else own
            z[first : end - 1] = 0
    live = np.flatnonzero(rho * np.abs(z) > tol)
    if not len(live):
        return values, vectors
    d, own = values[live], z[live]
    origin, x = _roots(d, own * own, rho)
    gap = (d[None, :] - d[origin][:, None]) - x[:, None]  # pole minus root: a row a root
    # z again, from the roots: products of (root - pole) over (other pole - pole), paired so that none over- or underflows
    k = len(d)
    poles = d[:, None] - d[None, :]
    np.fill_diagonal(poles, 1)
    ratio = np.empty((k, k))
    lower = np.tri(k, k, -1, dtype=bool)  # root i < pole j is paired with pole i, root i >= j with pole i + 1
    ratio[:] = np.where(lower.T, gap / np.where(lower.T, -poles, 1), 1.0)
    rest = np.tri(k, k, 0, dtype=bool)[:-1]  # rows i >= column j, but for the last root
    ratio[:-1] = np.where(rest, -gap[:-1] / np.where(rest, d[1:, None] - d[None, :], 1), ratio[:-1])
    ratio[-1] = -gap[-1]
    again = np.sqrt(np.maximum(np.abs(ratio).prod(0), 0)) * np.where(own < 0, -1, 1)
    turned = again[:, None] / np.where(gap.T == 0, EPS * tol + np.finfo(float).tiny, gap.T)
    turned /= np.sqrt((turned * turned).sum(0))
    values = values.copy()
    values[live] = d[origin] + x
    vectors[:, live] = vectors[:, live] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Of a set of vectors: their number, mean, exact sums, and the eigenpairs of their scatter (ascending, a column each)."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, [0] * width, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, rows: np.ndarray) -> None:
        self.sums = [a + b for a, b in zip(self.sums, rows.sum(0).tolist(), strict=True)]
        for row in rows.astype(np.float64):
            away = row - self.mean
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
            self.n += 1
            self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        away = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / (self.n + other.n))
        self.n, self.sums = self.n + other.n, [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        self.mean = np.array([s / self.n for s in self.sums])

    def batch(self) -> pa.RecordBatch:
        width = len(self.mean)
        rows = [[width], [self.n], [self.sums], [self.values.tolist()], [self.vectors.ravel().tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 2), strict=True)], names=["width", "n", "sums", "eigenvalues", "basis"])

    @classmethod
    def of(cls, row) -> Spectrum:
        n, sums, width = row["n"], list(row["sums"]), row["width"]
        return cls(n, sums, np.array([s / max(n, 1) for s in sums]), np.array(row["eigenvalues"]), np.array(row["basis"]).reshape(width, width))


SPECTRUM = "width int, n long, sums array<long>, eigenvalues array<double>, basis array<double>"


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, rows, x: a row of integers each) of a batch with x as lists."""
    widths = batch.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        yield width, at, batch.column("x").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(width, x) -> the spectrum of this task's vectors, a row for each width."""
    own: dict[int, Spectrum] = {}
    for batch in batches:
        for width, _, x in _by_width(batch):
            own.setdefault(width, Spectrum.empty(width)).add(x)
    for spectrum in own.values():
        yield spectrum.batch()


def _merged_spectra(table: pa.Table) -> pa.Table:
    rows = table.drop(["part"]).to_pylist()
    whole = Spectrum.of(rows[0])
    for row in rows[1:]:
        whole.merge(Spectrum.of(row))
    return pa.Table.from_batches([whole.batch()])


def _moments(models, wanted: Callable):
    """(width, x) -> the sum of y and of the outer products of y over this task's vectors, y = wanted(model, x); a row for each width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _by_width(batch):
                y = wanted(models.value[width], x)
                y = np.concatenate([y, np.ones((len(y), 1))], 1)
                sums[width] = sums.get(width, 0) + y.T @ y
        for width, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([own.ravel().tolist()], pa.list_(pa.float64()))], names=["width", "moments"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = np.sum([np.array(r) for r in table["moments"].to_pylist()], axis=0)
    return pa.table({"width": table["width"].slice(0, 1), "moments": pa.array([total.tolist()], pa.list_(pa.float64()))})


def tree(rows: DataFrame, merge: Callable[[pa.Table], pa.Table], fan: int = 8) -> list:
    """Merges rows of each width, `fan` of them in a task, until one is left, and returns those: one a width."""

    def keyed(key, table):
        return merge(table).append_column("part", pa.array([key[1].as_py()], pa.int64()))

    names = [f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema]
    numbered = landed(rows.withColumn("part", F.monotonically_increasing_id()), "spectra")
    while True:
        counts = numbered.groupBy("width").count().agg(F.max("count")).first()[0] or 0
        if counts <= 1:
            return numbered.collect()
        groups = numbered.withColumn("part", F.row_number().over(Window.partitionBy("width").orderBy("part")) - 1).withColumn("part", F.expr(f"part div {fan}"))
        last, numbered = numbered, landed(groups.groupBy("width", "part").applyInArrow(keyed, ", ".join([*names, "part long"])), "spectra")
        discard(last)


@dataclass
class Model:
    """Of a width: number and exact sums of its vectors, mean, eigenvalues (falling) and unit eigenvectors (a column each) of the covariance, and its trace."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exactly: in 64 bits where they suffice, else in Python's integers."""
        most = max(max(abs(self.n * int(x[:, j].min()) - s), abs(self.n * int(x[:, j].max()) - s)) for j, s in enumerate(self.sums))
        exact = np.int64 if most * most * len(self.sums) < 1 << 63 and self.n * int(np.abs(x).max()) < 1 << 63 else object
        away = self.n * x.astype(exact) - np.array(self.sums, exact)
        return (away * away).sum(1).tolist()


def integers(vectors: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, width, x) of the vectors that can be used."""
    value = F.col("vector")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    good = rows.filter((F.size(value) > 0) & ~F.exists(value, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return good.select("vec_id", F.size(value).alias("width"), F.transform(value, lambda c: F.floor(c * scale) + shift).alias("x"))


def fit(x: DataFrame, components: int) -> dict[int, Model]:
    """A model for each width of x (width, x)."""
    spark = x.sparkSession
    found = {r["width"]: Spectrum.of(r) for r in tree(x.select("width", "x").mapInArrow(_spectra, SPECTRUM), _merged_spectra)}
    basis = {w: (s.mean, np.linalg.qr(s.vectors[:, ::-1])[0]) for w, s in found.items()}
    sent = spark.sparkContext.broadcast(basis)  # d x d numbers for each width
    project = lambda model, rows: (rows - model[0]) @ model[1]
    rows = tree(x.select("width", "x").mapInArrow(_moments(sent, project), "width int, moments array<double>"), _added)
    models = {}
    for row in rows:
        width = row["width"]
        spectrum, moments = found[width], np.array(row["moments"]).reshape(width + 1, width + 1)
        own = moments[:-1, :-1] / spectrum.n
        values, turned = np.linalg.eigh((own + own.T) / 2)  # the Ritz pairs
        values, vectors = values[::-1], basis[width][1] @ turned[:, ::-1]
        kept = np.flatnonzero(values[:components] > 1e-12 * np.trace(own))
        models[width] = Model(spectrum.n, spectrum.sums, basis[width][0], values[kept], vectors[:, kept], float(np.trace(own)))
    return models


def _rows(models, errors: dict[int, float]):
    """(vec_id, width, x) -> a row for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, x in _by_width(batch):
                model = models.value[width]
                k = len(model.values)
                deviations = pa.array(model.deviations(x), pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(each), model.n, np.int64)), deviations.take(each),
                    pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.values / model.trace, len(at)) if k else np.zeros(0)), pa.array(np.full(len(each), errors[width])),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(vec_id, component, n, deviation: decimal, whitened, explained, identity_error), a row for each usable vector and component."""
    spark = vectors.sparkSession
    ship(spark)
    x = landed(integers(vectors, vec_id, vector, scale, shift), "whitening-rows")
    models = fit(x, components)
    sent = spark.sparkContext.broadcast(models)  # `components` rows a width
    errors = {}
    for row in tree(x.select("width", "x").mapInArrow(_moments(sent, Model.whitened), "width int, moments array<double>"), _added):
        n, own = models[row["width"]].n, np.array(row["moments"])
        own = own.reshape(int(len(own) ** 0.5), -1) / n
        covariance = own[:-1, :-1] - np.outer(own[-1, :-1], own[-1, :-1])
        errors[row["width"]] = float(np.abs(covariance - np.eye(len(covariance))).max()) if len(covariance) else 0.0
    kind = dict(x.dtypes)["vec_id"]
    return x.mapInArrow(_rows(sent, errors), f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
