"""Whitening against numpy's eigenvectors of the whole covariance."""

import numpy as np
import pytest

from runscope.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, width string, x int, part int"


def check(rows, got, components=8):
    """rows: (id, list of floats), all usable and of one length; got: the result's rows for them."""
    x = np.floor(1024 * np.array([np.array(v, np.float32) for _, v in rows]).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:components] > 1e-12 * values.sum()).sum())
    assert len(got) == n * k
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    signs = None
    for i, (vec_id, _) in enumerate(rows):
        for own in zip(*[by_id[vec_id][c] for c in range(1, k + 1)], strict=True):
            assert {r["n"] for r in own} == {n}
            assert np.allclose([r["explained"] for r in own], values[:k] / values.sum(), rtol=1e-9)
            assert all(r["identity_error"] < 1e-9 for r in own)
        if sum(j == vec_id for j, _ in rows) == 1:
            own = [by_id[vec_id][c][0] for c in range(1, k + 1)]
            assert {int(r["deviation"]) for r in own} == {sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))}
            y = np.array([r["whitened"] for r in own])
            big = np.abs(want[i]) > 1e-3
            signs = np.sign(y * want[i]) if signs is None and big.all() else signs
            assert np.allclose(np.abs(y), np.abs(want[i]), atol=1e-8)
            assert signs is None or np.allclose(y, want[i] * signs, atol=1e-8)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("kind", ["normal", "common mean", "low rank", "copies"])
def test_components_match_numpy(spark, kind):
    r = np.random.default_rng(5)
    v = r.normal(size=(400, 12)) * np.linspace(1, 3, 12)
    if kind == "common mean":
        v = v * 0.1 + 5
    if kind == "low rank":  # in eighths, so that integers keep the rank
        v = (np.round(8 * r.normal(size=(400, 3))) @ np.round(3 * r.normal(size=(3, 12)))) / 8
    if kind == "copies":
        v[:150] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    check(rows, whitening.whiten(table(spark, rows)).collect())


def test_nulls_lengths_ties_and_empty_tables(spark):
    r = np.random.default_rng(6)
    good = [(i, r.normal(size=9).tolist()) for i in range(80)] + [(3, r.normal(size=9).tolist()), (None, r.normal(size=9).tolist())]
    short = [(1000 + i, r.normal(size=2).tolist()) for i in range(6)]
    bad = [(500, None), (501, []), (502, [1.0, None, *[0.0] * 7]), (503, [float("nan"), *[1.0] * 8]), (504, [float("-inf"), *[1.0] * 8]), (505, [1.0, 2.0, 3.0])]  # the last is alone with its length
    got = whitening.whiten(table(spark, good + short + bad)).collect()
    check(good, [g for g in got if g["n"] == 82])
    check(short, [g for g in got if g["n"] == 6])
    assert len(got) == 82 * 8 + 6 * 2
    assert whitening.whiten(table(spark, bad[:5], 1)).count() == 0
    assert whitening.whiten(table(spark, good).limit(0)).count() == 0
    same = [(i, [1.0, 2.0]) for i in range(10)]
    assert whitening.whiten(table(spark, same)).count() == 0


def test_few_vectors_and_fewer_components(spark):
    r = np.random.default_rng(7)
    rows = [(i, r.normal(size=30).tolist()) for i in range(6)]
    check(rows, whitening.whiten(table(spark, rows), components=4).collect(), 4)
    got = whitening.whiten(table(spark, rows)).collect()
    assert {g["component"] for g in got} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("case", ["random", "equal values", "zero entries", "close values", "tiny update", "huge update"])
def test_rank_one_updates(case):
    r = np.random.default_rng(8)
    k = 20
    values = np.sort(r.exponential(size=k))
    z = r.normal(size=k)
    rho = {"tiny update": 1e-13, "huge update": 1e9}.get(case, 0.7)
    if case == "equal values":
        values[3:9] = values[3]
    if case == "zero entries":
        z[::3] = 0
    if case == "close values":
        values = 1 + np.arange(k) * 1e-14
    q = np.linalg.qr(r.normal(size=(k, k)))[0]
    got, vectors = whitening.rank_one(values, q, q @ z, rho)
    want = q @ (np.diag(values) + rho * np.outer(z, z)) @ q.T
    scale = np.abs(want).max()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(vectors * got @ vectors.T - want).max() < 1e-12 * scale
    assert np.abs(got - np.linalg.eigvalsh(want)).max() < 1e-12 * scale and (np.diff(got) >= 0).all()


def test_merged_spectra_are_those_of_all_rows():
    r = np.random.default_rng(9)
    x = (np.floor(1024 * r.normal(size=(300, 10))) + 100_000).astype(np.int64)
    parts = [whitening.Spectrum.empty(10) for _ in range(4)]
    for p, rows in zip(parts, (x[:1], x[1:4], x[4:200], x[200:]), strict=True):
        p.add(rows)
    whole = parts[0]
    for p in parts[1:]:
        whole.merge(p)
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    assert whole.n == 300 and whole.sums == x.sum(0).tolist()
    assert np.allclose(whole.vectors * whole.values @ whole.vectors.T, scatter, rtol=0, atol=1e-10 * scatter.max())


def test_deviations_beyond_64_bits():
    x = np.array([[0, 5], [3 * 10**9, 7]], np.int64)
    model = whitening.Model(2, [3 * 10**9, 12], x.mean(0), np.ones(1), np.ones((2, 1)), 1.0)
    assert model.deviations(x) == [9 * 10**18 + 4] * 2
