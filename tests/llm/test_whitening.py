import random
from fractions import Fraction

import numpy as np
import pytest

from shelfmark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, key long, vector string, n int, part int"


@pytest.fixture
def embeddings(spark):
    """Vectors with extra columns whose names the operator uses itself."""

    def make(vectors, parts=3, ids=None):
        ids = range(len(vectors)) if ids is None else ids
        rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x", 3, 4) for i, v in zip(ids, vectors)]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)

    return make


def exact(vectors):
    """n, sums and covariance of x by fractions."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    dev = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in dev), n**3) for j in range(d)] for i in range(d)]
    return n, dev, cov


def check(rows, vectors, k):
    """Everything that the results must hold, from exact numbers."""
    n, dev, cov = exact(vectors)
    v = np.array([[float(c) for c in line] for line in cov])
    e = np.linalg.eigvalsh(v)[::-1]
    z = np.full((n, k), np.nan)
    for r in rows:
        assert r.n == n and r.deviation == sum(c * c for c in dev[r.vec_id]) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-8)
        z[r.vec_id, r.component - 1] = r.whitened
    assert not np.isnan(z).any() and len(rows) == n * k
    assert np.abs(z.mean(axis=0)).max() < 1e-9
    error = np.abs(z.T @ z / n - np.eye(k)).max()
    assert error < 1e-9 and abs(error - rows[0].identity_error) < 1e-9
    # the components themselves: z times its deviations is a projection on orthonormal eigenvectors
    centred = np.array(dev, float) / n
    unit = np.linalg.lstsq(centred, z * np.sqrt(e[:k]), rcond=None)[0]
    assert np.abs(v @ unit - unit * e[:k]).max() < 1e-9 * e[0]
    return unit


def normal(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.05, 0.6, d)).astype(np.float32).tolist()


def test_components_whiten_and_do_not_depend_on_partitions(embeddings):
    vectors = normal(300, 12)
    one = whitening.whitened_components(embeddings(vectors, 1), 8).collect()
    unit = check(one, vectors, 8)
    many = whitening.whitened_components(embeddings(vectors, 40), 8).collect()
    assert np.abs(np.abs(check(many, vectors, 8)) - np.abs(unit)).max() < 1e-9


def test_more_components_than_entries(embeddings):
    vectors = normal(50, 3)
    check(whitening.whitened_components(embeddings(vectors)).collect(), vectors, 3)


def test_equal_variances_and_dependent_entries(embeddings):
    # 8 corners of a cube: three equal variances; the fourth entry repeats the first, the fifth is constant
    cube = [[a, b, c, a, 0.5] for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    rows = whitening.whitened_components(embeddings(cube)).collect()
    check(rows, cube, 3)
    assert sorted({round(r.explained, 12) for r in rows}) == [0.25, 0.5]


def test_unusable_vectors_take_no_part(embeddings):
    vectors = normal(40, 4)
    bad = [None, [], [None, 1, 1, 1], [float("nan"), 0, 0, 0], [float("inf"), 0, 0, 0], [0, 0, float("-inf"), 0], [1, 2, 3], [1] * 9]
    rows = whitening.whitened_components(embeddings([*vectors, *bad])).collect()
    check(rows, vectors, 4)


def test_repeated_rows_and_rows_without_id_count(embeddings):
    vectors = normal(30, 3)
    rows = whitening.whitened_components(embeddings([*vectors, *vectors], ids=[*range(30), *[None] * 30])).collect()
    assert len(rows) == 180 and {r.n for r in rows} == {60} and sum(r.vec_id is None for r in rows) == 90


@pytest.mark.parametrize("vectors", [[], [None], [[0.5, 0.25]], [[0.5, 0.25]] * 5])
def test_no_variance_gives_no_rows(embeddings, vectors):
    got = whitening.whitened_components(embeddings(vectors))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_huge_entries_stay_exact_or_null(embeddings):
    rng = random.Random(2)
    large = [[rng.uniform(-1, 1) * 1.5e6, rng.uniform(-1, 1)] for _ in range(20)]
    check(whitening.whitened_components(embeddings(large), 1).collect(), large, 1)
    rows = whitening.whitened_components(embeddings([*large, [3e38, -3e38]]), 2).collect()
    assert {r.deviation for r in rows if r.vec_id == 20} == {None} and all(np.isfinite(r.whitened) for r in rows)


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(1)
    for most in (1, 100, 2**20, 2**25, 2**26, 2**40, 2**51):
        y = rng.integers(-most, most, (33, 3), endpoint=True)
        y[0] = most
        limbs = whitening.exact_products(y)
        got = [whitening._numbers(limbs[:, i].ravel().tolist()) for i in range(3)]
        assert got == (y.astype(object).T @ y.astype(object)).tolist(), most


def spectrum(values, seed=0):
    """A symmetric matrix with these eigenvalues, its vectors orthogonal to extended precision."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(d) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


CASES = {
    "apart": np.linspace(1, 0.01, 24),
    "equal": np.repeat([1.0, 0.5, 0.25], 8),
    "clusters closer than float32": np.repeat([1.0, 0.5, 0.25], 8) + np.arange(24) * 1e-10,
    "rank": np.r_[np.ones(4), np.zeros(20)],
    "wide": 10.0 ** -np.arange(12),
}


@pytest.mark.parametrize("name", CASES)
def test_refinement_reaches_double_precision(name):
    a = spectrum(CASES[name])
    start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    before = np.abs(a @ start - start * np.diag(start.T @ a @ start)).max()
    values, x = whitening.refined_eigenvectors(a, start)
    assert before > 1e-10 and np.abs(a @ x - x * values).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-15
    assert np.abs(values - np.sort(CASES[name])[::-1]).max() < 1e-16
    assert (np.diff(values) <= 0).all()
