"""Whitening against numpy's eigenvectors, exact deviations, degenerate tables."""

import math
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import whitening

SCHEMA = "component string, vec_id bigint, Embedding string, embedding array<float>, n string"


def table(spark, rows):
    wide = [("a", i, "b", None if v is None else [None if c is None else float(c) for c in v], "c") for i, v in rows]
    return spark.createDataFrame(wide, SCHEMA)


def brute(rows, count=4):
    """Result rows from the definition, with numpy's symmetric eigenvalues."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    sizes = Counter(len(v) for _, v in kept)
    d = max(sizes, key=lambda s: (sizes[s], s)) if sizes else 0
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in kept if len(v) == d]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    if n < 2:
        return []
    z = np.array([[c - s / n for c, s in zip(x, sums, strict=True)] for x in fit])
    e, u = np.linalg.eigh(z.T @ z / n)
    out = []
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        for k in range(min(count, d)):
            if e[-1 - k] > 1e-9 * e[-1]:
                at = np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ u[:, -1 - k]
                out.append((i, k + 1, n, deviation, at / math.sqrt(e[-1 - k]), e[-1 - k] / e.sum()))
    return out


def compare(found, want):
    key = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    found = sorted(map(tuple, found), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    for component in {r[1] for r in want}:
        ours = np.array([r[4] for r in found if r[1] == component])
        theirs = np.array([r[4] for r in want if r[1] == component])
        assert np.allclose(np.abs(ours), np.abs(theirs), rtol=1e-7, atol=1e-7)
        big = np.abs(theirs) > 1e-6
        assert len(set(np.sign(ours[big] * theirs[big]))) == 1  # one sign for all rows
    assert np.allclose([r[5] for r in found], [r[5] for r in want], rtol=1e-9)
    assert all(0 <= r[6] <= 1e-10 for r in found)


def random_rows(n, d, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.geomspace(1, 0.01, d)
    return [(int(k), (rng.normal(size=d) @ mix + 3).tolist()) for k in range(n)]


def test_against_numpy(spark):
    rows = random_rows(300, 12, 1)
    rows += [(1000 + k, rows[0][1]) for k in range(150)] + [(0, rows[0][1]), (None, rows[5][1])]
    rows += [(7, None), (8, []), (9, [None] * 12), (10, [float("nan")] * 12), (11, [1.0] * 11 + [float("-inf")])]
    rows += [(12, [1.0, 2.0]), (13, [-0.0] * 12)]
    compare(whitening.components(table(spark, rows).repartition(5)).collect(), brute(rows))


@pytest.mark.parametrize("d", [1, 2, 3])
def test_few_dimensions(spark, d):
    rows = random_rows(40, d, d)
    found = whitening.components(table(spark, rows)).collect()
    assert {r.component for r in found} == set(range(1, d + 1))
    compare(found, brute(rows))


def test_flat_directions_give_no_component(spark):
    rows = [(k, [k % 7, 2.0 * (k % 7), 5.0, k % 3]) for k in range(40)]
    found = whitening.components(table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    compare(found, brute(rows))


def test_one_vector_or_none(spark):
    assert whitening.components(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    empty = whitening.components(table(spark, [(1, None)]))
    assert empty.count() == 0 and "identity_error" in empty.columns
    assert whitening.components(table(spark, [(1, [1.0])]).limit(0)).count() == 0


def test_far_from_the_origin_and_beyond_a_long(spark):
    rows = [(k, [2.0**22 + k % 5 / 256, -(2.0**22) + k % 3 / 128]) for k in range(30)]
    compare(whitening.components(table(spark, rows)).collect(), brute(rows))
    huge = [(k, [k * 1e30, float(k % 2)]) for k in range(6)]
    found = whitening.components(table(spark, huge)).collect()
    assert {r.vec_id for r in found} == set(range(6)) and all(math.isfinite(r.whitened) for r in found)
    assert all(r.deviation is None for r in found)


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(30, 40)) * np.geomspace(1, 1e-6, 30)[:, None]
    v = a @ a.T
    factor = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v, atol=1e-12)
    unit, values = whitening.one_sided_jacobi(factor)
    want = np.linalg.svd(a)[1] ** 2
    assert np.allclose(values, want, rtol=1e-9)
    assert np.allclose(unit.T @ unit, np.eye(30), atol=1e-12)
    assert np.all(np.diff(values) <= 0)
