"""Whitened vectors against fractions and plain numpy."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from veilmark.llm import whitening

VECTOR = "vec_id long, embedding array<float>, x string, n string, component string, position string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * 4) for i, v in rows], VECTOR)


def usable(rows):
    found = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in found), default=0)
    return [(i, tuple(math.floor(np.float64(np.float32(c)) * 64) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))) for i, v in found]


def exact_covariance(fit):
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[n * c - s for c, s in zip(v, sums)] for v in fit]
    d = len(sums)
    return np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])


def odd_vectors(count=60, width=20, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1 + j / 5) + (i % 3) for j in range(width)]) for i in range(count)]
    rows += [(3, rows[3][1]), (1000, rows[4][1]), (None, rows[5][1]), (1001, rows[6][1][: width // 2])]
    rows += [(1002, []), (1003, None), (1004, [None] * width), (1005, [float("nan")] * width), (1006, [float("inf")] + [0.0] * (width - 1))]
    return rows


def test_whitening_matches_exact_arithmetic(spark):
    rows = odd_vectors()
    found = whitening.whitened(vectors_of(spark, rows)).collect()
    whole = usable(rows)
    fit = sorted({v for _, v in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    v = exact_covariance(fit)
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(found) == 16 * len(whole)
    assert {r["n"] for r in found} == {n} and {r["component"] for r in found} == set(range(1, 17))
    share = {r["component"]: r["explained"] for r in found}
    assert all(abs(share[i + 1] / (values[i] / np.trace(v)) - 1) < 1e-9 for i in range(16))
    deviations = sorted((-1 if i is None else i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in whole)
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == deviations
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    # Each component is a unit eigenvector: the whitened values are those of numpy's, up to sign.
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for _, x in whole])
    own = np.linalg.eigh(v)
    for k in range(1, 17):
        expected = centred @ own.eigenvectors[:, -k] / math.sqrt(own.eigenvalues[-k])
        values = {r["vec_id"]: r["whitened"] for r in found if r["component"] == k}
        sign = np.sign(values[0] * expected[0])
        assert all(abs(values[i] - sign * e) < 1e-8 for (i, _), e in zip(whole, expected))


def test_polarisation_is_exact(spark):
    rng = random.Random(9)
    fit = [[rng.randrange(-(10**9), 10**9) + 10**6 for _ in range(4)] for _ in range(50)]
    fit += [[c + 10**7 for c in fit[0]]]
    n, centre, rest, matrix = whitening.covariance(spark.createDataFrame([(v,) for v in fit], "x array<long>").repartition(5))
    sums = [sum(c) for c in zip(*fit)]
    assert n == 51 and [n * c + r for c, r in zip(centre, rest)] == sums
    assert (matrix == exact_covariance(fit)).all()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_spread_there_are_no_components(spark, rows):
    assert whitening.whitened(vectors_of(spark, rows)).collect() == []


def test_fewer_components_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    found = whitening.whitened(vectors_of(spark, rows)).collect()
    assert {r["component"] for r in found} == {1} and found[0]["identity_error"] < 1e-9
    assert abs(found[0]["explained"] - 1) < 1e-12


def test_values_that_do_not_fit_are_refused(spark):
    with pytest.raises(Exception, match="fit a long"):
        whitening.whitened(vectors_of(spark, [(1, [1e12]), (2, [-1e12])])).collect()
