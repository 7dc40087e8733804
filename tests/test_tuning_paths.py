"""Warm penalty paths with strong rules: same fits as the plain way, less summed."""

import numpy as np
import pytest

from hhlens.operators import linear_tuning, models, sampling
from hhlens.plans import registry as R
from hhlens.plans import specs

from conftest import SF001


def _one_step(beta, grad, hess, cols, l1, l2):
    """Coordinate descent on one quadratic model, one number at a time."""
    new = beta.copy()
    for _ in range(5000):
        for j in np.flatnonzero(cols):
            slope = grad[j] + hess[j] @ (new - beta)
            u = hess[j, j] * new[j] - slope
            new[j] = u / hess[j, j] if j == 0 else np.sign(u) * max(abs(u) - l1, 0) / (hess[j, j] + l2)
    return new


def test_steps_of_all_models_equal_steps_one_by_one():
    rng = np.random.default_rng(3)
    m, k = 7, 6
    z = rng.normal(size=(m, 40, k))
    hess = np.einsum("mik,mij->mkj", z, z) / 40
    beta, grad = rng.normal(size=(m, k)), rng.normal(size=(m, k))
    cols = rng.random((m, k)) < 0.7
    cols[:, 0] = True
    l1 = np.array([0.0, 0.0, 0.05, 0.3, 1.0, 5.0, 0.1])
    l2 = np.array([0.0, 0.5, 0.0, 0.2, 0.0, 0.1, 0.4])
    cols[l1 == 0] = True                                     # without an L1 part nothing is screened
    got = linear_tuning._steps(beta, grad, hess, cols, l1, l2)
    for i in range(m):
        want = _one_step(beta[i], grad[i], hess[i], cols[i], l1[i], l2[i])
        assert np.allclose(got[i], want, atol=1e-8)
        assert (got[i][~cols[i]] == beta[i][~cols[i]]).all()
    assert (got[5, 1:][cols[5, 1:]] == 0).all()
    assert linear_tuning._steps(beta[:0], grad[:0], hess[:0], cols[:0], l1[:0], l2[:0]).shape == (0, k)


def test_groups_hold_every_model_once_within_its_columns():
    rng = np.random.default_rng(4)
    keep = {c: np.r_[True, rng.random(12) < q] for c, q in enumerate(np.linspace(0, 1, 60))}
    groups = linear_tuning._groups(keep)
    assert sorted(c for _, ms in groups for c in ms) == sorted(keep)
    for cols, ms in groups:
        for c in ms:
            own = np.flatnonzero(keep[c])
            assert set(own) <= set(cols) and len(cols) ** 2 <= 2 * len(own) ** 2


def test_anchors_of_a_path():
    cands = [{"alpha": 1.0, "reg": r} for r in (0.3, 0.1, 0.9, 0.5, 0.7, 0.2)] + [{"alpha": 0.0, "reg": 1.0}]
    got = linear_tuning._paths([(0, i) for i in range(7)], cands, 4)
    # By falling penalty: 2, 4, 3, 0 | 5, 1; the last is an anchor, a path of one is its own.
    assert got == {(0, 2): None, (0, 4): (0, 2), (0, 3): (0, 2), (0, 0): (0, 2), (0, 5): None, (0, 1): None, (0, 6): None}


@pytest.fixture(scope="module")
def folded(spark):
    d = sampling.kfold(R.model_input(spark, SF001), specs.LABEL, 3, 123).cache()
    yield d
    d.unpersist()


GRID = models.expand_grid(alpha=[0.0, 0.5, 1.0], reg=[10 ** (-4 + 0.2 * i) for i in range(16)])


def _tune(d, **how):
    cv = linear_tuning.cross_validate_linear(d, specs.LINEAR_PREDICTORS, specs.LABEL, "fold", GRID, **how)
    cv.release()
    return cv


def _same(a, b, tol=2e-6):
    assert a.fits.keys() == b.fits.keys()
    assert max(np.abs(a.fits[m][0] - b.fits[m][0]).max() for m in a.fits) < tol
    assert all(gap <= linear_tuning.KKT_TOL for _, gap in a.fits.values())


def test_warm_paths_fit_the_same_with_less(folded):
    plain, warm = _tune(folded, stride=1, screen=False), _tune(folded)
    _same(warm, plain)
    # Anchors may need one scan more than a cold start of all models from the same null model.
    assert warm.work["scans"] <= plain.work["scans"] + 1
    assert warm.work["models"] < plain.work["models"]
    assert warm.work["entries"] < plain.work["entries"]


def test_columns_screened_by_mistake_come_back(folded, monkeypatch):
    plain = _tune(folded, stride=1, screen=False)
    monkeypatch.setattr(linear_tuning, "strong_columns", lambda beta, grad, l1, l1_from:
                        np.ones(len(beta), bool) if l1 == 0 else np.arange(len(beta)) == 0)
    _same(_tune(folded), plain)


def test_constant_and_repeated_columns(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        a, b = rng.normal(size=2)
        rows.append((i, i % 3, float(a), float(a), 7.1, float(b), int(rng.random() < 1 / (1 + np.exp(-a)))))
    d = spark.createDataFrame(rows, "id long, fold int, a double, twin double, same double, b double, y int")
    cands = models.expand_grid(alpha=[0.0, 1.0], reg=[0.001, 0.01, 0.05, 0.1, 0.2])
    cv = linear_tuning.cross_validate_linear(d, ["a", "twin", "same", "b"], "y", "fold", cands)
    assert all(gap <= linear_tuning.KKT_TOL for _, gap in cv.fits.values())
    assert all(beta[3] == 0 for beta, _ in cv.fits.values())
    for (f, i), (beta, _) in cv.fits.items():
        if cands[i]["alpha"] == 0:
            assert beta[1] == pytest.approx(beta[2], abs=1e-6)          # ridge shares between twins
    cv.release()
