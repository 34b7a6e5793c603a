"""The logistic model's summary against Newton steps and the inverse Fisher information in numpy."""

import math

import numpy as np
import pytest

from binledger.plans import ml


def newton(x, y):
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        information = x.T @ (x * (p * (1 - p))[:, None])
        w = w + np.linalg.solve(information, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ w))
    return w, np.sqrt(np.diag(np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None])))), -2 * np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(3)
    a, kind = draw.normal(size=400), draw.integers(0, 3, 400)
    y = (draw.random(400) < 1 / (1 + np.exp(-(0.5 + a - kind)))).astype(int)
    df = spark.createDataFrame([(float(u), "xyz"[k], int(v)) for u, k, v in zip(a, kind, y)], "a double, kind string, y int")
    return df, a, kind, y


def test_summary_of_terms(spark, sample):
    df, a, kind, y = sample
    got = {r.term: r for r in ml.logistic_summary(df, "y ~ a + kind").collect()}
    dropped = ({"x", "y", "z"} - {t[5:] for t in got if t.startswith("kind_")}).pop()
    others = [k for k in "xyz" if k != dropped]
    x = np.stack([np.ones(400), a, *[(kind == "xyz".index(k)).astype(float) for k in others]], axis=1)
    w, error, deviance = newton(x, y)
    for i, term in enumerate(["(Intercept)", "a", *[f"kind_{k}" for k in others]]):
        r = got[term]
        assert (r.coefficient, r.std_error) == pytest.approx((w[i], error[i]), rel=1e-5)
        assert r.z_value == pytest.approx(w[i] / error[i], rel=1e-5)
        assert r.p_value == pytest.approx(math.erfc(abs(w[i] / error[i]) / math.sqrt(2)), rel=1e-4, abs=1e-9)
    fit = ml.logistic_fit(df, "y ~ a + kind").first()
    assert (fit.residual_deviance, fit.aic) == pytest.approx((deviance, deviance + 8), rel=1e-6)
    share = y.mean()
    assert fit.null_deviance == pytest.approx(-800 * (share * math.log(share) + (1 - share) * math.log(1 - share)), rel=1e-6)
    assert (fit.null_degrees, fit.residual_degrees) == (399, 396) and fit.iterations > 0


def test_without_intercept_every_category_has_its_log_odds(spark, sample):
    df, _, kind, y = sample
    got = {r.term: r for r in ml.logistic_summary(df, "y ~ kind - 1").collect()}
    assert set(got) == {"kind_x", "kind_y", "kind_z"}
    for k in range(3):
        good, n = y[kind == k].sum(), (kind == k).sum()
        r = got[f"kind_{'xyz'[k]}"]
        assert (r.coefficient, r.std_error) == pytest.approx((math.log(good / (n - good)), math.sqrt(1 / good + 1 / (n - good))), rel=1e-6)
