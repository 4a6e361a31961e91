import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from cohortlab.functions.stats import t_two_sided_p
from cohortlab.operators import experiment as X
from cohortlab.sources import views
from conftest import SF_SMALL


def test_t_tail_known_values():
    assert math.isclose(t_two_sided_p(0.0, 10), 1.0)
    assert math.isclose(t_two_sided_p(2.0, 10), 0.07338803477074, rel_tol=1e-9)
    assert math.isclose(t_two_sided_p(-2.0, 10), 0.07338803477074, rel_tol=1e-9)
    for t in (0.3, 1.0, 7.0):          # closed forms of one and two degrees of freedom
        assert math.isclose(t_two_sided_p(t, 1), 1 - 2 / math.pi * math.atan(t), rel_tol=1e-9)
        assert math.isclose(t_two_sided_p(t, 2), 1 - t / math.sqrt(2 + t * t), rel_tol=1e-9)
        assert math.isclose(t_two_sided_p(t, 1e12), math.erfc(t / math.sqrt(2)), rel_tol=1e-5)


def test_ttest_matches_regression_on_arm(spark):
    trial = views.trial(spark, SF_SMALL)
    tv = {r.variable: r for r in X.ttest_verdict(trial, "test", ["income", "gamer"]).collect()}
    data = VectorAssembler(inputCols=["test"], outputCol="f").transform(trial.selectExpr("cast(test as double) test", "income"))
    m = LinearRegression(featuresCol="f", labelCol="income", solver="normal").fit(data)
    assert math.isclose(tv["income"].p_value, m.summary.pValues[0], rel_tol=1e-6)
    assert math.isclose(abs(tv["income"].t), abs(m.summary.tValues[0]), rel_tol=1e-6)
    assert tv["income"].verdict in (X.REJECT, X.KEEP)


def test_balance_and_nulls(spark):
    df = spark.createDataFrame([(0, 10.0), (0, None), (1, 15.0), (1, 5.0), (None, 99.0)], "test int, income double")
    r = X.balance(df, "test", ["income"]).first()
    assert (r.control, r.test, r.pct_diff) == (10.0, 10.0, 0.0)


def test_wald_and_errors_match_numpy(spark):
    iv = views.iv(spark, SF_SMALL)
    pdf = iv.toPandas()
    z, x, y = (pdf[c].to_numpy(float) for c in ("instrument", "treatment", "outcome"))
    Z = np.column_stack([np.ones_like(z), z])
    Xm = np.column_stack([np.ones_like(x), x])
    beta = np.linalg.solve(Z.T @ Xm, Z.T @ y)
    e = y - Xm @ beta
    A = np.linalg.inv(Z.T @ Xm)
    meat = (Z * e[:, None] ** 2).T @ Z
    se = math.sqrt((A @ meat @ A.T)[1, 1])
    w = X.wald(iv, "instrument", "treatment", "outcome").first()
    assert math.isclose(w.estimate, beta[1], rel_tol=1e-9) and math.isclose(w.intercept, beta[0], rel_tol=1e-9)
    got = X.wald_standard_error(iv, "instrument", "treatment", "outcome").first().standard_error
    assert math.isclose(got, se, rel_tol=1e-9)
    pa, pb = y[z == 1].mean(), y[z == 0].mean()
    itt = math.sqrt(pa * (1 - pa) / (z == 1).sum() + pb * (1 - pb) / (z == 0).sum())
    assert math.isclose(X.itt_standard_error(iv, "instrument", "outcome").first().standard_error, itt, rel_tol=1e-9)


def test_zero_first_stage_gives_null(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 0), (1, 0, 0), (0, 0, 1)], "instrument int, treatment int, outcome int")
    assert X.wald(df, "instrument", "treatment", "outcome").first().estimate is None


def test_rate_difference_in_differences(spark):
    rows = [(1, 1, 1), (1, 1, 0), (0, 1, 0), (1, 0, 1), (0, 0, 1), (0, 0, 0)]
    df = spark.createDataFrame(rows, "test int, gender int, purchase int")
    r = X.rate_difference(df, "test", "purchase", ["gender"], (1,), (0,)).first()
    assert math.isclose(r.diff, ((50 - 0) - (100 - 50)))
    assert r.abs_diff == abs(r.diff)


def test_two_sided_noncompliance_matches_numpy(spark):
    rng = np.random.default_rng(3)
    n = 2000
    z = rng.integers(0, 2, n)
    x = ((rng.random(n) < np.where(z == 1, 0.7, 0.2))).astype(int)      # treated without offer too
    y = ((rng.random(n) < 0.3 + 0.2 * x)).astype(int)
    df = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(z, x, y)],
                               "instrument int, treatment int, outcome int")
    Z = np.column_stack([np.ones(n), z])
    X_ = np.column_stack([np.ones(n), x])
    beta = np.linalg.solve(Z.T @ X_, Z.T @ y)
    e = y - X_ @ beta
    A = np.linalg.inv(Z.T @ X_)
    se = math.sqrt((A @ ((Z * e[:, None] ** 2).T @ Z) @ A.T)[1, 1])
    assert math.isclose(X.wald(df, "instrument", "treatment", "outcome").first().estimate, beta[1], rel_tol=1e-9)
    got = X.wald_standard_error(df, "instrument", "treatment", "outcome").first().standard_error
    assert math.isclose(got, se, rel_tol=1e-9)
    # the Wald ratio of rate differences is the same estimate
    itt = y[z == 1].mean() - y[z == 0].mean()
    take = x[z == 1].mean() - x[z == 0].mean()
    assert math.isclose(itt / take, beta[1], rel_tol=1e-9)
