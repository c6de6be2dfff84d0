import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import regress as rg

X, Y = ["a", "b", "c"], ["exact", "noisy", "flat"]


@pytest.fixture(scope="module")
def arrays():
    rnd = np.random.default_rng(11)
    x = rnd.normal([5e4, 0, -3], [1000, 1, 0.01], (400, 3))
    exact = 2 * x[:, 0] - 3 * x[:, 1] + 7
    noisy = x[:, 1] + rnd.normal(0, 1, 400)
    train = rnd.random(400) < 0.5
    return x, np.column_stack([exact, noisy, np.full(400, 4.0)]), train


@pytest.fixture(scope="module")
def data(spark, arrays):
    x, y, train = arrays
    rows = [[*map(float, r), *map(float, t), "train" if s else "test"]
            for r, t, s in zip(x, y, train)]
    rows.append([None, 1.0, 1.0, 1.0, 1.0, 1.0, "train"])     # incomplete rows are left out
    cols = ", ".join(f"{c} double" for c in X + Y)
    return spark.createDataFrame(rows, f"{cols}, split string")


def fit(x, y):
    return np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]


def r2(beta, x, y):
    e = y - np.column_stack([x, np.ones(len(x))]) @ beta
    return 1 - (e @ e) / ((y - y.mean()) ** 2).sum()


def test_coefficients(data, arrays):
    x, y, train = arrays
    got = {(r.target, r.input): r.coef for r in rg.ols_coefficients(data, X, Y).collect()}
    assert len(got) == 12
    for t, target in enumerate(Y):
        beta = fit(x[train], y[train, t])
        for name, b in zip(X + ["intercept"], beta):
            assert got[target, name] == pytest.approx(b, rel=1e-4, abs=1e-3)


def test_scores(data, arrays):
    x, y, train = arrays
    got = {r.target: r for r in rg.ols_scores(data, X, Y).collect()}
    assert got["exact"].train_r2 == pytest.approx(1.0) and got["exact"].test_r2 == pytest.approx(1.0)
    beta = fit(x[train], y[train, 1])
    assert got["noisy"].train_r2 == pytest.approx(r2(beta, x[train], y[train, 1]), abs=1e-8)
    assert got["noisy"].test_r2 == pytest.approx(r2(beta, x[~train], y[~train, 1]), abs=1e-8)
    assert not got["noisy"].overfit


def test_ablation(data, arrays):
    x, y, train = arrays
    got = {(r.target, r.removed): r for r in rg.ols_ablation(data, X, Y[:2]).collect()}
    for gone, name in enumerate(X):
        cols = [c for c in range(3) if c != gone]
        full, part = fit(x[train], y[train, 1]), fit(x[train][:, cols], y[train, 1])
        r = got["noisy", name]
        assert r.train_decrease == pytest.approx(
            r2(full, x[train], y[train, 1]) - r2(part, x[train][:, cols], y[train, 1]), abs=1e-8)
        assert r.test_decrease == pytest.approx(
            r2(full, x[~train], y[~train, 1]) - r2(part, x[~train][:, cols], y[~train, 1]), abs=1e-8)
    assert got["exact", "c"].train_decrease == pytest.approx(0.0, abs=1e-9)   # irrelevant input
    assert got["exact", "a"].train_decrease > 0.9


def test_overfitting_is_flagged(spark):
    rnd = np.random.default_rng(2)
    rows = [[*map(float, rnd.normal(size=4)), float(rnd.normal()), "train" if i < 6 else "test"]
            for i in range(60)]
    df = spark.createDataFrame(rows, "p double, q double, r double, s double, y double, split string")
    row = rg.ols_scores(df, ["p", "q", "r", "s"], ["y"]).first()
    assert row.train_r2 > 0.3 and row.test_r2 < 0 and row.overfit


def test_dependent_inputs_take_the_least_norm_solution(spark):
    rows = [(float(i), 2.0 * i, 5.0 * i + 1, "train") for i in range(20)]
    df = spark.createDataFrame(rows, "p double, q double, y double, split string")
    got = {r.input: r.coef for r in rg.ols_coefficients(df, ["p", "q"], ["y"]).collect()}
    assert (got["p"], got["q"], got["intercept"]) == pytest.approx((1.0, 2.0, 1.0))


def test_data_is_read_once(data):
    plan = rg.ols_ablation(data, X, Y)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "partial_covar_pop" in plan


def test_number_columns(spark):
    df = spark.createDataFrame([("s", [1.0, 2.0, 3.0], [4.0, 5.0], 9.0)],
                               "station string, T array<double>, S array<double>, lat double")
    out = rg.number_columns(df, ["T", "S"], 2, drop=["station"])
    assert out.columns == ["lat", "T1", "T2", "S1", "S2"]
    assert tuple(out.first()) == (9.0, 1.0, 2.0, 4.0, 5.0)
    assert rg.number_columns(df, ["S"], 3).select(F.col("S3").isNull()).first()[0]
