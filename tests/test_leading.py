import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import leading
from oreline.operators import lowrank as lr


def rows_of(spark, table, tasks=5):
    rows = [(s, None if v is None else [float(x) for x in v]) for s, m in table.items() for v in m]
    return spark.createDataFrame(rows, "series string, vec array<double>").repartition(tasks)


def found(df):
    return {(r.series, r.k): r for r in df.collect()}


@pytest.mark.parametrize("d", [1, 2, 8, 64, 150])
def test_like_the_full_solver(spark, monkeypatch, d):
    """Wide vectors need restarts, since fewer than d vectors are kept."""
    monkeypatch.setattr(leading, "KEEP", 24)
    rnd = np.random.default_rng(d)
    table = {s: rnd.normal(1e8 * (s == "far"), 1, (300, d)) * np.linspace(3, 1, d) ** 2 for s in ("near", "far")}
    got = found(leading.leading_eigen(rows_of(spark, table), 3))
    assert len(got) == 2 * min(3, d)
    for s, x in table.items():
        values, vectors = np.linalg.eigh(np.atleast_2d(np.cov(x.T, bias=True)))
        for k in range(1, min(3, d) + 1):
            r, v = got[s, k], vectors[:, -k]
            assert r.eigval == pytest.approx(values[-k], rel=1e-6 if s == "far" else 1e-10)
            assert r.share == pytest.approx(values[-k] / values.sum(), rel=1e-6)
            v = v * np.sign(v[np.abs(v).argmax()])
            assert np.abs(np.array(r.eigvec) - v).max() < (1e-3 if s == "far" else 1e-8)


def test_same_as_eigen_and_retries(spark):
    table = {"a": np.random.default_rng(1).normal(0, 1, (200, 64)) * np.linspace(4, 1, 64)}
    vectors = rows_of(spark, table)
    full = found(lr.eigen(lr.covariance(vectors)).where("k <= 3"))
    for tasks in (1, 7):
        for key, r in found(leading.leading_eigen(vectors.repartition(tasks))).items():
            assert r.eigval == pytest.approx(full[key].eigval, rel=1e-10)
            assert np.abs(np.array(r.eigvec) - np.array(full[key].eigvec)).max() < 1e-8
            assert r.residual <= 1e-10


def test_edges(spark):
    """Gaps, null vectors and series, constant and single rows, low rank, ties, empty tables, further columns."""
    nan = float("nan")
    line = np.outer(np.arange(1.0, 6.0), [3.0, 4.0, 0.0])
    table = {"line": [*line, None, [nan, 0, 0]], "flat": [[1, 2, 3]] * 4, "one": [[5, 6, 7]], "gaps": [[nan, 1, 2]],
             "ties": [[1, 0, 0], [-1, 0, 0], [0, 1, 0], [0, -1, 0]], None: [[1, 2, 3], [9, 9, 9]]}
    vectors = rows_of(spark, table).withColumn("k", F.lit("x")).withColumn("eigval", F.lit(0))
    got = found(leading.leading_eigen(vectors, 2))
    assert set(got) == {(s, k) for s in ("line", "flat", "one", "ties") for k in (1, 2)}
    assert got["line", 1].eigvec == pytest.approx([0.6, 0.8, 0.0]) and got["line", 1].share == pytest.approx(1.0)
    assert got["line", 2].eigval == pytest.approx(0.0, abs=1e-9)
    assert got["flat", 1].eigval == 0.0 and got["flat", 1].share is None and got["one", 1].share is None
    assert [got["ties", k].eigval for k in (1, 2)] == pytest.approx([0.5, 0.5])
    assert leading.leading_eigen(vectors.limit(0)).count() == 0


def test_large_bases_travel_as_rows(spark, monkeypatch):
    table = {s: np.random.default_rng(i).normal(0, 1, (60, 12)) * np.linspace(3, 1, 12) for i, s in enumerate("abc")}
    vectors = rows_of(spark, table)
    sent = found(leading.leading_eigen(vectors))
    monkeypatch.setattr(lr, "fits_broadcast", lambda df: False)
    for key, r in found(leading.leading_eigen(vectors)).items():
        assert r.eigval == pytest.approx(sent[key].eigval, rel=1e-10)
