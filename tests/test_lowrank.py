import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import lowrank as lr

D, NAN = 8, float("nan")


@pytest.fixture(scope="module")
def panel():
    """Two series; one row all but one day missing, some gaps, one rank-1 row."""
    rnd = np.random.default_rng(5)
    x = {"TMIN": rnd.normal(3, 2, (40, D)) @ rnd.normal(0, 1, (D, D)),
         "TMAX": rnd.normal(9, 1, (25, D))}
    x["TMIN"][3, 2] = x["TMIN"][7, :4] = NAN
    x["TMAX"][0, 1:] = NAN
    return x


@pytest.fixture(scope="module")
def vectors(spark, panel):
    rows = [(f"s{i}", s, [float(v) for v in row]) for s, m in panel.items() for i, row in enumerate(m)]
    return spark.createDataFrame(rows, "station string, series string, vec array<double>").repartition(5)


def masked_cov(m):
    out = np.zeros((D, D))
    for i in range(D):
        for j in range(D):
            both = ~np.isnan(m[:, i]) & ~np.isnan(m[:, j])
            a, b = m[both, i], m[both, j]
            out[i, j] = ((a - a.mean()) * (b - b.mean())).mean()
    return out


def basis_arrays(panel, rank=3):
    out = {}
    for s, m in panel.items():
        w, v = np.linalg.eigh(masked_cov(m))
        out[s] = np.nanmean(m, axis=0), v[:, np.argsort(-w)[:rank]].T
    return out


@pytest.mark.parametrize("tasks", [1, 3, 5])
def test_covariance(vectors, panel, tasks):
    got = lr.covariance(vectors.repartition(tasks)).collect()
    assert len(got) == 2 * D * (D + 1) // 2
    for r in got:
        assert r["cov"] == pytest.approx(masked_cov(panel[r.series])[r.i, r.j], abs=1e-9)
        m = ~np.isnan(panel[r.series])
        assert r.n == (m[:, r.i] & m[:, r.j]).sum()


def test_many_interleaved_series_emit_one_set_of_sums_each(spark, monkeypatch):
    series, d = 300, 4
    df = spark.range(series * 12).coalesce(1).selectExpr(
        f"id % {series} as series", f"transform(sequence(1, {d}), k -> cast((id * k * 7919) % 101 as double)) as vec")
    batches = df.sortWithinPartitions("series").mapInArrow(lr._comoments, lr._PARTIAL.format(t="bigint"))
    assert batches.count() == series                # one row of arrays each
    got = {(r.series, r.i, r.j): r["cov"] for r in lr.covariance(df).collect()}
    for s in (0, 17, 299):
        m = np.array([[(i * k * 7919) % 101 for k in range(1, d + 1)] for i in range(s, series * 12, series)], float)
        want = np.cov(m.T, bias=True)
        assert all(got[s, i, j] == pytest.approx(want[i, j], rel=1e-9) for i in range(d) for j in range(i, d))


def test_covariance_far_from_zero(spark):
    x = np.random.default_rng(3).normal(0, 1, (1000, 3)) @ np.array([[1, .5, 0], [0, 1, .3], [0, 0, 1]]) + 1e8
    df = spark.createDataFrame([("s", [float(v) for v in row]) for row in x], "series string, vec array<double>").repartition(4)
    want = np.cov((x - x.mean(axis=0)).T, bias=True)
    for r in lr.covariance(df).collect():
        scale = np.sqrt(want[r.i, r.i] * want[r.j, r.j])
        assert r["cov"] == pytest.approx(want[r.i, r.j], abs=1e-9 * scale)


def test_a_constant_series_has_no_shares(spark):
    df = spark.createDataFrame([("s", [1.0, 2.0])] * 3, "series string, vec array<double>")
    assert {r.explained for r in lr.explained_variance(lr.eigen(lr.covariance(df))).collect()} == {None}


def test_eigen(vectors, panel):
    eig = lr.eigen(lr.covariance(vectors)).collect()
    for s in panel:
        rows = sorted((r for r in eig if r.series == s), key=lambda r: r.k)
        values = np.array([r.eigval for r in rows])
        v = np.array([r.eigvec for r in rows])
        assert list(values) == sorted(values, reverse=True) and (values >= 0).all()
        assert np.allclose(v @ v.T, np.eye(D), atol=1e-9)
        assert (v[np.arange(D), np.abs(v).argmax(axis=1)] > 0).all()
        w = np.clip(np.sort(np.linalg.eigvalsh(masked_cov(panel[s])))[::-1], 0, None)
        assert np.allclose(values, w)


def test_explained_variance(vectors):
    rows = lr.explained_variance(lr.eigen(lr.covariance(vectors)), k_max=9).collect()
    for s in ("TMIN", "TMAX"):
        share = [r.explained for r in sorted((r for r in rows if r.series == s), key=lambda r: r.k)]
        assert len(share) == 10 and share[0] == 0.0
        assert share == sorted(share) and share[-1] == pytest.approx(1.0)


def test_eigenvector_series(vectors):
    eig = lr.eigen(lr.covariance(vectors))
    rows = lr.eigenvector_series(eig).where("series = 'TMAX'").collect()
    assert {(r.k, r.day) for r in rows} == {(k, d) for k in (1, 2, 3) for d in range(1, D + 1)}
    for k in (1, 2, 3):
        assert sum(r.value ** 2 for r in rows if r.k == k) == pytest.approx(1.0)


def rebuild(x, mean, v):
    out, total = [], mean.copy()
    for e in v:
        total = total + e * (e @ (x - mean))
        out.append(total)
    return out


def make_basis(vectors):
    return lr.fit_basis(vectors)


def test_means_of_the_covariance_pass(vectors):
    a = {r.series: r["mean"] for r in lr.fit_basis(vectors).collect()}
    b = {r.series: r["mean"] for r in lr.mean_vectors(vectors).collect()}
    assert all(np.allclose(a[s], b[s]) for s in ("TMIN", "TMAX"))


def test_reconstruction(vectors, panel):
    arrays = basis_arrays(panel)
    rows = lr.reconstruct(vectors, make_basis(vectors)).collect()
    assert len(rows) == 65
    for r in rows:
        x = np.array(r.vec)
        mean, v = arrays[r.series]
        assert np.allclose(r["mean"], mean)
        for got, want, err in zip(r.recon, rebuild(x, mean, v), r.err):
            assert np.allclose(got, want, equal_nan=True)
            assert err == pytest.approx(((want - x) ** 2).sum(), nan_ok=True)
        assert np.isnan(r.err).any() or list(r.err) == sorted(r.err, reverse=True)


def brute_extremes(panel):
    arrays, out = basis_arrays(panel), set()
    for s, m in panel.items():
        errs = sorted((((rebuild(x, *arrays[s])[-1] - x) ** 2).sum(), f"s{i}")
                      for i, x in enumerate(m) if not np.isnan(x).any())
        out |= {(s, "low", p + 1, k) for p, (_, k) in enumerate(errs[:2])}
        out |= {(s, "high", p + 1, k) for p, (_, k) in enumerate(errs[::-1][:2])}
    return out


def test_extremes_drop_rows_with_gaps(vectors, panel):
    got = lr.residual_extremes(vectors, make_basis(vectors), ["station"]).collect()
    assert {(r.series, r.end, r.pos, r.station) for r in got} == brute_extremes(panel)


def test_extremes_with_salted_lookup(vectors, panel, no_broadcast):
    got = lr.residual_extremes(vectors, make_basis(vectors), ["station"]).collect()
    assert {(r.series, r.end, r.pos, r.station) for r in got} == brute_extremes(panel)


def test_rows_carry_no_basis(vectors, panel):
    plan = lr.residuals(vectors, make_basis(vectors))._jdf.queryExecution().optimizedPlan().toString()
    assert "basis" not in plan and "mean" not in plan


def test_large_bases_open_the_rows_of_their_series(spark, no_broadcast, monkeypatch):
    """Every series is dealt over several tasks; rows of series without a basis drop out."""
    monkeypatch.setattr(lr, "HOT_ROWS", 3)
    rnd = np.random.default_rng(1)
    rows = [(i, f"s{i % 7}" if i % 11 else None, [float(x) for x in rnd.normal(size=5)] if i % 13 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, series string, vec array<double>").repartition(3)
    basis = lr.fit_basis(df.where("series <> 's3'"))
    assert not lr.fits_broadcast(basis)
    got = {r.id: r for r in lr.reconstruct(df, basis).collect()}
    want = {i for i, s, v in rows if s not in (None, "s3") and v is not None}
    assert set(got) == want and {r.id for r in lr.residuals(df, basis).collect()} == want
    arrays = {r.series: (np.array(r["mean"]), np.array(r["basis"])) for r in basis.collect()}
    for i, s, v in rows:
        if i in want:
            assert np.allclose(got[i].recon, rebuild(np.array(v), *arrays[s]))


@pytest.mark.parametrize("streams", [1, 2, 256])
def test_partial_sums_merge_in_any_number_of_streams(vectors, panel, monkeypatch, streams):
    monkeypatch.setattr(lr, "STREAMS", streams)
    for r in lr.covariance(vectors.repartition(9)).collect():
        assert r["cov"] == pytest.approx(masked_cov(panel[r.series])[r.i, r.j], abs=1e-9)


def test_short_series_shows_rows_at_both_ends(spark):
    df = spark.createDataFrame([("a", "s", [1.0, 2.0])], "station string, series string, vec array<double>")
    basis = lr.mean_vectors(df).withColumn("basis", F.array(F.array(F.lit(1.0), F.lit(0.0))))
    got = lr.residual_extremes(df, basis, ["station"]).collect()
    assert {(r.end, r.pos, r.station) for r in got} == {("low", 1, "a"), ("high", 1, "a")}


def test_profiles(vectors, panel):
    rows = lr.extreme_profiles(vectors, make_basis(vectors), ["station"]).collect()
    assert len(rows) == 2 * 4 * D
    arrays = basis_arrays(panel)
    for r in rows:
        x = panel[r.series][int(r.station[1:])]
        mean, v = arrays[r.series]
        assert r.original == x[r.day - 1] and r["mean"] == pytest.approx(mean[r.day - 1])
        assert np.allclose(r.recon, [w[r.day - 1] for w in rebuild(x, mean, v)])


def test_panel_vectors_fill_gaps_with_nan(spark):
    df = spark.createDataFrame([("u", 0, 1.0), ("u", 0, 3.0), ("u", 2, 5.0), ("u", 3, 9.0)],
                               "u string, h int, x double")
    vec = lr.panel_vectors(df, ["u"], "h", "x", 3, drop_outside=True).first().vec
    with pytest.raises(Exception, match="slot outside 0..2: 3"):
        lr.panel_vectors(df, ["u"], "h", "x", 3).collect()
    year = spark.range(1, 366).selectExpr("'u' as u", "cast(id as int) as h", "cast(id as double) as x")
    assert lr.panel_vectors(year, ["u"], "h", "x", 365, first_slot=1).first().vec == [float(k) for k in range(1, 366)]
    assert len(vec) == 3 and vec[0] == 2.0 and np.isnan(vec[1]) and vec[2] == 5.0
