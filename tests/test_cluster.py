import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import cluster as cl


@pytest.fixture(scope="module")
def array():
    rnd = np.random.default_rng(1)
    centre = rnd.normal(0, 20, (5, 3)) + 1000
    x = np.repeat(centre, 40, axis=0) + rnd.normal(0, 1, (200, 3))
    return np.vstack([x, x[:1]])        # one duplicate point


@pytest.fixture(scope="module")
def points(spark, array):
    rows = [(f"p{i}", [float(v) for v in x]) for i, x in enumerate(array)]
    return spark.createDataFrame(rows, "id string, v array<double>").repartition(6).persist()


def exact_d2(x, c):
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)


def test_distances_are_accurate_far_from_the_origin(array):
    x = array + 1e6
    got = cl.sq_distances(x, x[:30])
    assert np.allclose(got, exact_d2(x, x[:30]), rtol=1e-6, atol=1e-9)
    assert (np.diag(got[:30]) == 0).all()


def test_ties_take_the_lowest_label():
    centers = np.array([[[5.0, 0], [1, 0], [1, 0], [-1, 0]]] * 2)
    labels, d2 = cl.nearest(np.array([[0.0, 3], [1, 0], [-9, 0]]), centers)
    assert labels.tolist() == [[1, 1], [1, 1], [3, 3]]
    assert d2[:, 0].tolist() == [10.0, 0.0, 64.0]


def test_assign_and_sums(points, array):
    centers = np.stack([array[[0, 50, 90]], array[[120, 160, 199]]])
    rows = cl.assign(points, centers).collect()
    assert len(rows) == len(array)
    sums = {(r.run, r.j): r for r in cl.cluster_sums(points, centers).collect()}
    for run in range(2):
        d = exact_d2(array, centers[run])
        want = d.argmin(axis=1)
        for r in rows:
            i = int(r.id[1:])
            assert r.labels[run] == want[i] and r.d2[run] == pytest.approx(d[i].min(), abs=1e-6)
        for j in range(3):
            s = sums[run, j]
            assert s.n == (want == j).sum()
            assert np.allclose(s.c, array[want == j].mean(axis=0))
            assert s.cost == pytest.approx(d.min(axis=1)[want == j].sum())


def test_seeds_are_points_and_differ(points, array):
    seeds = cl.seed_centers(points, k=5, runs=4, seed=3)
    assert seeds.shape == (4, 5, 3)
    known = {tuple(x) for x in array}
    for run in seeds:
        assert all(tuple(c) in known for c in run) and len({tuple(c) for c in run}) == 5
    again = cl.seed_centers(points.repartition(2), k=5, runs=4, seed=3)
    assert (again == seeds).all()                      # independent of the partitions
    assert (cl.seed_centers(points, k=5, runs=4, seed=4) != seeds).any()


def test_draws_follow_the_weights(spark):
    """Squared distances 0, 1, 4 and 9 from the chosen centre."""
    df = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id int, v array<double>")
    runs = 3000
    chosen = np.zeros((runs, 1, 1))
    picked = [r.c[0] for r in cl.draw(df.coalesce(2), chosen, runs, 1, 5).collect()]
    share = np.array([picked.count(float(i)) / runs for i in range(4)])
    assert np.allclose(share, np.array([0, 1, 4, 9]) / 14, atol=0.03)
    first = [r.c[0] for r in cl.draw(df, None, runs, 0, 5).collect()]
    assert np.allclose([first.count(float(i)) / runs for i in range(4)], 0.25, atol=0.03)


def test_fewer_points_than_centres(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [4.0])], "id int, v array<double>")
    seeds = cl.seed_centers(df, k=4, runs=2, seed=1)
    assert seeds.shape == (2, 4, 1)
    out = cl.lloyd(df, seeds)
    assert cl.run_costs(df, out.centers).agg(F.max("cost")).first()[0] == 0.0


def test_lloyd_costs_never_rise(points):
    found = cl.kmeans(points, k=5, runs=6, seed=9)
    history = np.array(found.history)
    assert (np.diff(history, axis=0) <= 1e-6).all()
    assert found.shift <= cl.MAX_SHIFT
    costs = cl.run_costs(points, found.centers).collect()
    best = cl.best_run(cl.run_costs(points, found.centers)).first()
    assert best.cost == min(r.cost for r in costs)
    s = cl.cost_summary(cl.run_costs(points, found.centers)).first()
    assert s.log2_min == pytest.approx(math.log2(best.cost)) and s.log2_min <= s.log2_mean <= s.log2_max


def test_empty_cluster_keeps_its_centre(points):
    start = np.array([[[1000.0, 1000, 1000], [1e9, 1e9, 1e9]]])
    out = cl.lloyd(points, start, max_iter=3)
    assert out.centers[0, 1].tolist() == [1e9] * 3


def test_lloyd_ends_when_the_centres_rest(spark):
    """Two clusters that creep over a long line of points: more steps than any limit of old."""
    line = spark.createDataFrame([(i, [float(i ** 2)]) for i in range(60)], "id int, v array<double>").coalesce(1)
    start = np.array([[[-1.0], [0.0]]])
    early = cl.lloyd(line, start, max_move=0.0, max_iter=2)
    assert not early.converged and len(early.history) == 2
    found = cl.lloyd(line, start, max_move=0.0)
    assert found.converged and found.shift == 0.0


def test_missing_centres_are_not_shifted(spark):
    rows = spark.createDataFrame([(0, 1, [1.0]), (1, 0, [2.0])], "run int, j int, c array<double>")
    with pytest.raises(ValueError):
        cl.center_array(rows)
    got = cl.center_array(rows, previous=np.array([[[7.0], [8.0]], [[9.0], [10.0]]]))
    assert got.tolist() == [[[7.0], [1.0]], [[2.0], [10.0]]]


def test_best_centers(spark):
    costs = spark.createDataFrame([(0, 3.0), (1, 2.0)], "run int, cost double")
    assert cl.best_centers(costs, np.array([[[0.0]], [[5.0]]])).tolist() == [[5.0]]


def test_shift(points):
    a, b = np.zeros((2, 2, 2)), np.zeros((2, 2, 2))
    b[0, 0], b[0, 1], b[1, 1] = [3, 4], [0, 1], [5, 0]
    got = cl.max_shift(cl.center_rows(points, a), cl.center_rows(points, b)).first()
    assert got.max_shift == 6.0
    assert (cl.center_array(cl.center_rows(points, b)) == b).all()


def test_prefix_entropy(spark):
    rows = [([0, 0],), ([0, 1],), ([0, 1],), ([1, 1],)]
    got = [r.entropy for r in cl.prefix_entropy(
        spark.createDataFrame(rows, "labels array<int>")).orderBy("runs").collect()]
    assert got == pytest.approx([-(0.75 * math.log2(0.75) + 0.25 * math.log2(0.25)), 1.5])


def test_entropy_grows_with_the_runs(points):
    centers = cl.seed_centers(points, k=3, runs=6, seed=2)
    curve = [r.entropy for r in cl.prefix_entropy(cl.assign(points, centers)).orderBy("runs").collect()]
    assert all(b >= a - 1e-12 for a, b in zip(curve, curve[1:]))


def test_concat_features(spark):
    df = spark.createDataFrame([("s", [1.0], [2.0, 3.0])], "station string, a array<double>, b array<double>")
    assert cl.concat_features(df, "station", ["b", "a"]).first().v == [2.0, 3.0, 1.0]
