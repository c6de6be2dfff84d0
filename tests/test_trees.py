"""Node tables against Spark ML's own scores and against recursive SQL on another engine."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from oreline.operators import classify as cf
from oreline.operators import lookup
from oreline.operators import trees as tr


@pytest.fixture(scope="module")
def examples(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, float(a), float(b), float(c), float((a > 0) ^ (b > 0.3) ^ (rnd.random() < 0.2)))
            for i, (a, b, c) in enumerate(np.round(rnd.normal(size=(500, 3)), 2))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    return cf.assemble(df, ["a", "b", "c"], keep=["id"]).persist()


@pytest.fixture(scope="module")
def rows(examples):
    return examples.select("id", vector_to_array("features").alias("features"))


CASES = [("gbt", d) for d in cf.BOOSTING_DEPTHS] + [("rf", d) for d in cf.FOREST_DEPTHS]


@pytest.mark.parametrize("algo,depth", CASES)
def test_rows_of_the_sweeps_are_scored_alike(spark, examples, rows, tmp_path, algo, depth):
    model = cf.LEARNERS[algo](depth, 4, seed=3).fit(examples)
    want = {r.id: (r.prediction, r.rawPrediction) for r in model.transform(examples).collect()}
    path = str(tmp_path / "model")
    cf.save_model(model, path)
    nodes = tr.node_table(spark, path)
    got = {r.id: r.raw for r in tr.score(rows, nodes, depth, ["id"]).collect()}
    assert len(got) == len(want)
    for i, (label, raw) in want.items():
        mine = got[i]
        assert abs(mine - (raw[1] / sum(raw) if algo == "rf" else raw[1])) < 1e-9
        assert abs(mine - (0.5 if algo == "rf" else 0.0)) < 1e-9 or label == float(mine > (0.5 if algo == "rf" else 0.0))
    nodes.write.parquet(str(tmp_path / "nodes"))
    rows.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    for name in ("nodes", "rows"):
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}/*.parquet')")
    told = dict(con.execute(tr.score_sql("nodes", "rows", "id")).fetchall())
    assert set(told) == set(got) and all(abs(told[i] - got[i]) < 1e-9 for i in got)


def test_paths_and_leaves(spark, examples, tmp_path):
    path = str(tmp_path / "model")
    cf.save_model(cf.boosting(3, 2, seed=1).fit(examples), path)
    told = tr.with_paths(tr.node_table(spark, path), 3).collect()
    by_path = {(r.tree, r.path): r for r in told}
    assert len(by_path) == len(told) == tr.node_table(spark, path).count()
    for (tree, at), r in by_path.items():
        assert ((tree, at + "L") in by_path) == ((tree, at + "R") in by_path) == (r.left is not None) == (r.threshold is not None)
    assert {r.weight for r in told if r.tree == 0} == {1.0} and {r.weight for r in told if r.tree == 1} == {0.1}


def test_large_node_tables_are_joined_without_broadcast(spark, examples, rows, tmp_path, no_broadcast, monkeypatch):
    monkeypatch.setattr(tr, "fits_broadcast", lambda _: False)
    model = cf.forest(6, 3, seed=3).fit(examples)
    cf.save_model(model, str(tmp_path / "model"))
    twice = rows.unionAll(rows)
    got = tr.score(twice, tr.node_table(spark, str(tmp_path / "model")), 6, ["id"]).collect()
    want = {r.id: r.rawPrediction[1] / sum(r.rawPrediction) for r in model.transform(examples).collect()}
    assert len(got) == 2 * len(want) and all(abs(r.raw - want[r.id]) < 1e-9 for r in got)
    assert lookup.MAX_BROADCAST_BYTES == -1


def test_empty_and_repeated_rows_and_one_class(spark, examples, rows, tmp_path):
    one = examples.where("label = 1.0")
    cf.save_model(cf.forest(2, 2, seed=3).fit(one), str(tmp_path / "one"))
    nodes = tr.node_table(spark, str(tmp_path / "one"))
    assert {r.raw for r in tr.score(rows, nodes, 2, ["id"]).collect()} == {1.0}
    assert tr.score(rows.where("id < 0"), nodes, 2, ["id"]).count() == 0
