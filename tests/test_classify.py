import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.functions.hashing import arithmetic_uniform, hash_uniform
from oreline.operators import classify as cf
from oreline.operators import sampling as sm
from oreline.sources.schemas import COVER_TYPES


@pytest.fixture(scope="module")
def examples(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, float(a), float(b), float((a > 0) ^ (b > 0.3) ^ (rnd.random() < 0.05)))
            for i, (a, b) in enumerate(rnd.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, label double")
    return sm.train_test(cf.assemble(df, ["a", "b"], keep=["id"]), "id", 0.7, seed=1).drop("id")


def test_class_distribution(spark):
    df = spark.createDataFrame([(2.0,)] * 3 + [(1.0,)] * 1 + [(9.0,)], "label double")
    got = [tuple(r) for r in cf.class_distribution(df, names=COVER_TYPES).collect()]
    assert got == [(2.0, 3, 60.0, "Lodgepole Pine"), (1.0, 1, 20.0, "Spruce/Fir"), (9.0, 1, 20.0, None)]


def test_binarise(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (None,)], "y double")
    assert [r.label for r in cf.binarise(df, "y", 2.0).collect()] == [1.0, 0.0, 0.0]


def test_error_rate(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 0.0), ("b", 0.0, 0.0)],
                               "split string, label double, prediction double")
    got = {r.split: (r.n, r.err) for r in cf.error_rate(df, ["split"]).collect()}
    assert got == {"a": (2, 0.5), "b": (1, 0.0)}


@pytest.mark.parametrize("algo,depths", [("gbt", [1, 4]), ("rf", [1, 6])])
def test_deeper_trees_fit_better(examples, algo, depths):
    rows = cf.depth_sweep(examples, algo, depths, size=5, seed=7).collect()
    cached = cf.depth_sweep(examples, algo, depths[1:], size=5, seed=7, cache_node_ids=True)
    assert {r.err for r in cached.collect()} == {r.err for r in rows if r.depth == depths[1]}
    assert len(rows) == 4 and all(r.algo == algo and r.secs > 0 for r in rows)
    err = {(r.depth, r.split): r.err for r in rows}
    assert err[depths[1], "train"] < err[depths[0], "train"]
    assert err[depths[1], "test"] < 0.25
    assert sum(r.n for r in rows if r.depth == depths[0]) == 600


def test_parameters_of_the_learners():
    g, f = cf.boosting(3), cf.forest(20)
    assert (g.getMaxIter(), g.getStepSize(), g.getMaxBins(), g.getLossType()) == (10, 0.1, 32, "logistic")
    assert (f.getNumTrees(), f.getImpurity(), f.getFeatureSubsetStrategy()) == (10, "gini", "auto")
    assert cf.BOOSTING_DEPTHS == [1, 3, 6, 10] and cf.FOREST_DEPTHS == [1, 3, 6, 10, 15, 20]


def test_model_round_trip(spark, examples, tmp_path):
    model = cf.forest(3, trees=4, seed=1).fit(examples.where("split = 'train'"))
    cf.save_model(model, str(tmp_path / "m"))
    again = cf.load_model("rf", str(tmp_path / "m"))
    a, b = (m.transform(examples).agg(F.sum("prediction")).first()[0] for m in (model, again))
    assert a == b and "Tree 3" in cf.describe_model(again) and "If (feature" in cf.describe_model(again)


def test_sample_is_keyed_and_stable(spark):
    df = spark.range(20000)
    ids = {r.id for r in sm.bernoulli_sample(df, 0.1, 255, "id").collect()}
    again = {r.id for r in sm.bernoulli_sample(df.repartition(7), 0.1, 255, ["id"]).collect()}
    assert ids == again and 1850 < len(ids) < 2150
    assert ids != {r.id for r in sm.bernoulli_sample(df, 0.1, 1, "id").collect()}


def test_split_is_a_partition(spark):
    out = sm.train_test(spark.range(10000), "id", 0.7, seed=255)
    n = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert n["train"] + n["test"] == 10000 and 6800 < n["train"] < 7200
    train, test = sm.random_split(spark.range(5000), 0.7, 255)
    assert train.count() + test.count() == 5000 and train.intersect(test).count() == 0
    assert sm.random_split(spark.range(5000), 0.7, 255)[0].count() == train.count()


def test_uniforms(spark):
    df = spark.range(50000)
    for u in (hash_uniform("id", seed=3), arithmetic_uniform("id", seed=5)):
        r = df.select(u.alias("u")).agg(F.min("u"), F.max("u"), F.avg("u"), F.var_pop("u")).first()
        assert 0 <= r[0] and r[1] < 1 and abs(r[2] - 0.5) < 0.01 and abs(r[3] - 1 / 12) < 0.01


def test_null_and_large_keys(spark):
    df = spark.createDataFrame([(2 ** 62,), (0,)], "k bigint")
    assert all(0 <= r[0] < 1 for r in df.select(arithmetic_uniform("k")).collect())
