import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.operators import panel as pn
from oreline.operators import lookup, ranking
from oreline.operators.ranking import exact_quantiles, running_total

NAN = float("nan")


@pytest.fixture(scope="module")
def readings():
    """'hot' has most rows and one value in a third of them; 'one' has a single value."""
    rnd = random.Random(3)
    rows = [("hot", rnd.randrange(1, 9), 5.0 if i % 3 == 0 else round(rnd.gauss(0, 30), 1))
            for i in range(4000)]
    rows += [("few", rnd.randrange(1, 9), x) for x in (1.0, 2.0, 4.0, 8.0)]
    rows += [("one", 1, 3.5)] * 10
    rows += [("hot", 2, NAN)] * 50 + [("few", 3, None)] * 5
    return rows


@pytest.fixture(scope="module")
def panel(spark, readings):
    return spark.createDataFrame(readings, "series string, day int, x double")


def values(readings, series, day=None):
    return np.array([x for s, d, x in readings
                     if s == series and x is not None and not math.isnan(x)
                     and (day is None or d == day)])


def test_daily_stats(panel, readings):
    for r in pn.daily_stats(panel).collect():
        v = values(readings, r.series, r.day)
        assert r.ne == len(v)
        if len(v):
            assert r["mean"] == pytest.approx(v.mean()) and r["var"] == pytest.approx(v.var(), abs=1e-9)
            assert r.band_high - r["mean"] == pytest.approx(v.std(), abs=1e-6)
            assert r["mean"] - r.band_low == pytest.approx(v.std(), abs=1e-6)


def test_scalar_summary_is_exact(panel, readings):
    rows = {r.series: r for r in pn.scalar_summary(panel).collect()}
    assert set(rows) == {"hot", "few", "one"}
    for series, r in rows.items():
        v = values(readings, series)
        assert r["std"] == pytest.approx(v.std(), abs=1e-9)
        for name, p in pn.CUTS.items():
            assert r[name] == pytest.approx(np.quantile(v, p), abs=1e-9), (series, name)


def test_quantiles_with_salted_lookups(panel, readings, no_broadcast):
    clean = panel.where("x is not null and not isnan(x)")
    row = exact_quantiles(clean, ["series"], "x", {"q": 0.37}).where("series = 'hot'").first()
    assert row.q == pytest.approx(np.quantile(values(readings, "hot"), 0.37))


def test_running_total_over_many_partitions(spark):
    rows = [("a" if i % 3 else "b", i * 37 % 1009, i % 5 + 1) for i in range(1009)]
    df = spark.createDataFrame(rows, "g string, o int, w bigint")
    want = {}
    for g in "ab":
        total = 0
        for o, w in sorted((o, w) for k, o, w in rows if k == g):
            total += w
            want[g, o] = total
    got = {(r.g, r.o): r.upto for r in running_total(df, ["g"], ["o"], "w").collect()}
    assert got == want


@pytest.mark.parametrize("accuracy", [3, 20, 10_000])
def test_quantiles_do_not_depend_on_the_first_guess(panel, readings, accuracy):
    clean = panel.where("x is not null and not isnan(x)")
    probs = {"a": 0.0, "b": 0.1, "c": 0.105, "d": 0.5, "e": 0.999, "f": 1.0}
    for r in exact_quantiles(clean, ["series"], "x", probs, accuracy).collect():
        v = values(readings, r.series)
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(v, p), abs=1e-9), (r.series, name)


def test_a_wrong_bracket_is_noticed(panel, readings, monkeypatch):
    """Brackets that miss their quantile lead to a full count of the group."""
    def narrow(df, by, x, probs, accuracy):
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_size"), F.max(x).alias("_m_from"), F.max(x).alias("_m_to"))

    monkeypatch.setattr(ranking, "_brackets", narrow)
    clean = panel.where("x is not null and not isnan(x)")
    got = {r.series: r.m for r in exact_quantiles(clean, ["series"], "x", {"m": 0.4}).collect()}
    assert got == {s: pytest.approx(np.quantile(values(readings, s), 0.4)) for s in ("hot", "few", "one")}


def test_only_bracketed_values_are_shuffled(spark):
    df = spark.range(50000).select(F.lit("s").alias("series"), F.rand(1).alias("x"))
    seen = []
    original = ranking._order_statistics

    def watch(counts, by, probs):
        seen.append(counts.count())
        return original(counts, by, probs)

    ranking._order_statistics = watch
    try:
        exact_quantiles(df, ["series"], "x", {"m": 0.5}).collect()
    finally:
        ranking._order_statistics = original
    assert seen[0] < 200


def test_clip_is_inclusive(spark):
    panel = spark.createDataFrame([("s", float(x)) for x in range(5)], "series string, x double")
    limits = spark.createDataFrame([("s", 1.0, 3.0)], "series string, low100 double, high100 double")
    assert sorted(r.x for r in pn.clip_range(panel, limits).collect()) == [1.0, 2.0, 3.0]


def test_histogram_with_salted_lookups(panel, no_broadcast):
    want = {(r.series, r.bin): r.cnt for r in pn.clipped_histogram(panel, bins=7).collect()}
    assert sum(want.values()) > 3000
    lookup.MAX_BROADCAST_BYTES = 1 << 20
    got = {(r.series, r.bin): r.cnt for r in pn.clipped_histogram(panel, bins=7).collect()}
    assert got == want


def test_histogram(panel, readings):
    got = pn.clipped_histogram(panel, bins=10).collect()
    for series in ("hot", "few", "one"):
        v = values(readings, series)
        lo, hi = np.quantile(v, [0.01, 0.99])
        counts, edges = np.histogram(v[(v >= lo) & (v <= hi)], bins=10)
        mine = {r.bin: r.cnt for r in got if r.series == series}
        assert sum(mine.values()) == counts.sum()
        starts = {r.bin: r.bin_start for r in got if r.series == series}
        for b, start in starts.items():
            assert start == pytest.approx(edges[b])
        if series != "hot":      # values of 'hot' lie on bin edges, where rounding decides
            assert mine == {i: c for i, c in enumerate(counts) if c}


def test_pick_series(panel):
    assert {r.series for r in pn.pick_series(panel, ["few"]).collect()} == {"few"}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (None,)], "x double")
    assert df.select(F.avg(pn.present(F.col("x")))).first()[0] == 1.0
