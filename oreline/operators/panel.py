"""Statistics of measurement panels in long form ``(series, day, x)``.

Missing readings are NaN (or null) and count nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.operators.lookup import enrich
from oreline.operators.ranking import (exact_quantiles, interpolated, order_statistics,
                                       weighted_enrich)
from oreline.sources.schemas import MEASUREMENTS

# Cut points of a measurement: name and probability.
CUTS = {"low1000": 0.001, "low100": 0.01, "high100": 0.99, "high1000": 0.999}


def present(x: Column) -> Column:
    """NaN as null, so that aggregates skip it."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def pick_series(panel: DataFrame, kinds: list[str] = MEASUREMENTS,
                series: str = "series") -> DataFrame:
    """Only the named measurements; by default the six of the weather panels."""
    return panel.where(F.col(series).isin(kinds))


def daily_stats(panel: DataFrame, series: str = "series", day: str = "day",
                x: str = "x") -> DataFrame:
    """Mean, population variance, number of readings and mean +- std per day."""
    v = present(F.col(x))
    out = panel.groupBy(series, day).agg(
        F.avg(v).alias("mean"), F.var_pop(v).alias("var"), F.count(v).alias("ne"))
    return (out.withColumn("band_low", F.col("mean") - F.sqrt("var"))
            .withColumn("band_high", F.col("mean") + F.sqrt("var")))


def scalar_summary(panel: DataFrame, series: str = "series", x: str = "x",
                   cuts: dict[str, float] = CUTS) -> DataFrame:
    """Mean, population std and the exact cut points of each measurement."""
    readings = panel.select(series, present(F.col(x)).alias("_v")).where("_v is not null")
    moments = readings.groupBy(series).agg(
        F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("std"))
    return moments.join(exact_quantiles(readings, [series], "_v", cuts), series)


def clip_range(panel: DataFrame, limits: DataFrame, series: str = "series", x: str = "x",
               low: str = "low100", high: str = "high100") -> DataFrame:
    """Readings with ``low <= x <= high`` of their series, both ends included."""
    spread = [F.col(c) for c in panel.columns if c != series]
    bounded = enrich(panel, limits.select(series, low, high), [series], spread=spread)
    return bounded.where(F.col(x).between(F.col(low), F.col(high))).drop(low, high)


def clipped_histogram(panel: DataFrame, series: str = "series", x: str = "x",
                      bins: int = 100) -> DataFrame:
    """Equal-width histogram of the readings between the 1 % and 99 % points.

    Bins span the smallest to the largest clipped reading; the last bin is
    closed.  A series with a single value gets bins of total width one.
    """
    readings = panel.select(series, present(F.col(x)).alias("_v")).where("_v is not null")
    cuts = {c: CUTS[c] for c in ("low100", "high100")}
    stats = order_statistics(readings, [series], "_v", cuts)
    low, high = (interpolated(c, p) for c, p in cuts.items())
    # The smallest and largest clipped reading are neighbours of the cut points.
    ends = stats.select(
        series, low.alias("low100"), high.alias("high100"),
        F.when(F.col("_low100_lo") >= low, F.col("_low100_lo"))
        .otherwise(F.col("_low100_hi")).alias("_lo"),
        F.when(F.col("_high100_hi") <= high, F.col("_high100_hi"))
        .otherwise(F.col("_high100_lo")).alias("_hi"))
    pad = F.when(F.col("_lo") == F.col("_hi"), 0.5).otherwise(0.0)
    spans = ends.select(series, "low100", "high100", (F.col("_lo") - pad).alias("_lo"),
                        (F.col("_hi") + pad).alias("_hi"))
    placed = weighted_enrich(readings, spans, [series], "_v")
    kept = placed.where(F.col("_v").between(F.col("low100"), F.col("high100")))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    slot = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))
    return (kept.groupBy(series, slot.cast("int").alias("bin"),
                         (F.col("_lo") + slot * width).alias("bin_start"))
            .agg(F.sum("n").alias("cnt")))
