"""Ranks, running totals and exact quantiles without one-task sorts.

A window with few partition keys sorts everything in a few tasks.  Here rows
are range-partitioned by the sort order, each partition is summed on its own,
and the small table of partition totals gives every partition its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreline.operators.lookup import enrich, fits_broadcast
from oreline.session import cut_lineage

# Rank error of the first guess is 1 / ACCURACY; brackets are twice as wide.
ACCURACY = 10_000


def running_total(df: DataFrame, by: list[str], order: list[str], weight: str,
                  out: str = "upto") -> DataFrame:
    """``out`` = sum of ``weight`` over rows of the group up to this one.

    ``order`` must be unique inside a group.
    """
    # The partition number is stored with the rows before it is used twice;
    # range bounds are sampled and could differ if the shuffle ran again.
    placed = cut_lineage(
        df.repartitionByRange(*by, *order)
        .withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_part").agg(F.sum(weight).alias("_sum"))
    before = (Window.partitionBy(*by).orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*by, "_part",
                            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    local = (Window.partitionBy(*by, "_part").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = placed.withColumn("_local", F.sum(weight).over(local))
    return (within.join(offsets, [*by, "_part"])
            .withColumn(out, F.col("_local") + F.col("_offset"))
            .drop("_part", "_local", "_offset"))


def _brackets(df: DataFrame, by: list[str], x: str, probs: dict[str, float],
              accuracy: int) -> DataFrame:
    """Group size and, per quantile, a range of values that should hold it.

    From mergeable sketches of bounded size, combined map-side.
    """
    margin = 2.0 / accuracy
    edges = [e for p in probs.values() for e in (max(0.0, p - margin), min(1.0, p + margin))]
    guess = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_size"), F.min(x).alias("_min"), F.max(x).alias("_max"),
        F.percentile_approx(x, edges, accuracy).alias("_q"))
    out = []
    for i, name in enumerate(probs):
        low, high = edges[2 * i], edges[2 * i + 1]
        out.append((F.col("_min") if low == 0.0 else F.col("_q")[2 * i]).alias(f"_{name}_from"))
        out.append((F.col("_max") if high == 1.0 else F.col("_q")[2 * i + 1]).alias(f"_{name}_to"))
    return guess.select(*by, "_size", *out)


def weighted_enrich(df: DataFrame, lookup: DataFrame, by: list[str], x: str,
                    weight: str = "n") -> DataFrame:
    """``(by, x, weight)`` rows joined with a lookup on ``by``.

    With a lookup that can be broadcast every row stands for itself.  For a
    larger one equal values are counted first, so that neither a hot group nor
    a hot value inside it reaches a single task of the join.
    """
    lookup = cut_lineage(lookup)
    if fits_broadcast(lookup):
        rows = df.select(*by, x, F.lit(1).cast("bigint").alias(weight))
    else:
        rows = df.groupBy(*by, x).agg(F.count(F.lit(1)).alias(weight))
    return enrich(rows, lookup, by, spread=[F.col(x)])


def _order_statistics(counts: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """Values on either side of each target rank, from ``(by, _size, _x, _gap, n)``.

    Rows with ``_gap`` stand for all values of a stretch; a rank that falls on
    one is unknown and leaves a null.
    """
    counts = cut_lineage(counts)
    keys, order = [*by, "_size"], ["_x", "_gap"]
    ranked = running_total(counts, keys, order, "n")
    first, past = F.col("upto") - F.col("n"), F.col("upto")
    near, picks = F.lit(False), []
    for name, p in probs.items():
        spot = (F.col("_size") - 1) * F.lit(float(p))
        for rank, side in ((F.floor(spot), "lo"), (F.ceil(spot), "hi")):
            hit = (first <= rank) & (rank < past)
            near = near | hit
            picks.append(F.max(F.when(hit & ~F.col("_gap"), F.col("_x"))).alias(f"_{name}_{side}"))
    return ranked.where(near).groupBy(*by, "_size").agg(*picks)


def order_statistics(df: DataFrame, by: list[str], x: str, probs: dict[str, float],
                     accuracy: int = ACCURACY) -> DataFrame:
    """``(by, _size, _name_lo, _name_hi)``: exact neighbours of each quantile.

    A first pass brackets each quantile with a sketch, a second counts single
    values inside the brackets and whole stretches outside them, so only a
    small part of the values is ever shuffled and sorted.  The counts show
    whether each rank fell into its bracket; groups where one did not are
    counted in full.
    """
    data = df.select(*by, x)
    sized = weighted_enrich(data, _brackets(data, by, x, probs, accuracy), by, x)
    value = F.col(x)
    inside, below = F.lit(False), [F.lit(float("-inf"))]
    for name in probs:
        inside = inside | value.between(F.col(f"_{name}_from"), F.col(f"_{name}_to"))
        below.append(F.when(F.col(f"_{name}_to") < value, F.col(f"_{name}_to")))
    snapped = F.when(inside, value).otherwise(F.greatest(*below))
    counts = (sized.groupBy(*by, "_size", snapped.alias("_x"), (~inside).alias("_gap"))
              .agg(F.sum("n").alias("n")))
    found = cut_lineage(_order_statistics(counts, by, probs))
    ends = [f"_{name}_{side}" for name in probs for side in ("lo", "hi")]
    unknown = F.lit(False)
    for end in ends:
        unknown = unknown | F.col(end).isNull()
    if found.where(unknown).isEmpty():
        return found
    again = weighted_enrich(data, found.where(unknown).select(*by, "_size"), by, x)
    full = (again.groupBy(*by, "_size", value.alias("_x"), F.lit(False).alias("_gap"))
            .agg(F.sum("n").alias("n")))
    return found.where(~unknown).unionByName(_order_statistics(full, by, probs))


def interpolated(name: str, p: float) -> Column:
    """The quantile between its neighbours, by linear interpolation."""
    spot = (F.col("_size") - 1) * F.lit(float(p))
    lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
    return lo + (hi - lo) * (spot - F.floor(spot))


def exact_quantiles(df: DataFrame, by: list[str], x: str, probs: dict[str, float],
                    accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles per group, one column per name; ``x`` must be a number.

    The built-in exact percentile keeps all different values of a group in one
    task's memory.
    """
    stats = order_statistics(df, by, x, probs, accuracy)
    return stats.select(*by, *[interpolated(n, p).alias(n) for n, p in probs.items()])
