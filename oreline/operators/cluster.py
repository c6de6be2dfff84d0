"""k-means++ with many runs in one pass over the points.

Points never leave the executors.  A pass ships the centres of all runs
(runs x k vectors) to the tasks, and every task returns one partial sum per
run and cluster, or one candidate point per run when seeding, so skewed
clusters cost nothing extra.  No pass depends on per-point state of an earlier
one: lineage stays flat and a lost executor only repeats its own tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.arrow import chunks, lists, matrix

# Clusters, runs and the move at which a run rests.
CLUSTERS = 5
RUNS = 25
MAX_SHIFT = 0.1


def concat_features(df: DataFrame, id_: str, arrays: list[str], out: str = "v") -> DataFrame:
    """``(id, v)``: the feature arrays of a row as one vector of doubles."""
    parts = [F.col(a).cast("array<double>") for a in arrays]
    return df.select(id_, F.concat(*parts).alias(out))


# --- distances ----------------------------------------------------------------

def sq_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances n x m by one matrix product.

    Entries small against the vectors' own lengths lose digits in the product
    form and are computed again directly, so a point is at distance 0 from itself.
    """
    shift = centers.mean(axis=0)
    xs, cs = x - shift, centers - shift
    scale = (xs ** 2).sum(1)[:, None] + (cs ** 2).sum(1)[None, :]
    d2 = scale - 2.0 * (xs @ cs.T)
    rows, cols = np.nonzero(d2 <= 1e-5 * scale)
    for at in range(0, len(rows), 4096):
        r, c = rows[at:at + 4096], cols[at:at + 4096]
        d2[r, c] = ((x[r] - centers[c]) ** 2).sum(axis=1)
    return d2


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label and squared distance per point and run; ties take the lowest label."""
    runs, k, d = centers.shape
    d2 = sq_distances(x, centers.reshape(runs * k, d)).reshape(-1, runs, k)
    low = d2.min(axis=2, keepdims=True)
    close = d2 <= low + 1e-9 * (1.0 + low)
    rows, which = np.nonzero(close.sum(axis=2) > 1)
    for at in range(0, len(rows), 1024):       # settle near-ties exactly
        r, w = rows[at:at + 1024], which[at:at + 1024]
        d2[r, w] = ((x[r][:, None, :] - centers[w]) ** 2).sum(axis=2)
    labels = d2.argmin(axis=2)
    return labels.astype(np.int32), d2.min(axis=2)


def center_array(centers: DataFrame, run: str = "run", j: str = "j", c: str = "c",
                 previous: np.ndarray | None = None) -> np.ndarray:
    """Centres as a runs x k x d array; they are bounded by runs * k.

    Each row goes to its (run, j).  A cluster without a row (it was empty)
    keeps its ``previous`` centre; without any, a missing row is an error.
    """
    cells = {(r[0], r[1]): r[2] for r in centers.select(run, j, c).collect()}
    if previous is None:
        shape = (1 + max(r for r, _ in cells), 1 + max(k for _, k in cells))
        missing = [(r, k) for r in range(shape[0]) for k in range(shape[1]) if (r, k) not in cells]
        if missing:
            raise ValueError(f"no centre for (run, cluster) {missing[:5]}; pass the previous centres")
        previous = np.zeros((*shape, len(next(iter(cells.values())))))
    out = previous.astype(float).copy()
    for at, value in cells.items():
        out[at] = value
    return out


def center_rows(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """A centre array as a ``(run, j, c)`` table."""
    rows = [(r, j, [float(v) for v in centers[r, j]])
            for r in range(centers.shape[0]) for j in range(centers.shape[1])]
    return points.sparkSession.createDataFrame(rows, "run int, j int, c array<double>")


def _rows(centers: np.ndarray | None, runs: int = 1) -> int:
    """Points per step, so that the distances of a step take about 8 MB."""
    many = runs if centers is None else centers.shape[0] * centers.shape[1]
    return max(16, min(8192, (1 << 20) // many))


# --- passes over the points -----------------------------------------------------

def assign(points: DataFrame, centers: np.ndarray, id_: str = "id", v: str = "v") -> DataFrame:
    """``(id, labels, d2)``: nearest centre and squared distance, one entry per run."""
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, _rows(shared.value)):
                labels, d2 = nearest(matrix(batch.column(1)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), lists(labels), lists(d2)], [id_, "labels", "d2"])

    schema = T.StructType([points.schema[id_],
                           *T.StructType.fromDDL("labels array<int>, d2 array<double>").fields])
    return points.select(id_, v).mapInArrow(kernel, schema)


def cluster_sums(points: DataFrame, centers: np.ndarray, v: str = "v") -> DataFrame:
    """``(run, j, n, cost, c)``: members, their squared distances and their mean.

    Empty clusters have no row.
    """
    runs, k, d = centers.shape
    shared = points.sparkSession.sparkContext.broadcast(centers)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, total = np.zeros(runs * k), np.zeros(runs * k), np.zeros((runs * k, d))
        for whole in batches:
            for batch in chunks(whole, _rows(shared.value)):
                x = matrix(batch.column(0))
                labels, d2 = nearest(x, shared.value)
                slot = labels + np.arange(runs) * k
                n += np.bincount(slot.ravel(), minlength=runs * k)
                cost += np.bincount(slot.ravel(), weights=d2.ravel(), minlength=runs * k)
                member = np.zeros((runs * k, len(x)))
                member[slot, np.arange(len(x))[:, None]] = 1.0
                total += member @ x
        used = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array((used // k).astype(np.int32)), pa.array((used % k).astype(np.int32)),
             pa.array(n[used]), pa.array(cost[used]), lists(total[used])],
            ["run", "j", "n", "cost", "total"])

    partial = points.select(v).mapInArrow(
        kernel, "run int, j int, n double, cost double, total array<double>")
    summed = partial.groupBy("run", "j").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        vector_to_array(Summarizer.sum(array_to_vector(F.col("total")))).alias("_t"))
    return summed.select("run", "j", F.col("n").cast("bigint").alias("n"), "cost",
                         F.transform("_t", lambda t: t / F.col("n")).alias("c"))


def _mix(z: np.ndarray) -> np.ndarray:
    """Finaliser of the public SplitMix64 generator."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _uniform(h: np.ndarray, run: int, round_: int, seed: int) -> np.ndarray:
    """Uniform in (0, 1] from the point's hash, the run, the round and the seed."""
    start = (seed * 1_000_003 + round_) * 1_000_003 + run
    salt = _mix(np.array([start % 2 ** 64], dtype=np.uint64))
    bits = _mix(h ^ salt) >> np.uint64(11)
    return (bits.astype(np.float64) + 1.0) * 2.0 ** -53


def draw(points: DataFrame, chosen: np.ndarray | None, runs: int, round_: int, seed: int,
         id_: str = "id", v: str = "v") -> DataFrame:
    """One point per run, with probability proportional to its squared distance.

    The distance is that to the nearest of the run's ``chosen`` centres; without
    any, all points weigh the same.  Every point draws an exponential waiting
    time with its weight as rate and the first to ring is taken: the minimum
    of independent exponentials picks each point with probability weight / total.
    The minimum is a partial aggregate, so nothing per point is shuffled.

    A point's uniform follows from its id, the run, the round and the seed by
    64-bit arithmetic, so other engines can repeat the draw.  ``point`` is the id
    drawn (its hash, where ids are not whole numbers).
    """
    shared = points.sparkSession.sparkContext.broadcast(chosen)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [None] * runs
        for whole in batches:
            for batch in chunks(whole, _rows(shared.value, runs)):
                x = matrix(batch.column("v"))
                h = batch.column("h").to_numpy().astype(np.uint64)
                near = None if shared.value is None else nearest(x, shared.value)[1]
                for r in range(runs):
                    u = _uniform(h, r, round_, seed)
                    with np.errstate(divide="ignore"):
                        wait = -np.log(u) if near is None else -np.log(u) / near[:, r]
                    # Points already chosen have weight 0: they never ring.
                    if near is not None:
                        wait[near[:, r] <= 0.0] = np.inf
                    at = int(wait.argmin())
                    if np.isinf(wait[at]):       # nothing has weight: draw evenly
                        at = int(u.argmin())
                    entry = (float(wait[at]), float(u[at]), int(h[at].astype(np.int64)))
                    if best[r] is None or entry < best[r][0]:
                        best[r] = (entry, x[at].copy())
        found = [(r, *b[0], b[1]) for r, b in enumerate(best) if b is not None]
        if found:
            r, wait, u, h, c = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, pa.int32()), pa.array(wait, pa.float64()),
                 pa.array(u, pa.float64()), pa.array(h, pa.int64()), lists(np.array(c))],
                ["run", "wait", "u", "h", "c"])

    whole = isinstance(points.schema[id_].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    h = F.col(id_).cast("bigint") if whole else F.xxhash64(id_)
    keyed = points.select(h.alias("h"), F.col(v).alias("v"))
    partial = keyed.mapInArrow(
        kernel, "run int, wait double, u double, h bigint, c array<double>")
    first = F.struct("wait", "u", "h")
    return partial.groupBy("run").agg(F.min_by("c", first).alias("c"), F.min_by("h", first).alias("point"))


# --- the algorithm ----------------------------------------------------------------

def seed_centers(points: DataFrame, k: int = CLUSTERS, runs: int = RUNS, seed: int = 0,
                 id_: str = "id", v: str = "v") -> np.ndarray:
    """k-means++ starting centres of every run, as runs x k x d."""
    return seeds(points, k, runs, seed, id_, v)[0]


def seeds(points: DataFrame, k: int = CLUSTERS, runs: int = RUNS, seed: int = 0,
          id_: str = "id", v: str = "v") -> tuple[np.ndarray, np.ndarray]:
    """Starting centres (runs x k x d) and the points drawn as such (runs x k)."""
    chosen: np.ndarray | None = None
    drawn = []
    for round_ in range(k):
        rows = draw(points, chosen, runs, round_, seed, id_, v).orderBy("run").collect()
        if not rows:
            raise ValueError("no points to choose centres from")
        new = np.array([r["c"] for r in rows], dtype=float)[:, None, :]
        chosen = new if chosen is None else np.concatenate([chosen, new], axis=1)
        drawn.append([r["point"] for r in rows])
    return chosen, np.array(drawn).T


def best_center_rows(points: DataFrame, costs: DataFrame, centers: np.ndarray) -> DataFrame:
    """``(run, j, c)``: the centres of the run of least cost."""
    run = best_run(costs).first()["run"]
    return center_rows(points, centers).where(F.col("run") == run)


def max_shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Largest over the runs of the summed moves of a run's centres."""
    joined = old.select("run", "j", F.col("c").alias("_a")).join(
        new.select("run", "j", F.col("c").alias("_b")), ["run", "j"])
    move = F.sqrt(F.aggregate(F.zip_with("_a", "_b", lambda a, b: (a - b) * (a - b)),
                              F.lit(0.0), lambda s, t: s + t))
    return (joined.groupBy("run").agg(F.sum(move).alias("shift"))
            .agg(F.max("shift").alias("max_shift")))


@dataclass
class KMeansRuns:
    """Final centres of all runs and the total cost before each step."""

    centers: np.ndarray
    history: list[np.ndarray]
    shift: float
    converged: bool = True


def lloyd(points: DataFrame, centers: np.ndarray, max_move: float = MAX_SHIFT,
          max_iter: int | None = None, v: str = "v",
          watch: Callable[[int, float], None] | None = None) -> KMeansRuns:
    """Moves the centres of all runs until none of the runs moves more than ``max_move``.

    An empty cluster keeps its centre.  With ``max_iter`` the steps may end
    earlier, and ``converged`` says so; without, they end when the centres rest.
    """
    centers, history, shift = centers.copy(), [], float("inf")
    for step in itertools.count() if max_iter is None else range(max_iter):
        new, cost = centers.copy(), np.zeros(len(centers))
        for row in cluster_sums(points, centers, v).collect():     # runs * k rows
            new[row["run"], row["j"]] = row["c"]
            cost[row["run"]] += row["cost"]
        shift = float(np.sqrt(((new - centers) ** 2).sum(axis=2)).sum(axis=1).max())
        history.append(cost)
        centers = new
        if watch:
            watch(step + 1, shift)
        if shift <= max_move:
            break
    return KMeansRuns(centers, history, shift, shift <= max_move)


def kmeans(points: DataFrame, k: int = CLUSTERS, runs: int = RUNS,
           max_move: float = MAX_SHIFT, seed: int = 0, max_iter: int | None = None,
           id_: str = "id", v: str = "v") -> KMeansRuns:
    """Seeding and Lloyd steps; the points are cached for the passes."""
    cached = points.select(id_, v).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return lloyd(cached, seed_centers(cached, k, runs, seed, id_, v),
                     max_move, max_iter, v)
    finally:
        cached.unpersist()


# --- diagnostics ------------------------------------------------------------------

def run_costs(points: DataFrame, centers: np.ndarray, v: str = "v") -> DataFrame:
    """``(run, cost)``: sum of squared distances to the nearest centre."""
    return (cluster_sums(points, centers, v)
            .groupBy("run").agg(F.sum("cost").alias("cost")))


def cost_summary(costs: DataFrame) -> DataFrame:
    """Base-2 logarithms of the largest, smallest and mean cost over the runs."""
    return costs.agg(F.log2(F.max("cost")).alias("log2_max"),
                     F.log2(F.min("cost")).alias("log2_min"),
                     F.log2(F.avg("cost")).alias("log2_mean"))


def best_run(costs: DataFrame) -> DataFrame:
    """The run of least cost; the lowest run number on ties."""
    return costs.agg(F.min_by("run", F.struct("cost", "run")).alias("run"),
                     F.min("cost").alias("cost"))


def best_centers(costs: DataFrame, centers: np.ndarray) -> np.ndarray:
    """The k x d centres of the run of least cost."""
    return centers[best_run(costs).first()["run"]]


def entropy_of(counts: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """Entropy in bits of the frequencies ``n`` within each group."""
    total = F.sum(n).cast("double")
    return counts.groupBy(*by).agg(
        (F.log2(total) - F.sum(F.col(n) * F.log2(n)) / total).alias("entropy"))


def prefix_entropy(labelled: DataFrame, labels: str = "labels") -> DataFrame:
    """``(runs, entropy)`` of the joint label of the first 1..R runs.

    Whole signatures are counted first; only different signatures are expanded
    into their prefixes.
    """
    whole = labelled.groupBy(labels).agg(F.count(F.lit(1)).alias("n"))
    prefixes = whole.select(
        "n", F.col(labels).alias("_l"),
        F.explode(F.sequence(F.lit(1), F.size(labels))).alias("runs"))
    counts = (prefixes.groupBy("runs", F.slice("_l", F.lit(1), F.col("runs")).alias("sig"))
              .agg(F.sum("n").alias("n")))
    return entropy_of(counts, ["runs"])
