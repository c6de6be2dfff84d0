"""Leading eigenvectors of long vectors, without a matrix of all pairs of days.

:func:`oreline.operators.lowrank.covariance` holds d x d sums in a task, too
much once d is large.  Here a block of a few vectors is multiplied with the
covariance in one pass over the rows; the products of all rounds span the space
in which the leading vectors are sought (block iteration with Rayleigh-Ritz).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.arrow import chunks, lists, matrix
from oreline.operators.lowrank import STREAMS, _with_bases
from oreline.session import cut_lineage

# Vectors in a block beyond the ones asked for, and vectors kept between rounds.
SPARE = 5
KEEP = 64
# Sums that a task holds at a time.
HELD = 64

_PARTIAL = "series {t}, part int, v array<double>"
_STATE = ("series {t}, n double, mean array<double>, basis array<array<double>>, q array<array<double>>, "
          "image array<array<double>>, eigval array<double>, trace double, residual double, done boolean")


def _partial(key, type_: pa.DataType, part: int, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], type_), pa.array([part], pa.int32()), lists(v[None, :])], ["series", "part", "v"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (series, part) added up, as far as ``HELD`` of them are met together."""
    held: dict = {}
    type_ = None

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], type_), pa.array([k[1] for k in held], pa.int32()), lists(np.stack(list(held.values())))], ["series", "part", "v"])

    for batch in batches:
        type_ = batch.column(0).type
        for at, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            v = batch.column(2).slice(at, 1).flatten().to_numpy()
            if key not in held and len(held) == HELD:
                yield rows()
                held.clear()
            held[key] = held[key] + v if key in held else v
    if held:
        yield rows()


def _totals(partial: DataFrame) -> DataFrame:
    """One sum per series: added up in the task, in ``STREAMS`` streams, then in one, in a fixed order."""
    schema = partial.schema
    dealt = (partial.mapInArrow(_summed, schema).withColumn("stream", F.pmod("part", F.lit(STREAMS)))
             .repartition("series", "stream").sortWithinPartitions("series", "stream", "part"))
    first = dealt.select("series", F.col("stream").alias("part"), "v").mapInArrow(_summed, schema)
    return (first.repartition("series").sortWithinPartitions("series", "part")
            .select("series", F.lit(0).alias("part"), "v").mapInArrow(_summed, schema))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum and number of the rows without a gap, by series."""
    part = TaskContext.get().partitionId()
    for whole in batches:
        for batch in chunks(whole, 4096):
            codes = batch.column(0).dictionary_encode()
            x, index = matrix(batch.column(1)), codes.indices.to_numpy(zero_copy_only=False)
            full = ~np.isnan(x).any(axis=1)
            for code, name in enumerate(codes.dictionary.to_pylist()):
                own = x[(index == code) & full]
                yield _partial(name, batch.column(0).type, part, np.append(own.sum(axis=0), len(own)))


def _nested(x: np.ndarray) -> pa.Array:
    """One cell of array<array<double>>."""
    return pa.array([[row.tolist() for row in x]], pa.list_(pa.list_(pa.float64())))


def _state(key, type_, n, mean, block, q, image, values, trace, residual, done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key], type_), pa.array([n], pa.float64()), lists(mean[None, :]), _nested(block), _nested(q), _nested(image), lists(values[None, :]),
         pa.array([trace], pa.float64()), pa.array([residual], pa.float64()), pa.array([done])],
        ["series", "n", "mean", "basis", "q", "image", "eigval", "trace", "residual", "done"])


def _directions(x: np.ndarray, q: np.ndarray, size: int) -> np.ndarray:
    """Orthonormal rows that span ``x`` outside ``q``; rows of zeros where there are fewer than ``size``."""
    out = []
    for row in x:
        before = np.linalg.norm(row)
        for _ in range(2):  # the second time takes away what rounding left
            for known in (q, np.array(out).reshape(-1, x.shape[1])):
                row = row - (known @ row) @ known
        left = np.linalg.norm(row)
        if left > 1e-8 * before:
            out.append(row / left)
    return np.concatenate([np.array(out).reshape(-1, x.shape[1]), np.zeros((size - len(out), x.shape[1]))])


def _ritz(q: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, vectors and their products within the span of ``q``, largest first."""
    inner = q @ image.T
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1].T
    return values, turn @ q, turn @ image


def leading_eigen(vectors: DataFrame, top: int = 3, series: str = "series", vec: str = "vec",
                  tolerance: float = 1e-10, rounds: int = 200, seed: int = 0) -> DataFrame:
    """``(series, k, eigval, eigvec, share, residual)`` for k = 1..top, like ``eigen`` of the covariance.

    ``share`` is the value's part of the whole variance (null without variance);
    ``residual`` tells how far the worst of the vectors is from an eigenvector,
    relative to the first value.  Rounds go on until it is at most ``tolerance``
    in every series, or ``rounds`` are over; each reads the rows once.  A task
    holds sums of ``top + SPARE`` vectors, a series ``KEEP`` vectors.

    Only rows without a gap count, since pairwise means need all pairs of
    days; a null series or vector counts nowhere; a series without a full row
    has no result; vectors with fewer than ``top`` days have as many results.
    """
    kind = vectors.schema[series].dataType.simpleString()
    narrow = vectors.select(F.col(series).alias("series"), F.col(vec).cast("array<double>").alias("vec")).where("series is not null and vec is not null")
    wide = top + SPARE
    state_schema = _STATE.format(t=kind)

    def start(batches):
        for batch in batches:
            for at, key in enumerate(batch.column(0).to_pylist()):
                v = batch.column(2).slice(at, 1).flatten().to_numpy()
                n, d = v[-1], len(v) - 1
                if n and d:
                    none = np.zeros((0, d))
                    block = _directions(np.random.default_rng(seed).normal(size=(min(wide, d), d)), none, wide)
                    yield _state(key, batch.column(0).type, n, v[:-1] / n, block, none, none, np.zeros(0), 0.0, np.inf, False)

    def multiply(batch, bases):
        part = TaskContext.get().partitionId()
        for name, _, x, mean, block in bases.found(batch.column("series"), batch.column("vec")):
            c = x[~np.isnan(x).any(axis=1)] - mean
            yield _partial(name, batch.column("series").type, part, np.append((c @ block.T).T @ c, (c * c).sum()))

    def step(batches):
        for batch in batches:
            for row in batch.to_pylist():
                mean, block = np.array(row["mean"]), np.array(row["basis"])
                d, used = len(mean), block.any(axis=1)
                y, trace = np.array(row["v"][:-1]).reshape(block.shape) / row["n"], row["v"][-1] / row["n"]
                q = np.concatenate([np.array(row["q"]).reshape(-1, d), block[used]])
                values, q, image = _ritz(q, np.concatenate([np.array(row["image"]).reshape(-1, d), y[used]]))
                missed = image[:wide] - values[:wide, None] * q[:wide]
                residual = float(np.linalg.norm(missed[:top], axis=1).max() / max(values[0], 1e-300))
                if len(q) + wide > KEEP:
                    keep = max(KEEP - wide, wide)
                    values, q, image = values[:keep], q[:keep], image[:keep]
                following = _directions(missed, q, wide)
                done = residual <= tolerance or len(q) >= d or not following.any()
                yield _state(row["series"], batch.column("series").type, row["n"], mean, following, q, image, values, trace, residual, done)

    state = cut_lineage(_totals(narrow.mapInArrow(_sums, _PARTIAL.format(t=kind))).mapInArrow(start, state_schema))
    for _ in range(rounds):
        going = state.where("not done")
        if going.isEmpty():
            break
        products = _with_bases(narrow, going.select("series", "mean", "basis"), "series", "vec", _PARTIAL.format(t=kind), multiply)
        moved = going.join(_totals(products).select("series", "v"), "series").mapInArrow(step, state_schema)
        state = cut_lineage(state.where("done").unionByName(moved))
    pairs = state.select("series", "trace", "residual", F.posexplode(F.arrays_zip(F.slice("eigval", 1, top).alias("value"), F.slice("q", 1, top).alias("vector"))).alias("p", "z"))
    peak = F.reduce("z.vector", F.lit(0.0), lambda a, x: F.when(F.abs(x) > F.abs(a), x).otherwise(a))
    return pairs.select(
        F.col("series").alias(series), (F.col("p") + 1).alias("k"), F.greatest(F.col("z.value"), F.lit(0.0)).alias("eigval"),
        F.transform("z.vector", lambda x: F.when(peak < 0, -x).otherwise(x)).alias("eigvec"),
        F.try_divide(F.greatest(F.col("z.value"), F.lit(0.0)), F.col("trace")).alias("share"), "residual")
