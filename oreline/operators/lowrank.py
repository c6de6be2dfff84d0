"""Spectra and low-rank reconstruction of day-by-day vectors.

A vector row is ``(keys..., series, vec ARRAY<DOUBLE>)`` with NaN for missing
readings.  Matrix work runs in Arrow batches inside the tasks; what is
shuffled are d x d partial sums and the few rows each task still considers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.arrow import chunks, lists, matrix, stacked
from oreline.operators.lookup import HOT_ROWS, enrich, fits_broadcast
from oreline.operators.topk import top_per_group
from oreline.session import cut_lineage


def panel_vectors(panel: DataFrame, keys: list[str], slot: str, x: str,
                  length: int, first_slot: int = 0, drop_outside: bool = False) -> DataFrame:
    """Long panel to one vector per key; ``length`` slots from ``first_slot``, NaN where empty.

    Readings are averaged per slot first, so a key collects at most
    ``length`` entries however many readings it has.  A reading of another
    slot is an error unless ``drop_outside`` asks to leave such readings out.
    """
    last = first_slot + length - 1
    inside = F.col(slot).between(first_slot, last)
    if drop_outside:
        panel, checked = panel.where(inside), F.col(slot)
    else:
        message = F.concat(F.lit(f"slot outside {first_slot}..{last}: "), F.col(slot).cast("string"))
        checked = F.when(F.col(slot).isNull() | inside, F.col(slot)).otherwise(F.raise_error(message).cast("int"))
    cells = (panel.where(F.col(slot).isNotNull())
             .groupBy(*keys, checked.alias("_slot")).agg(F.avg(x).alias("_x")).groupBy(*keys)
             .agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_x"))).alias("_m")))
    at = F.transform(F.sequence(F.lit(first_slot), F.lit(last)),
                     lambda i: F.coalesce(F.try_element_at(F.col("_m"), i),
                                          F.lit(float("nan"))))
    return cells.select(*keys, at.alias("vec"))


# --- covariance and eigenvectors ---------------------------------------------

_SUMS = ("n", "mi", "mj", "c")
_PARTIAL = "series {t}, part int, n array<double>, mi array<double>, mj array<double>, c array<double>"
# Partial sums of a series are merged in so many streams, and these in one.
STREAMS = 256


class _Moments:
    """Pair counts, means and co-moments of the days, merged chunk by chunk.

    ``mean[i, j]`` is the mean of day i over the rows that have both days.
    Sums are taken around a chunk's own means and merged by the pairwise
    update of Chan, Golub and LeVeque, so large means cost no digits.
    """

    def __init__(self, d: int):
        self.n, self.mean, self.c = np.zeros((d, d)), np.zeros((d, d)), np.zeros((d, d))

    def add(self, rows: np.ndarray) -> None:
        seen = ~np.isnan(rows)
        m = seen.astype(np.float64)
        count = m.sum(axis=0)
        near = np.where(seen, rows, 0.0).sum(axis=0) / np.maximum(count, 1.0)
        v = np.where(seen, rows - near, 0.0)
        n = m.T @ m
        rest = np.divide(v.T @ m, n, out=np.zeros_like(n), where=n > 0)
        self._merge(n, near[:, None] + rest, v.T @ v - n * rest * rest.T)

    def _merge(self, n: np.ndarray, mean: np.ndarray, c: np.ndarray) -> None:
        total = self.n + n
        share = np.divide(n, total, out=np.zeros_like(n), where=total > 0)
        delta = np.where(n > 0, mean - self.mean, 0.0)
        self.c += c + self.n * share * delta * delta.T
        self.mean += share * delta
        self.n = total

    def row(self, key, type_: pa.DataType, part: int) -> pa.RecordBatch:
        """One row: the entries on and above the diagonal as arrays."""
        i, j = np.triu_indices(len(self.n))
        return pa.RecordBatch.from_arrays(
            [pa.array([key], type=type_), pa.array([part], pa.int32()),
             *[lists(x[None, :]) for x in (self.n[i, j], self.mean[i, j], self.mean[j, i], self.c[i, j])]],
            ["series", "part", *_SUMS])

    def add_row(self, n: np.ndarray, mi: np.ndarray, mj: np.ndarray, c: np.ndarray) -> None:
        """Merges what :meth:`row` wrote."""
        d = len(self.n)
        i, j = np.triu_indices(d)
        full = [np.zeros((d, d)) for _ in range(3)]
        for whole, upper, lower in zip(full, (n, mi, c), (n, mj, c)):
            whole[j, i] = lower
            whole[i, j] = upper
        self._merge(*full)


def _comoments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and series one row of sums; the rows of a series come together."""
    key, held, type_, part = None, None, None, TaskContext.get().partitionId()
    for whole in batches:
        for batch in chunks(whole, 4096):
            type_ = batch.column(0).type
            codes = batch.column(0).dictionary_encode(null_encoding="encode")
            x, names = matrix(batch.column(1)), codes.dictionary.to_pylist()
            index = codes.indices.to_numpy(zero_copy_only=False)
            for code in dict.fromkeys(index.tolist()):
                if held is None or names[code] != key:
                    if held is not None:
                        yield held.row(key, type_, part)
                    key, held = names[code], _Moments(x.shape[1])
                held.add(x[index == code])
    if held is not None:
        yield held.row(key, type_, part)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of equal (series, part) as one; holds one set of sums."""
    key, held, type_ = None, None, None
    for batch in batches:
        type_ = batch.column(0).type
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for at, own in enumerate(keys):
            sums = [batch.column(2 + k).slice(at, 1).flatten().to_numpy() for k in range(4)]
            if held is None or own != key:
                if held is not None:
                    yield held.row(key[0], type_, key[1])
                key, held = own, _Moments((math.isqrt(8 * len(sums[0]) + 1) - 1) // 2)
            held.add_row(*sums)
    if held is not None:
        yield held.row(key[0], type_, key[1])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per entry on and above the diagonal."""
    for batch in batches:
        for at in range(batch.num_rows):
            n, mi, _, c = [batch.column(2 + k).slice(at, 1).flatten().to_numpy() for k in range(4)]
            i, j = np.triu_indices((math.isqrt(8 * len(n) + 1) - 1) // 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.full(len(n), at))), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n),
                 pa.array(np.where(n > 0, mi, np.nan)), pa.array(np.divide(c, n, out=np.zeros_like(c), where=n > 0))],
                ["series", "i", "j", "n", "mean", "cov"])


def covariance(vectors: DataFrame, series: str = "series", vec: str = "vec") -> DataFrame:
    """Pairwise-complete population covariance: ``(series, i, j, n, mean, cov)``, i <= j.

    ``n`` counts the rows with both days and ``mean`` is that of day i over them,
    so the rows with i = j hold the plain daily means.
    Each task sorts its rows by series and adds them up around their means
    before anything is shuffled, so it holds the sums of one series at a time
    and emits one row of arrays per series.  These rows are merged as they stream
    by, first in ``STREAMS`` streams a series and then in one, in an order that a
    retried task repeats; no task holds more than one set of sums.
    """
    narrow = (vectors.select(series, vec).where(F.col(vec).isNotNull())
              .sortWithinPartitions(series))
    kind = vectors.schema[series].dataType.simpleString()
    partial = narrow.mapInArrow(_comoments, _PARTIAL.format(t=kind))
    schema = partial.schema
    ordered = partial.withColumn("stream", F.pmod("part", F.lit(STREAMS))).repartition("series", "stream").sortWithinPartitions("series", "stream", "part")
    first = ordered.select("series", F.col("stream").alias("part"), *_SUMS).mapInArrow(_merged, schema)
    last = (first.repartition("series").sortWithinPartitions("series", "part")
            .select("series", F.lit(0).alias("part"), *_SUMS).mapInArrow(_merged, schema))
    entries = last.mapInArrow(_entries, f"series {kind}, i int, j int, n double, mean double, cov double")
    return entries.withColumnRenamed("series", series)


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    d = int(pdf["j"].max()) + 1
    c = np.zeros((d, d))
    i, j = pdf["i"].to_numpy(), pdf["j"].to_numpy()
    c[i, j] = c[j, i] = pdf["cov"].to_numpy()
    values, vectors = np.linalg.eigh(c)
    order = np.argsort(-values, kind="stable")
    values, vectors = np.clip(values[order], 0.0, None), vectors[:, order].T
    peak = np.abs(vectors).argmax(axis=1)
    vectors = vectors * np.sign(vectors[np.arange(d), peak])[:, None]
    return pd.DataFrame({"series": [pdf.iloc[0, 0]] * d, "k": np.arange(1, d + 1),
                         "eigval": values, "eigvec": list(vectors)})


def eigen(cov: DataFrame, series: str = "series") -> DataFrame:
    """``(series, k, eigval, eigvec)``, largest eigenvalue first.

    One small d x d problem per series.  Negative eigenvalues (possible with
    missing readings) become 0; the largest entry of a vector is positive.
    """
    kind = cov.schema[series].dataType.simpleString()
    out = (cov.select(F.col(series).alias("series"), "i", "j", "cov").groupBy("series")
           .applyInPandas(_solve, f"series {kind}, k int, eigval double, eigvec array<double>"))
    return out.withColumnRenamed("series", series)


def explained_variance(eig: DataFrame, series: str = "series", k_max: int = 9) -> DataFrame:
    """Share of the total variance in the top k eigenvalues, k = 0..k_max.

    A series without variance has no shares: ``explained`` is null.
    """
    values = eig.groupBy(series).agg(
        F.sort_array(F.collect_list("eigval"), asc=False).alias("_v"))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)

    return (values
            .select(series, "_v", F.explode(F.sequence(F.lit(0), F.lit(k_max))).alias("k"))
            .select(series, "k",
                    F.try_divide(total(F.slice("_v", F.lit(1), F.col("k"))), total(F.col("_v")))
                    .alias("explained")))


def eigenvector_series(eig: DataFrame, series: str = "series", top: int = 3) -> DataFrame:
    """The leading eigenvectors as rows ``(series, k, day, value)``, day from 1."""
    return (eig.where(F.col("k") <= top)
            .select(series, "k", F.posexplode("eigvec").alias("_p", "value"))
            .select(series, "k", (F.col("_p") + 1).alias("day"), "value"))


# --- reconstruction -----------------------------------------------------------

def mean_vectors(vectors: DataFrame, series: str = "series", vec: str = "vec") -> DataFrame:
    """Mean of each day over the present readings: ``(series, mean)``."""
    days = vectors.select(series, F.posexplode(vec).alias("_p", "_x"))
    means = days.groupBy(series, "_p").agg(
        F.avg(F.nanvl(F.col("_x").cast("double"), F.lit(None).cast("double"))).alias("_x"))
    return means.groupBy(series).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_p", "_x"))),
                    lambda s: F.coalesce(s["_x"], F.lit(float("nan")))).alias("mean"))


def basis_of(eig: DataFrame, means: DataFrame, series: str = "series",
             rank: int = 3) -> DataFrame:
    """One row per series: ``mean`` and the leading vectors as ``basis``."""
    leading = (eig.where(F.col("k") <= rank).groupBy(series)
               .agg(F.sort_array(F.collect_list(F.struct("k", "eigvec"))).alias("_b"))
               .select(series, F.transform("_b", lambda s: s["eigvec"]).alias("basis")))
    return means.join(leading, series)


def fit_basis(vectors: DataFrame, series: str = "series", vec: str = "vec",
              rank: int = 3) -> DataFrame:
    """Mean and leading eigenvectors of every series from one pass over the vectors."""
    cov = cut_lineage(covariance(vectors, series, vec))
    means = (cov.where(F.col("i") == F.col("j")).groupBy(series)
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "mean"))),
                              lambda s: s["mean"]).alias("mean")))
    return basis_of(eigen(cov, series), means, series, rank)


def _rebuild(x: np.ndarray, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rank 1..k reconstructions, n x k x d.  NaN in a row spreads over it."""
    weight = np.einsum("nd,nkd->nk", x - mean, basis)
    return mean[:, None, :] + np.cumsum(weight[:, :, None] * basis, axis=1)


class _Bases:
    """Mean and basis of the series, as arrays, and what they rebuild of a batch."""

    def __init__(self, known: dict):
        self.known = known

    def found(self, names: pa.Array, vectors: pa.Array) -> Iterator[tuple]:
        """Per series of a batch: its name, places, vectors, mean and basis; unknown series and null vectors are left out."""
        codes = names.dictionary_encode(null_encoding="encode")
        index = codes.indices.to_numpy(zero_copy_only=False)
        usable = vectors.is_valid().to_numpy(zero_copy_only=False)
        for code, name in enumerate(codes.dictionary.to_pylist()):
            at = np.flatnonzero((index == code) & usable)
            if len(at) and name is not None and name in self.known:
                yield name, at, matrix(vectors.take(pa.array(at))), *self.known[name]

    def built(self, names: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per series of a batch: its places, vectors, mean and reconstructions."""
        for _, at, x, mean, basis in self.found(names, vectors):
            yield at, x, mean, _rebuild(x, np.broadcast_to(mean, x.shape), np.broadcast_to(basis, (len(x), *basis.shape)))


def _with_bases(vectors: DataFrame, basis: DataFrame, series: str, vec: str, schema: T.StructType, work) -> DataFrame:
    """``work(batch, bases)`` over the rows of ``vectors``, with the bases at hand and in no row.

    Bases of a measured, small size are sent to the tasks once.  Larger ones
    travel as rows of their own: each opens the rows of its series, which are
    dealt over as many tasks as the series asks for.
    """
    typed = vectors.withColumn(vec, F.col(vec).cast("array<double>"))
    own = cut_lineage(basis.select(F.col(series).alias("s"), F.col("mean").cast("array<double>"), F.col("basis").cast("array<array<double>>")))
    if fits_broadcast(own):
        shared = vectors.sparkSession.sparkContext.broadcast(
            {r["s"]: (np.array(r["mean"], float), np.array(r["basis"], float)) for r in own.collect()})     # bounded by fits_broadcast

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bases = _Bases(shared.value)
            for whole in batches:
                for batch in chunks(whole):
                    yield from work(batch, bases)

        return typed.mapInArrow(kernel, schema)

    hot = cut_lineage(typed.groupBy(F.col(series).alias("s")).agg(F.ceil(F.count(F.lit(1)) / F.lit(HOT_ROWS)).cast("int").alias("salts")).where("salts > 1"))
    known = F.broadcast(hot) if fits_broadcast(hot) else hot
    spread = F.xxhash64(*[F.col(c) for c in typed.columns if c != series])
    rows = (typed.withColumn("_row", F.struct(*typed.columns)).join(known, F.col(series) == F.col("s"), "left")
            .select(F.col(series).alias("s"), F.pmod(spread, F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), F.lit(1).alias("kind"), "_row"))
    heads = (own.join(hot, "s", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
             .select("s", "salt", F.lit(0).alias("kind"), "mean", "basis"))
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("s", "salt").sortWithinPartitions("s", "salt", "kind")
    names = typed.columns

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = _Bases({})
        for whole in batches:
            for batch in chunks(whole):
                kind = batch.column(2).to_numpy()
                for at in np.flatnonzero(kind == 0).tolist():
                    bases.known[batch.column(0)[at].as_py()] = tuple(np.array(batch.column(k)[at].as_py(), float) for k in (4, 5))
                rest = batch.filter(pa.array(kind == 1))
                if rest.num_rows:
                    yield from work(pa.RecordBatch.from_arrays(rest.column(3).flatten(), names), bases)
                last = batch.column(0)[batch.num_rows - 1].as_py()
                bases.known = {k: v for k, v in bases.known.items() if k == last}     # earlier series are done

    return both.mapInArrow(opened, schema)


def _prepend(schema: T.StructType, drop: set[str], extra: str) -> T.StructType:
    kept = [f for f in schema.fields if f.name not in drop]
    return T.StructType(kept + T.StructType.fromDDL(extra).fields)


def reconstruct(vectors: DataFrame, basis: DataFrame, series: str = "series",
                vec: str = "vec") -> DataFrame:
    """Adds ``mean``, ``recon`` (one array per rank) and ``err`` (one per rank).

    ``err`` is the squared distance between the vector and its reconstruction.
    """
    columns = [c for c in vectors.columns if c not in ("mean", "recon", "err")]

    def work(batch: pa.RecordBatch, bases: _Bases) -> Iterator[pa.RecordBatch]:
        for at, x, mean, built in bases.built(batch.column(series), batch.column(vec)):
            n, k, d = built.shape
            ends = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32))
            recon = pa.ListArray.from_arrays(ends, lists(built.reshape(n * k, d)))
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in columns] + [lists(np.tile(mean, (n, 1))), recon, lists(((built - x[:, None, :]) ** 2).sum(axis=2))],
                [*columns, "mean", "recon", "err"])

    typed = vectors.withColumn(vec, F.col(vec).cast("array<double>")).schema
    schema = _prepend(typed, {"mean", "recon", "err"}, "mean array<double>, recon array<array<double>>, err array<double>")
    return _with_bases(vectors, basis, series, vec, schema, work)


def residuals(vectors: DataFrame, basis: DataFrame, series: str = "series",
              vec: str = "vec") -> DataFrame:
    """Keys and ``err`` per rank, without the vectors; NaN rows are dropped."""
    columns = [c for c in vectors.columns if c not in (vec, "err")]

    def work(batch: pa.RecordBatch, bases: _Bases) -> Iterator[pa.RecordBatch]:
        for at, x, _, built in bases.built(batch.column(series), batch.column(vec)):
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in columns] + [lists(((built - x[:, None, :]) ** 2).sum(axis=2))], [*columns, "err"])

    schema = _prepend(vectors.schema, {vec, "err"}, "err array<double>")
    return _with_bases(vectors, basis, series, vec, schema, work).where(~F.isnan(F.element_at("err", -1)))


def residual_extremes(vectors: DataFrame, basis: DataFrame, keys: list[str],
                      series: str = "series", vec: str = "vec", k: int = 2) -> DataFrame:
    """The k rows of each series nearest to and farthest from their reconstruction.

    ``(keys, series, end, pos, err)`` with ``end`` 'low' or 'high' and ``pos``
    counted from the extreme; a short series shows rows at both ends.
    """
    scored = (residuals(vectors, basis, series, vec)
              .select(*keys, series, F.element_at("err", -1).alias("err")))
    both = scored.select(
        "*", F.explode(F.array(F.lit("low"), F.lit("high"))).alias("end"))
    signed = F.when(F.col("end") == "low", F.col("err")).otherwise(-F.col("err"))
    return top_per_group(both.withColumn("_o", signed), [series, "end"],
                         [F.asc("_o"), *[F.asc(c) for c in keys]], k, "pos").drop("_o")


def extreme_profiles(vectors: DataFrame, basis: DataFrame, keys: list[str],
                     series: str = "series", vec: str = "vec", k: int = 2) -> DataFrame:
    """Original, mean and every reconstruction of the extreme rows, one row per day.

    Only the keys of the extremes (2k per series) travel back to the vectors.
    """
    found = residual_extremes(vectors, basis, keys, series, vec, k)
    chosen = enrich_many(vectors, found, [*keys, series])
    built = reconstruct(chosen, basis, series, vec)
    ranks = F.col("recon")
    day = F.posexplode(F.arrays_zip(F.col(vec).alias("original"), F.col("mean").alias("mean")))
    rows = built.select(*keys, series, "end", "pos", ranks.alias("_r"), day.alias("_p", "_z"))
    return rows.select(
        *keys, series, "end", "pos", (F.col("_p") + 1).alias("day"),
        F.col("_z.original").alias("original"), F.col("_z.mean").alias("mean"),
        F.transform("_r", lambda a: F.get(a, F.col("_p"))).alias("recon"))


def enrich_many(facts: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """Join with a table whose keys may repeat a bounded number of times."""
    grouped = few.groupBy(*on).agg(F.collect_list(F.struct("end", "pos")).alias("_m"))
    return (enrich(facts, grouped, on)
            .select("*", F.inline("_m")).drop("_m"))
