"""Least squares for many targets from one aggregation pass.

Means and population covariances of all inputs and targets are computed per
split by Spark's partial aggregates.  Everything asked of the models - the
coefficients, R-squared on either split, and the scores with one input left
out - follows from those numbers, so the data is read once however many
targets and inputs there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERFIT_RATIO = 0.1    # test / train score below this means over-fitting


def number_columns(df: DataFrame, arrays: list[str], width: int,
                   drop: list[str] | None = None) -> DataFrame:
    """Arrays as scalar columns ``name1..nameW``; arrays and ``drop`` are removed."""
    gone = set(arrays) | set(drop or [])
    kept = [F.col(c) for c in df.columns if c not in gone]
    split = [F.get(F.col(a), F.lit(i)).cast("double").alias(f"{a}{i + 1}")
             for a in arrays for i in range(width)]
    return df.select(*kept, *split)


def moments(df: DataFrame, inputs: list[str], targets: list[str], split: str) -> DataFrame:
    """One row per split: ``n``, ``mean`` and the upper triangle of ``cov``."""
    names = [*inputs, *targets]
    data = df.select(split, *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    p = len(inputs)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))
             if i < p or i == j]     # target x other target is never needed
    cov = [F.covar_pop(names[i], names[j]) if i != j else F.var_pop(names[i])
           for i, j in pairs]
    return data.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in names]).alias("mean"),
        F.array(*cov).alias("cov"))


class _Moments:
    def __init__(self, row: pd.Series, p: int, t: int):
        size = p + t
        pairs = [(i, j) for i in range(size) for j in range(i, size) if i < p or i == j]
        full = np.zeros((size, size))
        for (i, j), v in zip(pairs, row["cov"]):
            full[i, j] = full[j, i] = v
        mean = np.asarray(row["mean"], dtype=float)
        self.xx, self.xm = full[:p, :p], mean[:p]
        self.xy, self.yy, self.ym = full[:p, p:], np.diag(full)[p:], mean[p:]

    def fit(self, t: int, cols: list[int]) -> tuple[np.ndarray, float]:
        """Slopes and intercept; the least-norm solution when inputs depend on each other."""
        c, y = self.xx[np.ix_(cols, cols)], self.xy[cols, t]
        scale = np.sqrt(np.where(np.diag(c) > 0, np.diag(c), 1.0))
        r = c / np.outer(scale, scale)
        if cols and np.linalg.matrix_rank(r, tol=1e-10) == len(cols):
            slope = np.linalg.solve(r, y / scale) / scale
        else:
            slope = np.linalg.pinv(c, rcond=1e-12, hermitian=True) @ y
        return slope, float(self.ym[t] - slope @ self.xm[cols])

    def score(self, t: int, cols: list[int], slope: np.ndarray, intercept: float) -> float:
        """R-squared of a given model on this split; may be negative."""
        bias = self.ym[t] - intercept - slope @ self.xm[cols]
        c = self.xx[np.ix_(cols, cols)]
        mse = self.yy[t] - 2 * slope @ self.xy[cols, t] + slope @ c @ slope + bias ** 2
        if self.yy[t] <= 0:
            return 1.0 if mse <= 0 else 0.0
        return float(1.0 - mse / self.yy[t])


def _report(stats: DataFrame, inputs: list[str], targets: list[str], split: str,
            train: str, test: str, schema: str, rows) -> DataFrame:
    p, t = len(inputs), len(targets)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        found = {r[split]: _Moments(r, p, t) for _, r in pdf.iterrows()}
        out = list(rows(found[train], found.get(test, found[train]))) if train in found else []
        names = [part.split()[0] for part in schema.split(",")]
        return pd.DataFrame(out, columns=names)

    # One group of two rows, one per split.
    return stats.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(solve, schema)


def ols_coefficients(df: DataFrame, inputs: list[str], targets: list[str],
                     split: str = "split", train: str = "train") -> DataFrame:
    """``(target, input, coef)`` fitted on the train split, with the intercept."""
    every = list(range(len(inputs)))

    def rows(tr: _Moments, _te: _Moments):
        for t, target in enumerate(targets):
            slope, intercept = tr.fit(t, every)
            yield target, "intercept", intercept
            for name, value in zip(inputs, slope):
                yield target, name, float(value)

    stats = moments(df.where(F.col(split) == train), inputs, targets, split)
    return _report(stats, inputs, targets, split, train, train,
                   "target string, input string, coef double", rows)


def ols_scores(df: DataFrame, inputs: list[str], targets: list[str], split: str = "split",
               train: str = "train", test: str = "test") -> DataFrame:
    """``(target, train_r2, test_r2, overfit)`` of the models on all inputs."""
    every = list(range(len(inputs)))

    def rows(tr: _Moments, te: _Moments):
        for t, target in enumerate(targets):
            model = tr.fit(t, every)
            a, b = tr.score(t, every, *model), te.score(t, every, *model)
            yield target, a, b, bool(b < OVERFIT_RATIO * a)

    return _report(moments(df, inputs, targets, split), inputs, targets, split, train, test,
                   "target string, train_r2 double, test_r2 double, overfit boolean", rows)


def ols_ablation(df: DataFrame, inputs: list[str], targets: list[str], split: str = "split",
                 train: str = "train", test: str = "test") -> DataFrame:
    """Loss of R-squared on both splits when one input is left out and the model refitted."""
    every = list(range(len(inputs)))

    def rows(tr: _Moments, te: _Moments):
        for t, target in enumerate(targets):
            full = tr.fit(t, every)
            base = tr.score(t, every, *full), te.score(t, every, *full)
            for gone, name in enumerate(inputs):
                cols = [c for c in every if c != gone]
                model = tr.fit(t, cols)
                yield (target, name, base[0] - tr.score(t, cols, *model),
                       base[1] - te.score(t, cols, *model))

    return _report(moments(df, inputs, targets, split), inputs, targets, split, train, test,
                   "target string, removed string, train_decrease double, test_decrease double",
                   rows)
