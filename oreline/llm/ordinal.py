"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the set of its hashed words and of a few hashed shapes (share of
capitals, of symbols, of different words, of repeated lines).  One weight per
hash value is shared by all grades; ordered thresholds turn the score s into
P(grade <= k) = sigmoid(threshold_k - s).  From these come the expected grade
and the tail probabilities used to select documents.

The model is fitted on at most ``sample`` labelled rows (a documented bound;
the rows with the smallest hash of their id), so what reaches the driver is
bounded by that parameter.  Scoring covers every row and the whole text.

Defined results: a null text is the empty text, judged by its shapes alone;
null ids are scored like any other; rows with a null rating, ids that are null
and ratings of absent documents are not used for fitting; a document rated more
than once takes its lowest grade; with no rated document every score is the
neutral one and everything is kept; an empty table gives an empty table.  Only
the named columns are read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
SAMPLE = 12_000
EDGE = ".,;:!?\"'()[]%&$#*|<>"
CACHE = 200_000
#: Rows whose features are summed at a time while fitting.
PART = 500


def bucket(word: str) -> int:
    return zlib.crc32(word.strip(EDGE).encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def shapes(text: str, words: list[str], distinct: int) -> list[str]:
    """Names of the shape features, each a share in tenths."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    symbols = sum(text.count(c) for c in "%#&$*|<>")
    lines = [line for line in text.split("\n") if line]
    n = max(1, len(words))
    tenth = lambda part, of: min(10, 10 * part // max(1, of))
    return [f"\0upper {tenth(upper, len(raw))}", f"\0symbols {tenth(symbols, n)}", f"\0any {symbols.bit_length()}",
            f"\0bangs {tenth(text.count('!!'), n)}", f"\0different {tenth(distinct, n)} {min(4, len(words) // 20)}",
            f"\0lines {tenth(len(lines) - len(set(lines)), len(lines))}", f"\0size {len(words).bit_length()}"]


def features(text: str | None) -> np.ndarray:
    """Sorted hash values of a text, one per different word or shape."""
    text = text or ""
    words = text.lower().split()
    distinct = set(words)
    return np.sort(np.array([bucket(w) for w in distinct] + [zlib.crc32(s.encode()) & ((1 << BITS) - 1)
                                                             for s in shapes(text, words, len(distinct))], dtype=np.int32))


@dataclass(frozen=True)
class Model:
    """Weights of the hash values and the ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. number of thresholds, one row per score."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int, steps: int = 150, rate: float = 0.05,
        penalty: float = 5e-4, least: int = 3) -> Model:
    """Full-batch Adam on the cumulative-link likelihood, all grades weighing alike in square root.

    Hash values seen in fewer than ``least`` rows keep the weight 0.
    """
    size = 1 << BITS
    weights = np.zeros(size)
    if not len(rows):
        return Model(weights, -np.arange(top, 0, -1, dtype=float) - 1)
    flat, size_of = np.concatenate(rows), np.array([len(r) for r in rows])
    names = np.flatnonzero(np.bincount(flat, minlength=size) >= least)
    place = np.full(size, len(names), dtype=np.int32)  # values seen too seldom share a last weight, which stays 0
    place[names] = np.arange(len(names), dtype=np.int32)
    flat, starts = place[flat], np.concatenate([[0], np.cumsum(size_of)])
    parts = [(i, min(i + PART, len(rows))) for i in range(0, len(rows), PART)]
    w, base, gaps = np.zeros(len(names) + 1), 0.0, np.zeros(max(0, top - 1))

    def scored() -> np.ndarray:
        return np.concatenate([np.add.reduceat(w[flat[starts[i]:starts[j]]], starts[i:j] - starts[i]) for i, j in parts])

    def by_weight(by_score: np.ndarray) -> np.ndarray:
        return sum(np.bincount(flat[starts[i]:starts[j]], weights=np.repeat(by_score[i:j], size_of[i:j]), minlength=len(w)) for i, j in parts)

    share = np.bincount(grades, minlength=top + 1)
    balance = (1.0 / np.sqrt(np.maximum(share, 1)))[grades]
    balance = balance / balance.sum()
    moments = [np.zeros(len(w) + top), np.zeros(len(w) + top)]
    for step in range(1, steps + 1):
        score = scored()
        cuts = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        below = 1.0 / (1.0 + np.exp(np.clip(score[:, None] - cuts[None, :], -60, 60)))
        edge = np.concatenate([np.zeros((len(rows), 1)), below, np.ones((len(rows), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(rows), 1)), below * (1 - below), np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        chance = np.maximum(edge[at, grades + 1] - edge[at, grades], 1e-12)
        up, down = balance * slope[at, grades + 1] / chance, balance * slope[at, grades] / chance
        by_score = up - down  # derivative of the loss by the score
        by_cut = np.array([(down[grades == k + 1]).sum() - (up[grades == k]).sum() for k in range(top)])
        gradient = np.concatenate([by_weight(by_score) + penalty * w,
                                   [by_cut.sum()], [by_cut[k + 1:].sum() * np.exp(gaps[k]) for k in range(top - 1)]])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient ** 2
        move = rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)
        w, base, gaps = w - move[:len(w)], base - move[len(w)], gaps - move[len(w) + 1:]
        w[-1] = 0.0
    weights[names] = w[:-1]
    return Model(weights, base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def graded(labels: DataFrame, id_: str = "doc_id") -> DataFrame:
    """Grades from two yes/no ratings: 0 toxic, 1 of low quality, 2 good."""
    grade = (F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
             .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2))
    return labels.select(F.col(id_), grade.cast("int").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, id_: str = "doc_id", text: str = "text", top: int = 2,
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rated documents; ``ratings`` holds (id, grade)."""
    chosen = (ratings.where(F.col(id_).isNotNull() & F.col("grade").isNotNull())
              .groupBy(F.col(id_).alias("_op10_id")).agg(F.min("grade").alias("grade"))
              .orderBy(F.xxhash64("_op10_id"), "_op10_id").limit(sample))

    def kernel(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), batch.column("grade").cast(pa.int32()), batch.column("id")], names=["f", "grade", "id"])

    kind = dict(docs.dtypes)[id_]
    rated = (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
             .join(F.broadcast(chosen), F.col("id") == F.col("_op10_id")).select("id", "text", "grade"))
    got = rated.mapInArrow(kernel, f"f binary, grade int, id {kind}").orderBy("id", "f").limit(sample).toArrow()
    rows = [np.frombuffer(b, dtype=np.int32) for b in got.column("f").to_pylist()]
    return fit(rows, got.column("grade").to_numpy().astype(np.int64), top)


def _scorer(weights: np.ndarray):
    """Scores of a list of texts; words met before are looked up."""
    known: dict[str, float] = {}

    def scores(texts: list[str | None]) -> np.ndarray:
        out = []
        for t in texts:
            t = t or ""
            words = t.lower().split()
            distinct = set(words)
            total = 0.0
            for w in distinct:
                v = known.get(w)
                if v is None:
                    v = known[w] = float(weights[bucket(w)])
                total += v
            out.append(total + sum(float(weights[zlib.crc32(s.encode()) & ((1 << BITS) - 1)])
                                   for s in shapes(t, words, len(distinct))))
            if len(known) > CACHE:
                known.clear()
        return np.array(out, dtype=float)

    return scores


def score(docs: DataFrame, model: Model, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, expected_grade, at_least array<double>): one row per row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # plain arrays

    def kernel(batches):
        model = Model(*shipped.value)
        scores = _scorer(model.weights)
        for batch in batches:
            tails = model.tails(scores(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                names=["id", "expected_grade", "at_least"])

    kind = docs.schema[id_].dataType.simpleString()
    return (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
            .mapInArrow(kernel, f"id {kind}, expected_grade double, at_least array<double>").withColumnRenamed("id", id_))


def accepted(at_least: Column | str = "at_least") -> Column:
    """Selection by tail probability: probably of the top grade."""
    return F.element_at(at_least, -1) >= 0.5


def select(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns as they are."""
    at = docs.columns.index(text)
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # plain arrays

    def kernel(batches):
        model = Model(*shipped.value)
        scores = _scorer(model.weights)
        for batch in batches:
            yield batch.filter(pa.array(model.tails(scores(batch.column(at).to_pylist()))[:, -1] >= 0.5))

    return docs.mapInArrow(kernel, docs.schema)
