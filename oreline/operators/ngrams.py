"""Most frequent word n-grams of a corpus, n = 1..N.

Sentences are cut into words in built-in functions.  A kernel numbers the words
of a batch, so that n-grams are runs of small numbers: a rolling hash of the
words' hashes gives the bucket of every n-gram of every order at once, and a
task only returns its bucket counts, one array per order.  Strings are made
only of the different n-grams in buckets that can still hold a result.

Totals over all n-grams need no strings: an n-gram is named by 96 bits of hash (a
chance of 4e-11 that any two of 5e9 different ones meet), and tasks shuffle sorted
tables of names and counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions import text as tx
from oreline.functions.arrow import lists
from oreline.operators.topk import top_per_group
from oreline.session import cut_lineage

# Hash buckets per n-gram order, and how many of them are counted exactly first.
# More buckets separate light n-grams better: the mean load (words / buckets)
# should stay below the count of the k-th n-gram.  Fewer only cost time.
BUCKETS = 1 << 20
FIRST_BUCKETS = 100
# Counts travel in blocks of so many buckets.
BLOCK = 1 << 14
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Names of n-grams: keys of the words' two hashes, the words whose n-grams a task
# merges at a time, and the characters of the corpus per part of the names.
_KEYS = ("oreline n-grams1", "oreline n-grams2")
TABLE_WORDS = 1 << 20
PART_CHARS = 8 << 20


def sentence_rows(corpus: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence of each paragraph."""
    return corpus.select(F.explode(tx.sentences(F.col(text))).alias("sentence"))


def ngram_rows(corpus: DataFrame, text: str = "text", max_n: int = 5) -> DataFrame:
    """One row ``(n, ngram)`` per occurrence; n-grams never cross a sentence."""
    windows = (sentence_rows(corpus, text)
               .select(tx.words(F.col("sentence")).alias("w"))
               .select(F.inline(tx.word_windows(F.col("w"), max_n))))
    grams = F.array(*[F.struct(F.lit(n).alias("n"), tx.window_gram(n).alias("ngram"))
                      for n in range(1, max_n + 1)])
    return windows.select(F.inline(grams)).where(F.col("ngram").isNotNull())


def ngram_counts(corpus: DataFrame, text: str = "text", max_n: int = 5) -> DataFrame:
    """``(n, ngram, cnt)`` of all n-grams; counted map-side before the shuffle."""
    return (ngram_rows(corpus, text, max_n)
            .groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("cnt")))


def gram_tables(corpus: DataFrame, text: str = "text", max_n: int = 5, bits: int = 4) -> DataFrame:
    """``(n, part, high, low, cnt)``: the different n-grams of about a million words, by the first ``bits`` bits of their name.

    An n-gram's name is a hash of 96 bits, ``high`` and ``low``; the columns hold one number per n-gram.
    """
    def merged(words: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        left, *own = (np.concatenate(c) for c in zip(*words))
        name = own
        for n in range(1, max_n + 1):
            if n > 1:
                name = [_mixed(h[:-1] * _MULTIPLIER + w[n - 1:]) for h, w in zip(name, own)]
            at = np.flatnonzero(left[:len(name[0])] >= n)
            if not len(at):
                return
            high, low, cnt = _summed(name[0][at], name[1][at].astype(np.uint32), np.ones(len(at), np.uint32))
            ends = np.searchsorted(high, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            ends = np.concatenate([[0], ends, [len(high)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(1 << bits, n, np.int32)), pa.array(np.arange(1 << bits, dtype=np.int32)), *[_blobs(c, ends) for c in (high, low, cnt)]],
                names=["n", "part", "high", "low", "cnt"]).filter(pa.array(np.diff(ends) > 0))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, size = [], 0
        for batch in batches:
            part = _Batch(batch.column(0), max_n, 1)
            if not len(part.codes):
                continue
            words.append((part.left, *[hash_array(part.words, hash_key=key, categorize=False)[part.codes] for key in _KEYS]))
            size += len(part.codes)
            if size >= TABLE_WORDS:
                yield from merged(words)
                words, size = [], 0
        if words:
            yield from merged(words)

    return _sentence_words(corpus, text).mapInArrow(kernel, "n int, part int, high binary, low binary, cnt binary")


def order_totals(corpus: DataFrame, text: str = "text", max_n: int = 5, part_chars: int = PART_CHARS) -> DataFrame:
    """``(n, occurrences, different, top_count)`` over every n-gram of each order.

    Tasks merge equal n-grams before they are shuffled by (order, part of the names); a
    group holds all n-grams of its part.  The number of parts follows the size of the
    corpus, so that a group does not.
    """
    chars = corpus.agg(F.sum(F.length(text))).first()[0] or 0
    tables = gram_tables(corpus, text, max_n, min(16, max(4, int(chars // part_chars).bit_length())))

    def kernel(table: pa.Table) -> pa.Table:
        high, low, cnt = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in table.column(c)])
                          for c, kind in (("high", np.uint64), ("low", np.uint32), ("cnt", np.uint32)))
        cnt = _summed(high, low, cnt.astype(np.int64))[2]
        return pa.table({"n": table.column("n").slice(0, 1), "occurrences": [int(cnt.sum())], "different": [len(cnt)], "top_count": [int(cnt.max())]})

    return (tables.groupBy("n", "part").applyInArrow(kernel, "n int, occurrences bigint, different bigint, top_count bigint")
            .groupBy("n").agg(F.sum("occurrences").alias("occurrences"), F.sum("different").alias("different"), F.max("top_count").alias("top_count")))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULTIPLIER
    return h ^ (h >> np.uint64(32))


def _summed(high: np.ndarray, low: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different names in order, and the sums of their counts."""
    order = np.argsort(high)
    same = np.diff(high[order]) == 0
    if (same & (np.diff(low[order]) != 0)).any():     # names that agree in ``high`` alone must be parted
        order = np.lexsort((low, high))
        same = np.diff(high[order]) == 0
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], ~(same & (np.diff(low) == 0))]))
    return high[first], low[first], np.add.reduceat(cnt[order], first, dtype=cnt.dtype)


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary per slice of ``values``."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _top(counts: DataFrame, k: int) -> DataFrame:
    return top_per_group(counts, ["n"], [F.desc("cnt"), F.asc("ngram")], k)


def top_ngrams_direct(corpus: DataFrame, text: str = "text", max_n: int = 5,
                      k: int = 5) -> DataFrame:
    """Top-k by counting every n-gram.  Long n-grams hardly repeat inside a task,
    so the shuffle is many times the corpus; meant for small corpora and tests."""
    return _top(ngram_counts(corpus, text, max_n), k)


class _Batch:
    """The words of a batch of sentences as numbers, and the buckets of its n-grams."""

    def __init__(self, sentences: pa.ListArray, max_n: int, buckets: int):
        flat = sentences.flatten()
        coded = flat.dictionary_encode()
        self.words = coded.dictionary.to_numpy(zero_copy_only=False)
        self.codes = coded.indices.to_numpy().astype(np.int64)
        sizes = np.diff(sentences.offsets.to_numpy())
        ends = np.repeat(np.cumsum(sizes), sizes)
        self.left = ends - np.arange(len(self.codes))      # words to the end of the sentence
        self.hashes = hash_array(self.words, categorize=False)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        self.max_n, self.buckets = max_n, np.uint64(buckets)

    def orders(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Order, the places where its n-grams start, and their buckets."""
        rolling = self.hashes
        for n in range(1, self.max_n + 1):
            if n > 1:
                rolling = rolling[:-1] * _MULTIPLIER + self.hashes[n - 1:]
            mixed = rolling ^ (rolling >> np.uint64(29))
            at = np.flatnonzero(self.left[:len(rolling)] >= n)
            yield n, at, (mixed[at] * _MULTIPLIER >> np.uint64(16)) % self.buckets

    def counted(self, n: int, at: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The different n-grams that start at ``at`` and their counts."""
        key, wide = self.codes[at], max(1, len(self.words))
        for k in range(1, n):
            # numbers stay below (places x words), so none is met twice
            key = np.unique(key * wide + self.codes[at + k], return_inverse=True)[1]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        parts = [self.words[self.codes[at[first] + k]] for k in range(n)]
        return [" ".join(p) for p in zip(*parts)], count


def _sentence_words(corpus: DataFrame, text: str) -> DataFrame:
    return sentence_rows(corpus, text).select(tx.words(F.col("sentence")).alias("w"))


def bucket_loads(corpus: DataFrame, text: str = "text", max_n: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """``(n, block, load)``: counts of the n-grams' hash buckets, in blocks; at most a task's arrays are shuffled."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((max_n, buckets), np.int64)
        for batch in batches:
            for n, _, b in _Batch(batch.column(0), max_n, buckets).orders():
                total[n - 1] += np.bincount(b.astype(np.int64), minlength=buckets)
        for n in range(max_n):
            for block in range(-(-buckets // BLOCK)):
                part = total[n, block * BLOCK:(block + 1) * BLOCK]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n + 1], pa.int32()), pa.array([block], pa.int32()), lists(part[None, :].astype(float))], ["n", "block", "load"])

    partial = _sentence_words(corpus, text).mapInArrow(kernel, "n int, block int, load array<double>")
    return (partial.groupBy("n", "block").agg(Summarizer.sum(array_to_vector(F.col("load"))).alias("v"))
            .select("n", "block", vector_to_array("v").alias("load")))


def heaviest(loads: DataFrame, many: int) -> DataFrame:
    """``(n, b, load, at)``: the buckets of largest count per order."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, block, load in zip(*(c.to_pylist() for c in batch.columns)):
                order = np.argsort(-np.array(load), kind="stable")[:many]
                used = order[np.array(load)[order] > 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), n, np.int32)), pa.array(used + block * BLOCK), pa.array(np.array(load)[used].astype(np.int64))], ["n", "b", "load"])

    return top_per_group(loads.mapInArrow(kernel, "n int, b bigint, load bigint"), ["n"], [F.desc("load"), F.asc("b")], many, "at")


def _marked(loads: DataFrame, floors: dict[int, int], buckets: int) -> dict[int, np.ndarray]:
    """Per order, which buckets hold at least its floor: one bit a bucket."""
    floor = F.create_map(*[F.lit(v) for kv in floors.items() for v in kv])
    wanted = loads.where(F.col("n").isin(list(floors))).withColumn("floor", F.try_element_at(floor, F.col("n")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.array(load) >= least).tobytes() for load, least in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["n", "block", "bits"])

    out = {n: np.full(buckets, least <= 0) for n, least in floors.items()}
    for row in wanted.mapInArrow(kernel, "n int, block int, bits binary").collect():      # one bit per order and bucket
        at = row["block"] * BLOCK
        size = min(BLOCK, buckets - at)
        out[row["n"]][at:at + size] = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:size].astype(bool)
    return out


def _exact(corpus: DataFrame, text: str, max_n: int, buckets: int, own: dict[int, np.ndarray],
           below: dict[int, np.ndarray] | None = None) -> DataFrame:
    """``(n, ngram, cnt)`` of the n-grams in the buckets marked in ``own``.

    With ``below``, both shorter n-grams at the ends of an n-gram must be in a bucket marked there.
    """
    shipped = corpus.sparkSession.sparkContext.broadcast(
        ({n: np.packbits(m) for n, m in own.items()}, {n: np.packbits(m) for n, m in (below or {}).items()}))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, lower = [{n: np.unpackbits(m)[:buckets].astype(bool) for n, m in side.items()} for side in shipped.value]
        for batch in batches:
            part, places = _Batch(batch.column(0), max_n, buckets), None
            for n, at, b in part.orders():
                hit = marks[n][b] if n in marks else np.zeros(len(at), bool)
                if n in lower and places is not None:
                    fine = np.zeros(len(part.codes) + 1, bool)
                    fine[places[0]] = lower[n][places[1]]
                    hit &= fine[at] & fine[at + 1]
                places = at, b
                if hit.any():
                    grams, count = part.counted(n, at[hit])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), n, np.int32)), pa.array(grams, pa.string()), pa.array(count.astype(np.int64))],
                                                     ["n", "ngram", "cnt"])

    found = _sentence_words(corpus, text).mapInArrow(kernel, "n int, ngram string, cnt bigint")
    return found.groupBy("n", "ngram").agg(F.sum("cnt").alias("cnt"))


def top_ngrams(corpus: DataFrame, text: str = "text", max_n: int = 5, k: int = 5,
               buckets: int = BUCKETS, first: int = FIRST_BUCKETS) -> DataFrame:
    """The ``k`` most frequent n-grams of each order, ties by n-gram.  Exact.

    A bucket's count bounds the count of each n-gram in it, so once the n-grams
    of the heaviest buckets are counted exactly, every bucket lighter than the
    k-th of them is out.  If a heavy bucket was left over, the n-grams of all
    buckets that can still matter are counted, unless the counts of the order
    below already rule them out.
    """
    loads = cut_lineage(bucket_loads(corpus, text, max_n, buckets))
    heavy = heaviest(loads, first + 1).collect()               # max_n * (first + 1) rows
    chosen = {n: np.zeros(buckets, bool) for n in range(1, max_n + 1)}
    for r in heavy:
        if r["at"] <= first:
            chosen[r["n"]][r["b"]] = True
    found = cut_lineage(_top(_exact(corpus, text, max_n, buckets, chosen), k))
    floor = {r["n"]: r["cnt"] for r in found.where(F.col("rank") == k).collect()}
    open_orders = {r["n"]: floor.get(r["n"], 0) for r in heavy
                   if r["at"] > first and r["load"] >= floor.get(r["n"], 0)}
    if not open_orders:
        return found
    own = _marked(loads, open_orders, buckets)
    below = {n + 1: m for n, m in _marked(loads, {n - 1: c for n, c in open_orders.items() if n > 1}, buckets).items()} if max(open_orders) > 1 else {}
    rest = cut_lineage(_top(_exact(corpus, text, max_n, buckets, own, below), k))
    return found.where(~F.col("n").isin(list(open_orders))).unionByName(rest)
