"""Embedding near-duplicates: sign hashing in several tables, exact cosines, components.

Vectors that are equal with equal labels form a class.  Class vectors are
hashed by the signs of random hyperplanes into buckets, one per table.  Only
(table, mark, number) is shuffled to find the buckets that two classes or more
share; of buckets that hold the same classes in several tables the first is
kept.  A vector then travels once for each bucket in which it has company.
Within a bucket cosines are exact, in double precision.  A pair counts in the
first table in which it meets, so links are counted without writing pairs out:
a task emits the number of links per vector and a spanning set of edges.  Large
buckets are cut into blocks that meet in pairs; tasks read sorted buckets as a
stream and hold one batch and one pair of blocks.

The number of bits follows the number of classes, so that buckets stay small;
the number of tables follows from the bits and the recall asked for at the
threshold.

Defined results: vectors that are null, zero, or hold null or non-finite
numbers, and vectors with a null label, link with nothing: no links, their own
component.  Repeated rows link with each other.  A null id never is a
component's name unless all its members lack one.  Vectors of different lengths
never link.  An empty table gives an empty result.  Only the named columns are
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.arrow import lists
from oreline.llm.components import components
from oreline.session import scratch_path

THRESHOLD = 0.98
RECALL = 0.9999
BUCKETS = 4
BLOCK = 2048
SEED = 20


def shape_of(classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits and tables: about BUCKETS buckets per class if directions were even, so that strangers seldom meet."""
    bits = max(8, min(48, math.ceil(math.log2(max(2, classes) * BUCKETS))))
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def planes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def buckets(rows: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """n x tables bucket numbers of unit vectors."""
    sign = (rows @ planes(rows.shape[1], bits, tables) > 0).reshape(len(rows), tables, bits)
    return (sign * (np.int64(1) << np.arange(bits, dtype=np.int64))).sum(axis=2)


def unit_rows(column, size: int) -> np.ndarray:
    """A list column of vectors of ``size`` numbers as rows of length 1."""
    m = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def spanning(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joins the trees of ``parent`` (each node names its root) along pairs; the places of the pairs that joined two."""
    used, at = [], np.arange(len(i))
    while True:
        p, q = parent[i[at]], parent[j[at]]
        at, p, q = at[p != q], p[p != q], q[p != q]
        if not len(at):
            return np.concatenate(used) if used else at
        high, first = np.unique(np.maximum(p, q), return_index=True)
        parent[high] = np.minimum(p, q)[first]
        used.append(at[first])
        while not np.array_equal(parent[parent], parent):
            parent[:] = parent[parent]


#: Buckets up to this size are multiplied together, CELLS numbers at a time; PAIRS pairs compare marks at a time.
SMALL, CELLS, PAIRS = 64, 1 << 21, 1 << 16


def close_pairs(unit: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, same: np.ndarray, threshold: float, rows: int = 256):
    """Blocks (i, j) of the pairs at or above ``threshold`` inside buckets ``starts``..``ends``.

    A bucket that is a pair of blocks (``same`` is false) gives the pairs between its ``first`` rows and the others.
    """
    sizes = ends - starts
    for size in np.unique(sizes[same & (sizes <= SMALL)]):
        chosen, step = starts[same & (sizes == size)], max(1, CELLS // (size * max(size, unit.shape[1])))
        for at in range(0, len(chosen), step):
            places = chosen[at:at + step, None] + np.arange(size)
            held = unit[places]
            g, i, j = np.nonzero(np.triu(held @ held.transpose(0, 2, 1) >= threshold, 1))
            yield places[g, i], places[g, j]
    for s, e, one in zip(starts, ends, same):
        if one and e - s <= SMALL:
            continue
        left = right = np.arange(s, e)
        if not one:
            left, right = left[first[s:e]], right[~first[s:e]]
        for at in range(0, len(left), rows):
            near = unit[left[at:at + rows]] @ unit[right].T >= threshold
            if one:
                near &= right[None, :] > left[at:at + rows, None]
            i, j = np.nonzero(near)
            yield left[at + i], right[j]


def near_duplicates(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id, kept): one row per row of ``vectors``."""
    spark = vectors.sparkSession
    v = F.col("v")
    whole = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_).alias("id"), F.col(vector).cast(whole).alias("v"), F.col(label).alias("label"))
    usable = (v.isNotNull() & F.col("label").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists("v", lambda x: x != 0))
    keyed = rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), F.unhex(F.sha2(F.concat_ws(
        ",", F.col("label").cast("string"), F.array_join(F.transform("v", lambda x: (x.cast("double") + F.lit(0.0)).cast("string")), " ")), 256))))
    base = scratch_path(spark, "near")
    (keyed.where("key is not null").groupBy("key")
     .agg(F.first("v").alias("v"), F.first("label").alias("label"), F.count(F.lit(1)).alias("members"), F.min("id").alias("least"))
     .withColumn("num", F.monotonically_increasing_id()).write.parquet(f"{base}/classes"))
    classes = spark.read.parquet(f"{base}/classes")
    bits, tables = shape_of(classes.count(), threshold, recall)

    def hashed(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False).astype(np.int64)
            for size in np.unique(sizes):
                part = pa.Table.from_batches([batch]).filter(pa.array(sizes == size))
                marks = lists(buckets(unit_rows(part["v"], size), bits, tables))
                part = part.append_column("size", pa.array(np.full(len(marks), size))).append_column("marks", marks)
                yield from part.to_batches()

    kind = classes.schema["label"].dataType.simpleString()
    (classes.select("num", "label", "members", "v")
     .mapInArrow(hashed, f"num long, label {kind}, members long, v {whole}, size long, marks array<long>").write.parquet(f"{base}/hashed"))
    known = spark.read.parquet(f"{base}/hashed")
    cell = ["t", "mark", "size", "label"]
    spread = known.select("num", "size", "label", F.posexplode("marks").alias("t", "mark"))
    shared = spread.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("n"), F.min("num").alias("low"), F.max("num").alias("high"),
        F.bit_xor(F.xxhash64("num")).alias("x"), F.bit_xor(F.xxhash64("num", F.lit(1))).alias("y")).where("n > 1")
    shared = (shared.groupBy("n", "low", "high", "x", "y", "size", "label").agg(F.min(F.struct("t", "mark")).alias("at"))
              .select("at.t", "at.mark", "size", "label", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")))
    pairs = (spread.join(shared, cell).withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select(*cell, "num", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     (F.col("block") <= F.col("other")).alias("first")))
    group = [*cell, "low", "high"]
    met = pairs.join(known.select("num", "members", "v", "marks"), "num").repartition(*group).sortWithinPartitions(*group)

    def begins(part):
        new = np.ones(len(part), dtype=bool)
        new[1:] = False
        for c in group:
            column = part[c].combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def found(part, size):
        starts = begins(part)
        unit, nums = unit_rows(part["v"], size), part["num"].to_numpy()
        marks = part["marks"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)
        table, members, same = part["t"].to_numpy(), part["members"].to_numpy(), part["low"].to_numpy() == part["high"].to_numpy()
        names, node = np.unique(nums, return_inverse=True)
        parent, weight, edges = np.arange(len(names)), np.zeros(len(names), dtype=np.int64), []
        first = part["first"].combine_chunks().to_numpy(zero_copy_only=False)
        for left, right in close_pairs(unit, first, starts, np.append(starts[1:], len(part)), same[starts], threshold):
            for at in range(0, len(left), PAIRS):
                i, j = left[at:at + PAIRS], right[at:at + PAIRS]
                new = ~((marks[i] == marks[j]) & (np.arange(tables) < table[i, None])).any(axis=1)
                i, j = i[new], j[new]
                np.add.at(weight, node[i], members[j])
                np.add.at(weight, node[j], members[i])
                used = spanning(parent, node[i], node[j])
                edges.append(np.stack([nums[i[used]], nums[j[used]]]))
        counted = np.flatnonzero(weight)
        ends = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(names[counted], ends[0])), pa.array([*[None] * len(counted), *ends[1].tolist()], pa.int64()),
             pa.array(np.append(weight[counted], np.zeros(ends.shape[1], dtype=np.int64)))], names=["num", "other", "links"])

    def settled(part):
        sizes = part["size"].to_numpy()
        for size in np.unique(sizes):
            yield found(part.filter(pa.array(sizes == size)), size)

    def linked(batches):
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if rest is None else pa.concat_tables([rest, part])
            if len(part):
                last = begins(part)[-1]  # the last bucket may go on in the next batch
                yield from settled(part.slice(0, last))
                rest = part.slice(last)
        if rest is not None:
            yield from settled(rest)

    met.mapInArrow(linked, "num long, other long, links long").write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    joined = components(links.where("other is not null").select(F.col("num").alias("a"), F.col("other").alias("b")))
    degree = links.where("other is null").groupBy("num").agg(F.sum("links").alias("links"))
    named = (classes.select("key", "num", "members", "least").join(joined, F.col("num") == F.col("node"), "left")
             .withColumn("component", F.coalesce("component", "num")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    told = (named.join(smallest, "component").join(degree, "num", "left")
            .select("key", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    out = keyed.select("id", "key").join(told, "key", "left").select(
        F.col("id").alias(id_), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_).eqNullSafe(F.col("component_id")))
