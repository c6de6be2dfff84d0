"""Packing by cutting-stock column generation.

1. Documents are tokenised in their tasks and cut into pieces of the sequence
   length; what is left over is a half sequence and a shorter piece.  A piece
   carries only its numbers and a checksum, and the pieces are written once.
2. The histogram of piece lengths (one row per class of lengths) goes to the
   driver.  A linear program over patterns, whose columns are priced by a
   knapsack recursion, says how often each pattern is used; the counts are
   rounded down and what remains is packed by best fit into further patterns.
3. Pieces of each class are ranked by part, id and start without gathering a
   class in one task: counts per (class, part) give each part its first rank.
   The rank decides sequence and slot by looking up a plan whose size depends
   on the sequence length alone; the slots before give the offset.

Defined results: a null text is the empty text (its only id is the end id);
rows with null or repeated ids are packed row by row like any others; an empty
table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.session import scratch_path

LENGTH = 1024
#: Classes of the length histogram are this wide; a piece counts as the upper end of its class.
UNIT = 4
END = 0
#: Pieces ranked together in one task.
PART_ROWS = 4_000
SPECIAL = "<|endoftext|>"
#: Fixed value: how the vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---- tokenising ------------------------------------------------------------

def _encoder(vocabulary: str, ranks: str | None):
    """Texts to ids as little-endian unsigned 32-bit bytes.

    With ``ranks`` (the same vocabulary as byte strings in order of merging)
    texts of Latin-1 characters, whose classes no two Unicode versions put
    differently, are encoded by the faster library; the ids are the same.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer, quick = Tokenizer.from_file(vocabulary), None
    if ranks:
        import base64

        import tiktoken
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(text: str) -> bytes:
        plain = quick is not None and SPECIAL not in text
        if plain and not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                plain = False
        ids = quick.encode_ordinary(text) if plain else tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    return encode


def cuts(total: int, length: int) -> list[tuple[int, int]]:
    """Whole sequences, then a half one if more than half is left, then the rest.

    Pieces of at most half a sequence leave the patterns room to fill.
    """
    edges = list(range(0, total, length))
    if total - edges[-1] > length // 2 and total - edges[-1] < length:
        edges.append(edges[-1] + length // 2)
    return list(zip(edges, [*edges[1:], total]))


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, id_: str = "doc_id", text: str = "text",
           length: int = LENGTH, end: int = END, rows: int = 256) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): the cuts of every document."""
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        encode = _encoder(vocabulary, ranks)
        last = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = [encode(t or "") + last for t in part.column(1).to_pylist()]
                owner, start, size, crc, total = [], [], [], [], []
                for i, b in enumerate(ids):
                    view = memoryview(b)
                    for s, e in cuts(len(b) // 4, length):
                        cut = view[4 * s:4 * e]
                        owner.append(i)
                        start.append(s)
                        size.append(e - s)
                        crc.append(zlib.crc32(cut))
                        total.append(len(b) // 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, size, crc, total)]],
                    names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    return (docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
            .mapInArrow(kernel, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"))


# ---- the plan --------------------------------------------------------------

def units(size, unit: int = UNIT):
    """Length class: the length in units, rounded up."""
    return -(-size // unit)


def price(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack recursion: the best value of a pattern of each total, and the last class in it.

    ``values[c]`` is the value of a piece of c units (index 0 unused).
    """
    capacity = len(values) - 1
    best, last = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, dtype=np.int64)
    best[0] = 0.0
    for t in range(1, capacity + 1):
        options = best[t - 1::-1][:t] + values[1:t + 1]
        k = int(options.argmax())
        best[t], last[t] = options[k], k + 1
    return best, last


def solve(demand: np.ndarray, tolerance: float = 1e-4) -> tuple[list[np.ndarray], np.ndarray]:
    """Linear program by column generation: patterns and how often each is used.

    ``demand[c]`` is the number of pieces of c units; its last index is the
    capacity.  Starts with one pattern per class; each round the knapsack
    prices the best pattern, which enters the basis.  Ends when no pattern can
    save more than ``tolerance`` of the sequences (Farley's bound).
    """
    capacity, sizes = len(demand) - 1, np.flatnonzero(demand)
    m = len(sizes)
    if not m:
        return [], np.zeros(0)
    row = {int(s): i for i, s in enumerate(sizes)}
    repeat = capacity // sizes
    inverse, columns, level = np.diag(1.0 / repeat), list(np.diag(repeat)), demand[sizes] / repeat
    while True:
        dual = inverse.sum(axis=0)  # every sequence costs 1
        values = np.full(capacity + 1, -np.inf)
        values[sizes] = dual
        best, last = price(values)
        t = int(best[1:].argmax()) + 1
        if best[t] <= 1 + tolerance:
            break
        column = np.zeros(m, dtype=np.int64)
        while t:
            column[row[int(last[t])]] += 1
            t -= int(last[t])
        enter = inverse @ column
        usable = enter > 1e-9
        steps = np.where(usable, level / np.where(usable, enter, 1.0), np.inf)
        out = int(steps.argmin())
        step = float(steps[out])
        level = np.maximum(level - step * enter, 0.0)
        level[out] = step
        pivot = inverse[out] / enter[out]
        inverse -= np.outer(enter, pivot)
        inverse[out] = pivot
        columns[out] = column
    return [np.repeat(sizes, c) for c in columns], level


@dataclass(frozen=True)
class Plan:
    """Blocks of ranks, sorted by (class, first rank).

    A block starts at ``rank`` of its class and fills consecutive sequences
    from ``sequence`` with ``each`` pieces, in the slots from ``slot``.
    """

    size: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    slot: np.ndarray
    sequences: int


def plan(demand: np.ndarray) -> Plan:
    """Patterns rounded down, the rest by best fit; ``demand`` counts pieces by class."""
    capacity = len(demand) - 1
    blocks, used, first = [], np.zeros(capacity + 1, dtype=np.int64), 0

    def take(pattern, times: int) -> None:
        nonlocal first
        slot = 0
        for size, each in zip(*np.unique(pattern, return_counts=True)):
            blocks.append((size, used[size], first, each, slot))
            used[size] += each * times
            slot += each
        first += times

    if demand[capacity]:
        take([capacity], int(demand[capacity]))
    left = demand.copy()
    left[capacity] = 0
    patterns, level = solve(left)
    for i in sorted(range(len(patterns)), key=lambda i: tuple(patterns[i])):
        need = np.bincount(patterns[i], minlength=capacity + 1)
        has = need > 0
        times = min(int(level[i] + 1e-9), int((left[has] // need[has]).min()))
        if times > 0:
            take(patterns[i], times)
            left -= need * times
    rest: list[list[int]] = []
    room: list[int] = []
    for size in np.repeat(np.arange(capacity, -1, -1), left[::-1]):
        fits = [b for b, r in enumerate(room) if r >= size]
        b = min(fits, key=room.__getitem__) if fits else len(room)
        if not fits:
            rest.append([])
            room.append(capacity)
        rest[b].append(int(size))
        room[b] -= int(size)
    for pattern in rest:
        take(pattern, 1)
    cells = np.array(sorted(blocks), dtype=np.int64).reshape(-1, 5)
    return Plan(*[cells[:, i].copy() for i in range(5)], first)


# ---- assigning -------------------------------------------------------------

def ranked(cut: DataFrame, n_rows: int) -> DataFrame:
    """``cut`` with the rank (from 0) of each piece within its class.

    Rows are dealt to parts by a hash of the row, so no class is gathered
    whole: a part numbers its own rows and starts where earlier parts end.
    """
    parts = max(1, -(-n_rows // PART_ROWS))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("id", "start", "row"), F.lit(parts)))
    inside = F.row_number().over(Window.partitionBy("size", "part").orderBy("id", "start", "row"))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = dealt.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n"))
    firsts = counts.select("size", "part", F.coalesce(before, F.lit(0)).alias("first"))
    return (dealt.withColumn("inside", inside).join(firsts, ["size", "part"])
            .withColumn("rank", F.col("first") + F.col("inside") - 1).drop("first", "inside", "part", "row"))


def assign(placed: DataFrame, found: Plan) -> DataFrame:
    """Adds sequence_id and offset to ranked pieces: the plan gives sequence and slot, the slots before give the offset."""
    # plain arrays: a broadcast names its classes, which executors could not import
    shipped = placed.sparkSession.sparkContext.broadcast((found.size, found.rank, found.sequence, found.each, found.slot))
    kept = [f.name for f in placed.schema.fields if f.name not in ("rank", "size")]
    kinds = ", ".join(f"{c} {placed.schema[c].dataType.simpleString()}" for c in kept)

    def kernel(batches):
        p = Plan(*shipped.value, 0)
        wide = int(p.rank.max(initial=0)) + 1
        for batch in batches:
            size, rank = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "rank")]
            at = np.searchsorted(p.size * wide + p.rank, size * wide + np.minimum(rank, wide - 1), side="right") - 1
            over = rank - p.rank[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(p.sequence[at] + over // p.each[at]), pa.array(p.slot[at] + over % p.each[at])],
                names=[*kept, "sequence_id", "slot"])

    slots = placed.mapInArrow(kernel, f"{kinds}, sequence_id long, slot long")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return slots.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, id_: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    (pieces(docs, vocabulary, ranks, id_, text, length)
     .withColumns({"row": F.monotonically_increasing_id(), "size": F.ceil(F.col("length") / UNIT)})
     .write.parquet(path))
    cut = spark.read.parquet(path)
    demand = np.zeros(length // UNIT + 1, dtype=np.int64)
    for size, n in cut.groupBy("size").count().collect():  # at most one row per class
        demand[size] = n
    return assign(ranked(cut, int(demand.sum())), plan(demand)).withColumnRenamed("id", id_)
