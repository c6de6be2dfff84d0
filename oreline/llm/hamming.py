"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

1. A text is the set of its 5-word shingles; each of 64 permutations leaves the
   lowest 8 bits of its minimum.  Texts with equal sets form a class.
2. Signatures are compared by the number of different values.  With distance at
   most D = 2 M - 1 and M chunks, some chunk differs in at most floor(D / M) = 1
   value, so a class is filed, for every chunk, under the chunk with each one of its
   values left out.  Every pair within the distance meets in some bucket.
3. Links are confirmed on the full sets of shingles.  First each class meets the
   smallest class it shares a bucket with.  Buckets that then still hold several
   components are searched for pairs within the distance that could join them;
   what these pairs connect is a candidate group, whose texts meet once and are
   compared exactly, pair by pair, by the sizes of their intersections.  Pairs
   are never written out, only edges that join components.  Large buckets and
   groups are cut into blocks, and pairs of blocks are tasks.

D and M follow from the threshold, so that a pair at it lies beyond D with a
probability of at most 1e-4 (binomial, 64 values; at 85 %: D = 21, M = 11, loss
9.5e-5; at 80 %: D = 27, M = 14, loss 1.4e-5).

Spark takes a table that a kernel makes for as many rows as went in, and a written
one for its compressed size, so what it thinks small enough to broadcast may be far
too large for the driver (the filed chunks are 64 rows a class).  Tables that grow
with the classes are therefore always joined by sorting; those with a row per open
group are broadcast if they are counted to be few.

Defined results: a null text or one without words has the empty set and links
with nothing; with fewer than five words the whole sequence is the only
shingle; rows with equal sets link; a null id names a component only if all its
members lack one; an empty table gives an empty result.  Only the named columns
are read.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.components import components
from oreline.session import scratch_path

WORDS = 5
VALUES = 64
#: Largest probability that a pair at the threshold lies beyond the distance.
LOSS = 1e-4
BLOCK = 4096
#: Texts of a candidate group that meet in one task are at most twice as many.
GROUP_BLOCK = 512
CACHE = 200_000
#: So many rows of a table of groups are broadcast.
FEW = 50_000
SEED = 9


def reach(percent: int) -> tuple[int, int]:
    """(distance, chunks) for a threshold: the fewest chunks, one error each, that lose at most LOSS."""
    differ = 1 - percent / 100
    beyond = lambda d: sum(comb(VALUES, k) * differ ** k * (1 - differ) ** (VALUES - k) for k in range(d + 1, VALUES + 1))
    chunks = next(m for m in range(1, VALUES + 1) if beyond(2 * m - 1) <= LOSS)
    return 2 * chunks - 1, chunks


class _Hashes(dict):
    """64-bit hashes of words, looked up when met again."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, known: dict, words: int = WORDS) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes; A-Z count as a-z."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(words, len(found))
    h = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + each[k:len(found) - width + 1 + k])
    return np.unique(h)


def signature(items: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One byte per permutation, from the smallest permuted hash."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), 4096):
        np.minimum(least, (factors[:, None] * items[None, at:at + 4096]).min(axis=1), out=least)
    return (_mixed(least) & np.uint64(255)).astype(np.uint8)


def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2 ** 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, name, n_shingles, digest, sig): ``name`` is the hash of the text, ``digest`` of the set."""
    kind = docs.schema[id_].dataType.simpleString()

    def kernel(batches):
        known, factors = _Hashes(), _factors()
        for batch in batches:
            sets = [shingles(t, known) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([signature(s, factors).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["id", "name", "n_shingles", "digest", "sig"])

    return (docs.select(F.col(id_).alias("id"), _name(text).alias("name"), F.col(text).alias("text"))
            .mapInArrow(kernel, f"id {kind}, name binary, n_shingles long, digest binary, sig binary"))


def _name(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("name")


def filed(classes: DataFrame, chunks: int) -> DataFrame:
    """(key, node): every class under each chunk with each one value left out."""
    def kernel(batches):
        draw = np.random.default_rng(SEED + 1)
        table = draw.integers(0, 2 ** 64, (VALUES, 256), dtype=np.uint64)
        salt = draw.integers(0, 2 ** 64, VALUES, dtype=np.uint64)
        places = np.array_split(np.arange(VALUES), chunks)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
                code = table[np.arange(VALUES)[None, :], sig]
                keys = np.concatenate([_mixed(code[:, c].sum(axis=1, keepdims=True) - code[:, c] + salt[c][None, :]) for c in places], axis=1)
                node = part.column("node").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(node, VALUES))], names=["key", "node"])

    return classes.select("node", "sig").mapInArrow(kernel, "key long, node long")


def _joining(component: np.ndarray, close) -> list[tuple[int, int]]:
    """Edges (places) that join rows of different components along ``close`` pairs.

    ``close(i, rows)`` says which of the rows are near row i.  A search from
    each row in turn looks only at rows not reached yet, so a dense group costs
    about one comparison per row; at most one edge per component is returned.
    """
    left, edges = np.arange(len(component)), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        seen = {component[todo[0]]}
        while todo and len(left):
            i = todo.pop()
            met = close(i, left) | (component[left] == component[i])
            for j in left[met].tolist():
                if component[j] not in seen:
                    seen.add(component[j])
                    edges.append((i, j))
                todo.append(j)
            left = left[~met]
    return edges


def _edge_table(node: np.ndarray, edges: list[tuple[int, int]]) -> pa.Table:
    return pa.table({k: pa.array([int(node[e[i]]) for e in edges], pa.int64()) for i, k in enumerate("xy")})


def _pair_blocks(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` (with ``blocks``) dealt to pairs of blocks (low, high) of their group ``by``."""
    block = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    return block.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        by, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        *[c for c in rows.columns if c not in (by, "blocks")])


def candidates(held: DataFrame, distance: int) -> DataFrame:
    """(x, y): edges between components that classes of one bucket within the distance may join.

    ``held`` has key, node, component, sig, blocks.
    """
    def kernel(_, table):
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
        close = lambda i, rows: (sig[rows] != sig[i]).sum(axis=1) <= distance
        return _edge_table(table.column("node").to_numpy(), _joining(table.column("component").to_numpy(), close))

    return _pair_blocks(held, "key").groupBy("key", "low", "high").applyInArrow(kernel, "x long, y long")


def _similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets are similar enough: sizes of all intersections by products of incidence matrices."""
    n, size = len(sets), np.array([len(s) for s in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = many[column] > 1
    row, column = np.repeat(np.arange(n), size)[shared], (np.cumsum(many > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), dtype=np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        low, high = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((n, 4096), dtype=np.float32)
        part[row[low:high], column[low:high] - at] = 1.0
        common += part @ part.T
    common = common.astype(np.int64)
    return 100 * common >= percent * (size[:, None] + size[None, :] - common)


def links_in_groups(held: DataFrame, percent: int) -> DataFrame:
    """(x, y): confirmed links that join the components of each candidate group, at most one per component and task.

    ``held`` has grp, node, component, text, blocks.
    """
    def kernel(_, table):
        known = _Hashes()
        good = _similar([shingles(t, known) for t in table.column("text").to_pylist()], percent)
        return _edge_table(table.column("node").to_numpy(), _joining(table.column("component").to_numpy(), lambda i, rows: good[i, rows]))

    return _pair_blocks(held, "grp").groupBy("grp", "low", "high").applyInArrow(kernel, "x long, y long")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets are similar enough."""
    texts = texts.hint("merge")
    both = (pairs.join(texts.select(F.col("node").alias("y"), F.col("text").alias("text_y")), "y")
            .join(texts.select(F.col("node").alias("x"), F.col("text").alias("text_x")), "x").select("x", "y", "text_x", "text_y"))

    def kernel(batches):
        known, last, held = _Hashes(), None, None
        for batch in batches:
            good = []
            for x, tx, ty in zip(batch.column("x").to_pylist(), batch.column("text_x").to_pylist(), batch.column("text_y").to_pylist()):
                if x != last:
                    last, held = x, shingles(tx, known)
                other = shingles(ty, known)
                shared = len(np.intersect1d(held, other, assume_unique=True))
                good.append(100 * shared >= percent * (len(held) + len(other) - shared))
            yield batch.select(["x", "y"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(kernel, "x long, y long")


def grouped(docs: DataFrame, id_: str = "doc_id", text: str = "text", percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(id, name, n_shingles, digest) of every row, and (digest, component) of every class.

    ``percent`` is the similarity of linked sets; distance and chunks follow from it.
    """
    distance, chunks = reach(percent)
    spark = docs.sparkSession
    base = scratch_path(spark, "hamming")
    at = lambda name: f"{base}/{name}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(at(name))
        return spark.read.schema(df.schema).parquet(at(name))

    rows = kept(signatures(docs, id_, text), "rows")
    classes = kept(rows.where("n_shingles > 0").groupBy("digest")
                   .agg(F.first("sig").alias("sig"), F.min("name").alias("name"))
                   .withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = filed(classes, chunks)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1")
    members = kept(keys.join(shared.hint("merge"), "key").select("key", "node", "n", "leader"), "members")
    first = members.where("node <> leader").groupBy("node").agg(F.min("leader").alias("x")).select("x", F.col("node").alias("y"))
    sig = classes.select("node", "sig").hint("merge")
    near = (first.join(sig.withColumnRenamed("node", "x").withColumnRenamed("sig", "a"), "x")
            .join(sig.withColumnRenamed("node", "y").withColumnRenamed("sig", "b"), "y"))

    def within(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, VALUES) for c in ("a", "b"))
            yield batch.select(["x", "y"]).filter(pa.array((a != b).sum(axis=1) <= distance))

    first = near.mapInArrow(within, "x long, y long")
    involved = members.select("node").distinct().join(classes.select("node", "name").hint("merge"), "node")
    texts = kept(docs.select(_name(text).alias("name"), F.col(text).alias("text")).join(involved.hint("merge"), "name")
                 .groupBy("node").agg(F.first("text").alias("text")), "texts")
    links = kept(confirmed(kept(first.distinct(), "first"), texts, percent), "links0")

    told = kept(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))), "told")
    named = members.join(told.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    # buckets with the same members are one; those of a single component are done
    mixed = (named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("h1"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"),
                                      (F.min("component") < F.max("component")).alias("open"))
             .where("open").groupBy("n", "h1", "h2").agg(F.min("key").alias("key"), F.first("n").alias("members")))
    held = (named.select("key", "node", "component")
            .join(mixed.select("key", F.ceil(F.col("members") / BLOCK).cast("long").alias("blocks")).hint("merge"), "key").join(sig, "node"))
    maybe = kept(candidates(held, distance).distinct(), "maybe")
    # a candidate group holds whole components; its texts meet once, in blocks
    whole = told.select(F.col("component").alias("a"), F.col("node").alias("b"))
    joined = kept(components(maybe.select(F.col("x").alias("a"), F.col("y").alias("b")).unionAll(whole)), "joined")
    ends = maybe.select(F.col("x").alias("node")).unionAll(maybe.select(F.col("y").alias("node"))).distinct()
    open_ = kept(joined.join(ends.hint("merge"), "node", "left_semi").select("component").distinct(), "open")
    to_all = F.broadcast if open_.count() <= FEW else lambda table: table.hint("merge")  # a group may be large, so few groups are not dealt by group
    inside = joined.join(to_all(open_), "component", "left_semi").select(F.col("component").alias("grp"), "node")
    blocks = inside.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("long").alias("blocks"))
    met = (inside.join(to_all(blocks), "grp").join(told.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
           .join(texts.hint("merge"), "node").select("grp", "node", "component", "text", "blocks"))
    links = links.unionAll(kept(links_in_groups(met, percent), "links1"))

    told = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    named = classes.select("digest", "node").join(told.hint("merge"), "node", "left")
    return rows, kept(named.select("digest", F.coalesce("component", "node").alias("component")), "components")


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``."""
    rows, classes = grouped(docs, id_, text, percent)
    least = (rows.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("least")).join(classes, "digest")
             .groupBy("component").agg(F.min("least").alias("component_id")))
    out = (rows.join(classes.join(least, "component").select("digest", "component_id"), "digest", "left")
           .select(F.col("id").alias(id_), "n_shingles",
                   F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
    return out.withColumn("kept", F.col(id_).eqNullSafe(F.col("component_id")))


def survivors(docs: DataFrame, id_: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One document of each group, with all columns: the one of the smallest id, null last, then text hash.

    Rows with equal id and text are one document.  Texts without words all stay.
    """
    rows, classes = grouped(docs, id_, text, percent)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "name")
    chosen = (rows.where("n_shingles > 0").groupBy("digest").agg(F.min(order).alias("first")).join(classes.hint("merge"), "digest")
              .groupBy("component").agg(F.min("first").alias("first"))
              .select(F.col("first.name").alias("_op9_name"), F.col("first.id").alias("_op9_id")))
    empty = rows.where("n_shingles = 0").select(F.col("name").alias("_op9_name"), F.col("id").alias("_op9_id")).distinct()
    stays = chosen.unionAll(empty)
    named = docs.withColumn("_op9_text", _name(text))
    same = (F.col("_op9_text") == F.col("_op9_name")) & F.col(f"`{id_}`").eqNullSafe(F.col("_op9_id"))
    return named.join(stays.hint("merge"), same, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
