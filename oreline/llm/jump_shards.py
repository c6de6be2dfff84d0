"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone, without a
table of the shards: the key seeds a generator whose jumps say at which shard
counts the row moves, and the last jump below the count is its shard.  With one
shard more only rows that jump to the new shard move, a share of 1 / (n + 1).

Keys that are whole numbers are taken as they are, others by a 64-bit hash;
either is mixed before the first jump.  Rows of a shard are numbered in the
order of their ids: ranges of ids are counted by shard, and each range starts
where the earlier ones end, so no shard is gathered in one task.

Defined results: a null text has 0 bytes and the checksum of the empty text; all
null keys are one key; rows with equal keys share a shard and are numbered one
by one; an empty table gives an empty table.  Other columns are kept by
:func:`place` and :func:`write`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.llm.codes import written

#: The multiplier of the published jump generator; shifts and multipliers of the mixing step.
JUMP = 2862933555777941757
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1))
#: Rows numbered together in one range.
RANGE_ROWS = 500_000


def mixed(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64)
    for shift, factor in MIX:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x


def jump(keys: np.ndarray, *counts: int) -> list[np.ndarray]:
    """The shard of every (mixed, 64-bit) key for each of the rising shard counts."""
    state, last, out = keys.astype(np.uint64), np.zeros(len(keys), dtype=np.int64), []
    ahead = np.zeros(len(keys), dtype=np.int64)  # the next jump, not yet taken
    for count in counts:
        while (now := np.flatnonzero(ahead < count)).size:
            last[now] = ahead[now]
            state[now] = state[now] * np.uint64(JUMP) + np.uint64(1)
            reach = float(1 << 31) / ((state[now] >> np.uint64(33)).astype(np.float64) + 1.0)
            ahead[now] = ((last[now] + 1) * reach).astype(np.int64)
        out.append(last.copy())
    return out


def key_of(docs: DataFrame, id_: str) -> Column:
    """64-bit key of an id."""
    whole = isinstance(docs.schema[id_].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(F.col(id_).cast("long") if whole else F.xxhash64(id_), F.lit(0))


def place(docs: DataFrame, shards: int, id_: str = "doc_id") -> DataFrame:
    """``docs`` with ``_op13_shard`` and ``_op13_grown``: the shard of every row, and with one shard more."""
    keyed = docs.withColumn("_op13_key", key_of(docs, id_))
    kinds = T.StructType([*docs.schema.fields, T.StructField("_op13_shard", T.IntegerType()), T.StructField("_op13_grown", T.IntegerType())])

    def kernel(batches):
        for batch in batches:
            keys = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            now, grown = jump(mixed(keys), shards, shards + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(now.astype(np.int32)), pa.array(grown.astype(np.int32))], names=kinds.names)

    return keyed.mapInArrow(kernel, kinds)


def slots(placed: DataFrame, order: list[str], name: str = "slot", rows: int = RANGE_ROWS) -> DataFrame:
    """``placed`` (a written table) with the number, from 0, of every row in its shard, in the order of the columns ``order``.

    Those columns must tell all rows apart.
    """
    parts = max(1, -(-placed.count() // rows))
    dealt = written(placed.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    inside = F.row_number().over(Window.partitionBy("_op13_shard", "range").orderBy(*order))
    before = F.sum("n").over(Window.partitionBy("_op13_shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    firsts = (dealt.groupBy("_op13_shard", "range").agg(F.count(F.lit(1)).alias("n"))
              .select("_op13_shard", "range", F.coalesce(before, F.lit(0)).alias("first")))
    return (dealt.withColumn("inside", inside).join(firsts, ["_op13_shard", "range"])
            .withColumn(name, F.col("first") + F.col("inside") - 1).drop("first", "inside", "range"))


def shard(docs: DataFrame, shards: int = 8, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row; only numbers of a text are shuffled."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(id_).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = written(place(narrow, shards, "id").withColumn("row", F.monotonically_increasing_id()), "placed")
    return slots(placed, ["id", "text_crc32", "row"]).select(
        F.col("id").alias(id_), "size", "text_crc32", F.lit("key").alias("law"), F.col("_op13_shard").alias("shard"), "slot",
        F.col("_op13_grown").alias("grown_shard"))


def write(docs: DataFrame, path: str, shards: int = 8, id_: str = "doc_id", files: int = 1) -> None:
    """All of ``docs`` as Parquet, one folder ``shard=k`` a shard; ``files`` tasks share the rows of a shard."""
    placed = place(docs, shards, id_)
    dealt = placed.repartition(shards * files, "_op13_shard", F.pmod(F.xxhash64(*[c for c, kind in placed.dtypes if not kind.startswith("map")]), F.lit(files)))
    dealt.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_op13_shard").alias("shard")).write.partitionBy("shard").parquet(path)


def _jumps_sql(counts: tuple[int, ...]) -> str:
    return ", ".join(f"max(b) FILTER (b < {n})::INTEGER AS s{n}" for n in counts)


def shard_sql(shards: int = 8) -> str:
    """The result of :func:`shard` over ``documents`` in DuckDB, for ids of whole numbers."""
    two64, mix = 1 << 64, "x0"
    steps = []
    for i, (shift, factor) in enumerate(MIX):
        steps.append(f"m{i} AS (SELECT * EXCLUDE (x), ((xor(x, x >> {shift})::UHUGEINT * {factor}::UHUGEINT) % {two64}::UHUGEINT)::UBIGINT AS x "
                     f"FROM {mix})")
        mix = f"m{i}"
    return f"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS body FROM documents),
x0 AS (SELECT r, ((coalesce(doc_id, 0)::HUGEINT + {two64}::HUGEINT) % {two64}::HUGEINT)::UBIGINT AS x FROM t),
{", ".join(steps)},
j AS (
  SELECT r, x AS state, 0::BIGINT AS b FROM {mix}
  UNION ALL
  SELECT r, s, floor((b + 1)::DOUBLE * (2147483648.0::DOUBLE / ((s >> 33)::DOUBLE + 1.0::DOUBLE)))::BIGINT
  FROM (SELECT r, b, ((state::UHUGEINT * {JUMP}::UHUGEINT + 1::UHUGEINT) % {two64}::UHUGEINT)::UBIGINT AS s FROM j WHERE b < {shards + 1}) q),
p AS (SELECT r, {_jumps_sql((shards, shards + 1))} FROM j GROUP BY r),
e AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i) q0
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM e WHERE k < 8),
v AS (SELECT list(c ORDER BY i) AS crc FROM e WHERE k = 8),
h AS (SELECT r, doc_id, octet_length(body)::BIGINT + 1 AS size,
             xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(body), '..'), lambda s: ('0x' || s)::BIGINT)),
                 lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)::BIGINT AS text_crc32
      FROM t, v)
SELECT doc_id, size, text_crc32, 'key' AS law, s{shards} AS shard,
       row_number() OVER (PARTITION BY s{shards} ORDER BY doc_id NULLS FIRST, text_crc32) - 1 AS slot, s{shards + 1} AS grown_shard
FROM h JOIN p USING (r)"""
