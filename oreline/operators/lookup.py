"""Joins of a large table with a lookup table, safe for hot keys.

A lookup is broadcast only after its rows and bytes were measured.  A larger
one is joined through a shuffle.  Keys with many rows are counted first and
spread over as many salts as their size asks for; only their lookup rows are
repeated, so a key holding a third of all rows still splits into small tasks
and the other keys cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.session import cut_lineage

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that may meet in a task of the join.
HOT_ROWS = 1_000_000


def _row_bytes(lookup: DataFrame) -> Column:
    """Payload bytes of a row: text by its length, arrays by their elements, structs and maps as text."""
    total = F.lit(0).cast("bigint")
    for field in lookup.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            size = F.octet_length(c)
        elif isinstance(field.dataType, T.ArrayType):
            nested = isinstance(field.dataType.elementType, T.ArrayType)
            size = F.size(F.flatten(c) if nested else c) * 8
        elif isinstance(field.dataType, (T.StructType, T.MapType)):
            size = F.octet_length(F.to_json(c))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def fits_broadcast(lookup: DataFrame) -> bool:
    """Measure a table: true when its rows and payload bytes are in bounds."""
    rows, size = lookup.agg(F.count(F.lit(1)),
                            F.coalesce(F.sum(_row_bytes(lookup)), F.lit(0))).first()
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


def enrich(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
           spread: list[Column] | None = None) -> DataFrame:
    """Join ``facts`` with a ``lookup`` holding at most one row per key.

    ``spread`` are columns that differ between rows of one key; they pick the
    salt.  A hash of columns, not a random number, so that a retried task
    sends every row to the same place.  The lookup is checkpointed: it is
    measured and joined without being computed twice, also after a lost executor.
    """
    lookup = cut_lineage(lookup)
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), on, how)
    if not spread:
        return facts.join(lookup, on, how)
    hot = cut_lineage(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
                      .select(*on, F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias("_salts")))
    if hot.isEmpty():
        return facts.join(lookup, on, how)
    known = F.broadcast(hot) if fits_broadcast(hot) else hot
    many = F.coalesce(F.col("_salts"), F.lit(1))
    salted = (facts.join(known, on, "left")
              .withColumn("_salt", F.pmod(F.xxhash64(*spread), many).cast("int")).drop("_salts"))
    repeated = (lookup.join(hot, on, "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1))).drop("_salts"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def one_row_per_key(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Dictionary semantics: one value per key (the smallest when there are more)."""
    return (mapping.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(value).alias(value)))
