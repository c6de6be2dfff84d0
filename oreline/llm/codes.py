"""Tables kept as shards that hold their own small dictionary.

A task numbers the keys that occur in its shard, so rows carry small numbers
and every key leaves the shard once, however often it occurs.  What the whole
table knows of a key is joined back by (shard, number): a key has at most one
row per shard, hence no key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; its schema is known, so no job reads it from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keys_of(shards: DataFrame, keys: str) -> DataFrame:
    """(shard, at, key): the keys of every shard with their numbers."""
    return shards.select("shard", F.posexplode(keys).alias("at", "key"))


def looked_up(shards: DataFrame, keys: str, table: DataFrame, *values: str) -> DataFrame:
    """(shard, one array per value): for every shard the values of its keys, in the order of their numbers.

    ``table`` holds each key once, in column ``key``.  Shards without keys have no row.
    """
    met = keys_of(shards, keys).join(table, "key").groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("at", *values))).alias("all"))
    return met.select("shard", *[F.col(f"all.{v}").alias(v) for v in values])
