"""Samples and splits that come out the same on every run and retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.hashing import hash_uniform


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 0,
                     key: str | list[str] | None = None) -> DataFrame:
    """Each row is kept with probability ``fraction``, without replacement.

    With a key the draw depends on the key alone; without one it is Spark's
    seeded sample, which suits raw text lines.
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    keys = [key] if isinstance(key, str) else key
    return df.where(hash_uniform(*keys, seed=seed) < fraction)


def with_split(df: DataFrame, draw: Column, train_share: float,
               split: str = "split") -> DataFrame:
    """Marks rows 'train' or 'test' by one draw, so the test set is exactly the rest."""
    return df.withColumn(split, F.when(draw < train_share, "train").otherwise("test"))


def train_test(df: DataFrame, key: str | list[str], train_share: float = 0.7,
               seed: int = 0, split: str = "split") -> DataFrame:
    """Keyed train/test split."""
    keys = [key] if isinstance(key, str) else key
    return with_split(df, hash_uniform(*keys, seed=seed), train_share, split)


def random_split(df: DataFrame, train_share: float = 0.7,
                 seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Two DataFrames by Spark's seeded split, for tables without a key."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test
