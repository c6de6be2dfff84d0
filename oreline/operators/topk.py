"""Top-k per group.

Written as ``row_number() <= k`` so that Spark plans a group limit before the
shuffle: each task sends at most k rows per group, whatever the group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int,
                  rank: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group by a complete (tie-free) order."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def top_overall(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k; planned as a per-task heap merge, not as a full sort."""
    return df.orderBy(*order).limit(k)
