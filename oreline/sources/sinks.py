"""Sinks: results are tables; printing is left to callers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> None:
    """Writes parquet, optionally partitioned by columns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_lines(df: DataFrame, path: str, separator: str = "\n",
                mode: str = "errorifexists") -> None:
    """Writes a single string column as text records."""
    df.write.mode(mode).option("lineSep", separator).text(path)
