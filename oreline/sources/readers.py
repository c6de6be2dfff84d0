"""Readers.  Every schema is given; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.sources.schemas import (COVER_FIELDS, PARTICLE_FIELDS, POST, expand_names,
                                     numeric_schema)

PARAGRAPH = "\r\n\r\n"


def read_paragraphs(spark: SparkSession, path: str | list[str],
                    separator: str = PARAGRAPH) -> DataFrame:
    """Text files as one row ``value`` per separated record."""
    return spark.read.option("lineSep", separator).text(path)


def manifest_paths(spark: SparkSession, manifest: str) -> list[str]:
    """The input paths listed in a file, one per line; blanks are stripped.

    The list is what the reader needs to plan the scan, so it belongs on the
    driver; it holds file names, not data.
    """
    lines = spark.read.text(manifest).select(F.trim(F.regexp_replace("value", r"\s+$", "")).alias("p"))
    return [r["p"] for r in lines.where(F.col("p") != "").collect()]


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Lines of all files named by a manifest."""
    return spark.read.text(manifest_paths(spark, manifest))


def json_object(line: Column, schema: T.StructType) -> Column:
    """The line as a struct; null unless the whole line is one JSON object.

    A parser asked for a struct stops after the first object and would accept
    whatever follows it.  Read as the body of an array, anything after the
    object is a syntax error or a second element.
    """
    items = F.from_json(F.concat(F.lit("["), line, F.lit("]")), T.ArrayType(schema),
                        {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))


def parse_posts(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(user_id, text)`` of the lines that are posts; all others drop out.

    Broken lines, notices without a user, and JSON that is no object are not posts.
    """
    return (lines.select(json_object(F.col(value), POST).alias("p"))
            .select(F.col("p.user.id_str").alias("user_id"), F.col("p.text").alias("text"))
            .where("user_id is not null and text is not null"))


def rejected_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines :func:`parse_posts` drops, for inspection."""
    post = json_object(F.col(value), POST)
    return lines.where(post["user"]["id_str"].isNull() | post["text"].isNull())


def read_posts(spark: SparkSession, manifest: str) -> DataFrame:
    """Posts from the JSON-lines files named by a manifest."""
    return parse_posts(read_manifest(spark, manifest))


def read_numeric_csv(spark: SparkSession, path: str | list[str], names: list[str],
                     label: str) -> DataFrame:
    """Headerless numeric CSV; the label column is renamed and moved to the front.

    Works for a label in the first, last or any other place.
    """
    df = (spark.read.schema(numeric_schema(names))
          .option("header", "false").option("ignoreLeadingWhiteSpace", "true")
          .option("ignoreTrailingWhiteSpace", "true").option("mode", "FAILFAST").csv(path))
    return df.select(F.col(f"`{label}`").alias("label"),
                     *[F.col(f"`{n}`") for n in names if n != label])


def read_cover_types(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Forest cover rows: the class (1..7) comes last in the file."""
    return read_numeric_csv(spark, path, expand_names(COVER_FIELDS), "Cover_Type")


def read_particles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Particle rows: the label (0 or 1) comes first in the file."""
    return read_numeric_csv(spark, path, expand_names(PARTICLE_FIELDS), "label")


def parse_numeric_lines(lines: DataFrame, names: list[str], label: str,
                        value: str = "value") -> DataFrame:
    """The same from a text frame, so that lines can be sampled before parsing."""
    cells = F.split(F.col(value), ",")
    typed = lines.select(F.transform(cells, lambda c: F.trim(c).cast("double")).alias("_c"))
    at = {n: F.get("_c", F.lit(i)).alias("label" if n == label else n)
          for i, n in enumerate(names)}
    return typed.select(at[label], *[at[n] for n in names if n != label])


def read_lookup(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A key-to-value table in parquet."""
    return spark.read.parquet(path).select(key, value)


def flatten_stations(nested: DataFrame) -> DataFrame:
    """Nested station records to ``(station, measurement, year, vec)`` rows."""
    return (nested.select("station", F.explode("measurements").alias("m"))
            .select("station", "m.measurement", "m.year", "m.vec"))


def peek(df: DataFrame, rows: int = 1) -> DataFrame:
    """The first rows, reading only as many partitions as needed."""
    return df.limit(rows)
