"""Access to the test tables and small SQL helpers shared by the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nudge(places: int) -> float:
    """Moves exact halves off the rounding boundary.

    Averages of prices end in exact halves; engines adding up in another order
    would round them either way.
    """
    return float(f"1.37e-{places + 3}")


def rounded(c: Column | str, places: int = 6) -> Column:
    """Rounded double; adding 0.0 turns -0.0 into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(_nudge(places)), places) + F.lit(0.0)


def rounded_sql(sql: str) -> str:
    """Every ``round(x, n)`` of a statement with the same nudge and zero."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, comma, end = 1, -1, start + len("round(")
        while depth:
            ch = sql[end]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = end
            end += 1
        places = int(sql[comma + 1:end - 1])
        inner = rounded_sql(sql[start + len("round("):comma])
        out += [sql[at:start], f"(round(({inner}) + {_nudge(places)!r}::DOUBLE, {places}) + 0.0::DOUBLE)"]
        at = end
    return "".join(out) + sql[at:]


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"
