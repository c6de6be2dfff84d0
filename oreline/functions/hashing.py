"""Deterministic uniforms: the same row always gets the same number.

Row-order-dependent generators change when a task is retried on other
input splits; a hash of the row's key does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and modulus of the arithmetic hash.
_MULTIPLIER = 2654435761
_MODULUS = 4294967296


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(*keys: Column | str, seed: int = 0) -> Column:
    """Uniform in [0, 1) from a 64-bit hash of any key columns."""
    h = F.xxhash64(F.lit(seed), *[_col(k) for k in keys])
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0 ** -53)


def arithmetic_uniform(key: Column | str, seed: int = 0) -> Column:
    """Uniform in [0, 1) from an integer key, in arithmetic any SQL engine has.

    Consecutive keys are spread evenly rather than at random, which suits
    splits; use :func:`hash_uniform` where draws must be independent.
    """
    folded = F.pmod(_col(key).cast("bigint"), F.lit(2 ** 31)) * F.lit(_MULTIPLIER)
    return F.pmod(folded + F.lit(seed), F.lit(_MODULUS)) / F.lit(float(_MODULUS))


def arithmetic_uniform_sql(key: str, seed: int = 0) -> str:
    """The same number as text for engines with ``%`` (keys are not negative)."""
    return (f"((((CAST({key} AS BIGINT) % {2 ** 31}) * {_MULTIPLIER} + {seed}) "
            f"% {_MODULUS}) / {float(_MODULUS)!r}::DOUBLE)")
