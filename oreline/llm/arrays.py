"""Helpers for columns that hold arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)
