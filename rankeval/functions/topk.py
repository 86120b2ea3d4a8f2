"""A bounded top-k aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql.internal import InternalFunction


def greatest_k(value: Column, k: int) -> Column:
    """The ``k`` greatest values of a group, greatest first: Spark's own heap aggregate, which keeps at most ``k`` values
    per group in every task and merges them behind the exchange."""
    return InternalFunction.collect_top_k(value, k, False)
