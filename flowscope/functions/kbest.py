"""Bounded k-best aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction


def k_best(key: str, value: str, k: int, where: Column | None = None) -> Column:
    """Aggregate: array of the ``k`` structs (value, key) with the largest ``value``, best first;
    ties go to the smaller key. Rows that fail ``where`` do not count.

    The buffer is a queue of at most ``k`` entries that partial aggregates merge, so neither a
    task nor a streaming state row ever holds the keys of a group. Spark has the aggregate
    (``collect_top_k``), but only among the functions its pandas API uses.
    """
    order = F.struct((-F.col(value)).alias("less"), F.col(key).alias(key))
    if where is not None:
        order = F.when(where, order)  # nulls are not collected
    best = InternalFunction.collect_top_k(order, k, True)
    return F.transform(best, lambda e: F.struct((-e["less"]).alias(value), e[key].alias(key)))
