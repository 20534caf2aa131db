"""Unions that stay plain concatenations."""

from __future__ import annotations

from pyspark.sql import DataFrame

_MANY = 1 << 20

def union_all(first: DataFrame, *rest: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by name, planned as a plain concatenation.

    Spark 4.1 may zip the partitions of inputs that are hashed the same way. That fails
    when adaptive execution has merged the partitions of one input and not of the other
    ("Can't zip RDDs with unequal numbers of partitions"). Coalescing to more partitions
    than there are moves nothing, but leaves the partitioning unknown, so no session
    setting is needed.
    """
    whole = first
    for df in rest:
        whole = whole.unionByName(df.coalesce(_MANY), allowMissingColumns=allow_missing)
    return whole
