"""Session settings this library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Parsing text is bound by CPU: let small shuffles keep all cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition also where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.unionOutputPartitioning": "false",  # see operators.joins.union_all
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """``shuffle_partitions`` is an upper bound: adaptive execution merges small ones, so
    on a cluster choose it from data size (about 128 MB of shuffle input each)."""
    builder = SparkSession.builder.appName("kerbside")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
