"""Tables rewritten as a whole (checkpoint state, geocode cache, overrides): every write
makes a new numbered folder, so nobody's input is overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbside.sources.workspace import folder_names, is_finished, mark_finished


def latest_version(spark: SparkSession, root: str) -> int:
    """Highest finished version below ``root``, 0 if there is none."""
    names = [n for n in folder_names(spark, root) if n.startswith("v=") and is_finished(spark, f"{root}/{n}")]
    return max((int(n[2:]) for n in names), default=0)


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    version = latest_version(spark, root)
    if not version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={version}")


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write the next version; an unfinished one of the same number is replaced."""
    version = latest_version(df.sparkSession, root) + 1
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    mark_finished(df.sparkSession, f"{root}/v={version}")
    return version
