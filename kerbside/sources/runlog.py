"""Tables as logs of runs: every run appends one folder of its own and nothing else.

A run's rows lie below ``run=<id>/day=<date>``, the date being that of a stamp column. A
repeated run overwrites only its own folder, so runs may be repeated in any order; readers
take the newest row of a key and reduce what they read by days. ``compact`` writes the
newest rows of closed runs as one more run; the runs it covers are left out by readers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import clock
from kerbside.sources.workspace import folder_names

ROWS_PER_FILE = 5_000_000


def append_run(df: DataFrame, root: str, run: str, stamp: str) -> DataFrame:
    """Write ``df`` once as the run's folder and return what was written. Each day's rows
    come from a few tasks, so a run leaves few files."""
    dated = df.withColumn("day", F.to_date(stamp))
    path = f"{root}/run={run}"
    dated.repartition("day").write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("day").parquet(path)
    return df.sparkSession.read.schema(_stored(df.schema)).parquet(path).select(*df.columns)


def _stored(schema: T.StructType, *more: T.StructField) -> T.StructType:
    plain = [T.StructField(f.name, f.dataType) for f in schema]
    return T.StructType([*plain, *more, T.StructField("day", T.DateType())])


def covered_runs(spark: SparkSession, root: str) -> list[str]:
    """Runs whose rows a finished compaction holds."""
    names = [n for n in folder_names(spark, f"{root}-covered") if n.startswith("run=")]
    return sorted({r.name for n in names for r in spark.read.parquet(f"{root}-covered/{n}").collect()})  # one row per run


def read_log(spark: SparkSession, root: str, schema: T.StructType, since: Column | None = None,
             days: Sequence[date] | None = None) -> DataFrame:
    """Every stored row with its ``run``; with ``since``, only days from that wall clock's
    date on are opened, with ``days`` only these."""
    if not _runs(spark, root):
        return spark.createDataFrame([], T.StructType([*_stored(schema).fields[:-1], T.StructField("run", T.StringType())]))
    rows = spark.read.schema(_stored(schema, T.StructField("run", T.StringType()))).parquet(root)
    covered = covered_runs(spark, root)
    if covered:
        rows = rows.where(~F.col("run").isin(covered))
    if since is not None:
        rows = rows.where(F.col("day") >= F.to_date(since))
    if days is not None:
        rows = rows.where(F.col("day").isin(list(days)))
    return rows.select(*schema.fieldNames(), "run")


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], coalesce: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key by ``order``, then by its other values; ``coalesce``
    columns take their newest value that is not null. One row per key leaves a map task."""
    columns = [c for c in rows.columns if c != "run"]
    rank = F.struct(*[F.col(c) for c in [*order, *[c for c in columns if c not in {*keys, *order}]]])
    picked = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(f"_{c}") for c in coalesce]
    best = rows.groupBy(*keys).agg(F.max(rank).alias("_row"), *picked)
    value = lambda c: F.col(f"_{c}") if c in coalesce else F.col(c) if c in keys else F.col(f"_row.{c}")
    return best.select(*[value(c).alias(c) for c in columns])


def newest_runs(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows of each key's newest run, by ``order``."""
    latest = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc("run"))
    return rows.withColumn("_run", F.dense_rank().over(latest)).where(F.col("_run") == 1).drop("_run")


def _cover(spark: SparkSession, root: str, name: str, runs: list[str]) -> None:
    entries = spark.range(1).select(F.explode(F.array(*map(F.lit, runs))).alias("name"))
    entries.write.mode("overwrite").parquet(f"{root}-covered/run={name}")


def _runs(spark: SparkSession, root: str) -> list[str]:
    return sorted(n[4:] for n in folder_names(spark, root) if n.startswith("run="))


def replace_runs(df: DataFrame, root: str, run: str, stamp: str) -> None:
    """Write ``df`` as a run in place of all runs there are."""
    earlier = [r for r in _runs(df.sparkSession, root) if r != run]
    append_run(df, root, run, stamp)
    if earlier:
        _cover(df.sparkSession, root, run, earlier)


def compact(spark: SparkSession, root: str, schema: T.StructType, stamp: str, before: str | datetime,
            reduce: Callable[[DataFrame], DataFrame]) -> str | None:
    """Write ``reduce`` of the rows of all runs whose last day is before ``before`` as one
    run, then note what it covers. A compaction that dies in between covers nothing."""
    rows = read_log(spark, root, schema)
    last = rows.groupBy("run").agg(F.max(F.to_date(stamp)).alias("last")).where(F.col("last") < F.to_date(clock.ntz(before)))
    runs = sorted(r.run for r in last.select("run").collect())  # names of folders
    if len(runs) < 2:
        return None
    name = f"compact-{runs[-1]}"
    append_run(reduce(rows.where(F.col("run").isin(runs))).select(*schema.fieldNames()), root, name, stamp)
    _cover(spark, root, name, runs)
    return name
