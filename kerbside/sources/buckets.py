"""Tables bucketed by key, so that a merge moves its batch and not the table.

A table is bucketed and sorted by its keys and partitioned by slices of neighbouring
buckets. A join on the keys reads the table where it lies, one task a bucket; only the other
side is exchanged. A merge opens the slices that hold a key of its batch and no others, and
replaces just these by a dynamic partition overwrite, so its cost follows the batch as long
as that is clustered or small, and never includes an exchange of the table.

Give a table as many buckets as the session has shuffle partitions or more: with fewer,
Spark prefers to exchange both sides. Spark swaps finished slices in on the driver, one
after the other; a driver that dies meanwhile needs the merge run again from its batch, and
a table format where that is not good enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.upsert import require_schema, upsert
from kerbside.sources.workspace import new_folder

SLICE = "_slice"
SLICES = 64  # at most 32,768: the slices a merge has written are noted as one bitmap


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalogue. ``buckets`` is a multiple of ``slices``."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int
    slices: int

    def slice_of(self) -> Column:
        """The slice of a row's key: buckets are what Spark's own hash says."""
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        return F.floor(bucket / F.lit(self.buckets // self.slices)).cast("int")

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(SLICE)

    def touched(self, keys: DataFrame) -> list[int]:
        """Slices that hold a key of ``keys``; their number is bounded by ``slices``."""
        return sorted(r[0] for r in keys.select(self.slice_of()).distinct().collect())

    def target(self, numbers: Sequence[int]) -> DataFrame:
        """The rows of some slices; no other folder is opened."""
        return self.spark.table(self.name).where(F.col(SLICE).isin(list(numbers))).drop(SLICE)

    def rewrite(self, keys: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the slices that hold a key of ``keys`` by ``merge`` of their rows, whose
        keys lie in these slices too; returns them. Rows without any key go to one slice."""
        numbers = self.touched(keys)
        if not numbers:
            return []
        written = Observation()
        rows = require_schema(merge(self.target(numbers)), self.read().columns).withColumn(SLICE, self.slice_of())
        rows = rows.observe(written, F.bitmap_construct_agg(F.col(SLICE).cast("long")).alias("slices"))
        with _dynamic_overwrite(self.spark):
            rows.write.insertInto(self.name, overwrite=True)
        bits = written.get["slices"]
        for number in numbers:  # a slice that lost all rows has no folder to be swapped in
            if not bits[number // 8] >> number % 8 & 1:
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({SLICE} = {number})")
        return numbers


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Only partitions that are written are replaced. A table in the catalogue takes this from
    the session, not from the writer."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def create_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None, slices: int = SLICES) -> BucketedTable:
    """Write ``df`` as the bucketed table ``name``, in the shared folder; one exchange by key."""
    spark = df.sparkSession
    wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = min(slices, wanted)
    table = BucketedTable(spark, name, tuple(keys), -(-wanted // slices) * slices, slices)
    (df.withColumn(SLICE, table.slice_of()).repartition(table.buckets, *keys)
     .write.partitionBy(SLICE).bucketBy(table.buckets, *keys).sortBy(*keys)
     .option("path", new_folder(spark, name)).saveAsTable(name))
    return table


def upsert_bucketed(table: BucketedTable, source: DataFrame, coalesce_cols: Sequence[str] = (), order_col: str | None = None) -> list[int]:
    """``operators.upsert.upsert`` on the table's keys; ``source`` should be stored, since it
    is read for its slices first. Returns the slices replaced."""
    return table.rewrite(source, lambda target: upsert(target, source, table.keys, coalesce_cols, order_col))


def replace_bucketed(table: BucketedTable, gone: DataFrame, fresh: DataFrame) -> list[int]:
    """Delete the rows whose keys are in ``gone`` and add ``fresh``, both stored."""
    keys = list(table.keys)
    removed = gone.select(*keys).distinct()
    return table.rewrite(gone.select(*keys).unionByName(fresh.select(*keys)),
                         lambda target: target.join(removed, keys, "left_anti").select(*fresh.columns)
                         .unionByName(fresh.repartition(table.buckets, *keys)))
