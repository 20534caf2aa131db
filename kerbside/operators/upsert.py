"""Keyed writes as DataFrame algebra: parquet has no MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.joins import union_all


class SchemaMismatch(ValueError):
    """A table does not have exactly the declared columns."""


def schema_difference(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) column names, each sorted; names compare without case."""
    have = {name.lower() for name in df.columns}
    want = {name.lower() for name in expected}
    return sorted(want - have), sorted(have - want)


def schema_guard(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Report ``(column_name, status, table_rows)``: status in expected, missing, extra, and
    how many rows a migration would touch. Rows are counted without reading a column."""
    missing, extra = schema_difference(df, expected)
    present = [name for name in expected if name.lower() not in missing]
    report = [(n, "expected") for n in present] + [(n, "missing") for n in missing] + [(n, "extra") for n in extra]
    entries = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(s).alias("status")) for n, s in report])
    return df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.inline(entries), "table_rows")


def require_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``df`` with the declared column order, or an error that lists the differences."""
    missing, extra = schema_difference(df, expected)
    if missing or extra:
        raise SchemaMismatch(
            f"missing columns: {', '.join(missing) or 'none'}; extra columns: {', '.join(extra) or 'none'}")
    return df.select(*expected)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           coalesce_cols: Sequence[str] = (), order_col: str | None = None) -> DataFrame:
    """MERGE on ``keys``: matched rows take the source's values, new rows are added.

    ``coalesce_cols`` keep the target's value where the source has null. With ``order_col``
    a source row older than its target row changes nothing else, so that the order in
    which batches arrive does not matter. Two source rows
    for one target row raise, as MERGE does; two source rows for a new key are both added.
    Both exchanges hash the keys, so the duplicate check moves only the source's keys.
    """
    keys = list(keys)
    source = require_schema(source, target.columns)
    repeated = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
                .where(F.col("_copies") > 1))
    checked = (target.join(repeated, keys, "left")
               .withColumn("_t", F.when(F.col("_copies").isNull(), F.lit(True)).otherwise(
                   F.raise_error(F.lit(f"several source rows match one target row on {', '.join(keys)}"))
                   .cast("boolean")))
               .drop("_copies"))
    t, s = checked.alias("t"), source.withColumn("_s", F.lit(True)).alias("s")

    source_wins = F.col("s._s")
    if order_col:
        source_wins = source_wins & F.coalesce(F.col(f"s.`{order_col}`") >= F.col(f"t.`{order_col}`"), F.lit(True))

    def merged(name: str) -> Column:
        new, old = F.col(f"s.`{name}`"), F.col(f"t.`{name}`")
        if name in coalesce_cols:
            return F.when(source_wins, F.coalesce(new, old)).otherwise(F.coalesce(old, new)).alias(name)
        return F.when(source_wins, new).otherwise(old).alias(name)

    matched = [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]
    # The filter is always true; it reads "_t" on every target row, so the check runs.
    return (t.join(s, matched, "full_outer")
            .where(F.coalesce(F.col("t._t"), F.col("s._s")))
            .select(*[merged(c) for c in target.columns]))


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str], coalesce_cols: Sequence[str] = ()) -> DataFrame:
    """One row: how many rows of ``source`` an ``upsert`` inserts, updates, and finds as they
    are (``inserted``, ``updated``, ``unchanged``). A null in a key matches nothing, so such a
    row is inserted. Only the target's keys, the columns to be coalesced and one digest of the
    others move; a table bucketed by its keys is not exchanged. A source without rows counts
    zeros."""
    keys = list(keys)
    source = require_schema(source, target.columns)
    others = [c for c in target.columns if c not in {*keys, *coalesce_cols}]
    digest = F.sha2(F.to_json(F.struct(*others), {"ignoreNullFields": "false"}), 256) if others else F.lit("")
    own = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in coalesce_cols], digest.alias("_new"))
    old = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in coalesce_cols], digest.alias("_old"), F.lit(True).alias("_hit"))
    same = F.col("_new") == F.col("_old")
    for c in coalesce_cols:  # a null in the source keeps what is there
        same = same & (F.col(f"_s_{c}").isNull() | F.col(f"_s_{c}").eqNullSafe(F.col(f"_t_{c}")))
    found = own.join(old, keys, "left")
    return found.agg(F.count_if(F.col("_hit").isNull()).alias("inserted"), F.count_if(F.col("_hit") & ~same).alias("updated"),
                     F.count_if(F.col("_hit") & same).alias("unchanged"))


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   protect: Column | None = None) -> DataFrame:
    """Delete target rows whose key is in ``batch`` (but for protected rows), add the batch.

    Rows whose ``protect`` is null stay too: a delete needs a condition that is true.
    """
    keys = list(keys)
    batch = require_schema(batch, target.columns)
    touched = batch.select(*keys).distinct()
    if protect is None:
        kept = target.join(touched, keys, "left_anti")
    else:
        hit = touched.withColumn("_hit", F.lit(True))
        kept = (target.join(hit, keys, "left")
                .where(F.col("_hit").isNull() | F.coalesce(protect, F.lit(True)))
                .drop("_hit"))
    return union_all(kept.select(*target.columns), batch)
