"""Data-quality checks: every check returns its violations as rows. ``write_checks`` attaches
those that are counts to the job that writes a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Declared checks per table.
NOT_NULL = {
    "bronze": ["channel", "id", "scraped_at_gmt8"],
    "geocodes": ["normalized_location", "resolution_status", "resolution_source", "result_count"],
    "silver": ["channel", "message_id", "request_type"],
    "gold": ["gold_request_id", "silver_request_id", "is_canonical_request", "telegram_user_key",
             "channel", "message_id", "request_type"],
}


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls per column, all columns in one pass; a count of 0 is a pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "null_count")


def dq_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that occur more than once (nulls are not compared)."""
    present = df.dropna(how="any", subset=list(cols))
    return present.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def dq_accepted_values(df: DataFrame, col: str, values: Sequence, where: Column | None = None) -> DataFrame:
    """Values outside the list, with their number; null is left to ``dq_not_null``."""
    rows = df if where is None else df.where(where)
    return (rows.where(~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("row_count")))


def dq_duplicate_keys(messages: DataFrame, keys: Sequence[str] = ("channel", "id")) -> DataFrame:
    return messages.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def source_profile(messages: DataFrame) -> DataFrame:
    """Rows, oldest and newest message and highest id per channel and topic."""
    return (messages.groupBy("channel", "topic_id")
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("message_date_gmt8").alias("oldest_message_gmt8"),
                 F.max("message_date_gmt8").alias("newest_message_gmt8"), F.max("id").alias("maximum_message_id"))
            .orderBy("channel", "topic_id"))


# --- checks in the pass that writes a table ------------------------------------------------

@dataclass(frozen=True)
class WriteChecks:
    """Checks whose counts come out of the job that writes a table, by ``Observation``.

    ``watched`` goes to the writer in place of the table. Once it is written, the results
    cost no further job: nulls per column are the rows of ``dq_not_null``; whether any value
    lies outside its list is known too, and only then ``odd_values`` reads the written table
    (its rows with such values only) to name them, as ``dq_accepted_values`` does.
    """

    watched: DataFrame
    seen: Observation
    not_null: tuple[str, ...]
    accepted: Mapping[str, Sequence]

    def rows(self) -> int:
        return self.seen.get["rows"]

    def null_counts(self) -> list[tuple[str, int]]:
        """(column_name, null_count) of every checked column."""
        return [(c, self.seen.get[f"null {c}"]) for c in self.not_null]

    def odd_rows(self) -> dict[str, int]:
        """How many rows have a value outside its column's list."""
        return {c: self.seen.get[f"odd {c}"] for c in self.accepted}

    def passed(self) -> bool:
        return not any(n for _, n in self.null_counts()) and not any(self.odd_rows().values())

    def odd_values(self, written: DataFrame, col: str) -> DataFrame:
        """(value, row_count) of a column's values outside its list."""
        return dq_accepted_values(written if self.odd_rows()[col] else written.where(F.lit(False)), col, self.accepted[col])


def write_checks(df: DataFrame, not_null: Sequence[str], accepted: Mapping[str, Sequence] | None = None) -> WriteChecks:
    """``df`` with counts of nulls and of values outside their lists attached."""
    accepted = accepted or {}
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in not_null],
        *[F.count_if(~F.col(c).isin(list(values))).alias(f"odd {c}") for c, values in accepted.items()])
    return WriteChecks(watched, seen, tuple(not_null), dict(accepted))
