"""Silver: latest copy of every message, parsed into a request."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import clock, text
from kerbside.functions import patterns as P
from kerbside.operators.upsert import upsert
from kerbside.schemas import SILVER_COLUMNS, SILVER_KEYS


def lookback_filter(df: DataFrame, col: str, as_of: str | datetime | None, hours: int = 6) -> DataFrame:
    """Rows of the last ``hours``; ``as_of=None`` is a first run and keeps all."""
    if as_of is None:
        return df
    return df.where(F.col(col) >= clock.ntz(as_of) - clock.hours(hours))


def newest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """The row with the highest ``order_col`` per key.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so many copies of one key never meet in one task. Remaining columns break
    ties: the result does not depend on row order.
    """
    ties = [c for c in df.columns if c not in {*keys, order_col}]
    newest = Window.partitionBy(*keys).orderBy(F.desc(order_col), *[F.desc(c) for c in ties])
    return df.withColumn("_copy", F.row_number().over(newest)).where(F.col("_copy") == 1).drop("_copy")


def latest_copy(messages: DataFrame, keys: Sequence[str] = ("channel", "id"),
                order_col: str = "scraped_at_gmt8") -> DataFrame:
    """Newest copy per message; copies without text are dropped before the choice."""
    return newest_per_key(messages.where(F.col("message").isNotNull()), keys, order_col)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Classify, drop noise, then extract; each step is one projection, so no regex that
    several columns depend on is evaluated twice, and noise never reaches extraction.

    ``stack`` of one row is a projection that a filter is not pushed through: otherwise
    the optimizer copies the whole classification into the filter and runs it twice.
    """
    m = F.col("message")
    requests = (
        messages.withColumn("_lowered", F.lower(F.trim(m)))
        .select(*[c for c in messages.columns if c != "id"], F.col("id").alias("message_id"), "_lowered",
                F.stack(F.lit(1), text.classify_lowered(F.col("_lowered"))).alias("request_type"))
        .where(F.col("request_type").isNotNull())
    )
    extracted = requests.select(
        "*", text.line_text(m, P.PICKUP_LINE).alias("_pickup"), text.line_text(m, P.DROPOFF_LINE).alias("_dropoff"),
        text.line_text(m, P.TIME_LINE).alias("_time"), text.pax_texts(m).alias("_pax_texts"))
    cleaned = extracted.select(
        "*", text.unflagged_text(F.col("_pickup")).alias("_pickup_place"),
        text.unflagged_text(F.col("_dropoff")).alias("_dropoff_place"),
        text.blank_to_null(F.col("_time")).alias("_time_text"), text.pax_numbers(F.col("_pax_texts")).alias("_pax"))
    parsed = cleaned.select(
        "*",
        text.collapse_border_route(text.blank_to_null(F.col("_pickup_place"))).alias("pickup_location"),
        text.collapse_border_route(text.blank_to_null(F.col("_dropoff_place"))).alias("dropoff_location"),
        text.resolve_now(F.col("_time_text"), F.col("message_date_gmt8")).alias("request_time_text"),
        text.pax_of_lowered(F.col("_lowered"), F.col("_pax")).alias("pax_count"))
    return parsed.withColumn("parse_status", text.parse_status(
        F.col("pickup_location"), F.col("dropoff_location"), F.col("request_time_text"))).select(*SILVER_COLUMNS)


def silver_requests(messages: DataFrame, as_of: str | datetime | None = None, hours: int = 6) -> DataFrame:
    """Bronze -> Silver. With ``as_of``, only messages scraped in the last ``hours``."""
    return parse_messages(latest_copy(lookback_filter(messages, "scraped_at_gmt8", as_of, hours)))


def silver_merge(silver: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge a batch on (channel, message_id); other columns than declared raise. A message
    edited into noise is not in the batch, so its earlier request stays."""
    return upsert(silver.select(*SILVER_COLUMNS), batch, SILVER_KEYS)
