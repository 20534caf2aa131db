"""Incremental ingest: which messages to take per source, and what to remember."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import text
from kerbside.functions.clock import ntz
from kerbside.operators.joins import union_all
from kerbside.schemas import MESSAGE_COLUMNS
from kerbside.sources.workspace import stored

# Ids are counted in blocks of this size to find where a page ends.
PAGE_BLOCK = 65_536


def source_plan(sources: DataFrame, state: DataFrame, per_run: int = 0, page: int = 0) -> DataFrame:
    """One row per source: where it stands, its mode and its row limit (null = no limit).

    A source without state starts at 0. Until its backfill is complete it reads full
    history in pages of ``page``; afterwards at most ``per_run`` messages. 0 = unlimited.
    """
    if per_run < 0:
        raise ValueError("per_run must be zero or greater")
    if page < 0:
        raise ValueError("page must be zero or greater")
    backfilled = F.coalesce("initial_backfill_complete", F.lit(False))
    last = F.coalesce("last_message_id", F.lit(0).cast("bigint"))
    limit = F.when(backfilled, F.lit(per_run)).otherwise(F.lit(page)).cast("bigint")
    return (
        sources.select("channel", "topic_id", "state_key").join(state, "state_key", "left")
        .select(
            "state_key",
            text.canonical_channel(F.col("channel")).alias("channel"),
            F.col("topic_id").alias("source_topic_id"),
            F.when(last >= 0, last).otherwise(
                F.raise_error(F.lit("last_message_id must be zero or greater")).cast("bigint")
            ).alias("last_message_id"),
            backfilled.alias("initial_backfill_complete"),
            F.when(backfilled, F.lit("incremental")).otherwise(F.lit("full_history")).alias("sync_mode"),
            F.nullif(limit, F.lit(0).cast("bigint")).alias("row_limit"),
        )
    )


def scan_sources(messages: DataFrame, plan: DataFrame, limited: bool = True) -> DataFrame:
    """The next page of every source: id above its mark, topic match, ascending id.

    The page end is an id found by counting: rows per id block, a running sum over the
    blocks of a source, then rows per id inside the one block where the limit falls. Only
    counts are shuffled, so a source with a third of all messages costs no more than any
    other, and the messages themselves stay where they were read. Copies of one id are
    never split over two pages. Sources of a whole channel are joined by channel, sources
    of one topic by channel and topic, so a channel with many topics costs no more. The plan
    and the page ends, one row per source, are stored first: the planner then knows their
    size and broadcasts them if it may.
    """
    plan = stored(plan, "plan")
    of_channel, of_topic = plan.where("source_topic_id IS NULL"), plan.where("source_topic_id IS NOT NULL")
    pending = union_all(
        messages.drop("topic_id").join(of_channel, "channel"),
        messages.withColumnRenamed("topic_id", "source_topic_id").join(of_topic, ["channel", "source_topic_id"]),
    ).where(F.col("id") > F.col("last_message_id"))
    page_rows = pending
    if limited:
        block = F.floor(F.col("id") / F.lit(PAGE_BLOCK)).cast("bigint")
        narrow = pending.where(F.col("row_limit").isNotNull()).select("state_key", "row_limit", "id", block.alias("block"))
        by_source = Window.partitionBy("state_key").orderBy("block")
        blocks = (
            narrow.groupBy("state_key", "row_limit", "block").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("through", F.sum("n").over(by_source))
            .where((F.col("through") >= F.col("row_limit")) & (F.col("through") - F.col("n") < F.col("row_limit")))
            .select("state_key", "block", (F.col("row_limit") - F.col("through") + F.col("n")).alias("wanted"))
        )
        in_block = Window.partitionBy("state_key").orderBy("id")
        ends = (
            narrow.join(blocks, ["state_key", "block"])
            .groupBy("state_key", "wanted", "id").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("through", F.sum("n").over(in_block))
            .where(F.col("through") >= F.col("wanted"))
            .groupBy("state_key").agg(F.min("id").alias("page_end"))
        )
        page_rows = (pending.join(stored(ends, "page-ends"), "state_key", "left")
                     .where(F.col("page_end").isNull() | (F.col("id") <= F.col("page_end"))))
    return page_rows.select(
        "state_key", "sync_mode", "row_limit",
        "channel", F.col("source_topic_id").alias("topic_id"), "id", "message_date_gmt8", "message",
        "sender_id", text.sender_handle(F.col("sender_handle")).alias("sender_handle"), "scraped_at_gmt8")


def since_year_filter(page: DataFrame, since_year: int | None) -> DataFrame:
    return page.where(F.year("message_date_gmt8") >= since_year) if since_year else page


def incremental_fetch(messages: DataFrame, sources: DataFrame, state: DataFrame, per_run: int = 0,
                      page: int = 0, since_year: int | None = None,
                      scraped_at: str | None = None) -> DataFrame:
    """Messages to store in this run, with their ``state_key`` and ``sync_mode``.

    ``scraped_at`` stamps the run; without it the messages keep their own stamp. The year
    filter runs after the page limit; ``checkpoint_advance`` takes the page before it.
    """
    plan = source_plan(sources, state, per_run, page)
    fetched = since_year_filter(scan_sources(messages, plan, limited=bool(per_run or page)), since_year)
    if scraped_at is not None:
        fetched = fetched.withColumn("scraped_at_gmt8", ntz(scraped_at))
    return fetched.select("state_key", "sync_mode", *MESSAGE_COLUMNS)


def checkpoint_advance(plan: DataFrame, scanned: DataFrame) -> DataFrame:
    """New state of every source, from the page as scanned (before any year filter)."""
    seen = scanned.groupBy("state_key").agg(F.max("id").alias("max_id"), F.count(F.lit(1)).alias("fetched"))
    fetched = F.coalesce("fetched", F.lit(0))
    limit_reached = F.coalesce(fetched >= F.col("row_limit"), F.lit(False))
    return plan.join(seen, "state_key", "left").select(
        "state_key",
        F.greatest("last_message_id", F.coalesce("max_id", F.lit(0).cast("bigint"))).alias("last_message_id"),
        (F.col("initial_backfill_complete") | ~limit_reached).alias("initial_backfill_complete"))


def advance_state(state: DataFrame, advanced: DataFrame) -> DataFrame:
    """Stored state and a run's new state together: no mark moves back and no finished
    backfill is reopened, whichever run comes last."""
    done = F.coalesce("s.initial_backfill_complete", F.lit(False)) | F.coalesce("a.initial_backfill_complete", F.lit(False))
    return (state.alias("s").join(advanced.alias("a"), F.col("s.state_key") == F.col("a.state_key"), "full_outer")
            .select(F.coalesce("s.state_key", "a.state_key").alias("state_key"),
                    F.greatest("s.last_message_id", "a.last_message_id").alias("last_message_id"),
                    done.alias("initial_backfill_complete")))


def sync_summary(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row: sources, messages fetched and merged, and the mode (``mixed`` if several)."""
    per_source = fetched.groupBy("state_key").agg(F.count(F.lit(1)).alias("fetched"))
    one_mode = F.min("sync_mode") == F.max("sync_mode")
    return plan.join(per_source, "state_key", "left").agg(
        F.count(F.lit(1)).alias("channel_count"),
        F.coalesce(F.sum("fetched"), F.lit(0).cast("bigint")).alias("fetched"),
        F.coalesce(F.sum("fetched"), F.lit(0).cast("bigint")).alias("merged"),
        F.when(one_mode, F.min("sync_mode")).otherwise(F.lit("mixed")).alias("sync_mode"))


def checkpoint_rebuild(bronze: DataFrame) -> DataFrame:
    """High-water mark per source from what is stored."""
    return (bronze.groupBy(text.state_key(F.col("channel"), F.col("topic_id")).alias("state_key"))
            .agg(F.max("id").alias("last_message_id")))
