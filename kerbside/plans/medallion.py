"""Bronze to Gold over stored tables: full refresh, incremental runs, compaction.

Every table of rows is a log of runs (``sources.runlog``), so repeated runs, in any order,
change nothing. Gold rows carry when they were refreshed; a request that a run has seen
again and that gives no Gold row any more leaves a row without values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import clock, text
from kerbside.operators import geocode, gold, ingest, partials, silver
from kerbside.operators.joins import union_all
from kerbside.schemas import (GEOCODE_SCHEMA, GOLD_COLUMNS, GOLD_SCHEMA, MESSAGE_COLUMNS, MESSAGE_KEYS, MESSAGE_SCHEMA,
                              OVERRIDE_SCHEMA, SILVER_COLUMNS, SILVER_KEYS, SILVER_SCHEMA, STATE_SCHEMA)
from kerbside.sources import runlog
from kerbside.sources.messages import append_messages, newest_messages, read_message_table
from kerbside.sources.snapshots import read_snapshot, write_snapshot
from kerbside.sources.workspace import is_finished, mark_finished, stored

GOLD_LOG_SCHEMA = T.StructType([*[T.StructField(f.name, f.dataType) for f in GOLD_SCHEMA], T.StructField("refreshed_at", T.TimestampNTZType())])


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment below a shared root."""

    root: str

    def at(self, table: str) -> str:
        return f"{self.root}/{table}"


def _newest_requests(rows: DataFrame) -> DataFrame:
    return runlog.newest(rows, SILVER_KEYS, ["scraped_at_gmt8"], ["topic_id"]).select(*SILVER_COLUMNS)


def _newest_gold(rows: DataFrame) -> DataFrame:
    return runlog.newest_runs(rows, ["silver_request_id"], "refreshed_at")


def read_silver(spark: SparkSession, layout: Layout) -> DataFrame:
    return _newest_requests(runlog.read_log(spark, layout.at("silver"), SILVER_SCHEMA))


def read_gold(spark: SparkSession, layout: Layout, since: Column | None = None, days: Sequence[date] | None = None) -> DataFrame:
    """Gold as the newest runs left it; with ``since``, posts from that wall clock's day on,
    with ``days``, posts of these."""
    rows = runlog.read_log(spark, layout.at("gold"), GOLD_LOG_SCHEMA, since, days)
    return _newest_gold(rows).where("gold_request_id IS NOT NULL").select(*GOLD_COLUMNS)


def read_geocodes(spark: SparkSession, layout: Layout, now: Column) -> DataFrame:
    """The cache with reviewed overrides applied."""
    return geocode.apply_overrides(read_snapshot(spark, layout.at("geocodes"), GEOCODE_SCHEMA),
                                   read_snapshot(spark, layout.at("overrides"), OVERRIDE_SCHEMA), now)


def full_refresh(messages: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(Silver, Gold) of all messages with the geocodes known so far. Silver is stored
    first: Gold reads it more than once."""
    requests = stored(silver.silver_requests(messages), "silver")
    return requests, gold.gold_requests(requests, cache)


def ingest_run(spark: SparkSession, layout: Layout, remote: DataFrame, sources: DataFrame, run_id: str,
               per_run: int = 0, page: int = 0, since_year: int | None = None) -> DataFrame:
    """Fetch, append, and only then advance the checkpoints; returns the run's summary.

    What is fetched is stored under ``run_id`` first: it is read from the source once, and
    a repeated run appends the same rows again, which changes nothing.
    """
    page_path, plan_path = layout.at(f"fetched/{run_id}/page"), layout.at(f"fetched/{run_id}/plan")
    state = read_snapshot(spark, layout.at("state"), STATE_SCHEMA)
    if not is_finished(spark, plan_path):
        plan = ingest.source_plan(sources, state, per_run, page)
        ingest.scan_sources(remote, plan, limited=bool(per_run or page)).write.mode("overwrite").parquet(page_path)
        plan.write.mode("overwrite").parquet(plan_path)
        mark_finished(spark, plan_path)
    plan, scanned = spark.read.parquet(plan_path), spark.read.parquet(page_path)
    fetched = ingest.since_year_filter(scanned, since_year)
    newest = silver.newest_per_key(fetched.select(*MESSAGE_COLUMNS), MESSAGE_KEYS, "scraped_at_gmt8")
    append_messages(layout.at("bronze"), newest, run_id)
    write_snapshot(ingest.advance_state(state, ingest.checkpoint_advance(plan, scanned)), layout.at("state"))
    return ingest.sync_summary(plan, fetched)


def _gold_rows(fresh: DataFrame, seen: DataFrame, as_of: str | datetime) -> DataFrame:
    """A run's Gold rows, and a row without values for every other request it has seen."""
    ids = seen.select(text.silver_request_id(F.col("channel"), F.col("message_id")).alias("silver_request_id"), "message_date_gmt8")
    gone = ids.join(fresh.select("silver_request_id"), "silver_request_id", "left_anti").distinct()
    return (union_all(fresh, gone, allow_missing=True).withColumn("refreshed_at", clock.ntz(as_of))
            .select(*GOLD_LOG_SCHEMA.fieldNames()))


def transform_run(spark: SparkSession, layout: Layout, gazetteer: DataFrame, as_of: str | datetime, run_id: str,
                  now: Column, hours: int = 6, geocode_limit: int = 0) -> None:
    """Silver, geocode cache and Gold for everything scraped within the lookback."""
    bronze = read_message_table(spark, layout.at("bronze"), clock.ntz(as_of) - clock.hours(hours))
    batch = runlog.append_run(silver.silver_requests(bronze, as_of, hours), layout.at("silver"), run_id, "scraped_at_gmt8")
    requests = read_silver(spark, layout)
    found = stored(geocode.geocode_run(requests, read_geocodes(spark, layout, now), gazetteer, now, geocode_limit), "geocodes")
    if not found.isEmpty():
        write_snapshot(geocode.geocode_replace(read_snapshot(spark, layout.at("geocodes"), GEOCODE_SCHEMA), found), layout.at("geocodes"))
    fresh = stored(gold.gold_incremental(requests, read_geocodes(spark, layout, now), as_of, hours), "gold")
    seen = silver.lookback_filter(batch, "scraped_at_gmt8", as_of, hours)
    written = runlog.append_run(_gold_rows(fresh, seen, as_of), layout.at("gold"), run_id, "message_date_gmt8")
    days = partials.changed_days(written)
    partials.update_partials(read_gold(spark, layout, days=partials.days_around(days)), layout.at("partials"), days)


def dashboard(spark: SparkSession, layout: Layout, as_of: str | datetime) -> DataFrame:
    """Rolling, live and daily counts; of Gold only the days of the last 15 minutes are read."""
    live = read_gold(spark, layout, clock.ntz(as_of) - clock.minutes(15))
    return partials.dashboard_rows(partials.read_partials(spark, layout.at("partials")), live, as_of)


def full_refresh_run(spark: SparkSession, layout: Layout, as_of: str | datetime, run_id: str, now: Column) -> None:
    """Write Silver and Gold anew from all of Bronze, as after a change of overrides; what
    earlier runs wrote is not read any more."""
    requests, table = full_refresh(read_message_table(spark, layout.at("bronze")), read_geocodes(spark, layout, now))
    runlog.replace_runs(requests, layout.at("silver"), run_id, "scraped_at_gmt8")
    runlog.replace_runs(_gold_rows(stored(table, "gold"), requests, as_of), layout.at("gold"), run_id, "message_date_gmt8")
    partials.write_partials(read_gold(spark, layout), layout.at("partials"))


def overrides_run(spark: SparkSession, layout: Layout, gazetteer: DataFrame, now: Column,
                  preview: bool = False) -> tuple[DataFrame, DataFrame]:
    """Look the override towns up and merge what is found into the overrides table; a
    preview writes nothing. Returns (override rows, towns without a usable hit)."""
    rows, failures = geocode.build_overrides(geocode.town_queries(spark), gazetteer, now)
    if not preview:
        rows = stored(rows, "overrides")
        write_snapshot(geocode.overrides_upsert(read_snapshot(spark, layout.at("overrides"), OVERRIDE_SCHEMA), rows), layout.at("overrides"))
    return rows, failures


def compact_run(spark: SparkSession, layout: Layout, before: str | datetime) -> None:
    """Rewrite the runs that ended before a day as one run, for each table."""
    runlog.compact(spark, layout.at("bronze"), MESSAGE_SCHEMA, "scraped_at_gmt8", before, newest_messages)
    runlog.compact(spark, layout.at("silver"), SILVER_SCHEMA, "scraped_at_gmt8", before, _newest_requests)
    runlog.compact(spark, layout.at("gold"), GOLD_LOG_SCHEMA, "message_date_gmt8", before, _newest_gold)
