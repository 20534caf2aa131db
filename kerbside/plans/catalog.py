"""The query catalogue: every operator applied to tables derived from the test tables.

Keys are operator names. Every query takes ``(spark, sf_dir)`` and reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import clock, text
from kerbside.operators import geocode, gold, ingest, partials, quality, serving, silver, upsert
from kerbside.operators.joins import union_all
from kerbside.schemas import (DRIVER, GOLD_SCHEMA, HITCHER, MESSAGE_COLUMNS, MESSAGE_KEYS, PAX_COUNTS,
                              RESOLUTION_STATUSES, SILVER_KEYS)
from kerbside.sources import buckets, feed, sample
from kerbside.sources.messages import read_message_table, read_messages, write_csv
from kerbside.sources.sample import AS_OF
from kerbside.sources.workspace import new_folder, stored
from kerbside.streaming import keyed_state, streams

Query = Callable[[SparkSession, str], DataFrame]
PER_RUN, PAGE, SINCE_YEAR = 300, 700, 2024
MERGE_HOURS = 240
RUN_AT = "2024-01-31 01:02:03"
LEGACY_COLUMN = "date"
CLOSING = "2100-01-01 00:00:00"  # after every event
NEW_IDS = 1_000_000_000  # beyond every id of the test tables


class Tables:
    """The derived tables of one scale factor, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _load(self, sql: str) -> DataFrame:
        return sample.load(self.spark, self.sf_dir, sql)

    @cached_property
    def messages(self) -> DataFrame:
        return self._load(sample.MESSAGES)

    @cached_property
    def edits(self) -> DataFrame:
        return self._load(sample.EDITS)

    @cached_property
    def copies(self) -> DataFrame:
        return self._load(sample.MESSAGE_COPIES)

    @cached_property
    def sources(self) -> DataFrame:
        return self._load(sample.SOURCES)

    @cached_property
    def state(self) -> DataFrame:
        return self._load(sample.STATE)

    @cached_property
    def gazetteer(self) -> DataFrame:
        return self._load(sample.GAZETTEER)

    @cached_property
    def cache(self) -> DataFrame:
        return self._load(sample.CACHE)

    @cached_property
    def overrides(self) -> DataFrame:
        return self._load(sample.OVERRIDES)

    @cached_property
    def latest(self) -> DataFrame:
        return silver.latest_copy(self.copies)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.silver_requests(self.copies)

    @cached_property
    def parsed(self) -> DataFrame:
        return gold.parsed_requests(self.silver)

    @cached_property
    def locations(self) -> DataFrame:
        return geocode.distinct_locations(self.silver)

    @cached_property
    def keyed(self) -> DataFrame:
        return gold.dedup_keys(gold.enrich_geocodes(gold.parsed_requests(self.silver_table), gold.rank_geocodes(self.cache)))

    # Stored tables, as deployed: Gold reads Silver twice and serving reads Gold, so each is
    # written once per query to the shared folder instead of being derived again.

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, name)

    @cached_property
    def silver_table(self) -> DataFrame:
        return self.stored(self.silver, "silver")

    @cached_property
    def first_silver_table(self) -> DataFrame:
        return self.stored(silver.silver_requests(self.messages), "silver")

    @cached_property
    def gold(self) -> DataFrame:
        return gold.gold_requests(self.silver_table, self.cache)

    @cached_property
    def gold_table(self) -> DataFrame:
        return self.stored(self.gold, "gold")

    @cached_property
    def plan(self) -> DataFrame:
        return ingest.source_plan(self.sources, self.state, PER_RUN, PAGE)

    @cached_property
    def page(self) -> DataFrame:
        return ingest.scan_sources(self.messages, self.plan)

    @cached_property
    def upsert_batch(self) -> DataFrame:
        """Edits, a fifth of them under new ids and half without their topic."""
        fresh = F.when(F.col("id") % 5 == 0, F.col("id") + NEW_IDS).otherwise(F.col("id"))
        return self.edits.withColumn("topic_id", F.when(F.col("id") % 2 == 0, F.col("topic_id"))).withColumn("id", fresh)

    def bucketed(self, df: DataFrame, name: str, keys: list[str]) -> buckets.BucketedTable:
        """A table of its own in the session's catalogue."""
        return buckets.create_bucketed(df, f"{name}_{uuid.uuid4().hex}", keys)


def _run_at() -> Column:
    return F.lit(RUN_AT).cast("timestamp")


def _wall(df: DataFrame) -> DataFrame:
    """Instants as session wall clock, which is how other engines print them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType()
                       else F.col(f.name) for f in df.schema])


QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


# --- A: sources, sinks, ingest -------------------------------------------------------

@query
def bronze_scan(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "bronze")
    t.messages.write.parquet(path)
    return read_messages(t.spark, path)


@query
def canonical_channel(t: Tables) -> DataFrame:
    typed = F.concat(F.lit("  @@"), F.upper("channel"), F.lit(" "))
    return t.messages.select("id", text.canonical_channel(typed).alias("canonical_channel"))


@query
def sender_handle(t: Tables) -> DataFrame:
    typed = (F.when(F.col("id") % 4 == 0, F.concat(F.lit("@"), "sender_handle")).when(F.col("id") % 4 == 1, F.lit(""))
             .when(F.col("id") % 4 == 2, F.substring("sender_handle", 2, 100)).otherwise(F.col("sender_handle")))
    return t.messages.select("id", text.sender_handle(typed).alias("handle"))


@query
def to_gmt8(t: Tables) -> DataFrame:
    return t.messages.select("id", clock.to_gmt8(F.col("message_date_gmt8")).alias("gmt8"))


@query
def incremental_fetch(t: Tables) -> DataFrame:
    return ingest.incremental_fetch(t.messages, t.sources, t.state, PER_RUN, PAGE, SINCE_YEAR)


@query
def incremental_fetch_pruned(t: Tables) -> DataFrame:
    """The same page from a feed laid out by channel and ids: only folders that hold it are opened."""
    path = new_folder(t.spark, "feed")
    feed.write_feed(t.messages, path, id_block=1000)
    return ingest.incremental_fetch(feed.pending_feed(t.spark, path, t.plan), t.sources, t.state, PER_RUN, PAGE, SINCE_YEAR)


@query
def checkpoint_advance(t: Tables) -> DataFrame:
    return ingest.checkpoint_advance(t.plan, t.page)


@query
def sync_summary(t: Tables) -> DataFrame:
    return ingest.sync_summary(t.plan, ingest.since_year_filter(t.page, SINCE_YEAR))


@query
def checkpoint_rebuild(t: Tables) -> DataFrame:
    return ingest.checkpoint_rebuild(t.messages)


@query
def bronze_upsert(t: Tables) -> DataFrame:
    return upsert.upsert(t.messages, t.upsert_batch, MESSAGE_KEYS, ["topic_id"])


@query
def bronze_upsert_bucketed(t: Tables) -> DataFrame:
    """The same merge into a table bucketed by key: the table is not exchanged."""
    table = t.bucketed(t.messages, "bronze", MESSAGE_KEYS)
    buckets.upsert_bucketed(table, t.stored(t.upsert_batch, "edits"), ["topic_id"])
    return table.read()


@query
def merge_counts(t: Tables) -> DataFrame:
    """What the merge of edits, and of all messages once more, does to the stored rows."""
    return upsert.merge_counts(t.messages, union_all(t.messages, t.upsert_batch), MESSAGE_KEYS, ["topic_id"])


@query
def schema_guard(t: Tables) -> DataFrame:
    legacy = t.messages.drop("sender_handle", "scraped_at_gmt8").withColumnRenamed("message_date_gmt8", LEGACY_COLUMN)
    return upsert.schema_guard(legacy, MESSAGE_COLUMNS)


@query
def csv_sink(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    write_csv(t.messages, path)
    schema = ", ".join(f"{c} string" for c in MESSAGE_COLUMNS)
    return t.spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(path)


@query
def replace_by_key(t: Tables) -> DataFrame:
    return upsert.replace_by_key(t.messages, t.edits, MESSAGE_KEYS)


# --- B: Silver -----------------------------------------------------------------------

@query
def latest_copy(t: Tables) -> DataFrame:
    return t.latest


@query
def lookback_filter(t: Tables) -> DataFrame:
    return silver.lookback_filter(t.copies, "scraped_at_gmt8", AS_OF, 48)


def _of_message(name: str, build: Callable[[Column], Column]) -> Callable[[Tables], DataFrame]:
    return lambda t: t.latest.select("channel", "id", build(F.col("message")).alias(name))


def _register(name: str, build: Callable[[Tables], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))


_register("classify_request", _of_message("request_type", text.classify_request))
_register("extract_pickup", _of_message("pickup", text.extract_pickup))
_register("extract_dropoff", _of_message("dropoff", text.extract_dropoff))
_register("extract_time", _of_message("time_text", text.extract_time))


@query
def extract_pax_fields(t: Tables) -> DataFrame:
    fields = t.latest.select("channel", "id", text.extract_pax_fields(F.col("message")).alias("p"))
    return fields.select("channel", "id", *[F.col(f"p.{c}").alias(f"pax_{c}") for c in ("after", "before", "lo", "hi")])


@query
def strip_flags(t: Tables) -> DataFrame:
    m = F.col("message")
    return t.latest.select("channel", "id", text.strip_flags(text.extract_pickup(m)).alias("pickup"),
                           text.strip_flags(text.extract_dropoff(m)).alias("dropoff"))


@query
def collapse_border_route(t: Tables) -> DataFrame:
    place = text.strip_flags(text.extract_pickup(F.col("message")))
    return t.latest.select("channel", "id", text.collapse_border_route(place).alias("pickup"),
                           text.collapse_border_route(F.lit("SG 🇸🇬-→ jb ")).alias("arrow"),
                           text.collapse_border_route(F.concat(F.lit("sg/"), "channel")).alias("other"))


@query
def resolve_now(t: Tables) -> DataFrame:
    return t.latest.select("channel", "id", text.resolve_now(
        text.extract_time(F.col("message")), F.col("message_date_gmt8")).alias("time_text"))


@query
def resolve_pax(t: Tables) -> DataFrame:
    m = F.col("message")
    return (t.latest.withColumn("fields", text.extract_pax_fields(m))
            .select("channel", "id", text.resolve_pax(m, F.col("fields")).alias("pax_count")))


@query
def parse_status(t: Tables) -> DataFrame:
    return t.silver.groupBy("request_type", "parse_status").agg(F.count(F.lit(1)).alias("requests"))


@query
def silver_requests(t: Tables) -> DataFrame:
    return t.silver


@query
def silver_merge(t: Tables) -> DataFrame:
    return silver.silver_merge(t.first_silver_table, silver.silver_requests(t.copies, AS_OF, MERGE_HOURS))


@query
def silver_merge_bucketed(t: Tables) -> DataFrame:
    table = t.bucketed(t.first_silver_table, "silver", SILVER_KEYS)
    buckets.upsert_bucketed(table, t.stored(silver.silver_requests(t.copies, AS_OF, MERGE_HOURS), "batch"))
    return table.read()


# --- C: places -----------------------------------------------------------------------

@query
def normalize_location(t: Tables) -> DataFrame:
    return t.silver.select("channel", "message_id", text.normalize_location(F.col("pickup_location")).alias("pickup"),
                           text.normalize_location(F.col("dropoff_location")).alias("dropoff"))


@query
def distinct_locations(t: Tables) -> DataFrame:
    return t.locations


@query
def locations_to_resolve(t: Tables) -> DataFrame:
    return geocode.locations_to_resolve(t.silver, t.cache)


@query
def postal_codes_in_text(t: Tables) -> DataFrame:
    twice = F.concat("pickup_location", F.lit(" "), "pickup_location", F.lit(" 1234567"))
    return t.silver.where(F.col("pickup_location").isNotNull()).select(
        "channel", "message_id", F.array_join(text.postal_codes_in_text(twice), ",").alias("codes"))


@query
def explode_postal_codes(t: Tables) -> DataFrame:
    return geocode.explode_postal_codes(t.locations)


@query
def non_specific_rule(t: Tables) -> DataFrame:
    return geocode.non_specific_rule(t.locations)


@query
def search_fallbacks(t: Tables) -> DataFrame:
    longer = F.concat("normalized_location", F.lit(" hotel main entrance"))
    return t.locations.select("normalized_location", F.posexplode(text.search_fallbacks(longer)).alias("pos", "query"))


@query
def choose_place(t: Tables) -> DataFrame:
    return geocode.choose_place(t.gazetteer)


@query
def choose_postal(t: Tables) -> DataFrame:
    return geocode.choose_postal(t.gazetteer)


@query
def resolve_places(t: Tables) -> DataFrame:
    return geocode.resolve_places(t.locations, t.gazetteer)


@query
def resolve_postals(t: Tables) -> DataFrame:
    return geocode.resolve_postals(t.locations, t.gazetteer)


@query
def geocode_row(t: Tables) -> DataFrame:
    return _wall(geocode.geocode_row(geocode.resolve_places(t.locations, t.gazetteer), _run_at()))


@query
def geocode_run(t: Tables) -> DataFrame:
    return _wall(geocode.geocode_run(t.silver_table, t.cache, t.gazetteer, _run_at()))


@query
def geocode_replace(t: Tables) -> DataFrame:
    return _wall(geocode.geocode_replace(t.cache, geocode.geocode_run(t.silver_table, t.cache, t.gazetteer, _run_at())))


@query
def apply_overrides(t: Tables) -> DataFrame:
    return _wall(geocode.apply_overrides(t.cache, t.overrides, _run_at()))


@query
def choose_station(t: Tables) -> DataFrame:
    return geocode.choose_station(t.gazetteer)


@query
def build_overrides(t: Tables) -> DataFrame:
    return _wall(geocode.build_overrides(geocode.town_queries(t.spark), t.gazetteer, _run_at())[0])


@query
def build_overrides_failures(t: Tables) -> DataFrame:
    return geocode.build_overrides(geocode.town_queries(t.spark), t.gazetteer, _run_at())[1]


@query
def overrides_upsert(t: Tables) -> DataFrame:
    reviewed = silver.newest_per_key(
        t.overrides.withColumn("normalized_location", text.normalize_location(F.col("normalized_location"))),
        ["normalized_location"], "updated_at")
    batch = (reviewed.where(F.col("postal_code").cast("bigint") % 3 == 0)
             .withColumn("notes", F.lit("rebuilt")).withColumn("updated_at", _run_at()))
    built = geocode.build_overrides(geocode.town_queries(t.spark), t.gazetteer, _run_at())[0]
    return _wall(geocode.overrides_upsert(reviewed, union_all(batch, built)))


@query
def geocode_status_counts(t: Tables) -> DataFrame:
    return geocode.geocode_status_counts(t.cache)


@query
def override_audit(t: Tables) -> DataFrame:
    return geocode.override_audit(t.cache)


@query
def override_audit_gold(t: Tables) -> DataFrame:
    return geocode.override_audit_gold(t.gold_table)


# --- D: Gold -------------------------------------------------------------------------

@query
def silver_request_id(t: Tables) -> DataFrame:
    return t.silver.select("channel", "message_id",
                           text.silver_request_id(F.col("channel"), F.col("message_id")).alias("silver_request_id"))


@query
def parsed_requests(t: Tables) -> DataFrame:
    return t.parsed


@query
def affected_requests(t: Tables) -> DataFrame:
    return gold.affected_requests(t.silver, AS_OF, 48)


@query
def rank_geocodes(t: Tables) -> DataFrame:
    return gold.rank_geocodes(t.cache)


@query
def enrich_geocodes(t: Tables) -> DataFrame:
    return gold.enrich_geocodes(gold.parsed_requests(t.silver_table), gold.rank_geocodes(t.cache))


@query
def dedup_keys(t: Tables) -> DataFrame:
    return t.keyed.select("silver_request_id", "pickup_formatted_address", "dropoff_formatted_address",
                          "telegram_user_key", "pickup_dedup_location_key", "dropoff_dedup_location_key")


@query
def repost_dedup(t: Tables) -> DataFrame:
    return gold.repost_dedup(t.keyed).select(
        "silver_request_id", "message_date_gmt8", "telegram_user_key", "pickup_dedup_location_key",
        "dropoff_dedup_location_key", "pickup_formatted_address", "dropoff_formatted_address")


@query
def gold_request_id(t: Tables) -> DataFrame:
    return t.keyed.select("silver_request_id", "pickup_formatted_address", "dropoff_formatted_address",
                          gold.gold_request_id().alias("gold_request_id"))


@query
def gold_requests(t: Tables) -> DataFrame:
    return t.gold


@query
def gold_incremental(t: Tables) -> DataFrame:
    return gold.gold_incremental(t.silver_table, t.cache, AS_OF, 48)


@query
def gold_merge(t: Tables) -> DataFrame:
    before = t.stored(gold.gold_requests(t.first_silver_table, t.cache), "gold")
    batch = t.stored(gold.gold_incremental(t.silver_table, t.cache, AS_OF, MERGE_HOURS), "batch")
    return gold.gold_merge(before, batch, t.silver_table, AS_OF, MERGE_HOURS)


@query
def gold_merge_bucketed(t: Tables) -> DataFrame:
    """Bucketed by request: requests seen again are deleted and added in their slices only."""
    table = t.bucketed(gold.gold_requests(t.first_silver_table, t.cache), "gold", ["silver_request_id"])
    batch = t.stored(gold.gold_incremental(t.silver_table, t.cache, AS_OF, MERGE_HOURS), "batch")
    buckets.replace_bucketed(table, t.stored(gold.rescraped(t.silver_table, AS_OF, MERGE_HOURS), "seen"), batch)
    return table.read()


@query
def gold_late_posts(t: Tables) -> DataFrame:
    """Every other post comes late, in no order of time, after Gold was made of the rest and of
    first copies. What it changes in other requests changes too: Gold is that of a full refresh."""
    early = t.stored(t.first_silver_table.where("message_id % 2 = 0"), "early")
    before = t.stored(gold.gold_requests(early, t.cache), "gold")
    changes = gold.late_post_changes(early, t.silver_table, t.cache, gold.changed_requests(early, t.silver_table))
    return gold.apply_changes(before, *changes)


# --- E: serving ----------------------------------------------------------------------

@query
def recent_requests(t: Tables) -> DataFrame:
    return serving.recent_requests(t.gold_table, AS_OF, 720)


@query
def feed_page(t: Tables) -> DataFrame:
    return serving.feed_page(t.gold_table, AS_OF, 43_200)


@query
def route_within(t: Tables) -> DataFrame:
    return serving.route_within(t.gold_table)


@query
def route_cross_border(t: Tables) -> DataFrame:
    return serving.route_cross_border(t.gold_table)


@query
def rolling_counts(t: Tables) -> DataFrame:
    return serving.rolling_counts(t.gold_table, AS_OF)


@query
def live_counts(t: Tables) -> DataFrame:
    return serving.live_counts(t.gold_table, AS_OF)


@query
def daily_counts(t: Tables) -> DataFrame:
    return serving.daily_counts(t.gold_table, AS_OF)


@query
def dashboard_rows(t: Tables) -> DataFrame:
    return serving.dashboard_rows(t.gold_table, AS_OF)


@query
def dashboard_partials(t: Tables) -> DataFrame:
    """Partials of the first copies' Gold, brought up to date for the days that later copies change."""
    root = new_folder(t.spark, "partials")
    before = t.stored(gold.gold_requests(t.first_silver_table, t.cache), "gold")
    partials.write_partials(before, root)
    changed = union_all(t.gold_table.exceptAll(before), before.exceptAll(t.gold_table))
    partials.update_partials(t.gold_table, root, partials.changed_days(changed))
    return partials.dashboard_rows(partials.read_partials(t.spark, root), t.gold_table, AS_OF)


@query
def dashboard_metrics(t: Tables) -> DataFrame:
    def series(points: str, label: str) -> Column:
        return F.array_join(F.transform(points, lambda p: F.concat(
            p[label], F.lit("="), p["total_count"].cast("bigint").cast("string"))), ";")

    metrics = serving.dashboard_metrics(serving.dashboard_rows(t.gold_table, AS_OF))
    return (metrics.withColumn("daily_points", series("daily_points", "day_start_gmt8"))
            .withColumn("rolling_points", series("rolling_points", "bucket_start_gmt8")))


@query
def chart_downsample(t: Tables) -> DataFrame:
    return serving.chart_downsample(serving.rolling_counts(t.gold_table, AS_OF))


@query
def unique_request_count(t: Tables) -> DataFrame:
    return serving.unique_request_count(t.gold_table, AS_OF, 720, DRIVER)


@query
def latest_request_time(t: Tables) -> DataFrame:
    return serving.latest_request_time(t.gold_table, AS_OF, 720, HITCHER)


@query
def recent_summary(t: Tables) -> DataFrame:
    return serving.recent_summary(t.gold_table, AS_OF, 720, serving.CROSS_BORDER, 20)


@query
def map_nodes(t: Tables) -> DataFrame:
    return serving.map_nodes(serving.recent_requests(t.gold_table, AS_OF, 43_200), AS_OF)


@query
def map_node_requests(t: Tables) -> DataFrame:
    return serving.map_node_requests(serving.recent_requests(t.gold_table, AS_OF, 43_200))


@query
def recency_score(t: Tables) -> DataFrame:
    return t.gold_table.select("gold_request_id", clock.recency_score(F.col("message_date_gmt8"), AS_OF).alias("recency_score"))


@query
def service_hours_filter(t: Tables) -> DataFrame:
    return serving.service_hours_filter(t.messages, "message_date_gmt8", start=21, end=7)


# --- F: data quality -----------------------------------------------------------------

@query
def dq_not_null(t: Tables) -> DataFrame:
    checked = {"bronze": t.copies, "geocodes": t.cache, "silver": t.silver_table, "gold": t.gold}
    parts = [quality.dq_not_null(df, quality.NOT_NULL[name]).select(F.lit(name).alias("table_name"), "*")
             for name, df in checked.items()]
    parts.append(quality.dq_not_null(t.copies, ["topic_id", "sender_handle"]).select(F.lit("optional").alias("table_name"), "*"))
    return union_all(*parts)


@query
def dq_in_write(t: Tables) -> DataFrame:
    """Null counts of Silver and Gold out of the jobs that write them."""
    parts = []
    for name, df in (("silver", t.silver), ("gold", t.gold)):
        checks = quality.write_checks(df, quality.NOT_NULL[name], {"request_type": [HITCHER, DRIVER]})
        t.stored(checks.watched, name)
        parts += [(name, c, n) for c, n in checks.null_counts()] + [(name, f"{c} outside its list", n) for c, n in checks.odd_rows().items()]
    return t.spark.createDataFrame(parts, "table_name string, column_name string, null_count bigint")


@query
def dq_unique(t: Tables) -> DataFrame:
    return quality.dq_unique(t.cache, ["normalized_location"])


@query
def dq_accepted_values(t: Tables) -> DataFrame:
    # Values that the derived tables never hold, so that there is something to report.
    many = t.silver.withColumn("pax_count", F.when(F.col("message_id") % 97 == 0, F.col("pax_count") + 10).otherwise(F.col("pax_count")))
    odd = t.cache.withColumn("resolution_status", F.when(F.length("normalized_location") % 5 == 0, F.upper("resolution_status"))
                             .otherwise(F.col("resolution_status")))
    few = quality.dq_accepted_values(many, "pax_count", PAX_COUNTS, F.col("pax_count").isNotNull())
    status = quality.dq_accepted_values(odd, "resolution_status", RESOLUTION_STATUSES)
    return union_all(few.select(F.lit("pax_count").alias("column_name"), F.col("value").cast("string").alias("value"), "row_count"),
                     status.select(F.lit("resolution_status").alias("column_name"), "value", "row_count"))


@query
def dq_duplicate_keys(t: Tables) -> DataFrame:
    return quality.dq_duplicate_keys(t.copies)


@query
def source_profile(t: Tables) -> DataFrame:
    return quality.source_profile(t.copies)


# --- G: streams, run until all input is read ------------------------------------------

def _drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run ``stream`` over all that has arrived since ``folder`` was last used."""
    (stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def _as_stream(df: DataFrame, schema: T.StructType) -> DataFrame:
    folder = new_folder(df.sparkSession, "feed")
    df.write.parquet(folder)
    return streams.read_stream(df.sparkSession, folder, schema)


@query
def stream_bronze_upsert(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "stream-bronze")
    stream = _as_stream(t.copies, t.copies.schema)
    streams.stream_bronze_upsert(stream, f"{folder}/bronze", folder, {"availableNow": True}).awaitTermination()
    return read_message_table(t.spark, f"{folder}/bronze")


@query
def stream_latest_copy(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "stream-latest")
    stream = _as_stream(t.copies, t.copies.schema)
    streams.stream_latest_copy(stream, f"{folder}/latest", folder, {"availableNow": True}).awaitTermination()
    return read_message_table(t.spark, f"{folder}/latest")


@query
def stream_repost_dedup(t: Tables) -> DataFrame:
    keyed = t.keyed.select(*streams.POST_KEYS, "message_date_gmt8", "channel", "message_id")
    folder = new_folder(t.spark, "feed")
    keyed.write.parquet(folder)
    results = new_folder(t.spark, "stream-dedup")
    _drain(streams.stream_repost_dedup(streams.read_stream(t.spark, folder, keyed.schema)), results)
    streams.closing_event(t.spark, keyed.schema, "message_date_gmt8", CLOSING).write.mode("append").parquet(folder)
    return _drain(streams.stream_repost_dedup(streams.read_stream(t.spark, folder, keyed.schema)), results)


@query
def stream_repost_changes(t: Tables) -> DataFrame:
    """Keyed state: every post is decided in its own micro-batch; what stands at the end."""
    keyed = t.keyed.select(*streams.POST_KEYS, "message_date_gmt8", "channel", "message_id")
    changes = _drain(keyed_state.stream_repost_changes(_as_stream(keyed, keyed.schema), delay="40 days"), new_folder(t.spark, "stream-changes"))
    return keyed_state.standing_posts(changes)


@query
def stream_rolling_counts(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "stream-rolling")
    stream = _as_stream(t.gold, GOLD_SCHEMA)
    streams.stream_rolling_counts(stream, f"{folder}/counts", folder, 6, trigger={"availableNow": True}).awaitTermination()
    return streams.read_rolling_counts(t.spark, f"{folder}/counts")
