"""Declared schemas and enumerations; nothing in this package infers a schema."""

from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType(), False),
    T.StructField("topic_id", T.LongType()),
    T.StructField("id", T.LongType(), False),
    T.StructField("message_date_gmt8", T.TimestampNTZType(), False),
    T.StructField("message", T.StringType()),
    T.StructField("sender_id", T.LongType()),
    T.StructField("sender_handle", T.StringType()),
    T.StructField("scraped_at_gmt8", T.TimestampNTZType(), False),
])
MESSAGE_COLUMNS = MESSAGE_SCHEMA.fieldNames()
MESSAGE_KEYS = ["channel", "id"]

STATE_SCHEMA = T.StructType([
    T.StructField("state_key", T.StringType(), False),
    T.StructField("last_message_id", T.LongType(), False),
    T.StructField("initial_backfill_complete", T.BooleanType(), False),
])

SOURCE_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType(), False),
    T.StructField("topic_id", T.LongType()),
    T.StructField("state_key", T.StringType(), False),
])

SILVER_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("topic_id", T.LongType()),
    T.StructField("message_id", T.LongType()),
    T.StructField("message_date_gmt8", T.TimestampNTZType()),
    T.StructField("message", T.StringType()),
    T.StructField("sender_id", T.LongType()),
    T.StructField("sender_handle", T.StringType()),
    T.StructField("scraped_at_gmt8", T.TimestampNTZType()),
    T.StructField("request_type", T.StringType()),
    T.StructField("pickup_location", T.StringType()),
    T.StructField("dropoff_location", T.StringType()),
    T.StructField("request_time_text", T.StringType()),
    T.StructField("pax_count", T.IntegerType()),
    T.StructField("parse_status", T.StringType()),
])
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()
SILVER_KEYS = ["channel", "message_id"]

GAZETTEER_SCHEMA = T.StructType([
    T.StructField("query", T.StringType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("postal", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("searchval", T.StringType()),
])

GEOCODE_SCHEMA = T.StructType([
    T.StructField("normalized_location", T.StringType(), False),
    T.StructField("original_location", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("formatted_address", T.StringType()),
    T.StructField("search_value", T.StringType()),
    T.StructField("resolution_status", T.StringType(), False),
    T.StructField("resolution_source", T.StringType(), False),
    T.StructField("result_count", T.IntegerType(), False),
    T.StructField("error_message", T.StringType()),
    T.StructField("attempted_at", T.TimestampType(), False),
    T.StructField("resolved_at", T.TimestampType()),
])
GEOCODE_COLUMNS = GEOCODE_SCHEMA.fieldNames()

OVERRIDE_SCHEMA = T.StructType([
    T.StructField("normalized_location", T.StringType(), False),
    T.StructField("postal_code", T.StringType(), False),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("formatted_address", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])
OVERRIDE_COLUMNS = OVERRIDE_SCHEMA.fieldNames()

# One side of a request after geocoding: source column -> output suffix.
GEOCODE_SUFFIXES = {
    "postal_code": "postal_code",
    "formatted_address": "formatted_address",
    "latitude": "latitude",
    "longitude": "longitude",
    "search_value": "search_value",
    "resolution_source": "resolution_source",
    "result_count": "geocode_result_count",
    "error_message": "geocode_error_message",
}
def _side_fields(side: str) -> list[T.StructField]:
    kinds = {f.name: f.dataType for f in GEOCODE_SCHEMA}
    return [T.StructField(f"{side}_{suffix}", kinds[c]) for c, suffix in GEOCODE_SUFFIXES.items()]


GOLD_SCHEMA = T.StructType([
    T.StructField("gold_request_id", T.StringType()),
    T.StructField("silver_request_id", T.StringType()),
    T.StructField("is_canonical_request", T.BooleanType()),
    T.StructField("telegram_user_key", T.StringType()),
    *[SILVER_SCHEMA[c] for c in ("channel", "topic_id", "message_id", "message_date_gmt8", "sender_id",
                                 "sender_handle", "request_type", "pickup_location", "dropoff_location")],
    T.StructField("normalized_pickup_location", T.StringType()),
    T.StructField("normalized_dropoff_location", T.StringType()),
    *_side_fields("pickup"),
    *_side_fields("dropoff"),
    *[SILVER_SCHEMA[c] for c in ("request_time_text", "pax_count", "scraped_at_gmt8", "message")],
])
GOLD_COLUMNS = GOLD_SCHEMA.fieldNames()

FEED_COLUMNS = [
    "gold_request_id", "silver_request_id", "channel", "topic_id", "message_id",
    "message_date_gmt8", "scraped_at_gmt8", "sender_id", "sender_handle", "request_type",
    "request_time_text", "pax_count", "pickup_location", "dropoff_location",
    "normalized_pickup_location", "normalized_dropoff_location",
    *(f"{side}_{part}" for side in ("pickup", "dropoff")
      for part in ("postal_code", "latitude", "longitude", "formatted_address", "resolution_source")),
    "message",
]

HITCHER, DRIVER = "hitcher_request", "driver_request"
REQUEST_TYPES = [DRIVER, HITCHER]
PARSE_STATUSES = ["missing_pickup", "missing_dropoff", "missing_time", "parsed"]
RESOLUTION_STATUSES = ["resolved", "no_match", "ambiguous", "error"]
RESOLUTION_SOURCES = ["onemap", "rule", "override"]
PAX_COUNTS = list(range(1, 11))
