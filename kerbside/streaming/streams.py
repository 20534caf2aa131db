"""Continuous forms of the batch operators.

All state lives in Spark's own aggregations and is bounded by the watermark; none needs
Python per row or per key. Event time is the instant that a GMT+8 wall clock shows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbside.functions import clock
from kerbside.operators.silver import newest_per_key
from kerbside.schemas import MESSAGE_COLUMNS, MESSAGE_KEYS, MESSAGE_SCHEMA
from kerbside.sources import runlog
from kerbside.sources.messages import append_messages

POST_KEYS = ["telegram_user_key", "pickup_dedup_location_key", "dropoff_dedup_location_key"]


def read_stream(spark: SparkSession, path: str, schema: T.StructType = MESSAGE_SCHEMA, **options: str) -> DataFrame:
    """Files of raw messages as they arrive."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def _query_id(spark: SparkSession, progress: str) -> str:
    """The identity of a stream, which its progress folder keeps over restarts."""
    return spark.read.schema("id string").json(f"{progress}/metadata").first().id


def _appending(stream: DataFrame, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], trigger: dict | None) -> StreamingQuery:
    """Append every micro-batch to the message log at ``path`` under the stream's identity
    and the batch's number: a repeated batch replaces its own folder, and a stream that
    starts anew does not touch what an earlier one wrote."""
    progress = f"{checkpoint}/progress"

    def append(batch: DataFrame, batch_id: int) -> None:
        newest = newest_per_key(prepare(batch.select(*MESSAGE_COLUMNS)), MESSAGE_KEYS, "scraped_at_gmt8")
        append_messages(path, newest, f"{_query_id(batch.sparkSession, progress)}-{batch_id}")

    return (stream.writeStream.foreachBatch(append).option("checkpointLocation", progress)
            .trigger(**(trigger or {"processingTime": "15 minutes"})).start())


def stream_bronze_upsert(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the message table at ``path`` up to date. Its readers take the newest copy, so
    the order in which files arrive does not matter."""
    return _appending(stream, path, checkpoint, lambda batch: batch, trigger)


def stream_latest_copy(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the newest copy with a text of every message at ``path``. An edit however late
    replaces its message; nothing waits for a watermark, and no state is kept."""
    return _appending(stream, path, checkpoint, lambda batch: batch.where(F.col("message").isNotNull()), trigger)


def stream_repost_dedup(stream: DataFrame, gap_hours: int = 2, delay: str = "10 minutes") -> DataFrame:
    """Posts that are no repost, with their key, time and ``channel#id`` (append mode).

    Same rule as ``gold.repost_dedup``. A window of two gaps sliding by one shows each
    slot together with the slot before: its first post stays unless the last post of the
    slot before is within the gap. The two values per key and slot are the whole state,
    and both are formed before the shuffle, so one busy key does not become one busy task.
    Posts with a null in the key pass by. The last slots come out when a later event (see
    ``closing_event``) has moved the watermark past them.
    """
    ts = F.col("message_date_gmt8")
    post = F.struct(ts.alias("ts"), F.concat("channel", F.lit("#"), F.col("message_id").cast("string")).alias("cid"),
                    "channel", "message_id")
    two_slots = F.window("event_time", f"{2 * gap_hours} hours", f"{gap_hours} hours").alias("w")
    own = F.col("event_time") >= F.col("w.start") + clock.hours(gap_hours)
    keyless = F.lit(False)
    for name in [*POST_KEYS, "message_date_gmt8"]:
        keyless = keyless | F.col(name).isNull()
    timed = stream.withColumn("event_time", clock.gmt8_instant(ts)).withWatermark("event_time", delay)
    passing = timed.where(keyless & F.col("channel").isNotNull()).select(*POST_KEYS, "message_date_gmt8", "channel", "message_id")
    return passing.unionByName(
        timed.where(~keyless | F.col("channel").isNull())
        .select(*POST_KEYS, ts, "event_time", post.alias("post"), two_slots)
        .groupBy(*POST_KEYS, "w")
        .agg(F.min(F.when(own, F.col("post"))).alias("first"), F.max(F.when(~own, ts)).alias("previous"))
        .where(F.col("first.channel").isNotNull()
               & (F.col("previous").isNull() | (F.col("previous") < F.col("first.ts") - clock.hours(gap_hours))))
        .select(*POST_KEYS, F.col("first.ts").alias("message_date_gmt8"), "first.channel", "first.message_id")
    )


def closing_event(spark: SparkSession, schema: T.StructType, time: str, after: str) -> DataFrame:
    """One row of nulls but for its time: written to a feed that has ended, it moves the
    watermark past every open window. No result shows it."""
    return spark.range(1).select(*[(clock.ntz(after) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def stream_rolling_counts(stream: DataFrame, path: str, checkpoint: str, window_hours: int, step_min: int = 15,
                          delay: str = "10 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Distinct requests in (b - w, b] per type at every step b, kept at ``path`` (read by
    ``read_rolling_counts``). Every micro-batch adds the windows that it changed, so counts
    show before their window closes; the watermark only bounds the state.

    Spark windows are [start, end); moving the time back by one microsecond turns them
    into (start, end]. An id seen again with the same time is dropped first.
    """
    ended = F.window("moved", f"{window_hours} hours", f"{step_min} minutes").alias("w")
    microsecond = F.make_dt_interval(secs=F.lit("0.000001").cast("decimal(18,6)"))
    counts = (
        stream.withColumn("moved", clock.gmt8_instant(F.col("message_date_gmt8")) - microsecond)
        .withWatermark("moved", delay)
        .dropDuplicates(["gold_request_id", "request_type", "moved"])
        .groupBy("request_type", ended).agg(F.count(F.lit(1)).alias("total_count"))
        .select("request_type", F.lit(window_hours).alias("window_hours"),
                clock.to_gmt8(F.col("w.end"), instant=True).alias("bucket_start"), "total_count")
    )
    progress = f"{checkpoint}/progress"

    def append(batch: DataFrame, batch_id: int) -> None:
        runlog.append_run(batch, path, f"{_query_id(batch.sparkSession, progress)}-{batch_id}", "bucket_start")

    return (counts.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", progress)
            .trigger(**(trigger or {"processingTime": "15 minutes"})).start())


ROLLING_SCHEMA = T.StructType([T.StructField("request_type", T.StringType()), T.StructField("window_hours", T.IntegerType()),
                               T.StructField("bucket_start", T.TimestampNTZType()), T.StructField("total_count", T.LongType())])


def read_rolling_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts as they stand: a window's count only grows while it is open."""
    rows = runlog.read_log(spark, path, ROLLING_SCHEMA)
    return rows.groupBy("request_type", "window_hours", "bucket_start").agg(F.max("total_count").alias("total_count"))
