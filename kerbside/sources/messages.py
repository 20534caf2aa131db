"""The raw message table: declared schema, keyed merge, CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.upsert import require_schema
from kerbside.schemas import MESSAGE_COLUMNS, MESSAGE_KEYS, MESSAGE_SCHEMA
from kerbside.sources import runlog


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages under the declared columns; filters and columns reach the scan."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def newest_messages(rows: DataFrame) -> DataFrame:
    """The newest copy of every message; a topic that later copies lack is kept."""
    return runlog.newest(rows, MESSAGE_KEYS, ["scraped_at_gmt8"], ["topic_id"]).select(*MESSAGE_COLUMNS)


def read_message_table(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The table that ``append_messages`` keeps. With ``since``, a wall clock, only days of
    scraping from its date on are opened, and of the others only keys and topics, for
    messages that have no topic in these days."""
    found = newest_messages(runlog.read_log(spark, path, MESSAGE_SCHEMA, since))
    if since is None:
        return found
    lacking = found.where("topic_id IS NULL").select(*MESSAGE_KEYS)
    copies = runlog.read_log(spark, path, MESSAGE_SCHEMA).where("topic_id IS NOT NULL")
    known = newest_messages(copies.join(lacking, MESSAGE_KEYS, "left_semi")).select(*MESSAGE_KEYS, F.col("topic_id").alias("_known"))
    return (found.join(known, MESSAGE_KEYS, "left").withColumn("topic_id", F.coalesce("topic_id", "_known"))
            .select(*MESSAGE_COLUMNS))


def write_csv(messages: DataFrame, path: str) -> None:
    """CSV with header and fixed column order; quotes doubled, white space kept, times
    with their +08:00 offset. One file per partition, each with its header."""
    def stamped(name: str) -> Column:
        ts = F.col(name)
        whole = F.date_trunc("second", ts).cast("timestamp_ntz") == ts
        text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
        fraction = F.when(whole, F.lit("")).otherwise(F.date_format(ts, ".SSSSSS"))
        return F.concat(text, fraction, F.lit("+08:00")).alias(name)

    stamps = {"message_date_gmt8", "scraped_at_gmt8"}
    (require_schema(messages, MESSAGE_COLUMNS)
     .select(*[stamped(c) if c in stamps else F.col(c) for c in MESSAGE_COLUMNS])
     .write.options(header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
                    ignoreTrailingWhiteSpace=False).csv(path))


def append_messages(path: str, batch: DataFrame, run: str) -> DataFrame:
    """Add a run's messages to the table at ``path``; repeating the run changes nothing."""
    return runlog.append_run(require_schema(batch, MESSAGE_COLUMNS), path, run, "scraped_at_gmt8")
