"""A message feed laid out by channel and range of ids, so that a fetch opens what it takes.

Folders are ``channel=<name>/id_block=<n>``. A small table beside them says how many
messages each folder holds and the largest id. A run joins its plan with that table and
gets the few folders its sources still need: none of a source that has read everything,
and of a source with a limit only as many as hold that many messages. The join of the feed
with this list prunes partitions while the query runs (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.upsert import require_schema
from kerbside.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from kerbside.sources.workspace import path_exists, stored

ID_BLOCK = 1_000_000  # ids of one folder
MOST_FOLDERS, FOLDER_ROWS = 1024, 100_000  # folders of a new feed, and messages of one from which there may be more

_FEED = T.StructType([*[f for f in MESSAGE_SCHEMA if f.name != "channel"], T.StructField("channel", T.StringType()),
                      T.StructField("id_block", T.LongType())])


def _blocks_per_folder(path: str, blocks: DataFrame) -> int:
    """How many ranges of ids share a folder: as the feed has it, and for a new feed one, or
    the least power of two that keeps the folders of ``blocks`` from being too many."""
    spark = blocks.sparkSession
    if path_exists(spark, f"{path}/blocks"):
        return spark.read.schema("blocks_per_folder long").parquet(f"{path}/blocks").agg(F.max("blocks_per_folder")).first()[0] or 1
    folders, rows, least, most = blocks.agg(F.count(F.lit(1)), F.sum("n"), F.min("id_block"), F.max("id_block")).first()
    many, wide = max(MOST_FOLDERS, (rows or 0) // FOLDER_ROWS), 1
    while folders > many and wide <= most - least:
        wide *= 2
        folders = blocks.select("channel", F.floor(F.col("id_block") / F.lit(wide))).distinct().count()
    return wide


def write_feed(messages: DataFrame, path: str, id_block: int = ID_BLOCK) -> None:
    """Append ``messages`` to the feed. Rows go to their folders in a few tasks each, and the
    table of folders gets their counts; equal counts of two runs add up.

    A folder holds ``id_block`` ids. Where that makes more than ``MOST_FOLDERS`` folders, of
    fewer than ``FOLDER_ROWS`` messages on average, the run that begins the feed has several
    such ranges share one, and later runs keep to it: files and their listing would else
    cost more than the messages."""
    rows = require_schema(messages, MESSAGE_COLUMNS).withColumn("id_block", F.floor(F.col("id") / F.lit(id_block)).cast("long"))
    rows = stored(rows, "feed")  # counted and written from one reading of the source
    blocks = stored(rows.groupBy("channel", "id_block").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("max_id")), "feed-blocks")
    wide = _blocks_per_folder(path, blocks)
    folder = F.floor(F.col("id_block") / F.lit(wide)).cast("long")
    (rows.withColumn("id_block", folder).repartition("channel", "id_block").write.mode("append")
     .partitionBy("channel", "id_block").parquet(f"{path}/rows"))
    (blocks.groupBy("channel", folder.alias("id_block")).agg(F.sum("n").alias("n"), F.max("max_id").alias("max_id"))
     .withColumn("blocks_per_folder", F.lit(wide).cast("long")).write.mode("append").parquet(f"{path}/blocks"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """All messages, with their ``id_block``."""
    return spark.read.schema(_FEED).parquet(f"{path}/rows").select(*MESSAGE_COLUMNS, "id_block")


def wanted_blocks(spark: SparkSession, path: str, plan: DataFrame) -> DataFrame:
    """(channel, id_block) of the folders a plan (``ingest.source_plan``) needs, once each.

    A source of a whole channel with a limit stops at the folder that completes it; the
    first folder may hold ids already read, so it is not counted. A source of one topic
    takes all folders above its mark, since folders do not say how many rows a topic has.
    """
    blocks = spark.read.parquet(f"{path}/blocks").groupBy("channel", "id_block").agg(F.sum("n").alias("n"), F.max("max_id").alias("max_id"))
    needed = blocks.join(plan.select("state_key", "channel", "source_topic_id", "last_message_id", "row_limit"), "channel").where("max_id > last_message_id")
    order = Window.partitionBy("state_key").orderBy("id_block")
    counted = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)) - F.first("n").over(order)
    needed = needed.withColumn("_before", F.coalesce(counted, F.lit(0)))
    return needed.where("row_limit IS NULL OR source_topic_id IS NOT NULL OR _before < row_limit").select("channel", "id_block").distinct()


def pending_feed(spark: SparkSession, path: str, plan: DataFrame) -> DataFrame:
    """The messages of the folders a plan needs: what ``ingest.scan_sources`` has to see. The
    list of folders is stored, so its size is known and it is broadcast if that allows it."""
    wanted = stored(wanted_blocks(spark, path, plan), "wanted-blocks").where("id_block IS NOT NULL AND id_block > -1")
    return read_feed(spark, path).join(wanted, ["channel", "id_block"], "left_semi").select(*MESSAGE_COLUMNS)
