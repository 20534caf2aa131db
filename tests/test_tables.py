"""Stored tables, incremental runs and streams, with failures in between."""

import csv
from pathlib import Path

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kerbside.operators import geocode, gold, serving, silver
from kerbside.plans import medallion
from kerbside.plans.catalog import Tables
from kerbside.schemas import GEOCODE_SCHEMA, MESSAGE_COLUMNS, MESSAGE_SCHEMA, OVERRIDE_SCHEMA, STATE_SCHEMA
from kerbside.sources import messages, runlog, snapshots
from kerbside.streaming import streams

SF = "/root/testdata/sf0.001"


def batch(spark, *entries):
    at = ts("2024-01-01 00:00:00")
    return spark.createDataFrame([(c, topic, i, at, text, 1, "u", at) for c, topic, i, text in entries], MESSAGE_SCHEMA)


def stored_messages(spark, table, since=None):
    return rows(messages.read_message_table(spark, table, since).select("channel", "topic_id", "id", "message"))


def test_runs_may_be_repeated_in_any_order(spark, tmp_path):
    table, day = str(tmp_path / "bronze"), F.expr("interval 1 day")
    first = batch(spark, ("a", 7, 1, "x"), ("a", None, 301, "y"), ("b", 1, 1, None))
    second = batch(spark, ("a", None, 1, "edited"), ("a", None, 900, "new")).withColumn("scraped_at_gmt8", F.col("scraped_at_gmt8") + day)
    want = sorted([("a", 7, 1, "edited"), ("a", None, 301, "y"), ("a", None, 900, "new"), ("b", 1, 1, None)], key=repr)
    for run, rows_in in (("r1", first), ("r2", second), ("r1", first), ("r2", second), ("r1", first)):
        messages.append_messages(table, rows_in, run)
    assert stored_messages(spark, table) == want
    assert {p.name for p in Path(table).glob("run=*")} == {"run=r1", "run=r2"}


def test_a_lookback_opens_only_its_days(spark, tmp_path):
    table = str(tmp_path / "bronze")
    for n in range(5):
        shifted = batch(spark, ("a", None, n, "x")).withColumn("scraped_at_gmt8", F.col("scraped_at_gmt8") + F.expr(f"interval {n} days"))
        messages.append_messages(table, shifted, f"r{n}")
    since = F.lit("2024-01-04 05:00:00").cast("timestamp_ntz")
    recent = messages.read_message_table(spark, table, since)
    assert sorted(r.id for r in recent.collect()) == [3, 4]
    plan = spark._jvm.PythonSQLUtils.explainString(recent._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(day" in plan
    scanned = recent._jdf.queryExecution().executedPlan().toString()
    assert len(runlog.read_log(spark, table, MESSAGE_SCHEMA, since).inputFiles()) >= 2 and "day" in scanned


def test_compaction_keeps_the_rows_and_covers_its_runs(spark, tmp_path):
    table = str(tmp_path / "bronze")
    for n in range(4):
        shifted = batch(spark, ("a", 5 if n == 0 else None, 1, f"copy {n}"), ("a", None, 10 + n, "x")).withColumn(
            "scraped_at_gmt8", F.col("scraped_at_gmt8") + F.expr(f"interval {n} days"))
        messages.append_messages(table, shifted, f"r{n}")
    want = stored_messages(spark, table)
    assert runlog.compact(spark, table, MESSAGE_SCHEMA, "scraped_at_gmt8", "2024-01-03 00:00:00", messages.newest_messages) == "compact-r1"
    assert stored_messages(spark, table) == want and runlog.covered_runs(spark, table) == ["r0", "r1"]
    assert runlog.compact(spark, table, MESSAGE_SCHEMA, "scraped_at_gmt8", "2024-01-09 00:00:00", messages.newest_messages) == "compact-r3"
    assert stored_messages(spark, table) == want and len(want) == 5
    assert runlog.read_log(spark, table, MESSAGE_SCHEMA).select("run").distinct().count() == 1


def test_snapshots_are_versioned_and_unfinished_ones_ignored(spark, tmp_path):
    root = str(tmp_path / "state")
    assert snapshots.read_snapshot(spark, root, STATE_SCHEMA).count() == 0
    first = spark.createDataFrame([("a", 1, True)], STATE_SCHEMA)
    assert snapshots.write_snapshot(first, root) == 1
    again = snapshots.read_snapshot(spark, root, STATE_SCHEMA).withColumn("last_message_id", F.lit(5).cast("bigint"))
    assert snapshots.write_snapshot(again, root) == 2
    (tmp_path / "state" / "v=3").mkdir()
    assert rows(snapshots.read_snapshot(spark, root, STATE_SCHEMA)) == [("a", 5, True)]


def test_csv(spark, tmp_path):
    rows_in = batch(spark, ("a", None, 1, ' two\nlines, "quoted" '), ("a", 7, 2, None)).coalesce(1)
    messages.write_csv(rows_in, str(tmp_path / "csv"))
    (path,) = (tmp_path / "csv").glob("*.csv")
    with path.open(newline="", encoding="utf-8") as f:
        header, *lines = list(csv.reader(f))
    assert header == MESSAGE_COLUMNS
    assert lines == [["a", "", "1", "2024-01-01 00:00:00+08:00", ' two\nlines, "quoted" ', "1", "u", "2024-01-01 00:00:00+08:00"],
                     ["a", "7", "2", "2024-01-01 00:00:00+08:00", "", "1", "u", "2024-01-01 00:00:00+08:00"]]


def test_incremental_runs_end_where_a_full_refresh_does(spark, tmp_path):
    """Two ingest runs and one transform of everything equal the full refresh."""
    t, layout = Tables(spark, SF), medallion.Layout(str(tmp_path))
    sources = t.sources.where("topic_id is null").withColumn("channel", F.trim("channel"))
    first = medallion.ingest_run(spark, layout, t.messages, sources, "r1", page=150).collect()[0]
    assert (first.channel_count, first.fetched, first.sync_mode) == (4, 600, "full_history")
    again = medallion.ingest_run(spark, layout, t.messages, sources, "r1", page=150).collect()[0]
    assert again == first
    medallion.ingest_run(spark, layout, t.messages, sources, "r2")
    bronze = messages.read_message_table(spark, layout.at("bronze"))
    assert bronze.count() == t.messages.where("id > 0").count()  # message ids start at 1
    state = {r.state_key: r.initial_backfill_complete for r in snapshots.read_snapshot(spark, layout.at("state"), STATE_SCHEMA).collect()}
    assert set(state.values()) == {True} and len(state) == 4

    bronze_rows = rows(bronze)
    marks = rows(snapshots.read_snapshot(spark, layout.at("state"), STATE_SCHEMA))
    medallion.ingest_run(spark, layout, t.messages, sources, "r1", page=150)  # an old run comes again
    bronze, before = messages.read_message_table(spark, layout.at("bronze")), bronze_rows
    assert rows(bronze) == before
    assert rows(snapshots.read_snapshot(spark, layout.at("state"), STATE_SCHEMA)) == marks

    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    medallion.transform_run(spark, layout, t.gazetteer, "2024-01-31 00:00:00", "r1", now, hours=24 * 60)
    cache = snapshots.read_snapshot(spark, layout.at("geocodes"), GEOCODE_SCHEMA)
    want_silver, want_gold = (rows(df) for df in medallion.full_refresh(bronze, cache))
    assert rows(medallion.read_silver(spark, layout)) == want_silver
    assert rows(medallion.read_gold(spark, layout)) == want_gold and want_gold
    medallion.transform_run(spark, layout, t.gazetteer, "2024-01-31 00:00:00", "r2", now, hours=24)
    assert rows(medallion.read_gold(spark, layout)) == want_gold
    board = rows(serving.dashboard_rows(medallion.read_gold(spark, layout), "2024-01-31 00:00:00"))
    assert rows(medallion.dashboard(spark, layout, "2024-01-31 00:00:00")) == board and any(r[-1] for r in board)
    versions = snapshots.latest_version(spark, layout.at("geocodes"))
    medallion.transform_run(spark, layout, t.gazetteer, "2024-01-31 00:00:00", "r1", now, hours=24 * 60)
    assert rows(medallion.read_gold(spark, layout)) == want_gold
    assert snapshots.latest_version(spark, layout.at("geocodes")) == versions  # nothing new was found
    medallion.compact_run(spark, layout, "2024-03-01 00:00:00")
    assert rows(medallion.read_gold(spark, layout)) == want_gold and rows(medallion.read_silver(spark, layout)) == want_silver


def test_overrides_and_a_full_refresh(spark, tmp_path):
    t, layout = Tables(spark, SF), medallion.Layout(str(tmp_path))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    messages.append_messages(layout.at("bronze"), t.messages, "r1")
    medallion.transform_run(spark, layout, t.gazetteer, "2024-01-31 00:00:00", "r1", now, hours=24 * 60)
    found, missed = medallion.overrides_run(spark, layout, t.gazetteer, now, preview=True)
    assert snapshots.latest_version(spark, layout.at("overrides")) == 0
    assert found.count() + missed.count() == geocode.town_queries(spark).count()
    medallion.overrides_run(spark, layout, t.gazetteer, now)
    assert rows(snapshots.read_snapshot(spark, layout.at("overrides"), OVERRIDE_SCHEMA)) == rows(found)
    medallion.full_refresh_run(spark, layout, "2024-01-31 01:00:00", "full", now)
    requests, table = medallion.full_refresh(messages.read_message_table(spark, layout.at("bronze")), medallion.read_geocodes(spark, layout, now))
    assert rows(medallion.read_silver(spark, layout)) == rows(requests)
    assert rows(medallion.read_gold(spark, layout)) == rows(table)
    assert rows(medallion.dashboard(spark, layout, "2024-01-31 00:00:00")) == rows(serving.dashboard_rows(table, "2024-01-31 00:00:00"))


def test_streams_in_several_batches_equal_the_batch_results(spark, tmp_path):
    t = Tables(spark, SF)
    feed, keyed_feed = tmp_path / "feed", tmp_path / "keyed"
    t.copies.repartitionByRange(3, "scraped_at_gmt8").sortWithinPartitions("scraped_at_gmt8").write.parquet(str(feed))
    stream = streams.read_stream(spark, str(feed), maxFilesPerTrigger="1")
    query = streams.stream_bronze_upsert(stream, str(tmp_path / "bronze"), str(tmp_path / "ck"), {"availableNow": True})
    query.awaitTermination()
    table = messages.read_message_table(spark, str(tmp_path / "bronze"))
    assert rows(table.select("channel", "id", "message")) == rows(silver.latest_copy(t.copies).select("channel", "id", "message"))
    # A new progress folder over the same table: nothing that is stored counts as done or is lost.
    streams.stream_bronze_upsert(stream, str(tmp_path / "bronze"), str(tmp_path / "other"), {"availableNow": True}).awaitTermination()
    assert rows(messages.read_message_table(spark, str(tmp_path / "bronze"))) == rows(table)

    keyed = t.keyed.select(*streams.POST_KEYS, "message_date_gmt8", "channel", "message_id")
    (keyed.repartitionByRange(3, "message_date_gmt8").write.parquet(str(keyed_feed)))
    posts = streams.stream_repost_dedup(streams.read_stream(spark, str(keyed_feed), keyed.schema, maxFilesPerTrigger="1"), delay="40 days")
    done = (posts.writeStream.format("memory").queryName("posts").outputMode("append")
            .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    done.awaitTermination()
    assert spark.table("posts").count() == 0  # a long delay holds everything back
    streams.closing_event(spark, keyed.schema, "message_date_gmt8", "2100-01-01 00:00:00").write.mode("append").parquet(str(keyed_feed))
    posts = streams.stream_repost_dedup(streams.read_stream(spark, str(keyed_feed), keyed.schema, maxFilesPerTrigger="1", latestFirst="false"), delay="40 days")
    (posts.writeStream.format("memory").queryName("posts_now").outputMode("append")
     .option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start().awaitTermination())
    kept = gold.repost_dedup(t.keyed).select("channel", "message_id", *streams.POST_KEYS).distinct()
    assert rows(spark.table("posts_now").select("channel", "message_id", *streams.POST_KEYS)) == rows(kept)
