"""Repost suppression with keyed state: late posts, restarts, expiry."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows

from kerbside.operators import gold
from kerbside.streaming import keyed_state, streams

SCHEMA = ("telegram_user_key string, pickup_dedup_location_key string, dropoff_dedup_location_key string, "
          "message_date_gmt8 timestamp_ntz, channel string, message_id long")
BASE = datetime(2024, 1, 1)


def post(minute, n, user="u", pick="p", drop="d", channel="c"):
    return (user, pick, drop, None if minute is None else BASE + timedelta(minutes=minute), channel, n)


def brute(posts, gap):
    """Posts (at, cid) without an earlier one at most ``gap`` before."""
    return {p for p in posts if not any(q < p and p[0] - q[0] <= gap for q in posts)}


@pytest.mark.parametrize("seed", range(20))
def test_any_order_of_posts_leaves_what_all_pairs_leave(seed):
    r = random.Random(seed)
    posts = [(r.randrange(60), f"c#{n}", "c", n) for n in range(r.randrange(1, 40))]
    posts += r.sample(posts, len(posts) // 4)  # repeats
    runs, standing = [], set()
    for i, p in enumerate(posts):
        for change, changed in keyed_state.place_post(runs, p, 5):
            (standing.add if change == keyed_state.ADD else standing.remove)(changed)
        assert {s[:2] for s in standing} == brute({q[:2] for q in posts[:i + 1]}, 5)
        assert {tuple(run[:2]) for run in runs} == {s[:2] for s in standing} and runs == sorted(runs)


def run(spark, feed, folder, delay):
    """Read what has arrived since the last run, one file a micro-batch; the log of all changes."""
    changes = keyed_state.stream_repost_changes(streams.read_stream(spark, str(feed), spark.createDataFrame([], SCHEMA).schema, maxFilesPerTrigger="1"), delay=delay)
    query = (changes.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{folder}/out"), query


def arrive(spark, feed, posts):
    spark.createDataFrame(posts, SCHEMA).coalesce(1).write.mode("append").parquet(str(feed))


def state_rows(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_each_post_is_out_at_once_and_late_ones_take_back(spark, tmp_path):
    feed = tmp_path / "feed"
    arrive(spark, feed, [post(200, 2), post(500, 5)])
    changes, _ = run(spark, feed, tmp_path, "10 days")
    assert {(r.message_id, r.change) for r in changes.collect()} == {(2, "add"), (5, "add")}  # nothing waits for a slot
    arrive(spark, feed, [post(100, 1), post(250, 3), post(None, 9), post(100, 8, pick=None)])  # after a restart
    changes, _ = run(spark, feed, tmp_path, "10 days")
    log = sorted((r.message_id, r.change) for r in changes.collect())
    assert log == [(1, "add"), (2, "add"), (2, "retract"), (5, "add"), (8, "add"), (9, "add")]
    assert sorted(r.message_id for r in keyed_state.standing_posts(changes).collect()) == [1, 5, 8, 9]


def test_batches_in_any_order_equal_the_batch_rule(spark, tmp_path):
    r = random.Random(4)
    posts = [post(r.randrange(3000), n, user=r.choice("uuuuv"), drop=r.choice("dde"), channel=r.choice("ab")) for n in range(250)]
    posts += [post(r.choice([0, 120, 240]), 1000 + n) for n in range(20)]
    r.shuffle(posts)
    feed = tmp_path / "feed"
    for start in range(0, len(posts), 90):
        arrive(spark, feed, posts[start:start + 90])
        changes, _ = run(spark, feed, tmp_path, "10 days")
    assert changes.where("change = 'retract'").count() > 0
    want = gold.repost_dedup(spark.createDataFrame(posts, SCHEMA)).distinct()
    assert rows(keyed_state.standing_posts(changes).select(*want.columns)) == rows(want)


def test_state_expires_behind_the_watermark(spark, tmp_path):
    feed = tmp_path / "feed"
    arrive(spark, feed, [post(n, n, user=f"u{n}") for n in range(50)])
    _, query = run(spark, feed, tmp_path, "10 minutes")
    assert state_rows(query) >= 50
    for minute, user in ((1000, "late"), (1001, "later")):  # the second batch sees the first one's watermark
        arrive(spark, feed, [post(minute, minute, user=user)])
        changes, query = run(spark, feed, tmp_path, "10 minutes")
    assert state_rows(query) < 50 / 2
    assert changes.count() == 52 and changes.where("change = 'retract'").count() == 0


def test_a_busy_key_keeps_few_runs(spark, tmp_path):
    feed = tmp_path / "feed"
    arrive(spark, feed, [post(n % 300, n) for n in range(3000)])
    changes, query = run(spark, feed, tmp_path, "10 days")
    assert [(r.message_id, r.change) for r in changes.collect()] == [(0, "add")]
