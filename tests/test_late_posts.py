"""Gold brought up to date by changes equals a full refresh, whatever comes in whatever order."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kerbside.functions import text
from kerbside.operators import gold
from kerbside.plans.catalog import Tables
from kerbside.schemas import GEOCODE_SCHEMA, SILVER_SCHEMA
from kerbside.sources.buckets import create_bucketed, replace_bucketed
from kerbside.sources.workspace import stored

SF = "/root/testdata/sf0.001"
BASE = datetime(2024, 1, 1)


def request(n, minute, user=1, pick="a", drop="b", status="parsed"):
    values = {"channel": "c", "message_id": n, "message": f"m{n}", "parse_status": status, "sender_id": user, "request_type": "hitcher_request",
              "message_date_gmt8": None if minute is None else BASE + timedelta(minutes=minute),
              "scraped_at_gmt8": BASE + timedelta(days=9), "pickup_location": pick, "dropoff_location": drop}
    return tuple(values.get(f.name) for f in SILVER_SCHEMA)


def silver(spark, requests):
    return stored(spark.createDataFrame(requests, SILVER_SCHEMA), "silver")


def updated(spark, table, before, after, cache):
    changes = gold.late_post_changes(before, after, cache, gold.changed_requests(before, after))
    return stored(gold.apply_changes(table, *changes), "gold")


def check(spark, steps):
    """``steps``: one list of requests after another; the first is a full refresh."""
    cache = spark.createDataFrame([], GEOCODE_SCHEMA)
    before = silver(spark, steps[0])
    table = stored(gold.gold_requests(before, cache), "gold")
    for requests in steps[1:]:
        after = silver(spark, requests)
        table = updated(spark, table, before, after, cache)
        before = after
    assert rows(table) == rows(gold.gold_requests(before, cache))
    return table


def test_a_late_first_post_retracts_the_later_one(spark):
    later = request(2, 100)
    table = check(spark, [[later], [later, request(1, 50)]])
    assert [r.message_id for r in table.collect()] == [1]


def test_it_reaches_the_next_slot_and_no_further(spark):
    posts = [request(2, 110), request(3, 130), request(4, 250), request(5, 490)]
    before, after = silver(spark, posts), silver(spark, [*posts, request(1, 5)])
    retracted, fresh = gold.late_post_changes(before, after, spark.createDataFrame([], GEOCODE_SCHEMA), gold.changed_requests(before, after))
    assert sorted(r[0] for r in retracted.collect()) == sorted(
        r[0] for r in gold.parsed_requests(after).where("message_date_gmt8 < '2024-01-01 04:00:00'").select("silver_request_id").collect())
    assert sorted(r.message_id for r in fresh.collect()) == [1]


def test_an_edit_frees_the_post_it_had_suppressed(spark):
    table = check(spark, [[request(1, 10), request(2, 20)], [request(1, 10, pick="z"), request(2, 20)]])
    assert sorted(r.message_id for r in table.collect()) == [1, 2]


def test_a_request_that_is_no_longer_parsed_or_has_no_time(spark):
    check(spark, [[request(1, 10), request(2, 20), request(3, None)], [request(1, 10, status="missing_time"), request(2, 20), request(3, None, pick="q")]])
    check(spark, [[request(1, 10)], [request(1, 10), request(2, None), request(3, None)], [request(2, 15)]])


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_arrival_edits_and_removals(spark, seed):
    r = random.Random(seed)
    pool = [request(n, r.choice([None, *[r.randrange(900)] * 30]), r.choice([1, 1, 1, 2, None]), r.choice("aab"), r.choice("bbc")) for n in range(120)]
    r.shuffle(pool)
    have, steps = {}, []
    for start in range(0, 120, 40):
        have |= {p[1] if isinstance(p[1], int) else i: p for i, p in enumerate(pool[start:start + 40], start)}
        for key in r.sample(sorted(have), 5):  # edits: another time, another place
            number = dict(zip([f.name for f in SILVER_SCHEMA], have[key], strict=True))["message_id"]
            have[key] = request(number, r.randrange(900), 1, r.choice("ab"), "b", r.choice(["parsed", "parsed", "missing_time"]))
        for key in r.sample(sorted(have), 2):
            del have[key]
        steps.append(list(have.values()))
    check(spark, steps)


def test_a_new_geocode_changes_the_requests_at_its_place(spark):
    """Two places turn out to have one postal code, so posts there become reposts."""
    requests = silver(spark, [request(1, 10, pick="a"), request(2, 20, pick="a2"), request(3, 30, pick="q")])
    at = datetime(2024, 1, 1)
    cache = spark.createDataFrame([(p, p, "111111", 1.3, 103.8, "x", p, "resolved", "onemap", 1, None, at, at) for p in ("A", "A2")], GEOCODE_SCHEMA)
    parsed = gold.parsed_requests(requests)
    names = [r[0] for r in parsed.select("normalized_pickup_location").where("message_id < 3").distinct().collect()]
    cache = cache.replace({"A": names[0], "A2": names[1]}, subset=["normalized_location"])
    table = stored(gold.gold_requests(requests, spark.createDataFrame([], GEOCODE_SCHEMA)), "gold")
    changes = gold.late_post_changes(requests, requests, cache, gold.requests_at(requests, cache))
    got = gold.apply_changes(table, *changes)
    assert rows(got) == rows(gold.gold_requests(requests, cache)) and got.count() == 2 and table.count() == 3


def test_a_bucketed_gold_table_takes_the_changes(spark):
    t = Tables(spark, SF)
    early = stored(t.silver_table.where("message_id % 3 > 0"), "early")
    table = create_bucketed(gold.gold_requests(early, t.cache), "late_gold", ["silver_request_id"], 8, 4)
    replace_bucketed(table, *gold.late_post_changes(early, t.silver_table, t.cache, gold.changed_requests(early, t.silver_table)))
    assert rows(table.read()) == rows(t.gold)


def test_a_request_whose_time_moves_by_a_microsecond_is_a_changed_one(spark):
    """Nulls keep their place too: a value that moves to the next column is a change."""
    at = ts("2024-01-01 00:00:00")
    row = ("c", None, 1, at, "m", None, None, at, "driver_request", "a", None, "b", None, "parsed")
    before = spark.createDataFrame([row, ("c", *row[1:2], 2, *row[3:]), ("c", *row[1:2], 3, *row[3:])], SILVER_SCHEMA)
    moved = ("c", None, 1, at.replace(microsecond=1), *row[4:])
    shifted = (*row[:2], 2, *row[3:9], None, "a", *row[11:])
    after = spark.createDataFrame([moved, shifted, (*row[:2], 3, *row[3:])], SILVER_SCHEMA)
    ids = {r[0] for r in before.where("message_id < 3").select(text.silver_request_id(F.col("channel"), F.col("message_id"))).collect()}
    assert {r[0] for r in gold.changed_requests(before, after).collect()} == ids
