"""Reposts and joins against brute force, including keys that hold most rows."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import explained, rows, ts
from pyspark.sql import functions as F

from kerbside.operators import gold
from kerbside.plans.catalog import Tables
from kerbside.sources.workspace import stored
from kerbside.schemas import GEOCODE_SCHEMA, GOLD_COLUMNS, SILVER_SCHEMA

KEYED = ("telegram_user_key string, pickup_dedup_location_key string, dropoff_dedup_location_key string, "
         "message_date_gmt8 timestamp_ntz, channel string, message_id long, pickup_formatted_address string")
SF = "/root/testdata/sf0.001"


def brute_force(posts, gap=timedelta(hours=2)):
    kept = []
    for c in posts:
        cid = f"{c[4]}#{c[5]}"
        prior = any(
            e[:3] == c[:3] and None not in c[:3] and (e[3], f"{e[4]}#{e[5]}") < (c[3], cid) and e[3] >= c[3] - gap
            for e in posts)
        if not prior:
            kept.append(c)
    return sorted(kept, key=repr)


def check(spark, posts):
    assert rows(gold.repost_dedup(spark.createDataFrame(posts, KEYED))) == brute_force(posts)


def post(minute, n, user="u", pick="p", drop="d", address=None, second=0, micro=0, channel="c"):
    at = datetime(2024, 1, 1) + timedelta(minutes=minute, seconds=second, microseconds=micro)
    return (user, pick, drop, at, channel, n, address)


def test_a_chain_of_reposts_keeps_only_the_first(spark):
    check(spark, [post(90 * i, i) for i in range(10)])


def test_the_gap_is_inclusive(spark):
    check(spark, [post(30, 1), post(150, 2), post(400, 3), post(520, 4, micro=1), post(0, 9, user="v"), post(120, 8, user="v")])


def test_ties_compare_the_text_of_the_id(spark):
    posts = [post(5, 9), post(5, 10), post(5, 11)]
    check(spark, posts)
    assert rows(gold.repost_dedup(spark.createDataFrame(posts, KEYED)))[0][5] == 10


def test_fan_out_siblings_stay_together(spark):
    check(spark, [post(5, 1, address="x"), post(5, 1, address="y"), post(60, 2, address="x"), post(300, 3, address="x"), post(300, 3, address="z")])


def test_rows_without_a_key_always_stay(spark):
    check(spark, [post(5, 1, pick=None), post(6, 2, pick=None), post(7, 3), post(8, 4)])


@pytest.mark.parametrize("seed", range(4))
def test_random_posts_with_one_hot_key(spark, seed):
    r = random.Random(seed)
    posts = [post(r.randrange(2000), n, user=r.choice("uuuuv"), drop=r.choice("dddde"), second=r.choice([0, 0, 30]))
             for n in range(300)]
    posts += [post(r.choice([0, 120, 240, 360, 600]), 1000 + n, channel=r.choice("ab")) for n in range(40)]
    check(spark, posts)


def test_the_hot_key_is_reduced_before_the_shuffle(spark):
    plan = explained(gold.repost_dedup(spark.createDataFrame([post(1, 1)], KEYED)))
    assert "partial_min" in plan and "partial_max" in plan


def _cache(spark, entries):
    at = ts("2024-01-01 00:00:00")
    full = [(p, p, code, lat, 103.5, addr, p, status, source, 1, None, at, resolved)
            for p, code, lat, addr, status, source, resolved in entries]
    return spark.createDataFrame(full, GEOCODE_SCHEMA)


def test_ranking_keeps_one_row_per_identical_geocode(spark):
    old, new = ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00")
    cache = _cache(spark, [
        ("a", "111111", 1.5, "x", "resolved", "onemap", new), ("a", "111111", 1.5, "x", "resolved", "override", old),
        ("a", "222222", 1.5, "x", "resolved", "onemap", old), ("a", "333333", 1.5, "x", "no_match", "onemap", None),
        ("b", None, None, None, "resolved", "rule", old), ("b", None, None, None, "resolved", "rule", new)])
    got = {(r.normalized_location, r.postal_code, r.resolution_source) for r in gold.rank_geocodes(cache).collect()}
    assert got == {("a", "111111", "override"), ("a", "222222", "onemap"), ("b", None, "rule")}
    got = {(r.normalized_location, r.postal_code) for r in gold.rank_geocodes(cache, override_exclusive=True).collect()}
    assert got == {("a", "111111"), ("b", None)}


def test_ranking_is_limited_before_the_shuffle(spark):
    plan = explained(gold.rank_geocodes(_cache(spark, [])))
    assert "row_number(), 1, Partial" in plan


def test_a_hot_place_is_split_at_run_time(spark):
    """A third of the requests name one place; with a geocode table too large to broadcast,
    the executed plan splits that place's partition."""
    t = Tables(spark, SF)
    parsed = gold.parsed_requests(t.silver_table)
    hot = F.when(F.col("message_id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("message_id")))
    wide = parsed.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n").withColumn("normalized_pickup_location", hot)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = gold.enrich_geocodes(stored(wide.repartition(8), "wide"), gold.rank_geocodes(t.cache))
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_geocodes_are_joined_without_repeating_the_requests(spark):
    t = Tables(spark, SF)
    plan = gold.gold_requests(t.silver_table, t.stored(t.cache, "cache"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 6


def test_gold_columns_and_identity(spark):
    t = Tables(spark, SF)
    g = t.gold_table
    assert g.columns == GOLD_COLUMNS and len(GOLD_COLUMNS) == 35
    assert g.select("gold_request_id").distinct().count() == g.count()
    assert g.where(~F.col("is_canonical_request")).count() == 0


def test_unknown_senders(spark):
    s = spark.createDataFrame([(None, " @Ann ", "c", 1), (None, None, "c", 2), (5, "@x", "c", 3)],
                              "sender_id long, sender_handle string, channel string, message_id long")
    assert [r[0] for r in s.orderBy("message_id").select(gold.user_key()).collect()] == ["@ann", "unknown:c#2", "5"]


@pytest.mark.parametrize("hours", [1, 24, 24 * 40])
def test_an_incremental_run_equals_the_affected_rows_of_a_full_one(spark, hours):
    t = Tables(spark, SF)
    as_of = "2024-01-20 12:00:00"
    full = t.gold_table.where(F.col("scraped_at_gmt8") >= F.lit(as_of).cast("timestamp_ntz") - F.make_interval(hours=F.lit(hours)))
    assert rows(gold.gold_incremental(t.silver_table, t.cache, as_of, hours)) == rows(full)


def test_the_incremental_scan_gets_a_time_bound(spark):
    t = Tables(spark, SF)
    df = gold.gold_incremental(t.silver_table, t.cache, "2024-01-20 12:00:00", 6)
    assert "GreaterThanOrEqual(message_date_gmt8,2024-01" in explained(df)


def test_silver_schema_matches_the_plan(spark):
    t = Tables(spark, SF)
    assert [(f.name, f.dataType) for f in t.silver.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_a_hot_place_is_dealt_by_key(spark, monkeypatch):
    """Whatever adaptive execution does, requests at one place go to several partitions, and the
    join is that of the places: null places, repeated ids and several geocodes included."""
    names = "channel string, message_id long, normalized_pickup_location string, normalized_dropoff_location string"
    requests = spark.createDataFrame(
        [("c", n % 180, "hot" if n % 3 else None, f"p{n}" if n % 4 == 0 else "warm" if n % 4 == 1 else "hot") for n in range(200)]
        + [(None, None, "hot", "nowhere"), ("c", None, None, None)], names)
    ranked = gold.rank_geocodes(_cache(spark, [
        ("hot", "111111", 1.5, "x", "resolved", "onemap", None), ("hot", "222222", 1.5, "x", "resolved", "onemap", None),
        ("warm", "333333", 1.5, "x", "resolved", "onemap", None), ("p4", "444444", 1.5, "x", "resolved", "onemap", None)]))
    plain = rows(gold.enrich_geocodes(requests, ranked))
    monkeypatch.setattr(gold, "HOT_ROWS", 20)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spread = gold.enrich_geocodes(requests, ranked)
        assert spread.columns == gold.enrich_geocodes(requests.limit(1), ranked).columns
        assert rows(spread) == plain
        sizes = spread.where("normalized_dropoff_location = 'hot'").groupBy(F.spark_partition_id()).count()
        assert sizes.count() > 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
