import random
from datetime import datetime, timedelta

import pytest
from conftest import explained, rows, ts
from pyspark.sql import functions as F

from kerbside.operators import quality, serving
from kerbside.plans.catalog import Tables
from kerbside.schemas import DRIVER, FEED_COLUMNS, HITCHER
from kerbside.sources.sample import AS_OF

GOLD = "gold_request_id string, request_type string, message_date_gmt8 timestamp_ntz"
SF = "/root/testdata/sf0.001"


def small_gold(spark, entries):
    return spark.createDataFrame(entries, GOLD)


@pytest.mark.parametrize("seed", range(3))
def test_rolling_counts_equal_the_range_join(spark, seed):
    """Ids repeat across steps and types, times fall on and next to step borders."""
    r, end = random.Random(seed), datetime(2024, 1, 2, 10, 7)
    times = [end - timedelta(minutes=15 * r.randrange(-2, 60), microseconds=r.choice([-1, 0, 0, 1])) for _ in range(40)]
    times += [end - timedelta(seconds=r.randrange(50_000)) for _ in range(120)]
    entries = [(f"id{r.randrange(60)}", r.choice([HITCHER, DRIVER, "other"]), t) for t in times] + [(None, HITCHER, end)]
    got = {(x.request_type, x.window_hours, x.bucket_start): x.total_count for x in serving.rolling_counts(
        small_gold(spark, entries), "2024-01-02 10:07:33", windows=(1, 2, 3), span_hours=8).collect()}
    want = {}
    for kind in (HITCHER, DRIVER):
        for w in (1, 2, 3):
            for k in range(33):
                b = end - timedelta(minutes=15 * k)
                want[kind, w, b] = len({i for i, t, at in entries if i and t == kind and b - timedelta(hours=w) < at <= b})
    assert got == want


def test_rolling_counts_default_size_and_steps(spark):
    df = serving.rolling_counts(small_gold(spark, []), AS_OF)
    assert df.count() == 9608 and df.agg(F.sum("total_count")).collect()[0][0] == 0
    with pytest.raises(ValueError, match="whole numbers of steps"):
        serving.rolling_counts(small_gold(spark, []), AS_OF, windows=(1,), step_min=7)


def test_live_and_daily(spark):
    at = ts("2024-01-02 10:00:00")
    entries = [("a", HITCHER, at), ("a", HITCHER, at), ("b", HITCHER, at - timedelta(minutes=15)), ("c", HITCHER, at - timedelta(minutes=16)),
               ("d", HITCHER, at + timedelta(hours=20)), ("e", DRIVER, at - timedelta(days=13, hours=10)), ("f", DRIVER, at - timedelta(days=14))]
    g = small_gold(spark, entries)
    assert {r.request_type: r.total_count for r in serving.live_counts(g, at).collect()} == {HITCHER: 4, DRIVER: 0}
    days = {(r.request_type, str(r.day_start)): r.total_count for r in serving.daily_counts(g, at).collect()}
    assert len(days) == 28 and sum(days.values()) == 4
    assert days[HITCHER, "2024-01-02 00:00:00"] == 3 and days[DRIVER, "2023-12-20 00:00:00"] == 1


def test_dashboard_metrics_without_rows_of_a_kind(spark):
    rows = spark.createDataFrame([("rolling", HITCHER, 1, "2024-01-01 00:15:00", 3.0), ("rolling", HITCHER, 1, "2024-01-01 00:00:00", 1.0)],
                                 "metric string, request_type string, window_hours int, bucket_start_gmt8 string, metric_value double")
    (r,) = serving.dashboard_metrics(rows).where(F.col("request_type") == HITCHER).where("window_hours = 1").collect()
    assert (r.average_rolling_total, r.current_rolling_total, r.live_15m_count) == (2.0, 3.0, 0.0)
    assert [p.total_count for p in r.rolling_points] == [1.0, 3.0]


def test_chart_keeps_the_last_point(spark):
    rolling = serving.rolling_counts(small_gold(spark, []), AS_OF)
    chart = serving.chart_downsample(rolling)
    last = rolling.agg(F.max("bucket_start")).collect()[0][0]
    per = {(r.window_hours, r.n, r.newest) for r in chart.groupBy("request_type", "window_hours").agg(
        F.count("*").alias("n"), F.max("bucket_start").alias("newest")).collect()}
    assert per == {(w, 50, last) for w in (1, 2, 3, 6)}


def test_feed_and_summary(spark):
    t = Tables(spark, SF)
    g = t.gold_table
    recent = serving.recent_requests(g, AS_OF, 43_200, limit=7)
    assert recent.columns == FEED_COLUMNS and len(FEED_COLUMNS) == 27 and recent.count() == 7
    times = [r.message_date_gmt8 for r in recent.collect()]
    assert times == sorted(times, reverse=True)
    s = serving.recent_summary(g, AS_OF, tab="nonsense").collect()[0]
    assert (s.minutes, s.tab) == (360, "within-sg")
    assert serving.recent_summary(g, AS_OF, 10_000).collect()[0].minutes == 10_000
    for minutes, limit in ((0, None), (-5, 3), (60, 0)):
        with pytest.raises(ValueError):
            serving.recent_summary(g, AS_OF, minutes, limit=limit)
    ordered = [r.message_date_gmt8 for r in serving.recent_requests(g, AS_OF, 43_200, ordered=True).collect()]
    assert ordered == sorted(ordered, reverse=True) and ordered[:7] == times
    assert rows(serving.feed_page(g, AS_OF, 43_200)) == rows(serving.recent_requests(g, AS_OF, 720))
    assert serving.feed_page(g, AS_OF, -3).count() == serving.recent_requests(g, AS_OF, 1).count()
    whole = serving.recent_requests(g, AS_OF, 43_200)
    assert whole.count() == serving.recent_summary(g, AS_OF, 43_200).collect()[0]["count"]
    for tab in (serving.WITHIN, serving.CROSS_BORDER):
        s = serving.recent_summary(g, AS_OF, 600, tab, 3).collect()[0]
        assert s["count"] == serving.recent_requests(g, AS_OF, 600, tab, 3).count()
        assert s.total_count == serving.unique_request_count(g, AS_OF, 600, HITCHER).collect()[0][0]
        assert s.active_driver_count == serving.unique_request_count(g, AS_OF, 60, DRIVER).collect()[0][0]
        assert s.latest_post_at == serving.latest_request_time(g, AS_OF, 600).collect()[0][0]


def test_routes(spark):
    columns = ("pickup_resolution_source string, dropoff_resolution_source string, pickup_postal_code string, dropoff_postal_code string, "
               "normalized_pickup_location string, normalized_dropoff_location string, pickup_location string, dropoff_location string")
    df = spark.createDataFrame([
        ("onemap", "rule", "123456", "654321", "a", "b", "A", "B"), ("onemap", "rule", "123456", None, "a", "b", "A", "B"),
        ("onemap", "rule", "123456", "654321", "tommy", "b", "A", "B"), ("onemap", "rule", "123456", "654321", None, "b", "Johor", "B")], columns)
    assert serving.route_within(df).count() == 3
    assert serving.route_cross_border(df).count() == 3


def test_feed_filters_reach_the_scan(spark):
    g = Tables(spark, SF).gold_table
    plan = explained(serving.recent_requests(g, AS_OF, limit=7))
    assert "GreaterThanOrEqual(message_date_gmt8" in plan and "EqualTo(request_type,hitcher_request)" in plan
    assert "TakeOrderedAndProject" in plan
    counted = explained(serving.unique_request_count(g, AS_OF, 60, DRIVER))
    assert "formatted_address" not in counted


def test_nodes(spark):
    g = Tables(spark, SF).gold_table
    recent = serving.recent_requests(g, AS_OF, 43_200)
    nodes, members = serving.map_nodes(recent, AS_OF).collect(), serving.map_node_requests(recent).collect()
    assert sum(n.request_count for n in nodes) == len(members) == 2 * recent.count()
    assert {n.node_id for n in nodes} == {m.node_id for m in members}
    assert all(n.node_id.startswith(f"{n.kind}:") and 0 <= n.recency_score <= 1 for n in nodes)


def test_quality(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 3), (None, 2, 11)], "k string, id int, pax int")
    assert {tuple(r) for r in quality.dq_not_null(df, ["k", "id", "pax"]).collect()} == {("k", 1), ("id", 0), ("pax", 1)}
    assert [tuple(r) for r in quality.dq_unique(df, ["k"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.dq_duplicate_keys(df, ["k", "id"]).collect()] == [("a", 1, 2)]
    assert [tuple(r) for r in quality.dq_accepted_values(df, "pax", list(range(1, 11)), F.col("pax").isNotNull()).collect()] == [(11, 1)]


def test_metrics_without_data_are_zero(spark):
    got = serving.dashboard_metrics(serving.dashboard_rows(small_gold(spark, []), AS_OF).where("false")).collect()
    assert len(got) == 8 and all(r.live_15m_count == r.average_rolling_total == r.current_rolling_total == 0 for r in got)
    assert all(r.daily_points == r.rolling_points == [] for r in got)


def test_checks_in_the_write_pass(spark, tmp_path):
    entries = [(None if i % 7 == 0 else f"k{i}", i, 99 if i % 10 == 3 else i % 3) for i in range(1000)]
    df = spark.createDataFrame(entries, "k string, id int, pax int").repartition(4)
    checks = quality.write_checks(df, ["k", "id"], {"pax": [0, 1, 2]})
    spark.sparkContext.setJobGroup("checked write", "")
    checks.watched.write.parquet(str(tmp_path / "t"))
    got = (checks.rows(), checks.null_counts(), checks.odd_rows(), checks.passed())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("checked write")
    spark.sparkContext.setJobGroup("", "")
    plain = spark.read.parquet(str(tmp_path / "t"))
    assert got == (1000, [tuple(r) for r in quality.dq_not_null(plain, ["k", "id"]).collect()], {"pax": 100}, False)
    assert len(jobs) <= 2  # the exchange and the write; nothing for the checks
    assert [tuple(r) for r in checks.odd_values(plain, "pax").collect()] == [(99, 100)]
    clean = quality.write_checks(df.where("k IS NOT NULL AND pax < 9"), ["k"], {"pax": [0, 1, 2]})
    clean.watched.write.parquet(str(tmp_path / "clean"))
    assert clean.passed() and clean.odd_values(plain, "pax").collect() == []
    none = quality.write_checks(df.where("false"), ["k"])
    none.watched.write.parquet(str(tmp_path / "none"))
    assert none.rows() == 0 and none.null_counts() == [("k", 0)] and none.passed()
