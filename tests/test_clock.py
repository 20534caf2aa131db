from datetime import datetime, timezone

import pytest
from conftest import ts
from pyspark.sql import functions as F

from kerbside.functions import clock


@pytest.fixture(params=["UTC", "Asia/Singapore", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_utc_becomes_gmt8_in_every_session_zone(spark, zone):
    at = datetime(2026, 6, 7, 10, 30, tzinfo=timezone.utc)
    df = spark.createDataFrame([(at.replace(tzinfo=None), at.timestamp())], "naive timestamp_ntz, seconds double")
    instant = F.timestamp_seconds("seconds")
    got = df.select(clock.to_gmt8(F.col("naive")), clock.to_gmt8(instant, instant=True)).collect()[0]
    assert list(got) == [ts("2026-06-07 18:30:00")] * 2


def test_wall_micros_ignores_the_session_zone(spark, zone):
    moments = ["2024-03-10 02:30:00.000001", "1969-12-31 23:59:59.999999", "2024-01-01 00:00:00"]
    df = spark.createDataFrame([(n, ts(m)) for n, m in enumerate(moments)], "n int, t timestamp_ntz")
    got = [r[1] for r in sorted(df.select("n", clock.wall_micros(F.col("t"))).collect())]
    epoch = datetime(1970, 1, 1)
    assert got == [round((ts(m) - epoch).total_seconds() * 1e6) for m in moments]
    back = df.select("n", clock.to_gmt8(clock.gmt8_instant(F.col("t")), instant=True)).collect()
    assert [r[1] for r in sorted(back)] == [ts(m) for m in moments]


@pytest.mark.parametrize(("start", "end", "kept"), [(9, 21, {9, 20}), (21, 9, {0, 8, 21, 23}), (5, 5, {0, 8, 9, 20, 21, 23})])
def test_service_hours(spark, start, end, kept):
    hours = [0, 8, 9, 20, 21, 23]
    df = spark.createDataFrame([(h, datetime(2024, 1, 1, h, 59)) for h in hours], "h int, t timestamp_ntz")
    got = {r.h for r in df.where(clock.within_service_hours(F.col("t"), "Asia/Singapore", start, end)).collect()}
    assert got == kept


def test_recency(spark):
    df = spark.createDataFrame([("2024-01-01 12:00:00",), ("2024-01-01 09:00:00",), ("2024-01-01 01:00:00",),
                                ("2024-01-01 13:00:00",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(clock.recency_score(F.col("t"), "2024-01-01 12:00:00")).collect()]
    assert got == [1.0, 0.5, 0.0, 1.0, 0.0, 0.0]
