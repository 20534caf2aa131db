"""Kept partials of the rolling and daily counts.

An occurrence of an id stands for every minute from its own up to the id's next occurrence,
at most ``REACH`` minutes on. How many occurrences a day, type and minute has with the same
length of stay is all a rolling count needs: a window of w minutes that ends in minute b
holds as many ids as there are occurrences with ``minute <= b < minute + min(lasts, w)``. A
minute holds what was posted after the minute before and up to itself, so the partials serve
every ``as_of`` and every step of whole minutes. ``first_of_day`` counts the occurrences that
are their id's first of the day: summed up they are the day's distinct ids.

A day has at most types x minutes x ``REACH`` rows, however many posts there are. What a post
changes lies in its own day and, through the stay of earlier occurrences, in the day before;
``update_partials`` writes just these anew from the Gold rows of the days around them. Repeated
and reordered updates give the same table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions import clock
from kerbside.functions.clock import ntz, wall_micros
from kerbside.operators import serving
from kerbside.operators.joins import union_all
from kerbside.schemas import REQUEST_TYPES
from kerbside.sources.workspace import path_exists

REACH = 360  # minutes; the longest window
SCHEMA = "request_type string, minute bigint, lasts int, n bigint, first_of_day bigint, day date"
_ONE_DAY = timedelta(days=1)


def _minute(posted: Column) -> Column:
    """Number of the first whole minute that is not before the post."""
    micros, one = wall_micros(posted), F.lit(clock.MICROS_PER_MINUTE)
    return ((micros + F.pmod(-micros, one)) / one).cast("bigint")


def step_partials(gold: DataFrame) -> DataFrame:
    """(request_type, minute, lasts, n, first_of_day, day) of all rows; one exchange by id
    before the counts. Rows without identifier, date or known type are left out, as in the
    counts themselves."""
    posted = F.col("message_date_gmt8")
    seen = (gold.where(F.col("request_type").isin(REQUEST_TYPES) & F.col("gold_request_id").isNotNull() & posted.isNotNull())
            .select("request_type", "gold_request_id", _minute(posted).alias("minute"), posted.cast("date").alias("day"))
            .repartition("request_type", "gold_request_id").distinct())
    of_id = Window.partitionBy("request_type", "gold_request_id").orderBy("minute", "day")
    stay = F.least(F.coalesce(F.lead("minute").over(of_id) - F.col("minute"), F.lit(REACH)), F.lit(REACH)).cast("int")
    first = F.coalesce(F.lag("day").over(of_id) != F.col("day"), F.lit(True))
    return (seen.select("request_type", "minute", "day", stay.alias("lasts"), first.alias("first"))
            .groupBy("day", "request_type", "minute", "lasts")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("first").alias("first_of_day"))
            .select("request_type", "minute", "lasts", "n", "first_of_day", "day"))


def changed_days(rows: DataFrame) -> list[date]:
    """The days of posts; as many as the calendar has, so they may be listed."""
    days = rows.select(F.to_date("message_date_gmt8").alias("day")).where("day IS NOT NULL").distinct()
    return sorted(r.day for r in days.collect())


def days_around(days: Iterable[date]) -> list[date]:
    """The days whose Gold rows ``update_partials`` needs for changes in ``days``."""
    return sorted({d + k * _ONE_DAY for d in days for k in (-1, 0, 1)})


def write_partials(gold: DataFrame, root: str) -> None:
    """The partials of all of Gold in place of those there are."""
    (step_partials(gold).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("day").parquet(root))


def update_partials(gold: DataFrame, root: str, days: Sequence[date]) -> None:
    """Replace the partials of ``days``, in which Gold has gained, lost or changed rows, and
    of the days before them. ``gold`` holds at least the rows of ``days_around``."""
    if not days:
        return
    near, changed = days_around(days), sorted({d - k * _ONE_DAY for d in days for k in (0, 1)})
    posted = F.col("message_date_gmt8")
    rows = gold.where((posted >= ntz(near[0])) & (posted < ntz(near[-1] + _ONE_DAY)) & posted.cast("date").isin(near))
    fresh = step_partials(rows).where(F.col("day").isin(changed))
    # A day without posts still gets a row: an overwrite replaces only the days it holds.
    spark = gold.sparkSession
    empty = spark.range(1).select(
        F.lit(REQUEST_TYPES[0]).alias("request_type"), F.lit(None).cast("bigint").alias("minute"), F.lit(0).alias("lasts"),
        F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("first_of_day"), F.explode(F.array(*map(F.lit, changed))).alias("day"))
    (union_all(fresh, empty).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(root))


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(root) if path_exists(spark, root) else spark.createDataFrame([], SCHEMA)


def rolling_counts(partials: DataFrame, as_of: serving.AsOf, windows: Sequence[int] = serving.WINDOWS, step_min: int = 15,
                   span_hours: int = 300) -> DataFrame:
    """``serving.rolling_counts`` from partials; opens the days of the span only."""
    serving.check_steps(windows, step_min, span_hours)
    if max(windows) * 60 > REACH:
        raise ValueError(f"partials reach {REACH} minutes")
    last = span_hours * 60 // step_min
    end = F.date_trunc("minute", ntz(as_of)).cast("timestamp_ntz")
    origin = end - clock.hours(span_hours)
    in_span = F.col("day").between((origin - clock.hours(max(windows))).cast("date"), end.cast("date"))
    behind = F.col("minute") - _minute(origin)
    until = behind + F.least("lasts", F.col("window_hours") * F.lit(60)) - 1
    step = F.lit(step_min)
    counts = (
        partials.where(in_span & (F.col("lasts") > 0))
        .select("request_type", "minute", "lasts", "n", F.explode(F.array(*map(F.lit, windows))).alias("window_hours"))
        .select("request_type", "window_hours", "n", F.greatest(F.lit(0).cast("bigint"), -F.floor(-behind / step)).alias("low"),
                F.least(F.lit(last).cast("bigint"), F.floor(until / step)).alias("high"))
        .where("low <= high").groupBy("request_type", "window_hours", "low", "high").agg(F.sum("n").alias("n"))
        .select("request_type", "window_hours", "n", F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))).alias("step"))
        .groupBy("request_type", "window_hours", "step").agg(F.sum("n").alias("n"))
    )
    return serving.filled_rolling(counts, as_of, windows, step_min, span_hours)


def daily_counts(partials: DataFrame, as_of: serving.AsOf, days: int = 14) -> DataFrame:
    """``serving.daily_counts`` from partials; opens these days only."""
    today = ntz(as_of).cast("date")
    counts = (partials.where(F.col("day").between(F.date_sub(today, days - 1), today))
              .groupBy("request_type", "day").agg(F.sum("first_of_day").alias("n")))
    return serving.filled_daily(counts, as_of, days)


def dashboard_rows(partials: DataFrame, live: DataFrame, as_of: serving.AsOf) -> DataFrame:
    """``serving.dashboard_rows`` from partials. ``live`` are the Gold rows since 15 minutes
    before ``as_of`` at least: live counts are of rows and to the second."""
    return serving.dashboard_of(rolling_counts(partials, as_of), serving.live_counts(live, as_of), daily_counts(partials, as_of))
