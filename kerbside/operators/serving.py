"""Feed, dashboard and map queries over Gold. ``as_of`` is always a GMT+8 wall clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions import clock, text
from kerbside.functions import patterns as P
from kerbside.functions.clock import ntz, wall_micros
from kerbside.operators.joins import union_all
from kerbside.schemas import DRIVER, FEED_COLUMNS, HITCHER, REQUEST_TYPES

AsOf = str | datetime
WITHIN, CROSS_BORDER = "within-sg", "sg-jb"
DEFAULT_MINUTES, MOST_MINUTES, FEED_ROWS = 360, 720, 5_000
WINDOWS = (1, 2, 3, 6)
CHART_BARS = 50


# --- feed ----------------------------------------------------------------------------

def _since(as_of: AsOf, minutes: int) -> Column:
    return F.col("message_date_gmt8") >= ntz(as_of) - clock.minutes(minutes)


def _postal_ok(side: str) -> Column:
    return text.is_six_digits(F.coalesce(f"{side}_postal_code", F.lit("")))


def _names_malaysia(side: str) -> Column:
    place = F.coalesce(f"normalized_{side}_location", f"{side}_location", F.lit(""))
    return F.upper(place).rlike(P.MALAYSIA_TEXT)


def _not_malaysian(side: str) -> Column:
    return ~F.upper(F.coalesce(f"{side}_resolution_source", F.lit(""))).contains("MALAYSIA")


def _route(tab: str) -> Column:
    """Unknown tabs fall back to the within-country one. The two tabs overlap."""
    if tab == CROSS_BORDER:
        return (_names_malaysia("pickup") | _names_malaysia("dropoff")
                | ~_postal_ok("pickup") | ~_postal_ok("dropoff"))
    return (_not_malaysian("pickup") & _not_malaysian("dropoff")
            & _postal_ok("pickup") & _postal_ok("dropoff"))


def route_within(gold: DataFrame) -> DataFrame:
    return gold.where(_route(WITHIN))


def route_cross_border(gold: DataFrame) -> DataFrame:
    return gold.where(_route(CROSS_BORDER))


def _feed_rows(as_of: AsOf, minutes: int, tab: str) -> Column:
    located = F.lit(True)
    for side in ("pickup", "dropoff"):
        located = located & F.col(f"{side}_latitude").isNotNull() & F.col(f"{side}_longitude").isNotNull()
    return _since(as_of, minutes) & (F.col("request_type") == HITCHER) & located & _route(tab)


def recent_requests(gold: DataFrame, as_of: AsOf, minutes: int = DEFAULT_MINUTES, tab: str = WITHIN,
                    limit: int | None = None, ordered: bool = False) -> DataFrame:
    """Located hitcher requests of a route. With ``limit``, the newest ones in order; the id
    makes the order total. Without it every row, newest first only if ``ordered``."""
    rows = gold.where(_feed_rows(as_of, minutes, tab)).select(*FEED_COLUMNS)
    if limit is None and not ordered:
        return rows
    newest_first = rows.orderBy(F.desc("message_date_gmt8"), "gold_request_id")
    return newest_first if limit is None else newest_first.limit(limit)


def feed_page(gold: DataFrame, as_of: AsOf, minutes: int = DEFAULT_MINUTES, tab: str = WITHIN) -> DataFrame:
    """The feed as it is served: minutes brought into 1 to ``MOST_MINUTES``, newest first,
    at most ``FEED_ROWS`` rows."""
    return recent_requests(gold, as_of, max(1, min(minutes, MOST_MINUTES)), tab, FEED_ROWS)


def unique_request_count(gold: DataFrame, as_of: AsOf, minutes: int, request_type: str) -> DataFrame:
    return (gold.where(_since(as_of, minutes) & (F.col("request_type") == request_type))
            .agg(F.count_distinct("gold_request_id").alias("total_count")))


def latest_request_time(gold: DataFrame, as_of: AsOf, minutes: int, request_type: str | None = None) -> DataFrame:
    rows = gold.where(_since(as_of, minutes))
    if request_type:
        rows = rows.where(F.col("request_type") == request_type)
    return rows.agg(F.max("message_date_gmt8").cast("string").alias("latest_post_at"))


def recent_summary(gold: DataFrame, as_of: AsOf, minutes: int = DEFAULT_MINUTES, tab: str = WITHIN,
                   limit: int | None = None) -> DataFrame:
    """Feed totals in one row and one pass: rows a feed of ``limit`` rows returns, hitcher
    requests in the window, drivers active in the last hour, latest post."""
    if minutes < 1 or (limit is not None and limit < 1):
        raise ValueError("minutes and limit must be positive")
    tab = tab if tab == CROSS_BORDER else WITHIN
    shown = F.count_if(_feed_rows(as_of, minutes, tab))
    ident, kind = F.col("gold_request_id"), F.col("request_type")
    in_window = _since(as_of, minutes)
    return gold.where(_since(as_of, max(minutes, 60))).agg(
        (shown if limit is None else F.least(shown, F.lit(limit).cast("bigint"))).alias("count"),
        F.count_distinct(F.when(in_window & (kind == HITCHER), ident)).alias("total_count"),
        F.count_distinct(F.when(_since(as_of, 60) & (kind == DRIVER), ident)).alias("active_driver_count"),
        F.max(F.when(in_window, F.col("message_date_gmt8"))).cast("string").alias("latest_post_at"),
    ).select(F.lit(minutes).alias("minutes"), F.lit(tab).alias("tab"), "*")


# --- dashboard -----------------------------------------------------------------------

def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def check_steps(windows: Sequence[int], step_min: int, span_hours: int) -> None:
    if any(w * 60 % step_min for w in windows) or span_hours * 60 % step_min:
        raise ValueError("windows and span must be whole numbers of steps")


def filled_rolling(counts: DataFrame, as_of: AsOf, windows: Sequence[int], step_min: int, span_hours: int) -> DataFrame:
    """Counts by (request_type, window_hours, step) as rolling counts, zeros filled in."""
    origin = F.date_trunc("minute", ntz(as_of)).cast("timestamp_ntz") - clock.hours(span_hours)
    spine = (
        _one_row(counts.sparkSession).select(F.explode(_strings(REQUEST_TYPES)).alias("request_type"))
        .select("request_type", F.explode(F.array(*[F.lit(w) for w in windows])).alias("window_hours"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(span_hours * 60 // step_min))).alias("step"))
    )
    return spine.join(counts, ["request_type", "window_hours", "step"], "left").select(
        "request_type", "window_hours",
        (origin + F.make_dt_interval(mins=F.col("step") * F.lit(step_min))).alias("bucket_start"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("total_count"))


def rolling_counts(gold: DataFrame, as_of: AsOf, windows: Sequence[int] = WINDOWS, step_min: int = 15,
                   span_hours: int = 300) -> DataFrame:
    """Distinct requests in (b - w, b] for every type, window w and step b over the span,
    zeros kept. Steps are counted back from ``as_of`` cut to the minute.

    Every window is a whole number of steps, so a request matters only through the step
    it falls in. An id that occurs in several steps must count once per window: the
    occurrence in step s stands for the windows that end before the id's next step. So
    rows shrink to (type, step, steps until the next occurrence) counts, a table whose
    size depends on span and windows alone, and only that is spread over the windows.
    """
    check_steps(windows, step_min, span_hours)
    step = step_min * clock.MICROS_PER_MINUTE
    reach = max(windows) * 60 // step_min
    last = span_hours * 60 // step_min
    end = F.date_trunc("minute", ntz(as_of)).cast("timestamp_ntz")
    origin = end - clock.hours(span_hours)
    since_origin = wall_micros(F.col("message_date_gmt8")) - wall_micros(origin)
    # Steps are numbered from the origin; step s holds ((s - 1) * step, s * step].
    step_no = (-F.floor(-since_origin / F.lit(step))).cast("int")
    in_span = ((F.col("message_date_gmt8") > origin - clock.hours(max(windows)))
               & (F.col("message_date_gmt8") <= end) & F.col("request_type").isin(REQUEST_TYPES))
    steps_of_id = (
        gold.where(in_span & F.col("gold_request_id").isNotNull())
        .groupBy("request_type", "gold_request_id")
        .agg(F.sort_array(F.collect_set(step_no)).alias("steps"))
    )
    spaced = F.transform("steps", lambda s, i: F.struct(
        s.alias("step"),
        F.least(F.coalesce(F.get("steps", i + 1) - s, F.lit(reach)), F.lit(reach)).alias("lasts")))
    shapes = (steps_of_id.select("request_type", F.inline(spaced))
              .groupBy("request_type", "step", "lasts").agg(F.count(F.lit(1)).alias("n")))
    window_hours = F.explode(F.array(*[F.lit(w) for w in windows])).alias("window_hours")
    steps_per_window = F.col("window_hours") * F.lit(60 // step_min) if 60 % step_min == 0 else \
        (F.col("window_hours") * F.lit(60) / F.lit(step_min)).cast("int")
    counts = (
        shapes.select("request_type", "step", "lasts", "n", window_hours)
        .withColumn("until", F.col("step") + F.least("lasts", steps_per_window) - 1)
        .select("request_type", "window_hours", "n", F.explode(F.sequence("step", "until")).alias("step"))
        .where(F.col("step").between(0, last))
        .groupBy("request_type", "window_hours", "step").agg(F.sum("n").alias("n"))
    )
    return filled_rolling(counts, as_of, windows, step_min, span_hours)


def live_counts(gold: DataFrame, as_of: AsOf, minutes: int = 15) -> DataFrame:
    """Rows per type in the last minutes; no upper bound, not distinct, zeros kept."""
    live = (gold.where(_since(as_of, minutes) & F.col("request_type").isin(REQUEST_TYPES))
            .groupBy("request_type").agg(F.count(F.lit(1)).alias("n")))
    types = _one_row(gold.sparkSession).select(F.explode(_strings(REQUEST_TYPES)).alias("request_type"))
    return types.join(live, "request_type", "left").select(
        "request_type", F.coalesce("n", F.lit(0).cast("bigint")).alias("total_count"))


def filled_daily(counts: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Counts by (request_type, day) as daily counts, zeros filled in."""
    today = ntz(as_of).cast("date")
    spine = (
        _one_row(counts.sparkSession).select(F.explode(_strings(REQUEST_TYPES)).alias("request_type"))
        .select("request_type", F.explode(F.sequence(F.date_sub(today, days - 1), today)).alias("day"))
    )
    return spine.join(counts, ["request_type", "day"], "left").select(
        "request_type", F.col("day").cast("timestamp_ntz").alias("day_start"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("total_count"))


def daily_counts(gold: DataFrame, as_of: AsOf, days: int = 14) -> DataFrame:
    """Distinct requests per type and day for the last ``days`` days, zeros kept."""
    today = ntz(as_of).cast("date")
    first = F.date_sub(today, days - 1)
    posted = F.col("message_date_gmt8")
    counts = (
        gold.where((posted >= first.cast("timestamp_ntz")) & (posted < F.date_add(today, 1).cast("timestamp_ntz"))
                   & F.col("request_type").isin(REQUEST_TYPES))
        .groupBy("request_type", posted.cast("date").alias("day"))
        .agg(F.count_distinct("gold_request_id").alias("n"))
    )
    return filled_daily(counts, as_of, days)


def dashboard_of(rolling: DataFrame, live: DataFrame, daily: DataFrame) -> DataFrame:
    """The three counts in one long table."""
    def rows(metric: str, counts: DataFrame, hours: Column, bucket: Column) -> DataFrame:
        return counts.select(
            F.lit(metric).alias("metric"), "request_type", hours.cast("int").alias("window_hours"),
            bucket.cast("string").alias("bucket_start_gmt8"), F.col("total_count").cast("double").alias("metric_value"))

    none = F.lit(None)
    return union_all(
        rows("rolling", rolling, F.col("window_hours"), F.col("bucket_start")),
        rows("live_15m", live, none, none),
        rows("daily_total", daily, none, F.col("day_start")),
    ).orderBy("metric", "request_type", "window_hours", "bucket_start_gmt8")


def dashboard_rows(gold: DataFrame, as_of: AsOf) -> DataFrame:
    """Rolling, live and daily counts in one long table."""
    return dashboard_of(rolling_counts(gold, as_of), live_counts(gold, as_of), daily_counts(gold, as_of))


def dashboard_metrics(rows: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Per type and window: mean and last rolling value, live count, both point series.

    Every type and window has a row; without data its numbers are 0 and its series empty.
    Works on dashboard rows, whose number is fixed by span and windows.
    """
    value, bucket = F.col("metric_value"), F.col("bucket_start_gmt8")

    def points(label: str) -> Column:
        return F.sort_array(F.collect_list(F.struct(bucket.alias(label), value.alias("total_count"))))

    rolling = (rows.where((F.col("metric") == "rolling") & bucket.isNotNull() & F.col("window_hours").isNotNull())
               .groupBy("request_type", "window_hours")
               .agg(F.avg(value).alias("average_rolling_total"), F.max_by(value, bucket).alias("current_rolling_total"),
                    points("bucket_start_gmt8").alias("rolling_points")))
    live = rows.where(F.col("metric") == "live_15m").groupBy("request_type").agg(F.max(value).alias("live"))
    daily = (rows.where((F.col("metric") == "daily_total") & bucket.isNotNull())
             .groupBy("request_type").agg(points("day_start_gmt8").alias("daily_points")))
    entries = (_one_row(rows.sparkSession).select(F.explode(_strings(REQUEST_TYPES)).alias("request_type"))
               .select("request_type", F.explode(F.array(*[F.lit(w) for w in windows])).alias("window_hours")))
    found = entries.join(rolling, ["request_type", "window_hours"], "left").join(live, "request_type", "left").join(daily, "request_type", "left")
    kind = dict(found.dtypes)
    return found.select(
        "request_type", "window_hours", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("average_rolling_total", "current_rolling_total")],
        F.coalesce("live", F.lit(0.0)).alias("live_15m_count"),
        *[F.coalesce(c, F.array().cast(kind[c])).alias(c) for c in ("daily_points", "rolling_points")])


def chart_downsample(rolling: DataFrame, bars: int = CHART_BARS, steps_per_hour: int = 4) -> DataFrame:
    """One rolling point per window length, aligned to the last point, newest ``bars``."""
    newest = Window.partitionBy("request_type", "window_hours").orderBy(F.desc("bucket_start"))
    every = F.col("window_hours") * F.lit(steps_per_hour)
    return (rolling.withColumn("_back", F.row_number().over(newest) - 1)
            .where((F.col("_back") % every == 0) & (F.col("_back") < every * F.lit(bars)))
            .drop("_back"))


# --- map -----------------------------------------------------------------------------

def _point(c: Column, decimals: int) -> Column:
    return F.round(c, decimals).cast(f"decimal(38,{decimals})").cast("string")


def map_node_requests(recent: DataFrame, decimals: int = 5) -> DataFrame:
    """Each request once per node it belongs to: its pick-up point and its drop-off point.
    The list of a node as rows, so a busy node is not one huge value."""
    sides = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_latitude").alias("latitude"),
                               F.col(f"{k}_longitude").alias("longitude")) for k in ("pickup", "dropoff")])
    node = F.concat("kind", F.lit(":"), _point(F.col("latitude"), decimals), F.lit(","), _point(F.col("longitude"), decimals))
    return (recent.select("gold_request_id", "message_date_gmt8", F.inline(sides))
            .select(node.alias("node_id"), "kind", "latitude", "longitude", "gold_request_id", "message_date_gmt8"))


def map_nodes(recent: DataFrame, as_of: AsOf, decimals: int = 5) -> DataFrame:
    """Nodes of the map: how many requests, where the first of the feed lies, how recent."""
    place = F.struct("latitude", "longitude")
    feed_order = F.struct(-wall_micros(F.col("message_date_gmt8")), "gold_request_id")
    nodes = (map_node_requests(recent, decimals).groupBy("node_id", "kind")
             .agg(F.count(F.lit(1)).alias("request_count"), F.min_by(place, feed_order).alias("at"),
                  F.max("message_date_gmt8").alias("newest_request_at")))
    return nodes.select("node_id", "kind", "at.latitude", "at.longitude", "request_count", "newest_request_at",
                        clock.recency_score(F.col("newest_request_at"), as_of).alias("recency_score"))


def service_hours_filter(df: DataFrame, col: str, tz: str = "Asia/Singapore", start: int = 9, end: int = 21) -> DataFrame:
    return df.where(clock.within_service_hours(F.col(col), tz, start, end))
