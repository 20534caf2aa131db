"""Gold: requests with coordinates, reposts suppressed, stable keys."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import clock, text
from kerbside.operators.joins import union_all
from kerbside.operators.silver import lookback_filter
from kerbside.operators.upsert import upsert
from kerbside.schemas import GEOCODE_SUFFIXES, GOLD_COLUMNS, SILVER_KEYS
from kerbside.sources.workspace import stored

GAP_HOURS = 2
HOT_ROWS = 1 << 18  # requests of one place that are joined under one key
_DEDUP_KEYS = ["telegram_user_key", "pickup_dedup_location_key", "dropoff_dedup_location_key"]


def parsed_requests(silver: DataFrame) -> DataFrame:
    """Fully parsed requests with their id and normalised places."""
    return (
        silver.where(F.col("parse_status") == "parsed")
        .withColumn("silver_request_id", text.silver_request_id(F.col("channel"), F.col("message_id")))
        .withColumn("normalized_pickup_location", text.squeeze_location(F.col("pickup_location")))
        .withColumn("normalized_dropoff_location", text.squeeze_location(F.col("dropoff_location")))
    )


def affected_requests(silver: DataFrame, as_of: str | datetime | None, hours: int = 6) -> DataFrame:
    """Ids of parsed requests scraped within the lookback."""
    recent = lookback_filter(silver.where(F.col("parse_status") == "parsed"), "scraped_at_gmt8", as_of, hours)
    return recent.select(text.silver_request_id(F.col("channel"), F.col("message_id")).alias("silver_request_id")).distinct()


def rank_geocodes(cache: DataFrame, override_exclusive: bool = False) -> DataFrame:
    """Resolved rows, the best of each identical geocode: override, lookup, rule, other,
    then the newest. ``row_number() = 1`` is applied in every map task before the shuffle.

    A place keeps one row per distinct geocode, so an override does not displace a
    different geocode of its place; ``override_exclusive`` makes it do so.
    """
    order = (F.when(F.col("resolution_source") == "override", 1).when(F.col("resolution_source") == "onemap", 2)
             .when(F.col("resolution_source") == "rule", 3).otherwise(4))
    same = [F.col("normalized_location"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(""))
        for c in ("postal_code", "formatted_address", "latitude", "longitude")]]
    best = Window.partitionBy(*same).orderBy(
        order, F.desc("resolved_at"), F.desc("attempted_at"), "search_value", "result_count", "error_message")
    ranked = (cache.where(F.col("resolution_status") == "resolved")
              .withColumn("geocode_rank", F.row_number().over(best)).where(F.col("geocode_rank") == 1))
    if override_exclusive:
        is_override = F.col("resolution_source") == "override"
        overridden = ranked.where(is_override).select("normalized_location").distinct().withColumn("_has", F.lit(True))
        ranked = (ranked.join(overridden, "normalized_location", "left")
                  .where(F.col("_has").isNull() | is_override).drop("_has"))
    return ranked.select("normalized_location", *GEOCODE_SUFFIXES)


def _hot_places(requests: DataFrame) -> DataFrame:
    """(place, parts) of the places, null included, that more than ``HOT_ROWS`` requests name:
    one row in ``HOT_ROWS`` of their ends at most. Stored, so requests are read once for it."""
    ends = requests.select(F.explode(F.array("normalized_pickup_location", "normalized_dropoff_location")).alias("_place"))
    counts = ends.groupBy("_place").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS)
    return stored(counts.select("_place", F.ceil(F.col("n") / HOT_ROWS).alias("_parts")), "hot-places")


def enrich_geocodes(requests: DataFrame, ranked: DataFrame) -> DataFrame:
    """Left join the geocodes of both places; several per place multiply the request.

    Popular places make the join keys skewed. Their requests are cut into parts of about
    ``HOT_ROWS``, by a hash of their keys, and their few geocodes repeated for every part, so
    no task gets all requests of a place, however many. Adaptive execution still broadcasts
    a geocode table whose measured size allows it, and splits what is uneven below that.
    ``requests`` are read once more, to count their places.
    """
    hot, on = _hot_places(requests), ["normalized_location"]
    spread = not hot.isEmpty()
    if spread:
        on.append("_part")
        parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
        ranked = (ranked.join(F.broadcast(hot), F.col("normalized_location") == F.col("_place"), "left")
                  .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_place", "_parts"))
    enriched = requests
    for side in ("pickup", "dropoff"):
        place = f"normalized_{side}_location"
        kept = [F.col(c) for c in enriched.columns if c != place]
        left = enriched.withColumnRenamed(place, "normalized_location")
        if spread:
            part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*SILVER_KEYS), "_parts"))
            left = (left.join(F.broadcast(hot), F.col("normalized_location").eqNullSafe(F.col("_place")), "left")
                    .withColumn("_part", F.coalesce(part, F.lit(0).cast("bigint"))).drop("_place", "_parts"))
        enriched = left.join(ranked, on, "left").select(*kept, F.col("normalized_location").alias(place),
                 *[F.col(c).alias(f"{side}_{suffix}") for c, suffix in GEOCODE_SUFFIXES.items()])
    return enriched


def user_key() -> Column:
    """Who posted: sender id, else handle, else the message itself."""
    return F.coalesce(
        F.col("sender_id").cast("string"), F.lower(F.trim("sender_handle")),
        F.concat(F.lit("unknown:"), "channel", F.lit("#"), F.col("message_id").cast("string")))


def _geocoded(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with both geocodes and dedup keys."""
    return dedup_keys(enrich_geocodes(requests, rank_geocodes(cache)))


def dedup_keys(enriched: DataFrame) -> DataFrame:
    """Add who posted and, per side, the postal code or else the normalised place."""
    return enriched.withColumns({
        "telegram_user_key": user_key(),
        **{f"{side}_dedup_location_key": F.coalesce(f"{side}_postal_code", f"normalized_{side}_location")
           for side in ("pickup", "dropoff")}})


def _gap(hours: int) -> str:
    return f"{hours} hours"


def repost_dedup(keyed: DataFrame, gap_hours: int = GAP_HOURS) -> DataFrame:
    """Drop a row if the same user posted the same two places earlier, at most
    ``gap_hours`` before (inclusive; ties by ``channel#id``; suppressed posts count).

    Cut time into slots as long as the gap. A post with an earlier one in its own slot is
    a repost, so per key and slot only the first can stay, and it stays unless the last
    post of the slot before lies within the gap. Two aggregates per key and slot thus
    decide everything: they are formed before the shuffle, so a key with a third of all
    posts shrinks to one row per slot in every map task. The rows themselves are shuffled
    once, on the post, which is never skewed. Rows with a null in the key always stay.
    """
    post = F.struct(F.col("message_date_gmt8").alias("ts"),
                    F.concat("channel", F.lit("#"), F.col("message_id").cast("string")).alias("cid"))
    posts = keyed.select(*_DEDUP_KEYS, post.alias("post"))
    slots = (
        posts.where(F.col("post.ts").isNotNull())
        .groupBy(*_DEDUP_KEYS, F.window("post.ts", _gap(gap_hours)).alias("slot"))
        .agg(F.min("post").alias("first"), F.max("post.ts").alias("last_ts"))
    )
    previous = F.lag("last_ts").over(Window.partitionBy(*_DEDUP_KEYS).orderBy("slot.start"))
    stays = (
        slots.withColumn("previous", previous)
        .where(F.col("previous").isNull() | (F.col("previous") < F.col("first.ts") - clock.hours(gap_hours)))
        .select(*_DEDUP_KEYS, F.col("first.ts").alias("message_date_gmt8"), F.col("first.cid").alias("_cid"),
                F.lit(True).alias("_stays"))
    )
    on = [*_DEDUP_KEYS, "message_date_gmt8", "_cid"]
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    return (keyed.withColumn("_cid", post["cid"]).join(stays, on, "left")
            .where(F.col("_stays").isNotNull() | no_key)
            .select(*keyed.columns))


def gold_request_id() -> Column:
    def text_or_blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return F.sha2(F.concat_ws(
        "||", "silver_request_id", text_or_blank("pickup_dedup_location_key"),
        text_or_blank("dropoff_dedup_location_key"), text_or_blank("pickup_formatted_address"),
        text_or_blank("dropoff_formatted_address")), 256)


def _project(deduplicated: DataFrame) -> DataFrame:
    return (deduplicated.withColumn("gold_request_id", gold_request_id())
            .withColumn("is_canonical_request", F.lit(True)).select(*GOLD_COLUMNS))


def gold_requests(silver: DataFrame, cache: DataFrame, gap_hours: int = GAP_HOURS) -> DataFrame:
    """Full refresh of Gold."""
    keyed = _geocoded(parsed_requests(silver), cache)
    return _project(repost_dedup(keyed, gap_hours))


def _within_days(touched: DataFrame, gap_hours: int) -> Column:
    """Whether a post lies in the days of the touched slots, as ranges of time. The days
    that reach the driver are at most those of the calendar."""
    ends = F.array(F.to_date("_slot"), F.to_date(F.col("_slot") + clock.hours(gap_hours)))
    days = sorted(r.day for r in touched.select(F.explode(ends).alias("day")).where("day IS NOT NULL").distinct().collect())
    ranges: list[list[date]] = []
    for day in days:
        if ranges and ranges[-1][1] == day:
            ranges[-1][1] = day + timedelta(days=1)
        else:
            ranges.append([day, day + timedelta(days=1)])
    posted, inside = F.col("message_date_gmt8"), F.lit(False)
    for first, end in ranges:
        inside = inside | ((posted >= clock.ntz(f"{first} 00:00:00")) & (posted < clock.ntz(f"{end} 00:00:00")))
    return inside


def gold_incremental(silver: DataFrame, cache: DataFrame, as_of: str | datetime | None, hours: int = 6,
                     gap_hours: int = GAP_HOURS) -> DataFrame:
    """Gold rows of requests scraped within the lookback, deduplicated against history.

    Whether a post stays depends only on posts of its user in its own slot and the slot
    before. So history is cut to those (user, slot) pairs before it is geocoded, and to
    their days before it is read: the scan gets these days as filters, so one late message
    adds its own days and not all history since. What the lookback holds is written once.
    """
    if as_of is None:
        return gold_requests(silver, cache, gap_hours)
    requests = parsed_requests(silver)
    slot = F.window("message_date_gmt8", _gap(gap_hours))["start"]
    affected = stored(lookback_filter(requests, "scraped_at_gmt8", as_of, hours)
                      .select("silver_request_id", user_key().alias("_user"), slot.alias("_slot")), "affected")
    touched = affected.select(
        "_user", F.explode(F.array("_slot", F.col("_slot") - clock.hours(gap_hours))).alias("_slot")).distinct()
    neighbours = (
        requests.where(_within_days(touched, gap_hours))
        .withColumn("_user", user_key()).withColumn("_slot", slot)
        .join(touched, ["_user", "_slot"], "left_semi").drop("_user", "_slot")
    )
    keyed = _geocoded(neighbours, cache)
    changed = affected.select("silver_request_id").distinct()
    return _project(repost_dedup(keyed, gap_hours).join(changed, "silver_request_id", "left_semi"))


def rescraped(silver: DataFrame, as_of: str | datetime, hours: int = 6) -> DataFrame:
    """Ids of every request scraped within the lookback, parsed or not."""
    return (lookback_filter(silver, "scraped_at_gmt8", as_of, hours)
            .select(text.silver_request_id(F.col("channel"), F.col("message_id")).alias("silver_request_id")).distinct())


def gold_merge(gold: DataFrame, batch: DataFrame, silver: DataFrame, as_of: str | datetime, hours: int = 6) -> DataFrame:
    """Delete the Gold rows of every request scraped within the lookback, parsed or not,
    then merge the batch on ``gold_request_id``."""
    remaining = gold.join(rescraped(silver, as_of, hours), "silver_request_id", "left_anti").select(*gold.columns)
    return upsert(remaining, batch, ["gold_request_id"])


def _slot_start(gap_hours: int) -> Column:
    """The start of a post's slot, null without a time: a window would drop such a row."""
    epoch = "timestamp_ntz '1970-01-01 00:00:00'"
    return F.expr(f"timestampadd(HOUR, cast(floor(timestampdiff(SECOND, {epoch}, message_date_gmt8) / {3600 * gap_hours}) * {gap_hours} AS int), {epoch})")


# --- Late posts ------------------------------------------------------------------------

def changed_requests(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids of requests whose Silver row is new, gone or different, whenever it was posted."""
    def marked(silver: DataFrame, name: str) -> DataFrame:
        # A hash passes over nulls, so each value is followed by whether it is one.
        row = [part for c in sorted(silver.columns) for part in (F.col(c), F.col(c).isNull())]
        return silver.select(text.silver_request_id(F.col("channel"), F.col("message_id")).alias("silver_request_id"),
                             F.struct(F.xxhash64(*row), F.xxhash64(F.lit(1), *row)).alias(name))

    both = marked(before, "_before").join(marked(after, "_after"), "silver_request_id", "full_outer")
    return both.where(~F.col("_before").eqNullSafe(F.col("_after"))).select("silver_request_id").distinct()


def requests_at(silver: DataFrame, places: DataFrame) -> DataFrame:
    """Ids of parsed requests from or to one of ``places`` (normalized_location): what a new
    or reviewed geocode changes."""
    requests = parsed_requests(silver)
    ends = requests.select("silver_request_id", F.explode(F.array("normalized_pickup_location", "normalized_dropoff_location")).alias("normalized_location"))
    return ends.join(places.select("normalized_location").distinct(), "normalized_location", "left_semi").select("silver_request_id").distinct()


def late_post_changes(before: DataFrame, after: DataFrame, cache: DataFrame, changed: DataFrame,
                      gap_hours: int = GAP_HOURS) -> tuple[DataFrame, DataFrame]:
    """What changed requests change in Gold, however old: (ids to retract, rows to add).

    ``before`` and ``after`` are Silver around the change and ``changed`` ids of requests. A
    post decides only about its user's posts in its own slot and the slot after: a slot's
    decision reads the posts of two slots, not their decisions, so the change ends there. So
    both versions of a changed request make these two slots dirty; dirty slots are decided
    anew from their posts and those of the slots before, and all their rows replaced. Rows
    that read the same before and after are retracted and added with the same values. Posts
    without a time or user touch no others. Both results are written out.
    """
    gap = clock.hours(gap_hours)

    def posts(silver: DataFrame) -> DataFrame:
        return parsed_requests(silver).withColumns({"_user": user_key(), "_slot": _slot_start(gap_hours)})

    changed = stored(changed.select("silver_request_id").distinct(), "changed")
    moved = [posts(s).join(changed, "silver_request_id", "left_semi").select("_user", "_slot") for s in (before, after)]
    dirty = moved[0].unionByName(moved[1]).select("_user", F.explode(F.array("_slot", F.col("_slot") + gap)).alias("_slot")).distinct()
    dirty = stored(dirty.where("_user IS NOT NULL AND _slot IS NOT NULL"), "dirty-slots")
    # A slot that is dirty is decided; one that only precedes such a slot is read.
    read = dirty.select("_user", "_slot", F.lit(True).alias("_dirty")).unionByName(
        dirty.select("_user", (F.col("_slot") - gap).alias("_slot"), F.lit(False).alias("_dirty")))
    read = read.groupBy("_user", "_slot").agg(F.max("_dirty").alias("_dirty"))
    now = posts(after)
    slotless = now.where("_user IS NULL OR _slot IS NULL").join(changed, "silver_request_id", "left_semi").withColumn("_dirty", F.lit(True))
    near = now.where(_within_days(read, gap_hours)).join(read, ["_user", "_slot"]).unionByName(slotless)
    near = stored(near.drop("_user", "_slot"), "dirty-posts")
    decided = near.where("_dirty").select("silver_request_id").distinct()
    retracted = stored(decided.unionByName(changed).distinct(), "retracted")
    rows = repost_dedup(_geocoded(near.drop("_dirty"), cache), gap_hours).join(decided, "silver_request_id", "left_semi")
    return retracted, stored(_project(rows), "late-gold")


def apply_changes(gold: DataFrame, retracted: DataFrame, fresh: DataFrame) -> DataFrame:
    """Gold without the retracted requests' rows and with the fresh ones. A stored table that
    is bucketed by request takes them by ``sources.buckets.replace_bucketed``."""
    return union_all(gold.join(retracted, "silver_request_id", "left_anti").select(*fresh.columns), fresh)
