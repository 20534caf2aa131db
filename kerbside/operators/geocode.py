"""Places to coordinates: a join with a gazetteer table of search hits.

The gazetteer has one row per hit: ``query``, ``rank`` (order of hits), ``postal``,
``latitude``, ``longitude``, ``address``, ``searchval``, all text but the rank. It is
reduced to one row per query by partial aggregation before anything joins it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import patterns as P
from kerbside.functions import text
from kerbside.operators.joins import union_all
from kerbside.operators.upsert import replace_by_key, upsert
from kerbside.schemas import GEOCODE_COLUMNS, GEOCODE_SCHEMA, OVERRIDE_COLUMNS

_RESULT_COLUMNS = [c for c in GEOCODE_COLUMNS if c not in ("attempted_at", "resolved_at")]


def _hit() -> Column:
    return F.struct("postal", "latitude", "longitude", "address", "searchval")


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


# --- what to look up ---------------------------------------------------------------

def distinct_locations(requests: DataFrame) -> DataFrame:
    """Pick-up and drop-off texts by normalised form, with the smallest original.

    One scan; distinct texts come first because that is a hash aggregate on every map
    task, so a place named in a third of all requests leaves each task once. Using their
    count keeps the optimizer from folding both steps into one aggregate, which would
    have to sort all texts to find the smallest.
    """
    texts = (requests.select(F.explode(F.array("pickup_location", "dropoff_location")).alias("original_location"))
             .where(F.col("original_location").isNotNull())
             .groupBy("original_location").agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") > 0))
    return (texts.groupBy(text.squeeze_location(F.col("original_location")).alias("normalized_location"))
            .agg(F.min("original_location").alias("original_location")))


def locations_to_resolve(requests: DataFrame, cache: DataFrame, limit: int = 0) -> DataFrame:
    """Locations not cached, failed before, or whose postal codes the cache lacks.

    The cache may hold several rows per location; they are folded to flags first, so the
    join is one to one. ``limit`` 0 takes all.
    """
    if limit < 0:
        raise ValueError("limit must be zero or greater")
    known = cache.groupBy("normalized_location").agg(
        F.bool_or(F.col("resolution_status") == "error").alias("failed"),
        F.bool_or(F.col("postal_code").isNull()).alias("no_postal"),
        F.bool_or(F.col("postal_code").contains(",")).alias("joined_postal"),
        F.lit(True).alias("cached"))
    place = F.col("normalized_location")
    todo = (
        distinct_locations(requests).where(place != "").join(known, "normalized_location", "left")
        .where(F.col("cached").isNull() | F.col("failed")
               | (F.col("no_postal") & place.rlike(P.HAS_POSTAL_CODE))
               | (F.col("joined_postal") & place.rlike(P.HAS_TWO_POSTAL_CODES)))
        .select("normalized_location", "original_location")
    )
    return todo.orderBy("normalized_location").limit(limit) if limit else todo


def explode_postal_codes(locations: DataFrame) -> DataFrame:
    """One row per postal code named in the original text, with its position."""
    return locations.select("*", F.posexplode(text.postal_codes_in_text(F.col("original_location")))
                            .alias("code_pos", "code"))


def _has_code(original: Column) -> Column:
    return original.rlike(P.HAS_POSTAL_CODE)


def _is_vague(place: Column) -> Column:
    return place.isin(P.NON_SPECIFIC_PLACES)


def non_specific_rule(locations: DataFrame) -> DataFrame:
    """Vague names without a postal code: no_match by rule, never looked up."""
    vague = locations.where(~_has_code(F.col("original_location")) & _is_vague(F.col("normalized_location")))
    return vague.select(
        "normalized_location", "original_location", _null().alias("postal_code"),
        _null("double").alias("latitude"), _null("double").alias("longitude"),
        _null().alias("formatted_address"), _null().alias("search_value"),
        F.lit("no_match").alias("resolution_status"), F.lit("rule").alias("resolution_source"),
        F.lit(0).alias("result_count"), F.lit(P.NON_SPECIFIC_REASON).alias("error_message"))


# --- reducing hits -----------------------------------------------------------------

def _place_choice(valid: Column) -> dict[str, Column]:
    """Aggregates that decide a place query: one postal code among the valid hits or not."""
    postal = F.when(valid, F.trim("postal"))
    low, high = F.min(postal), F.max(postal)
    return {
        "result_count": F.count(F.lit(1)).cast("int"),
        "status": F.when(low.isNull(), F.lit("no_match")).when(low != high, F.lit("ambiguous"))
        .otherwise(F.lit("resolved")),
        "place_hit": F.when(low == high, F.min_by(_hit(), F.when(valid, F.col("rank")))),
    }


def _postal_choice() -> Column:
    """First hit whose postal code is the query itself."""
    return F.min_by(_hit(), F.when(F.trim("postal") == F.col("query"), F.col("rank")))


def _valid_postal() -> Column:
    return text.is_six_digits(F.trim("postal"))


def choose_place(hits: DataFrame) -> DataFrame:
    """Per query: the first valid hit if all valid hits share one postal code."""
    choice = _place_choice(_valid_postal())
    return (hits.groupBy("query").agg(*[c.alias(n) for n, c in choice.items()])
            .select("query", "result_count", "status", "place_hit.*"))


def choose_postal(hits: DataFrame) -> DataFrame:
    """Per query (a postal code): the first hit with exactly that code."""
    return (hits.groupBy("query")
            .agg(F.count(F.lit(1)).cast("int").alias("result_count"), _postal_choice().alias("hit"))
            .select("query", "result_count",
                    F.when(F.col("hit").isNull(), F.lit("no_match")).otherwise(F.lit("resolved")).alias("status"),
                    "hit.*"))


def choose_station(hits: DataFrame) -> DataFrame:
    """Per query: first hit that names a station, else first hit; hits need a numeric
    postal code and coordinates. ``hit_count`` counts all hits."""
    def filled(name: str) -> Column:
        return F.coalesce(F.trim(name) != "", F.lit(False))

    usable = F.trim("postal").rlike(P.ALL_DIGITS) & filled("latitude") & filled("longitude")
    name = F.coalesce(F.nullif("searchval", F.lit("")), F.col("address"), F.lit(""))
    is_station = F.upper(name).contains("MRT")
    order = F.when(usable, F.struct((~is_station).alias("other"), "rank"))
    return (hits.groupBy("query").agg(F.count(F.lit(1)).cast("int").alias("hit_count"), F.min_by(_hit(), order).alias("hit"))
            .select("query", "hit_count", F.col("hit").isNotNull().alias("found"), "hit.*"))


# --- resolving ---------------------------------------------------------------------

def _queries(gazetteer: DataFrame) -> DataFrame:
    """One row per query with both choices."""
    choice = _place_choice(_valid_postal())
    return gazetteer.groupBy("query").agg(
        *[c.alias(n) for n, c in choice.items()], _postal_choice().alias("postal_hit"))


def _attempts(locations: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """One row per lookup to try: each postal code, or each fallback text in order."""
    original, place = F.col("original_location"), F.col("normalized_location")
    kind = (F.when(_has_code(original), F.lit("postal")).when(_is_vague(place), F.lit("rule"))
            .otherwise(F.lit("place")))
    tries = (F.when(F.col("kind") == "postal", text.postal_codes_in_text(original))
             .when(F.col("kind") == "place", text.search_fallbacks(place)))
    return (locations.select("normalized_location", "original_location", kind.alias("kind"))
            .where(F.col("kind").isin(*kinds))
            .select("*", F.posexplode_outer(tries).alias("pos", "query")))


def _usable(hit: Column) -> Column:
    return hit["latitude"].try_cast("double").isNotNull() & hit["longitude"].try_cast("double").isNotNull()


_BAD_COORDINATES = "hit without usable coordinates"


def _resolve(attempts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Join every attempt with its query once, then settle each location or code. Of the
    gazetteer, only rows of attempted queries are aggregated.

    A place stops at its first resolved or ambiguous attempt, else its last attempt
    counts. A postal code is always settled by itself: a miss is stored as a rule result
    without coordinates and so is not tried again.
    """
    tried = gazetteer.join(attempts.select("query").distinct(), "query", "left_semi")
    looked_up = attempts.join(_queries(tried), "query", "left")
    status = F.coalesce("status", F.lit("no_match"))
    count = F.coalesce("result_count", F.lit(0))
    attempt = F.struct("pos", status.alias("status"), count.alias("count"), "place_hit", "postal_hit")
    stops = F.when(status != "no_match", F.col("pos"))
    settled = looked_up.groupBy(
        "normalized_location", "original_location", "kind",
        F.when(F.col("kind") == "postal", F.col("query")).alias("code"),
    ).agg(F.coalesce(F.min_by(attempt, stops), F.max_by(attempt, F.col("pos"))).alias("a"))

    postal, rule = F.col("kind") == "postal", F.col("kind") == "rule"
    hit = F.when(postal, F.col("a.postal_hit")).otherwise(F.col("a.place_hit"))
    rows = settled.select("*", hit.alias("hit"))
    hit, good = F.col("hit"), F.coalesce(_usable(F.col("hit")), F.lit(False))
    broken = hit.isNotNull() & ~good

    def of_hit(value: Column) -> Column:
        return F.when(good, value)

    return rows.select(
        "normalized_location", "original_location",
        F.when(postal, F.col("code")).otherwise(of_hit(F.trim(hit["postal"]))).alias("postal_code"),
        of_hit(hit["latitude"].try_cast("double")).alias("latitude"),
        of_hit(hit["longitude"].try_cast("double")).alias("longitude"),
        of_hit(hit["address"]).alias("formatted_address"),
        of_hit(hit["searchval"]).alias("search_value"),
        F.when(postal, F.lit("resolved")).when(rule, F.lit("no_match")).when(broken, F.lit("error"))
        .otherwise(F.col("a.status")).alias("resolution_status"),
        F.when(rule | (postal & ~good), F.lit("rule")).otherwise(F.lit("onemap")).alias("resolution_source"),
        F.when(rule | broken, F.lit(0)).otherwise(F.col("a.count")).alias("result_count"),
        F.when(rule, F.lit(P.NON_SPECIFIC_REASON)).when(broken, F.lit(_BAD_COORDINATES))
        .when(postal & hit.isNull(), F.concat(F.lit(P.NO_EXACT_POSTAL_REASON), F.col("code"))).alias("error_message"),
    )


def resolve_places(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Locations without a postal code and not vague, by their fallback texts."""
    return _resolve(_attempts(locations, ("place",)), gazetteer)


def resolve_postals(locations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Every postal code named by a location, by itself."""
    return _resolve(_attempts(locations, ("postal",)), gazetteer)


def geocode_row(resolved: DataFrame, attempted_at: Column, reason_length: int | None = None) -> DataFrame:
    """The 13 cache columns: typed coordinates, stamps, and the reason, whole unless a
    length is asked for."""
    stamp = attempted_at.cast("timestamp")
    kind = {f.name: f.dataType for f in GEOCODE_SCHEMA}
    plain = [F.col(c).try_cast(kind[c]).alias(c) for c in _RESULT_COLUMNS if c != "error_message"]
    reason = F.col("error_message") if reason_length is None else F.substring("error_message", 1, reason_length)
    shaped = resolved.select(
        *plain, reason.alias("error_message"), stamp.alias("attempted_at"),
        F.when(F.col("resolution_status") == "resolved", stamp).alias("resolved_at"))
    return shaped.select(*GEOCODE_COLUMNS)


def geocode_run(requests: DataFrame, cache: DataFrame, gazetteer: DataFrame, attempted_at: Column,
                limit: int = 0) -> DataFrame:
    """Everything still to resolve, in one pass: the three kinds of location share one
    scan of the requests, one lookup join and one aggregation."""
    todo = locations_to_resolve(requests, cache, limit)
    return geocode_row(_resolve(_attempts(todo, ("postal", "rule", "place")), gazetteer), attempted_at)


# --- cache and overrides -----------------------------------------------------------

def geocode_replace(cache: DataFrame, batch: DataFrame) -> DataFrame:
    """Replace the generated rows of every processed location; overrides stay."""
    return replace_by_key(cache, batch, ["normalized_location"], protect=F.col("resolution_source") == "override")


def apply_overrides(cache: DataFrame, overrides: DataFrame, now: Column) -> DataFrame:
    """Reviewed overrides win: every cached row of the place is rewritten, unknown places
    are added. Overrides equal after normalising are reduced to the latest."""
    stamp = now.cast("timestamp")
    latest = (
        overrides.groupBy(text.squeeze_location(F.col("normalized_location")).alias("normalized_location"))
        .agg(F.max_by(F.struct("postal_code", "latitude", "longitude", "formatted_address"),
                      F.struct("updated_at", "postal_code", "formatted_address")).alias("o"))
    )
    fixed = {
        "postal_code": F.col("o.postal_code"), "latitude": F.col("o.latitude"),
        "longitude": F.col("o.longitude"), "formatted_address": F.col("o.formatted_address"),
        "search_value": F.col("normalized_location"), "resolution_status": F.lit("resolved"),
        "resolution_source": F.lit("override"), "result_count": F.lit(1), "error_message": _null(),
        "attempted_at": stamp, "resolved_at": stamp,
    }
    matched = F.col("o").isNotNull()
    rewritten = cache.join(latest, "normalized_location", "left").select(*[
        F.when(matched, fixed[c]).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c)
        for c in GEOCODE_COLUMNS])
    added = latest.join(cache, "normalized_location", "left_anti").select(*[
        fixed[c].alias(c) if c in fixed else F.col("normalized_location").alias(c) for c in GEOCODE_COLUMNS])
    return union_all(rewritten, added)


def town_queries(spark) -> DataFrame:
    """Towns whose override is their own station, with the text to search for."""
    rows = [(town, f"{town.title()} MRT Station") for town in P.STATION_TOWNS]
    return spark.createDataFrame(rows, "normalized_location string, search_value string")


def build_overrides(towns: DataFrame, gazetteer: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(override rows, towns without a usable hit and how many hits they had).

    Hits of other queries are dropped by a semi join before anything is aggregated.
    """
    hits = gazetteer.join(towns.select(F.col("search_value").alias("query")), "query", "left_semi")
    joined = towns.join(choose_station(hits), F.col("search_value") == F.col("query"), "left")
    found = F.coalesce("found", F.lit(False))
    rows = joined.where(found).select(
        text.normalize_location(F.col("normalized_location")).alias("normalized_location"),
        F.trim("postal").alias("postal_code"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.trim(F.coalesce(F.nullif("address", F.lit("")), "searchval", F.lit(""))).alias("formatted_address"),
        F.concat(F.lit(P.OVERRIDE_NOTE), "search_value").alias("notes"),
        now.cast("timestamp").alias("updated_at"))
    failures = joined.where(~found).select(
        "normalized_location", "search_value", F.coalesce("hit_count", F.lit(0)).alias("hit_count"))
    return rows, failures


def overrides_upsert(overrides: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(overrides.select(*OVERRIDE_COLUMNS), batch, ["normalized_location"])


def geocode_status_counts(cache: DataFrame) -> DataFrame:
    return (cache.groupBy("resolution_status", "resolution_source")
            .agg(F.count(F.lit(1)).alias("location_count"))
            .orderBy("resolution_status", "resolution_source"))


def override_audit(cache: DataFrame) -> DataFrame:
    """Cached rows that come from an override, by place."""
    return (cache.where(F.col("resolution_source") == "override")
            .select("normalized_location", "postal_code", "formatted_address", "resolution_source")
            .orderBy("normalized_location", "postal_code"))


def override_audit_gold(gold: DataFrame, limit: int | None = None) -> DataFrame:
    """Gold rows that use an override on either side; with ``limit``, the newest ones."""
    uses = (F.col("pickup_resolution_source") == "override") | (F.col("dropoff_resolution_source") == "override")
    columns = [c for side in ("pickup", "dropoff") for c in (
        f"normalized_{side}_location", f"{side}_postal_code", f"{side}_formatted_address", f"{side}_resolution_source")]
    rows = gold.where(uses)
    if limit is not None:
        rows = rows.orderBy(F.desc("message_date_gmt8"), "gold_request_id").limit(limit)
    return rows.select(*columns)
