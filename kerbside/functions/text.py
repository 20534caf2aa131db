"""Free text to request fields, as Column expressions.

Each regex call decodes its string, so the chains below test for a plain substring
first wherever the pattern cannot match without it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions import patterns as P
from kerbside.schemas import DRIVER, HITCHER


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# --- identifiers -----------------------------------------------------------------

def canonical_channel(c: Column) -> Column:
    """Strip, drop leading ``@``, lower-case: the stored spelling of a channel."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), "^@+", ""))


def sender_handle(c: Column) -> Column:
    """Null or empty -> null, else exactly one leading ``@``."""
    return F.when(c != "", F.concat(F.lit("@"), F.regexp_replace(c, "^@+", "")))


def state_key(channel: Column, topic_id: Column) -> Column:
    name = canonical_channel(channel)
    return F.when(topic_id.isNull(), name).otherwise(F.concat(name, F.lit("#topic="), topic_id))


def silver_request_id(channel: Column, message_id: Column) -> Column:
    return F.sha2(F.concat_ws("||", channel, message_id.cast("string")), 256)


# --- classification --------------------------------------------------------------

def _mentions(lowered: Column, word: str, pattern: str) -> Column:
    return lowered.contains(word) & lowered.rlike(pattern)


def classify_lowered(lowered: Column) -> Column:
    """Request type of an already trimmed and lower-cased message, null for noise."""
    has_route = _mentions(lowered, "pick", P.PICKUP_WORD) & _mentions(lowered, "drop", P.DROP_WORD)
    by_driver = lowered.contains("looking") & (
        _mentions(lowered, "driver", P.DRIVER_LOOKING) | _mentions(lowered, "passenger", P.LOOKING_FOR_PASSENGER))
    by_hitcher = lowered.contains("looking") & lowered.contains("driver") & (
        lowered.rlike(P.HITCHER_LOOKING) | lowered.rlike(P.LOOKING_FOR_DRIVER))
    # A message with a route is a request either way: an offer if it names a vehicle.
    return (
        F.when(_mentions(lowered, "pillion", P.BIKER_PILLION), F.lit(None).cast("string"))
        .when(by_driver, F.lit(DRIVER))
        .when(has_route, F.when(lowered.rlike(P.VEHICLE), F.lit(DRIVER)).otherwise(F.lit(HITCHER)))
        .when(by_hitcher, F.lit(HITCHER))
    )


def classify_request(message: Column) -> Column:
    return classify_lowered(F.lower(F.trim(message)))


# --- labelled fields -------------------------------------------------------------
# ``*_text`` leave "nothing" as ''. Turning '' into null mentions its argument twice and
# so runs it twice, which matters for a regex: chains do it in a projection of their own.

def line_text(message: Column, pattern: str) -> Column:
    return F.trim(F.regexp_extract(message, pattern, 1))


def unflagged_text(place: Column) -> Column:
    unflagged = F.trim(F.regexp_replace(place, P.FLAG_LETTERS, ""))
    return F.trim(F.regexp_replace(unflagged, P.TRAILING_DOTS, ""))


def _labelled(message: Column, pattern: str) -> Column:
    return blank_to_null(line_text(message, pattern))


def extract_pickup(message: Column) -> Column:
    return _labelled(message, P.PICKUP_LINE)


def extract_dropoff(message: Column) -> Column:
    return _labelled(message, P.DROPOFF_LINE)


def extract_time(message: Column) -> Column:
    return _labelled(message, P.TIME_LINE)


def pax_texts(message: Column) -> Column:
    """The four ways a passenger count is written, as text, '' where not found."""
    patterns = {"after": P.PAX_AFTER_LABEL, "before": P.PAX_BEFORE_LABEL, "lo": P.PAX_RANGE_LOW, "hi": P.PAX_RANGE_HIGH}
    return F.struct(*[F.regexp_extract(message, p, 1).alias(name) for name, p in patterns.items()])


def pax_numbers(texts: Column) -> Column:
    """'' becomes null before the cast: a failing ``try_cast`` is slow."""
    return F.struct(*[blank_to_null(texts[name]).try_cast("int").alias(name) for name in ("after", "before", "lo", "hi")])


def extract_pax_fields(message: Column) -> Column:
    """struct<after, before, lo, hi: int>"""
    return pax_numbers(pax_texts(message))


def resolve_pax(message: Column, fields: Column) -> Column:
    """One count in 1..10: labelled range -> lower midpoint; nothing written -> 1."""
    return pax_of_lowered(F.lower(message), fields)


def pax_of_lowered(lowered: Column, fields: Column) -> Column:
    lo, hi = fields["lo"], fields["hi"]
    single = F.coalesce(fields["after"], fields["before"])
    nothing = F.lit(None).cast("int")
    return (
        F.when(_mentions(lowered, "whole", P.WHOLE_CAR), nothing)
        .when(_mentions(lowered, "pax", P.PAX_UNKNOWN), nothing)
        .when(lo.between(1, 10) & hi.between(1, 10) & (lo <= hi), F.floor((lo + hi) / F.lit(2.0)).cast("int"))
        .when(lowered.rlike(P.PAX_UNLABELLED_RANGE), nothing)
        .when(single.between(1, 10), single)
        .when(single.isNull(), F.lit(1))
    )


def strip_flags(place: Column) -> Column:
    """Remove flag letters, then trailing dots; nothing left -> null."""
    return blank_to_null(unflagged_text(place))


def collapse_border_route(place: Column) -> Column:
    """A whole value such as "JB→SG" names a crossing: keep the side it starts from."""
    lowered = F.lower(place)
    return (F.when(lowered.rlike(P.JB_TO_SG), F.lit("jb"))
            .when(lowered.rlike(P.SG_TO_JB), F.lit("sg"))
            .otherwise(place))


def resolve_now(time_text: Column, posted: Column) -> Column:
    return F.when(F.lower(F.trim(time_text)) == "now", posted.cast("string")).otherwise(time_text)


def parse_status(pickup: Column, dropoff: Column, time_text: Column) -> Column:
    return (F.when(pickup.isNull(), F.lit("missing_pickup"))
            .when(dropoff.isNull(), F.lit("missing_dropoff"))
            .when(time_text.isNull(), F.lit("missing_time"))
            .otherwise(F.lit("parsed")))


# --- places ----------------------------------------------------------------------

def squeeze_location(place: Column) -> Column:
    """Collapse white space, trim, lower-case; keeps '' as ''."""
    return F.lower(F.trim(F.regexp_replace(place, P.WHITESPACE_RUN, " ")))


def normalize_location(place: Column) -> Column:
    return blank_to_null(squeeze_location(place))


def postal_codes_in_text(text: Column) -> Column:
    """Standalone six-digit runs, each once, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(P.POSTAL_CODE_IN_TEXT), F.lit(1)))


def search_fallbacks(place: Column) -> Column:
    """The place, then the place with one more trailing noise suffix removed each time.

    Every strip removes at least one word, so the word count bounds the fold exactly.
    """
    def strip_once(found: Column, _: Column) -> Column:
        last = F.element_at(found, -1)
        shorter = F.trim(F.regexp_replace(last, P.SEARCH_SUFFIX, ""))
        return F.when((shorter == last) | (shorter == ""), found).otherwise(F.array_append(found, shorter))

    words = F.sequence(F.lit(1), F.size(F.split(place, " ")))
    return F.when(place.rlike(P.SEARCH_SUFFIX), F.aggregate(words, F.array(place), strip_once)) \
        .otherwise(F.array(place))


def is_six_digits(postal: Column) -> Column:
    return postal.rlike(P.SIX_DIGITS)
