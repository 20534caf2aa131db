"""The same results in DuckDB SQL, written from definitions rather than from the plans:
self joins and range joins where the library aggregates, recursion where it folds.

``{name}`` names a part below or a test table; ``statement`` puts the needed parts in
front as common table expressions.
"""

from __future__ import annotations

import re

from kerbside.functions import patterns as P
from kerbside.plans import catalog as C
from kerbside.schemas import FEED_COLUMNS, GEOCODE_COLUMNS, GEOCODE_SUFFIXES, GOLD_COLUMNS, MESSAGE_COLUMNS, SILVER_COLUMNS
from kerbside.sources import sample
from kerbside.sources.sample import AS_OF

TEST_TABLES = {"events", "customer", "supplier", "part", "region"}
NOW = f"TIMESTAMP '{AS_OF}'"
RUN_AT = f"TIMESTAMP '{C.RUN_AT}'"
SIDES = ("pickup", "dropoff")


def _list(columns, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in columns)


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def found(text: str, pattern: str) -> str:
    return f"nullif(trim(regexp_extract({text}, '{pattern}', 1), ' '), '')"


def number(pattern: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(message, '{pattern}', 1), '') AS INTEGER)"


def squeezed(place: str) -> str:
    return f"lower(trim(regexp_replace({place}, '{P.WHITESPACE_RUN}', ' ', 'g'), ' '))"


def unflagged(place: str) -> str:
    bare = f"trim(regexp_replace({place}, '{P.FLAG_LETTERS}', '', 'g'), ' ')"
    return f"nullif(trim(regexp_replace({bare}, '{P.TRAILING_DOTS}', ''), ' '), '')"


def one_side(place: str) -> str:
    return (f"CASE WHEN {has(f'lower({place})', P.JB_TO_SG)} THEN 'jb' "
            f"WHEN {has(f'lower({place})', P.SG_TO_JB)} THEN 'sg' ELSE {place} END")


def request_type(t: str) -> str:
    route = f"({has(t, P.PICKUP_WORD)} AND {has(t, P.DROP_WORD)})"
    offers = f"{has(t, P.DRIVER_LOOKING)} OR {has(t, P.LOOKING_FOR_PASSENGER)} OR ({has(t, P.VEHICLE)} AND {route})"
    asks = f"{has(t, P.HITCHER_LOOKING)} OR {has(t, P.LOOKING_FOR_DRIVER)} OR {route}"
    return (f"CASE WHEN {has(t, P.BIKER_PILLION)} THEN NULL WHEN {offers} THEN 'driver_request' "
            f"WHEN {asks} THEN 'hitcher_request' END")


def silver_of(copies: str) -> str:
    """Silver of a message log, one derived table per step."""
    newest = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel, id ORDER BY scraped_at_gmt8 DESC) AS nth "
              f"FROM {copies} WHERE message IS NOT NULL) WHERE nth = 1")
    typed = f"SELECT *, {request_type('lower(trim(message, chr(32)))')} AS request_type FROM ({newest})"
    fields = f"""SELECT *, {unflagged(found('message', P.PICKUP_LINE))} AS p, {unflagged(found('message', P.DROPOFF_LINE))} AS d,
      {found('message', P.TIME_LINE)} AS w, {number(P.PAX_AFTER_LABEL)} AS a, {number(P.PAX_BEFORE_LABEL)} AS b,
      {number(P.PAX_RANGE_LOW)} AS lo, {number(P.PAX_RANGE_HIGH)} AS hi, lower(message) AS m
    FROM ({typed}) WHERE request_type IS NOT NULL"""
    places = f"""SELECT channel, topic_id, id AS message_id, message_date_gmt8, message, sender_id, sender_handle,
      scraped_at_gmt8, request_type, {one_side('p')} AS pickup_location, {one_side('d')} AS dropoff_location,
      CASE WHEN lower(trim(w, ' ')) = 'now' THEN CAST(message_date_gmt8 AS VARCHAR) ELSE w END AS request_time_text,
      CASE WHEN {has('m', P.WHOLE_CAR)} OR {has('m', P.PAX_UNKNOWN)} THEN NULL
        WHEN lo >= 1 AND hi <= 10 AND lo <= hi THEN (lo + hi) // 2
        WHEN {has('m', P.PAX_UNLABELLED_RANGE)} THEN NULL
        WHEN coalesce(a, b, 1) BETWEEN 1 AND 10 THEN coalesce(a, b, 1) END AS pax_count
    FROM ({fields})"""
    return f"""SELECT *, CASE WHEN pickup_location IS NULL THEN 'missing_pickup'
      WHEN dropoff_location IS NULL THEN 'missing_dropoff'
      WHEN request_time_text IS NULL THEN 'missing_time' ELSE 'parsed' END AS parse_status FROM ({places})"""


def sid(channel: str = "channel", message_id: str = "message_id") -> str:
    return f"sha256(concat({channel}, '||', {message_id}))"


def _side(side: str) -> str:
    return ", ".join(f"{side[0]}.{c} AS {side}_{suffix}" for c, suffix in GEOCODE_SUFFIXES.items())


def parsed_of(silver: str) -> str:
    return (f"SELECT *, {sid()} AS silver_request_id, {squeezed('pickup_location')} AS normalized_pickup_location, "
            f"{squeezed('dropoff_location')} AS normalized_dropoff_location FROM {silver} WHERE parse_status = 'parsed'")


def enriched_of(parsed: str) -> str:
    return (f"SELECT r.*, {_side('pickup')}, {_side('dropoff')} FROM {parsed} r "
            "LEFT JOIN {ranked} p ON p.normalized_location = r.normalized_pickup_location "
            "LEFT JOIN {ranked} d ON d.normalized_location = r.normalized_dropoff_location")


def keyed_of(enriched: str) -> str:
    return (f"SELECT *, coalesce(CAST(sender_id AS VARCHAR), lower(trim(sender_handle)), concat('unknown:', channel, '#', message_id)) "
            "AS telegram_user_key, coalesce(pickup_postal_code, normalized_pickup_location) AS pickup_dedup_location_key, "
            f"coalesce(dropoff_postal_code, normalized_dropoff_location) AS dropoff_dedup_location_key FROM {enriched}")


def kept_of(keyed: str) -> str:
    """No earlier post of the same user and places within two hours, compared pairwise."""
    return f"""SELECT * FROM {keyed} c WHERE NOT EXISTS (SELECT 1 FROM {keyed} e
      WHERE e.telegram_user_key = c.telegram_user_key
        AND e.pickup_dedup_location_key = c.pickup_dedup_location_key
        AND e.dropoff_dedup_location_key = c.dropoff_dedup_location_key
        AND e.message_date_gmt8 BETWEEN c.message_date_gmt8 - INTERVAL 2 HOUR AND c.message_date_gmt8
        AND (e.message_date_gmt8 < c.message_date_gmt8
          OR concat(e.channel, '#', e.message_id) < concat(c.channel, '#', c.message_id)))"""


GOLD_ID = ("sha256(concat(silver_request_id, '||', coalesce(pickup_dedup_location_key, ''), '||', "
           "coalesce(dropoff_dedup_location_key, ''), '||', coalesce(pickup_formatted_address, ''), '||', "
           "coalesce(dropoff_formatted_address, '')))")


def gold_of(kept: str) -> str:
    named = {"gold_request_id": f"{GOLD_ID} AS gold_request_id", "is_canonical_request": "true AS is_canonical_request"}
    return f"SELECT {', '.join(named.get(c, c) for c in GOLD_COLUMNS)} FROM {kept}"


PARTS = {
    "messages": sample.MESSAGES, "edits": sample.EDITS, "copies": sample.MESSAGE_COPIES,
    "sources": sample.SOURCES, "state": sample.STATE, "gazetteer": sample.GAZETTEER,
    "cache": sample.CACHE, "overrides": sample.OVERRIDES,
    "latest": "SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY channel, id "
              "ORDER BY scraped_at_gmt8 DESC) AS nth FROM {copies} WHERE message IS NOT NULL) WHERE nth = 1",
    "silver": silver_of("{copies}"),
    "first_silver": silver_of("{messages}"),
    "late_silver": silver_of(f"(SELECT * FROM {{copies}} WHERE scraped_at_gmt8 >= {NOW} - INTERVAL {C.MERGE_HOURS} HOUR)"),
    "ranked": f"""SELECT normalized_location, {_list(GEOCODE_SUFFIXES)} FROM (SELECT *, row_number() OVER (
        PARTITION BY normalized_location, coalesce(postal_code, ''), coalesce(formatted_address, ''),
          coalesce(CAST(latitude AS VARCHAR), ''), coalesce(CAST(longitude AS VARCHAR), '')
        ORDER BY coalesce(list_position(['override', 'onemap', 'rule'], resolution_source), 4),
          resolved_at DESC NULLS LAST, attempted_at DESC, search_value, result_count, error_message) AS nth
      FROM {{cache}} WHERE resolution_status = 'resolved') WHERE nth = 1""",
    "parsed": parsed_of("{silver}"),
    "enriched": enriched_of("{parsed}"),
    "keyed": keyed_of("{enriched}"),
    "kept": kept_of("{keyed}"),
    "gold": gold_of("{kept}"),
    "first_parsed": parsed_of("{first_silver}"),
    "first_enriched": enriched_of("{first_parsed}"),
    "first_keyed": keyed_of("{first_enriched}"),
    "first_kept": kept_of("{first_keyed}"),
    "first_gold": gold_of("{first_kept}"),
    # --- ingest ---
    "plan": """SELECT s.state_key, lower(ltrim(trim(s.channel), '@')) AS channel, s.topic_id AS wanted_topic,
        coalesce(st.last_message_id, 0) AS last_id, coalesce(st.initial_backfill_complete, false) AS done
      FROM {sources} s LEFT JOIN {state} st ON st.state_key = s.state_key""",
    "page": f"""SELECT * FROM (SELECT m.*, p.state_key, p.wanted_topic, p.done,
        row_number() OVER (PARTITION BY p.state_key ORDER BY m.id) AS nth
      FROM {{messages}} m JOIN {{plan}} p ON p.channel = m.channel AND m.id > p.last_id
        AND (p.wanted_topic IS NULL OR p.wanted_topic = m.topic_id))
      WHERE nth <= CASE WHEN done THEN {C.PER_RUN} ELSE {C.PAGE} END""",
    # --- places ---
    "locations": f"""SELECT {squeezed('place')} AS normalized_location, min(place) AS original_location
      FROM (SELECT pickup_location AS place FROM {{silver}} UNION ALL SELECT dropoff_location FROM {{silver}})
      WHERE place IS NOT NULL GROUP BY 1""",
    "todo": f"""SELECT DISTINCT l.normalized_location, l.original_location
      FROM {{locations}} l LEFT JOIN {{cache}} g ON g.normalized_location = l.normalized_location
      WHERE l.normalized_location <> '' AND (g.normalized_location IS NULL OR g.resolution_status = 'error'
        OR (g.postal_code IS NULL AND {has('l.normalized_location', P.HAS_POSTAL_CODE)})
        OR (g.postal_code LIKE '%,%' AND {has('l.normalized_location', P.HAS_TWO_POSTAL_CODES)}))""",
    "hits": f"""SELECT query, count(*) AS n,
        count(DISTINCT CASE WHEN {has('trim(postal)', P.SIX_DIGITS)} THEN trim(postal) END) AS codes,
        min(CASE WHEN {has('trim(postal)', P.SIX_DIGITS)} THEN rank END) AS place_rank,
        min(CASE WHEN trim(postal) = query THEN rank END) AS postal_rank
      FROM {{gazetteer}} GROUP BY query""",
}


def codes_of(locations: str) -> str:
    words = "string_split_regex(original_location, '[^0-9]+')"
    split = f"SELECT *, unnest({words}) AS code, generate_subscripts({words}, 1) AS word FROM {locations}"
    return (f"SELECT normalized_location, original_location, code, row_number() OVER (PARTITION BY normalized_location "
            f"ORDER BY min(word)) - 1 AS code_pos FROM ({split}) WHERE length(code) = 6 "
            "GROUP BY normalized_location, original_location, code")


def vague_of(locations: str) -> str:
    names = ", ".join(f"'{n}'" for n in P.NON_SPECIFIC_PLACES)
    return (f"SELECT * FROM {locations} WHERE NOT {has('original_location', P.HAS_POSTAL_CODE)} "
            f"AND normalized_location IN ({names})")


def fallbacks_of(rows: str) -> str:
    """Recursive stripping; ``rows`` has normalized_location and the text to start from."""
    return (f"SELECT normalized_location, 0 AS pos, start AS query FROM ({rows}) UNION ALL "
            f"SELECT normalized_location, pos + 1, trim(regexp_replace(query, '{P.SEARCH_SUFFIX}', '')) "
            f"FROM {{self}} WHERE {has('query', P.SEARCH_SUFFIX)}")


RESULT = [c for c in GEOCODE_COLUMNS if c not in ("attempted_at", "resolved_at")]
_OK = "TRY_CAST(g.latitude AS DOUBLE) IS NOT NULL AND TRY_CAST(g.longitude AS DOUBLE) IS NOT NULL"


def postal_results(codes: str) -> str:
    return f"""SELECT c.normalized_location, c.original_location, c.code AS postal_code,
      CASE WHEN {_OK} THEN CAST(g.latitude AS DOUBLE) END AS latitude, CASE WHEN {_OK} THEN CAST(g.longitude AS DOUBLE) END AS longitude,
      CASE WHEN {_OK} THEN g.address END AS formatted_address, CASE WHEN {_OK} THEN g.searchval END AS search_value,
      'resolved' AS resolution_status, CASE WHEN {_OK} THEN 'onemap' ELSE 'rule' END AS resolution_source,
      CAST(coalesce(h.n, 0) AS INTEGER) AS result_count,
      CASE WHEN g.query IS NULL THEN concat('{P.NO_EXACT_POSTAL_REASON}', c.code) END AS error_message
    FROM {codes} c LEFT JOIN {{hits}} h ON h.query = c.code
      LEFT JOIN {{gazetteer}} g ON g.query = c.code AND g.rank = h.postal_rank"""


def rule_results(vague: str) -> str:
    return f"""SELECT normalized_location, original_location, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS DOUBLE) AS latitude,
      CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS VARCHAR) AS formatted_address, CAST(NULL AS VARCHAR) AS search_value,
      'no_match' AS resolution_status, 'rule' AS resolution_source, 0 AS result_count,
      '{P.NON_SPECIFIC_REASON}' AS error_message FROM {vague}"""


def place_results(locations: str, tries: str) -> str:
    """The first try that is resolved or ambiguous, else the last try."""
    return f"""SELECT l.normalized_location, l.original_location,
      CASE WHEN {_OK} THEN trim(g.postal) END AS postal_code,
      CASE WHEN {_OK} THEN CAST(g.latitude AS DOUBLE) END AS latitude, CASE WHEN {_OK} THEN CAST(g.longitude AS DOUBLE) END AS longitude,
      CASE WHEN {_OK} THEN g.address END AS formatted_address, CASE WHEN {_OK} THEN g.searchval END AS search_value,
      CASE WHEN t.codes > 1 THEN 'ambiguous' WHEN t.codes = 0 THEN 'no_match' WHEN {_OK} THEN 'resolved' ELSE 'error' END AS resolution_status,
      'onemap' AS resolution_source,
      CAST(CASE WHEN t.codes = 1 AND NOT ({_OK}) THEN 0 ELSE t.n END AS INTEGER) AS result_count,
      CASE WHEN t.codes = 1 AND NOT ({_OK}) THEN 'hit without usable coordinates' END AS error_message
    FROM (SELECT f.normalized_location, f.query, coalesce(h.codes, 0) AS codes, coalesce(h.n, 0) AS n, h.place_rank,
        row_number() OVER (PARTITION BY f.normalized_location ORDER BY coalesce(h.codes, 0) = 0,
          CASE WHEN coalesce(h.codes, 0) = 0 THEN -f.pos ELSE f.pos END) AS nth
      FROM {tries} f LEFT JOIN {{hits}} h ON h.query = f.query) t
    JOIN {locations} l ON l.normalized_location = t.normalized_location
    LEFT JOIN {{gazetteer}} g ON g.query = t.query AND g.rank = t.place_rank AND t.codes = 1
    WHERE t.nth = 1"""


def plain_of(locations: str) -> str:
    names = ", ".join(f"'{n}'" for n in P.NON_SPECIFIC_PLACES)
    return (f"SELECT *, normalized_location AS start FROM {locations} WHERE NOT {has('original_location', P.HAS_POSTAL_CODE)} "
            f"AND normalized_location NOT IN ({names})")


def stamped(results: str) -> str:
    return (f"SELECT {_list(RESULT)}, {RUN_AT} AS attempted_at, CASE WHEN resolution_status = 'resolved' THEN {RUN_AT} END "
            f"AS resolved_at FROM {results}")


for _prefix, _from in (("all", "{locations}"), ("new", "{todo}")):
    PARTS.update({
        f"{_prefix}_codes": codes_of(_from),
        f"{_prefix}_vague": vague_of(_from),
        f"{_prefix}_plain": plain_of(_from),
        f"{_prefix}_tries": fallbacks_of(f"SELECT * FROM {{{_prefix}_plain}}").replace("{self}", f"{_prefix}_tries"),
        f"{_prefix}_postal_results": postal_results(f"{{{_prefix}_codes}}"),
        f"{_prefix}_place_results": place_results(f"{{{_prefix}_plain}}", f"{{{_prefix}_tries}}"),
    })
PARTS.update({
    "longer_tries": fallbacks_of("SELECT normalized_location, concat(normalized_location, ' hotel main entrance') AS start "
                                 "FROM {locations}").replace("{self}", "longer_tries"),
    "new_results": "SELECT * FROM {new_postal_results} UNION ALL SELECT * FROM {new_place_results} UNION ALL "
                   f"SELECT * FROM ({rule_results('{new_vague}')})",
    "geocoded": stamped("{new_results}"),
    "stations": f"""SELECT query, max(n) AS hit_count, max(CASE WHEN nth = 1 AND usable THEN true END) IS NOT NULL AS found,
        max(CASE WHEN nth = 1 AND usable THEN postal END) AS postal, max(CASE WHEN nth = 1 AND usable THEN latitude END) AS latitude,
        max(CASE WHEN nth = 1 AND usable THEN longitude END) AS longitude, max(CASE WHEN nth = 1 AND usable THEN address END) AS address,
        max(CASE WHEN nth = 1 AND usable THEN searchval END) AS searchval
      FROM (SELECT *, CAST(count(*) OVER (PARTITION BY query) AS INTEGER) AS n,
          row_number() OVER (PARTITION BY query ORDER BY usable DESC, upper(searchval) LIKE '%MRT%' DESC, rank) AS nth
        FROM (SELECT *, {has('trim(postal)', P.ALL_DIGITS)} AND trim(latitude) <> '' AND trim(longitude) <> '' AS usable FROM {{gazetteer}}))
      GROUP BY query""",
    "towns": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{t.title()} MRT Station')" for t in P.STATION_TOWNS)
             + ") AS v(normalized_location, search_value)",
    "station_overrides": f"""SELECT t.normalized_location, trim(s.postal) AS postal_code, CAST(s.latitude AS DOUBLE) AS latitude,
        CAST(s.longitude AS DOUBLE) AS longitude, trim(coalesce(nullif(s.address, ''), s.searchval, '')) AS formatted_address,
        concat('{P.OVERRIDE_NOTE}', t.search_value) AS notes, {RUN_AT} AS updated_at
      FROM {{towns}} t JOIN {{stations}} s ON s.query = t.search_value WHERE s.found""",
    "reviewed": f"""SELECT * EXCLUDE (nth) FROM (SELECT * REPLACE ({squeezed('normalized_location')} AS normalized_location),
        row_number() OVER (PARTITION BY {squeezed('normalized_location')} ORDER BY updated_at DESC, postal_code DESC, formatted_address DESC) AS nth
      FROM {{overrides}}) WHERE nth = 1""",
    # --- serving ---
    "steps": f"""SELECT t.request_type, w.window_hours, b.bucket_start
      FROM (VALUES ('driver_request'), ('hitcher_request')) AS t(request_type)
      CROSS JOIN (VALUES (1), (2), (3), (6)) AS w(window_hours)
      CROSS JOIN (SELECT unnest(generate_series(date_trunc('minute', {NOW}) - INTERVAL 300 HOUR, date_trunc('minute', {NOW}),
        INTERVAL 15 MINUTE)) AS bucket_start) b""",
    "rolling": """SELECT s.request_type, s.window_hours, s.bucket_start, count(DISTINCT g.gold_request_id) AS total_count
      FROM {steps} s LEFT JOIN {gold} g ON g.request_type = s.request_type AND g.message_date_gmt8 <= s.bucket_start
        AND g.message_date_gmt8 > s.bucket_start - INTERVAL 1 HOUR * s.window_hours
      GROUP BY ALL""",
    "live": f"""SELECT t.request_type, count(g.request_type) AS total_count
      FROM (VALUES ('driver_request'), ('hitcher_request')) AS t(request_type)
      LEFT JOIN {{gold}} g ON g.request_type = t.request_type AND g.message_date_gmt8 >= {NOW} - INTERVAL 15 MINUTE GROUP BY ALL""",
    "daily": f"""SELECT t.request_type, d.day_start, count(DISTINCT g.gold_request_id) AS total_count
      FROM (VALUES ('driver_request'), ('hitcher_request')) AS t(request_type)
      CROSS JOIN (SELECT unnest(generate_series(date_trunc('day', {NOW} - INTERVAL 13 DAY)::TIMESTAMP, date_trunc('day', {NOW})::TIMESTAMP,
        INTERVAL 1 DAY)) AS day_start) d
      LEFT JOIN {{gold}} g ON g.request_type = t.request_type AND date_trunc('day', g.message_date_gmt8) = d.day_start GROUP BY ALL""",
    "dashboard": """SELECT 'rolling' AS metric, request_type, window_hours, CAST(bucket_start AS VARCHAR) AS bucket_start_gmt8,
        CAST(total_count AS DOUBLE) AS metric_value FROM {rolling}
      UNION ALL SELECT 'live_15m', request_type, NULL, NULL, total_count FROM {live}
      UNION ALL SELECT 'daily_total', request_type, NULL, CAST(day_start AS VARCHAR), total_count FROM {daily}""",
})


def in_window(minutes: int) -> str:
    return f"message_date_gmt8 >= {NOW} - INTERVAL {minutes} MINUTE"


def _six(side: str) -> str:
    return has(f"coalesce({side}_postal_code, '')", P.SIX_DIGITS)


WITHIN = " AND ".join(_six(side) for side in SIDES)
CROSS = f"(NOT ({WITHIN}) OR " + " OR ".join(
    has(f"upper(coalesce(normalized_{side}_location, {side}_location, ''))", P.MALAYSIA_TEXT) for side in SIDES) + ")"
LOCATED = " AND ".join(f"{side}_{c} IS NOT NULL" for side in SIDES for c in ("latitude", "longitude"))


def feed(minutes: int, route: str, limit: int | None = None) -> str:
    return (f"SELECT {_list(FEED_COLUMNS)} FROM {{gold}} WHERE {in_window(minutes)} AND request_type = 'hitcher_request' "
            f"AND {LOCATED} AND {route}" + (f" ORDER BY message_date_gmt8 DESC, gold_request_id LIMIT {limit}" if limit else ""))


def score(ts: str) -> str:
    age = f"(epoch_us({NOW}) - epoch_us({ts})) / CAST(3600000000 AS DOUBLE)"
    return f"1.0::DOUBLE - greatest(0.0::DOUBLE, least(6.0::DOUBLE, {age})) / 6.0::DOUBLE"


def _fixed5(column: str) -> str:
    return f"CAST(CAST(round({column}, 5) AS DECIMAL(18, 5)) AS VARCHAR)"


PARTS.update({
    "upsert_batch": f"""SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN id + {C.NEW_IDS} ELSE id END AS id,
        CASE WHEN id % 2 = 0 THEN topic_id END AS topic_id) FROM {{edits}}""",
    "feed": feed(43_200, WITHIN),
    "node_requests": " UNION ALL ".join(
        f"SELECT concat('{side}:', {_fixed5(side + '_latitude')}, ',', {_fixed5(side + '_longitude')}) AS node_id, '{side}' AS kind, "
        f"{side}_latitude AS latitude, {side}_longitude AS longitude, gold_request_id, message_date_gmt8 FROM {{feed}}" for side in SIDES),
})


def _nulls(table: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM {table}" for c in columns)


def _csv_time(ts: str) -> str:
    return (f"concat(strftime({ts}, '%Y-%m-%d %H:%M:%S'), CASE WHEN epoch_us({ts}) % 1000000 <> 0 THEN strftime({ts}, '.%f') ELSE '' END, '+08:00')")


_MERGE_FROM = f"{NOW} - INTERVAL {C.MERGE_HOURS} HOUR"
_PICKUP, _DROPOFF = found("message", P.PICKUP_LINE), found("message", P.DROPOFF_LINE)
_TYPED_HANDLE = ("CASE id % 4 WHEN 0 THEN '@' || sender_handle WHEN 1 THEN '' WHEN 2 THEN substring(sender_handle, 2) "
                 "ELSE sender_handle END")
_OVERRIDDEN = {
    "postal_code": "o.postal_code", "latitude": "o.latitude", "longitude": "o.longitude",
    "formatted_address": "o.formatted_address", "search_value": "o.normalized_location", "resolution_status": "'resolved'",
    "resolution_source": "'override'", "result_count": "1", "error_message": "NULL", "attempted_at": RUN_AT, "resolved_at": RUN_AT,
}

ORACLE = {
    "bronze_scan": "SELECT * FROM {messages}",
    "canonical_channel": "SELECT id, lower(ltrim(trim(concat('  @@', upper(channel), ' ')), '@')) AS canonical_channel FROM {messages}",
    "sender_handle": f"SELECT id, CASE WHEN typed <> '' THEN concat('@', ltrim(typed, '@')) END AS handle FROM (SELECT id, {_TYPED_HANDLE} AS typed FROM {{messages}})",
    "to_gmt8": "SELECT id, message_date_gmt8 + INTERVAL 8 HOUR AS gmt8 FROM {messages}",
    "incremental_fetch": f"""SELECT state_key, CASE WHEN done THEN 'incremental' ELSE 'full_history' END AS sync_mode, channel, wanted_topic AS topic_id,
        id, message_date_gmt8, message, sender_id, sender_handle, scraped_at_gmt8 FROM {{page}} WHERE year(message_date_gmt8) >= {C.SINCE_YEAR}""",
    "checkpoint_advance": f"""SELECT p.state_key, greatest(max(p.last_id), coalesce(max(m.id), 0)) AS last_message_id,
        bool_or(p.done) OR count(m.id) < CASE WHEN bool_or(p.done) THEN {C.PER_RUN} ELSE {C.PAGE} END AS initial_backfill_complete
      FROM {{plan}} p LEFT JOIN {{page}} m ON m.state_key = p.state_key GROUP BY p.state_key""",
    "sync_summary": """SELECT (SELECT count(*) FROM {plan}) AS channel_count, count(*) AS fetched, count(*) AS merged,
        (SELECT CASE WHEN count(DISTINCT done) > 1 THEN 'mixed' WHEN bool_and(done) THEN 'incremental' ELSE 'full_history' END FROM {plan}) AS sync_mode
      FROM {page}""",
    "checkpoint_rebuild": """SELECT concat(channel, CASE WHEN topic_id IS NULL THEN '' ELSE concat('#topic=', topic_id) END) AS state_key,
        max(id) AS last_message_id FROM {messages} GROUP BY ALL""",
    "bronze_upsert": f"""SELECT s.channel, coalesce(s.topic_id, m.topic_id) AS topic_id, {_list(MESSAGE_COLUMNS[2:], 's.')}
      FROM {{upsert_batch}} s LEFT JOIN {{messages}} m ON m.channel = s.channel AND m.id = s.id
      UNION ALL SELECT {_list(MESSAGE_COLUMNS)} FROM {{messages}} m WHERE NOT EXISTS (
        SELECT 1 FROM {{upsert_batch}} s WHERE s.channel = m.channel AND s.id = m.id)""",
    "schema_guard": "SELECT column_name, CASE WHEN column_name IN ('scraped_at_gmt8', 'sender_handle', 'message_date_gmt8') THEN 'missing' "
                    f"WHEN column_name = '{C.LEGACY_COLUMN}' THEN 'extra' ELSE 'expected' END AS status, (SELECT count(*) FROM {{messages}}) AS table_rows "
                    "FROM (VALUES " + ", ".join(f"('{c}')" for c in [*MESSAGE_COLUMNS, C.LEGACY_COLUMN]) + ") AS v(column_name)",
    "csv_sink": f"""SELECT channel, CAST(topic_id AS VARCHAR) AS topic_id, CAST(id AS VARCHAR) AS id, {_csv_time('message_date_gmt8')} AS message_date_gmt8,
        message, CAST(sender_id AS VARCHAR) AS sender_id, sender_handle, {_csv_time('scraped_at_gmt8')} AS scraped_at_gmt8 FROM {{messages}}""",
    "replace_by_key": "SELECT * FROM {edits} UNION ALL SELECT * FROM {messages} WHERE id NOT IN (SELECT id FROM {edits})",
    "latest_copy": "SELECT * FROM {latest}",
    "lookback_filter": f"SELECT * FROM {{copies}} WHERE scraped_at_gmt8 >= {NOW} - INTERVAL 48 HOUR",
    "classify_request": f"SELECT channel, id, {request_type('lower(trim(message))')} AS request_type FROM {{latest}}",
    "extract_pickup": f"SELECT channel, id, {_PICKUP} AS pickup FROM {{latest}}",
    "extract_dropoff": f"SELECT channel, id, {_DROPOFF} AS dropoff FROM {{latest}}",
    "extract_time": f"SELECT channel, id, {found('message', P.TIME_LINE)} AS time_text FROM {{latest}}",
    "extract_pax_fields": f"""SELECT channel, id, {number(P.PAX_AFTER_LABEL)} AS pax_after, {number(P.PAX_BEFORE_LABEL)} AS pax_before,
        {number(P.PAX_RANGE_LOW)} AS pax_lo, {number(P.PAX_RANGE_HIGH)} AS pax_hi FROM {{latest}}""",
    "strip_flags": f"SELECT channel, id, {unflagged(_PICKUP)} AS pickup, {unflagged(_DROPOFF)} AS dropoff FROM {{latest}}",
    "collapse_border_route": f"""SELECT channel, id, {one_side('place')} AS pickup, 'sg' AS arrow, concat('sg/', channel) AS other
      FROM (SELECT channel, id, {unflagged(_PICKUP)} AS place FROM {{latest}})""",
    "resolve_now": f"""SELECT channel, id, CASE WHEN lower(trim(w)) = 'now' THEN CAST(message_date_gmt8 AS VARCHAR) ELSE w END AS time_text
      FROM (SELECT *, {found('message', P.TIME_LINE)} AS w FROM {{latest}})""",
    "resolve_pax": f"""SELECT channel, id, CASE WHEN {has('m', P.WHOLE_CAR)} OR {has('m', P.PAX_UNKNOWN)} THEN NULL
        WHEN lo >= 1 AND hi <= 10 AND lo <= hi THEN (lo + hi) // 2 WHEN {has('m', P.PAX_UNLABELLED_RANGE)} THEN NULL
        WHEN coalesce(a, b, 1) BETWEEN 1 AND 10 THEN coalesce(a, b, 1) END AS pax_count
      FROM (SELECT *, lower(message) AS m, {number(P.PAX_AFTER_LABEL)} AS a, {number(P.PAX_BEFORE_LABEL)} AS b,
        {number(P.PAX_RANGE_LOW)} AS lo, {number(P.PAX_RANGE_HIGH)} AS hi FROM {{latest}})""",
    "parse_status": "SELECT request_type, parse_status, count(*) AS requests FROM {silver} GROUP BY ALL",
    "silver_requests": "SELECT * FROM {silver}",
    "silver_merge": "SELECT * FROM {late_silver} UNION ALL SELECT f.* FROM {first_silver} f ANTI JOIN {late_silver} b "
                    "ON b.channel = f.channel AND b.message_id = f.message_id",
    "normalize_location": f"SELECT channel, message_id, nullif({squeezed('pickup_location')}, '') AS pickup, nullif({squeezed('dropoff_location')}, '') AS dropoff FROM {{silver}}",
    "distinct_locations": "SELECT * FROM {locations}",
    "locations_to_resolve": "SELECT * FROM {todo}",
    "postal_codes_in_text": f"""SELECT s.channel, s.message_id, coalesce(c.codes, '') AS codes FROM {{silver}} s LEFT JOIN (
        SELECT original_location, string_agg(code, ',' ORDER BY code_pos) AS codes FROM (
          {codes_of("(SELECT DISTINCT pickup_location AS normalized_location, pickup_location AS original_location FROM {silver})")})
        GROUP BY original_location) c ON c.original_location = s.pickup_location WHERE s.pickup_location IS NOT NULL""",
    "explode_postal_codes": "SELECT normalized_location, original_location, CAST(code_pos AS INTEGER) AS code_pos, code FROM {all_codes}",
    "non_specific_rule": rule_results("{all_vague}"),
    "search_fallbacks": "SELECT * FROM {longer_tries}",
    "choose_place": """SELECT h.query, CAST(h.n AS INTEGER) AS result_count, CASE h.codes WHEN 0 THEN 'no_match' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS status,
        g.postal, g.latitude, g.longitude, g.address, g.searchval
      FROM {hits} h LEFT JOIN {gazetteer} g ON g.query = h.query AND g.rank = h.place_rank AND h.codes = 1""",
    "choose_postal": """SELECT h.query, CAST(h.n AS INTEGER) AS result_count, CASE WHEN h.postal_rank IS NULL THEN 'no_match' ELSE 'resolved' END AS status,
        g.postal, g.latitude, g.longitude, g.address, g.searchval
      FROM {hits} h LEFT JOIN {gazetteer} g ON g.query = h.query AND g.rank = h.postal_rank""",
    "resolve_places": "SELECT * FROM {all_place_results}",
    "resolve_postals": "SELECT * FROM {all_postal_results}",
    "geocode_row": stamped("{all_place_results}"),
    "geocode_run": "SELECT * FROM {geocoded}",
    "geocode_replace": "SELECT * FROM {geocoded} UNION ALL SELECT * FROM {cache} WHERE resolution_source = 'override' "
                       "OR normalized_location NOT IN (SELECT normalized_location FROM {geocoded})",
    "apply_overrides": f"""SELECT c.normalized_location, c.original_location, {', '.join(
        f"CASE WHEN o.normalized_location IS NULL THEN c.{c} ELSE {v} END AS {c}" for c, v in _OVERRIDDEN.items())}
      FROM {{cache}} c LEFT JOIN {{reviewed}} o ON o.normalized_location = c.normalized_location
      UNION ALL SELECT o.normalized_location, o.normalized_location, {', '.join(_OVERRIDDEN.values())}
      FROM {{reviewed}} o WHERE o.normalized_location NOT IN (SELECT normalized_location FROM {{cache}})""",
    "choose_station": "SELECT * FROM {stations}",
    "build_overrides": "SELECT * FROM {station_overrides}",
    "build_overrides_failures": """SELECT t.normalized_location, t.search_value, coalesce(s.hit_count, 0) AS hit_count
      FROM {towns} t LEFT JOIN {stations} s ON s.query = t.search_value WHERE s.found IS NOT TRUE""",
    "overrides_upsert": f"""SELECT * FROM {{station_overrides}} UNION ALL
      SELECT normalized_location, postal_code, latitude, longitude, formatted_address,
        CASE WHEN CAST(postal_code AS BIGINT) % 3 = 0 THEN 'rebuilt' ELSE notes END AS notes,
        CASE WHEN CAST(postal_code AS BIGINT) % 3 = 0 THEN {RUN_AT} ELSE updated_at END AS updated_at FROM {{reviewed}}""",
    "geocode_status_counts": "SELECT resolution_status, resolution_source, count(*) AS location_count FROM {cache} GROUP BY ALL",
    "override_audit": "SELECT normalized_location, postal_code, formatted_address, resolution_source FROM {cache} WHERE resolution_source = 'override'",
    "override_audit_gold": f"""SELECT {', '.join(f'normalized_{s}_location, {s}_postal_code, {s}_formatted_address, {s}_resolution_source' for s in SIDES)}
      FROM {{gold}} WHERE 'override' IN (pickup_resolution_source, dropoff_resolution_source)""",
    "silver_request_id": f"SELECT channel, message_id, {sid()} AS silver_request_id FROM {{silver}}",
    "parsed_requests": "SELECT * FROM {parsed}",
    "affected_requests": f"SELECT DISTINCT silver_request_id FROM {{parsed}} WHERE scraped_at_gmt8 >= {NOW} - INTERVAL 48 HOUR",
    "rank_geocodes": "SELECT * FROM {ranked}",
    "enrich_geocodes": "SELECT * FROM {enriched}",
    "dedup_keys": "SELECT silver_request_id, pickup_formatted_address, dropoff_formatted_address, telegram_user_key, "
                  "pickup_dedup_location_key, dropoff_dedup_location_key FROM {keyed}",
    "repost_dedup": "SELECT silver_request_id, message_date_gmt8, telegram_user_key, pickup_dedup_location_key, dropoff_dedup_location_key, "
                    "pickup_formatted_address, dropoff_formatted_address FROM {kept}",
    "gold_request_id": f"SELECT silver_request_id, pickup_formatted_address, dropoff_formatted_address, {GOLD_ID} AS gold_request_id FROM {{keyed}}",
    "gold_requests": "SELECT * FROM {gold}",
    "gold_incremental": f"SELECT * FROM {{gold}} WHERE scraped_at_gmt8 >= {NOW} - INTERVAL 48 HOUR",
    "gold_merge": f"""SELECT * FROM {{gold}} WHERE scraped_at_gmt8 >= {_MERGE_FROM} UNION ALL
      SELECT * FROM {{first_gold}} WHERE silver_request_id NOT IN (SELECT {sid()} FROM {{silver}} WHERE scraped_at_gmt8 >= {_MERGE_FROM})""",
    "gold_late_posts": "SELECT * FROM {gold}",
    "recent_requests": feed(720, WITHIN),
    "feed_page": feed(720, WITHIN, 5000),
    "route_within": f"SELECT * FROM {{gold}} WHERE {WITHIN}",
    "route_cross_border": f"SELECT * FROM {{gold}} WHERE {CROSS}",
    "rolling_counts": "SELECT * FROM {rolling}",
    "live_counts": "SELECT * FROM {live}",
    "daily_counts": "SELECT * FROM {daily}",
    "dashboard_rows": "SELECT * FROM {dashboard}",
    "dashboard_partials": "SELECT * FROM {dashboard}",
    "dashboard_metrics": """SELECT r.request_type, r.window_hours, avg(r.metric_value) AS average_rolling_total,
        arg_max(r.metric_value, r.bucket_start_gmt8) AS current_rolling_total,
        (SELECT max(metric_value) FROM {dashboard} l WHERE l.metric = 'live_15m' AND l.request_type = r.request_type) AS live_15m_count,
        (SELECT string_agg(concat(bucket_start_gmt8, '=', CAST(metric_value AS BIGINT)), ';' ORDER BY bucket_start_gmt8)
          FROM {dashboard} d WHERE d.metric = 'daily_total' AND d.request_type = r.request_type) AS daily_points,
        string_agg(concat(r.bucket_start_gmt8, '=', CAST(r.metric_value AS BIGINT)), ';' ORDER BY r.bucket_start_gmt8) AS rolling_points
      FROM {dashboard} r WHERE r.metric = 'rolling' GROUP BY r.request_type, r.window_hours""",
    "chart_downsample": f"""SELECT * FROM {{rolling}} WHERE date_diff('minute', bucket_start, date_trunc('minute', {NOW})::TIMESTAMP) % (60 * window_hours) = 0
      AND bucket_start > date_trunc('minute', {NOW})::TIMESTAMP - INTERVAL 1 HOUR * (50 * window_hours)""",
    "unique_request_count": f"SELECT count(DISTINCT gold_request_id) AS total_count FROM {{gold}} WHERE {in_window(720)} AND request_type = 'driver_request'",
    "latest_request_time": f"SELECT CAST(max(message_date_gmt8) AS VARCHAR) AS latest_post_at FROM {{gold}} WHERE {in_window(720)} AND request_type = 'hitcher_request'",
    "recent_summary": f"""SELECT 720 AS minutes, 'sg-jb' AS tab, (SELECT count(*) FROM ({feed(720, CROSS, 20)})) AS count,
        (SELECT count(DISTINCT gold_request_id) FROM {{gold}} WHERE {in_window(720)} AND request_type = 'hitcher_request') AS total_count,
        (SELECT count(DISTINCT gold_request_id) FROM {{gold}} WHERE {in_window(60)} AND request_type = 'driver_request') AS active_driver_count,
        (SELECT CAST(max(message_date_gmt8) AS VARCHAR) FROM {{gold}} WHERE {in_window(720)}) AS latest_post_at""",
    "map_node_requests": "SELECT * FROM {node_requests}",
    "map_nodes": f"""SELECT node_id, kind, max(CASE WHEN nth = 1 THEN latitude END) AS latitude, max(CASE WHEN nth = 1 THEN longitude END) AS longitude,
        count(*) AS request_count, max(message_date_gmt8) AS newest_request_at, {score('max(message_date_gmt8)')} AS recency_score
      FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY message_date_gmt8 DESC, gold_request_id) AS nth FROM {{node_requests}})
      GROUP BY node_id, kind""",
    "recency_score": f"SELECT gold_request_id, {score('message_date_gmt8')} AS recency_score FROM {{gold}}",
    "service_hours_filter": "SELECT * FROM {messages} WHERE hour(message_date_gmt8) >= 21 OR hour(message_date_gmt8) < 7",
    "dq_not_null": " UNION ALL ".join([
        *[_nulls(f"{{{table}}}", name, C.quality.NOT_NULL[name]) for name, table in
          (("bronze", "copies"), ("geocodes", "cache"), ("silver", "silver"), ("gold", "gold"))],
        _nulls("{copies}", "optional", ["topic_id", "sender_handle"])]),
    "dq_in_write": " UNION ALL ".join([
        *[_nulls(f"{{{table}}}", table, C.quality.NOT_NULL[table]) for table in ("silver", "gold")],
        *[f"SELECT '{table}', 'request_type outside its list', count(*) FILTER (request_type NOT IN ('hitcher_request', 'driver_request')) FROM {{{table}}}"
          for table in ("silver", "gold")]]),
    "dq_unique": "SELECT normalized_location, count(*) AS copies FROM {cache} GROUP BY ALL HAVING count(*) > 1",
    "dq_accepted_values": """SELECT 'pax_count' AS column_name, CAST(pax_count + 10 AS VARCHAR) AS value, count(*) AS row_count
        FROM {silver} WHERE message_id % 97 = 0 AND pax_count IS NOT NULL GROUP BY ALL
      UNION ALL SELECT 'resolution_status', upper(resolution_status), count(*) FROM {cache} WHERE length(normalized_location) % 5 = 0 GROUP BY ALL""",
    "dq_duplicate_keys": "SELECT channel, id, count(*) AS copies FROM {copies} GROUP BY ALL HAVING count(*) > 1",
    "source_profile": """SELECT channel, topic_id, count(*) AS row_count, min(message_date_gmt8) AS oldest_message_gmt8,
        max(message_date_gmt8) AS newest_message_gmt8, max(id) AS maximum_message_id FROM {copies} GROUP BY ALL""",
    "stream_bronze_upsert": "SELECT * FROM {latest}",
    "stream_latest_copy": "SELECT * FROM {latest}",
    "stream_repost_dedup": """SELECT DISTINCT telegram_user_key, pickup_dedup_location_key, dropoff_dedup_location_key, message_date_gmt8, channel, message_id
      FROM {kept}""",
    "stream_rolling_counts": """SELECT g.request_type, 6 AS window_hours, b.bucket_start, count(DISTINCT g.gold_request_id) AS total_count
      FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 15 MINUTE)) AS bucket_start) b
      JOIN {gold} g ON g.message_date_gmt8 <= b.bucket_start AND g.message_date_gmt8 > b.bucket_start - INTERVAL 6 HOUR GROUP BY ALL""",
}

_NAME = re.compile(r"\{([a-z_]+)\}")


def statement(sql: str) -> str:
    """One statement: the parts that ``sql`` names, in order of need, then ``sql``."""
    ordered: dict[str, str] = {}

    def need(text: str) -> str:
        for name in _NAME.findall(text):
            if name not in TEST_TABLES and name not in ordered:
                body = need(PARTS[name])
                ordered[name] = f"{name} AS ({body})"
        return _NAME.sub(r"\1", text)

    main = need(sql)
    return f"WITH RECURSIVE {', '.join(ordered.values())} {main}" if ordered else main


_SAME = " AND ".join(["(s.topic_id IS NULL OR s.topic_id IS NOT DISTINCT FROM m.topic_id)", *(f"s.{c} IS NOT DISTINCT FROM m.{c}" for c in MESSAGE_COLUMNS[2:])])
ORACLE["merge_counts"] = f"""SELECT count(*) FILTER (m.id IS NULL) AS inserted, count(*) FILTER (m.id IS NOT NULL AND NOT ({_SAME})) AS updated,
    count(*) FILTER (m.id IS NOT NULL AND {_SAME}) AS unchanged
  FROM (SELECT {_list(MESSAGE_COLUMNS)} FROM {{messages}} UNION ALL SELECT {_list(MESSAGE_COLUMNS)} FROM {{upsert_batch}}) s
  LEFT JOIN {{messages}} m ON m.channel = s.channel AND m.id = s.id"""
ORACLE["incremental_fetch_pruned"] = ORACLE["incremental_fetch"]
ORACLE["stream_repost_changes"] = ORACLE["stream_repost_dedup"]
# The same merges into bucketed tables.
ORACLE |= {f"{name}_bucketed": ORACLE[name] for name in ("bronze_upsert", "silver_merge", "gold_merge")}


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in ORACLE.items()}
