"""Sample tables derived from the star-schema test tables.

The texts below are SQL that Spark and DuckDB both run, with table names in braces, so a
check on another engine starts from exactly the same rows. All tables grow with theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-30 23:57:20"


def _messages(pax_line: str, scraped_after: str, where: str) -> str:
    return f"""
SELECT concat('chan', user_id % 4) AS channel,
  CASE WHEN event_id % 3 = 0 THEN 100 + event_id % 2 END AS topic_id,
  event_id AS id, ts AS message_date_gmt8,
  concat_ws(chr(10),
    CASE event_id % 8 WHEN 0 THEN 'Hitcher looking for driver' WHEN 1 THEN 'Driver looking for passengers'
      WHEN 2 THEN '接送服务 5 seater' WHEN 3 THEN 'Biker looking for pillion' WHEN 4 THEN 'Looking driver'
      WHEN 6 THEN 'hello' ELSE 'Hi' END,
    CASE WHEN event_id % 8 <> 6 THEN concat(
      CASE event_id % 3 WHEN 0 THEN 'Pick up: ' WHEN 1 THEN 'Pickup Point : ' ELSE 'pick  up: ' END,
      CASE user_id % 6 WHEN 0 THEN 'KSL  City' WHEN 1 THEN 'JB→SG'
        WHEN 2 THEN concat('Blk 53010', event_id % 3, ' / 53020', event_id % 2)
        WHEN 3 THEN CASE WHEN user_id % 12 = 3 THEN 'Vivo Lobby' ELSE concat('Mall ', user_id, ' Side  Entrance') END
        WHEN 4 THEN 'Plaza' ELSE '🇸🇬' END) END,
    CASE WHEN event_id % 8 <> 6 THEN concat('Drop off: ',
      CASE event_id % 4 WHEN 0 THEN 'Bugis..' WHEN 1 THEN 'SG🇸🇬' ELSE 'Bugis' END) END,
    CASE WHEN event_id % 8 <> 7 THEN CASE WHEN event_id % 4 = 0 THEN 'Time: NOW' ELSE 'Time: 6pm' END END,
    {pax_line}) AS message,
  1000 + user_id % 25 AS sender_id,
  CASE WHEN user_id % 20 <> 0 THEN concat('@U', user_id) END AS sender_handle,
  ts + {scraped_after} AS scraped_at_gmt8
FROM {{events}} WHERE {where}"""


def _mall_hits(rank: int) -> str:
    return f"""
SELECT concat('mall ', c_custkey) AS query, {rank} AS rank,
  CASE c_custkey % 5
    WHEN 0 THEN concat('', 100000 + c_custkey) WHEN 1 THEN concat('', 100000 + c_custkey + {rank})
    WHEN 2 THEN 'NIL' WHEN 3 THEN CASE WHEN {rank} = 0 THEN 'NIL' ELSE concat(' ', 200000 + c_custkey, ' ') END
    ELSE concat('', 300000 + c_custkey) END AS postal,
  CASE WHEN c_custkey % 35 = 4 THEN 'unknown' ELSE concat('1.3', 100 + c_custkey % 800) END AS latitude,
  concat('103.8', 100 + c_custkey % 800) AS longitude,
  concat('Mall ', c_custkey, ' Road') AS address, concat('MALL ', c_custkey) AS searchval
FROM {{customer}}"""


def _mall_cache(copy: int) -> str:
    return f"""
SELECT concat('mall ', c_custkey, ' side entrance') AS normalized_location,
  concat('Mall ', c_custkey, ' Side Entrance') AS original_location,
  CASE WHEN c_custkey % 4 < 2 THEN concat('', 100000 + c_custkey + {copy} * (c_custkey % 2)) END AS postal_code,
  CASE WHEN c_custkey % 4 < 2 THEN CAST(concat('1.3', 100 + c_custkey % 800) AS DOUBLE) END AS latitude,
  CASE WHEN c_custkey % 4 < 2 THEN CAST(concat('103.8', 100 + c_custkey % 800) AS DOUBLE) END AS longitude,
  CASE WHEN c_custkey % 4 < 2 THEN concat('Mall ', c_custkey, ' Road') END AS formatted_address,
  CASE WHEN c_custkey % 4 < 2 THEN concat('MALL ', c_custkey) END AS search_value,
  CASE c_custkey % 4 WHEN 2 THEN 'ambiguous' WHEN 3 THEN CASE WHEN c_custkey % 8 = 3 THEN 'error' ELSE 'no_match' END
    ELSE 'resolved' END AS resolution_status,
  CASE WHEN c_custkey % 12 = 0 AND {copy} = 1 THEN 'override' WHEN c_custkey % 4 = 0 AND {copy} = 1 THEN 'rule'
    ELSE 'onemap' END AS resolution_source,
  CAST(1 + c_custkey % 3 AS INT) AS result_count,
  CASE WHEN c_custkey % 8 = 3 THEN 'timed out' END AS error_message,
  TIMESTAMP '2024-01-02 03:04:05' AS attempted_at,
  CASE WHEN c_custkey % 4 < 2 THEN TIMESTAMP '2024-01-02 03:04:05' END AS resolved_at
FROM {{customer}}"""


_BASE_PAX = """CASE WHEN event_id % 5 = 0 THEN concat('Pax: ', event_id % 3, '-', event_id % 7)
      ELSE concat('Pax: ', event_id % 12) END"""
_EDITED_PAX = """CASE event_id % 5 WHEN 0 THEN 'Whole car pax 3' WHEN 1 THEN 'Pax nil' WHEN 2 THEN '2-3 pax'
      WHEN 3 THEN 'Pax: 100' ELSE '4 passengers' END"""

# Messages as first seen, one per event.
MESSAGES = _messages(_BASE_PAX, "INTERVAL '5' MINUTE", "event_id IS NOT NULL")
# A second, later copy of some messages with an edited passenger line.
EDITS = _messages(_EDITED_PAX, "INTERVAL '65' MINUTE", "event_id % 7 = 0")
# The log of all copies.
MESSAGE_COPIES = f"{MESSAGES} UNION ALL {EDITS}"

# Configured sources: every channel, and one topic of one channel by itself.
SOURCES = """
SELECT DISTINCT concat(' @Chan', user_id % 4) AS channel, CAST(NULL AS BIGINT) AS topic_id,
  concat('chan', user_id % 4) AS state_key FROM {events}
UNION ALL SELECT DISTINCT 'chan1' AS channel, CAST(100 AS BIGINT) AS topic_id, 'chan1#topic=100' AS state_key
FROM {events} WHERE user_id % 4 = 1"""
# Checkpoints: chan0 is done, chan1 is in its backfill, the others were never read.
STATE = """
SELECT concat('chan', user_id % 4) AS state_key, max(event_id) - max(event_id) % 100 - 400 AS last_message_id,
  user_id % 4 = 0 AS initial_backfill_complete
FROM {events} WHERE user_id % 4 < 2 GROUP BY user_id % 4"""

# Search hits. Malls come from customers: one, two or no postal codes among three hits.
# The fixed places are those of the messages, repeated under growing ranks by supplier.
GAZETTEER = " UNION ALL ".join(_mall_hits(rank) for rank in range(3)) + """
UNION ALL
SELECT CASE s_suppkey % 8 WHEN 0 THEN 'vivo' WHEN 1 THEN 'plaza' WHEN 2 THEN 'bugis' WHEN 3 THEN '530100'
    WHEN 4 THEN '530101' WHEN 5 THEN '530200' WHEN 6 THEN '530102' ELSE '530201' END AS query,
  CAST(s_suppkey AS INT) AS rank,
  CASE s_suppkey % 8 WHEN 0 THEN '098585' WHEN 1 THEN concat('', 400000 + s_suppkey)
    WHEN 2 THEN CASE WHEN s_suppkey % 24 = 2 THEN 'NIL' ELSE '188024' END WHEN 3 THEN '530100' WHEN 4 THEN ' 530101'
    WHEN 5 THEN CASE WHEN s_suppkey % 16 = 5 THEN '530201' ELSE '530200' END ELSE '999999' END AS postal,
  concat('1.2', 100 + s_suppkey % 800) AS latitude, concat('103.7', 100 + s_suppkey % 800) AS longitude,
  concat(s_suppkey % 3, ' Fixed Street') AS address, concat('PLACE ', s_suppkey % 5) AS searchval
FROM {supplier}
UNION ALL
SELECT concat(upper(substr(town, 1, 1)), substr(town, 2), ' MRT Station') AS query,
  CAST(p_partkey AS INT) AS rank,
  CASE p_partkey % 4 WHEN 0 THEN 'NIL' WHEN 1 THEN concat('', 500000 + p_partkey) ELSE concat('', 600000 + p_partkey) END AS postal,
  CASE WHEN p_partkey % 6 = 1 THEN ' ' ELSE concat('1.4', 100 + p_partkey % 800) END AS latitude,
  concat('103.9', 100 + p_partkey % 800) AS longitude,
  CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat(p_partkey, ' Station Road') END AS address,
  CASE p_partkey % 3 WHEN 0 THEN 'BUS STOP' WHEN 1 THEN concat('STATION ', p_partkey, ' MRT') ELSE 'TAXI STAND' END AS searchval
FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'bedok' WHEN 1 THEN 'bishan' WHEN 2 THEN 'clementi'
  WHEN 3 THEN 'dover' WHEN 4 THEN 'expo' WHEN 5 THEN 'simei' ELSE 'yishun' END AS town FROM {part}) AS stations"""

# Geocode cache left by earlier runs; malls again from customers, with all outcomes.
CACHE = " UNION ALL ".join(_mall_cache(copy) for copy in range(2)) + """
UNION ALL
SELECT place AS normalized_location, place AS original_location,
  CASE place WHEN 'bugis' THEN '188024' WHEN 'vivo lobby' THEN '098585' WHEN 'ksl city' THEN NULL
    WHEN 'blk 530100 / 530200' THEN '530100,530200' ELSE '530101' END AS postal_code,
  CASE place WHEN 'ksl city' THEN NULL ELSE CAST(concat('1.2', 100 + r_regionkey) AS DOUBLE) END AS latitude,
  CASE place WHEN 'ksl city' THEN NULL ELSE CAST(concat('103.7', 100 + r_regionkey) AS DOUBLE) END AS longitude,
  concat('Street ', r_regionkey % 3) AS formatted_address, upper(place) AS search_value,
  'resolved' AS resolution_status, CASE WHEN r_regionkey = 0 THEN 'override' ELSE 'onemap' END AS resolution_source,
  1 AS result_count, CAST(NULL AS VARCHAR(10)) AS error_message,
  TIMESTAMP '2024-01-03 03:04:05' AS attempted_at, TIMESTAMP '2024-01-03 03:04:05' AS resolved_at
FROM (SELECT r_regionkey, CASE r_regionkey WHEN 0 THEN 'bugis' WHEN 1 THEN 'vivo lobby' WHEN 2 THEN 'ksl city'
  WHEN 3 THEN 'blk 530100 / 530200' ELSE 'blk 530101 / 530201' END AS place FROM {region}) AS places"""

# Reviewed overrides as a person types them; some are the same place written twice.
OVERRIDES = """
SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'KSL   City' WHEN s_suppkey % 5 = 1 THEN concat('  New Place ', s_suppkey)
    ELSE concat('Mall  ', s_suppkey, ' SIDE entrance') END AS normalized_location,
  concat('', 700000 + s_suppkey) AS postal_code,
  CAST(concat('1.4', 100 + s_suppkey % 800) AS DOUBLE) AS latitude,
  CAST(concat('103.6', 100 + s_suppkey % 800) AS DOUBLE) AS longitude,
  concat(s_suppkey, ' Reviewed Road') AS formatted_address, 'checked' AS notes,
  TIMESTAMP '2024-01-05 00:00:00' + INTERVAL '1' DAY * (s_suppkey % 11) AS updated_at
FROM {supplier}"""

_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint",
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint",
    "part": "p_partkey bigint",
    "region": "r_regionkey int",
}


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One sample table; only the test tables and columns its text names are read."""
    used = {name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
            for name, schema in _TABLES.items() if f"{{{name}}}" in sql}
    return spark.sql(sql, **used)
