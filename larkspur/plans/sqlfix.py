"""DuckDB SQL fragments that re-derive the fixtures straight from the tables.

They restate the derivation rules of ``larkspur.sources`` in SQL so the
oracle never runs our Spark code.
"""

# Status fixture: one row per hashtag occurrence (see sources.topic.status_records).
STATUS_TAGS = """
e AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset",
         strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour
  FROM events),
tags AS (
  SELECT "partition", "offset", date, hour, ts, event_type AS hashtag FROM e
   WHERE event_type <> 'error' AND event_id % 50 NOT IN (7, 13, 17)
  UNION ALL
  SELECT "partition", "offset", date, hour, ts, 'k' || CAST(k AS VARCHAR) FROM e
   WHERE event_type <> 'error' AND event_id % 50 NOT IN (7, 13, 17, 21) AND k IS NOT NULL
  UNION ALL
  SELECT "partition", "offset", date, hour, ts, event_type FROM e
   WHERE event_type = 'purchase' AND event_id % 50 NOT IN (7, 13, 17, 21)
  UNION ALL
  SELECT "partition", "offset", date, hour, ts, 'k;' || CAST(k % 7 AS VARCHAR) FROM e
   WHERE event_type <> 'error' AND event_id % 50 = 41 AND k IS NOT NULL)
"""
