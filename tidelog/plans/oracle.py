"""Shared SQL pieces of the checks: the fixture rules as common table expressions."""

from tidelog.schema import DEFAULT_HEADER_PREFIX as PREFIX


def mid(position: str) -> str:
    return f"'rmid1:' || lpad(CAST({position} AS VARCHAR), 18, '0')"


MSG = f"""msg AS (
  SELECT event_id AS e, {mid('event_id')} AS rgmid, user_id,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN ''
         ELSE 'corr-' || CAST(event_id AS VARCHAR) END AS corr,
    'app-' || CAST(event_id AS VARCHAR) AS app,
    'events/' || event_type AS topic,
    CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(user_id AS VARCHAR)
         WHEN event_type = 'error' THEN '' END AS pkey,
    CASE WHEN event_id % 7 IN (0, 1) THEN epoch_us(ts) ELSE epoch_us(ts) - 1000000 END AS time_us,
    epoch_us(ts) AS receive_us,
    CASE WHEN event_id % 100 <= 90 THEN props
         WHEN event_id % 100 IN (91, 92, 93, 94, 95, 98) THEN 'att:' || props
         WHEN event_id % 100 IN (96, 97) THEN 'cnt:' || props
         ELSE '' END AS body,
    event_id % 2 AS consumer, event_id // 100 AS batch,
    epoch_us(ts) // 86400000000 AS day_no
  FROM events)"""

HDR = f"""hdr AS (
  SELECT e, 'colour' AS name, 'amber' AS val FROM msg
  UNION ALL SELECT e, 'checked', 'true' FROM msg
  UNION ALL SELECT e, 'blank', '' FROM msg
  UNION ALL SELECT e, 'ordinal', CAST(e AS VARCHAR) FROM msg
  UNION ALL SELECT e, 'JMSXGroupID', pkey FROM msg WHERE pkey IS NOT NULL
  UNION ALL SELECT e, '{PREFIX}sequenceNumber', CAST(e AS VARCHAR) FROM msg WHERE e % 4 <> 0
  UNION ALL SELECT e, '{PREFIX}expiration', '0' FROM msg
  UNION ALL SELECT e, '{PREFIX}timeToLive', CAST((e % 3) * 1000 AS VARCHAR) FROM msg
  UNION ALL SELECT e, '{PREFIX}priority', CAST(e % 10 AS VARCHAR) FROM msg
  UNION ALL SELECT e, '{PREFIX}redelivered', CASE WHEN e % 25 = 0 THEN 'true' ELSE 'false' END
    FROM msg)"""

HIST = f"""hist AS (
  SELECT 'c-' || CAST(consumer AS VARCHAR) AS part, max(rgmid) AS ids, day_no,
         max(rgmid) AS floor_id
  FROM msg GROUP BY consumer, day_no
  UNION ALL
  SELECT CAST(user_id AS VARCHAR),
         CASE WHEN user_id % 10 = 7 THEN '' ELSE min(rgmid) || ',' || max(rgmid) END, day_no,
         CASE WHEN user_id % 10 <> 7 THEN min(rgmid) END
  FROM msg WHERE pkey <> '' GROUP BY user_id, day_no),
ckpt AS (
  SELECT part, ids, floor_id FROM hist
  WHERE (part, day_no) IN (SELECT part, max(day_no) FROM hist GROUP BY part))"""

FAULTY = f"""faulty AS (
  SELECT e, day_no, time_us, pkey, body,
    CASE WHEN e % 11 <> 0 THEN rgmid END AS id,
    CASE WHEN e % 13 <> 0 THEN topic END AS topic,
    CASE WHEN e % 17 <> 0 THEN body END AS payload,
    CASE WHEN e % 11 = 0 THEN 'Id is null' WHEN e % 13 = 0 THEN 'Topic is null'
         WHEN e % 17 = 0 THEN 'Payload is null'
         WHEN e % 19 = 0 THEN 'invalid header priority' END AS reason
  FROM msg)"""
