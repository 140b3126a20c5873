"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each statement reads the driver's views and must give the same multiset of
rows, under the same column names, as the Spark plan in ``catalog``.
Windows and sessions are written as plain SQL (time buckets, gaps and
islands, analytic functions), not with the operators under test.
"""

_B = "time_bucket(INTERVAL '{w}', {ts}, TIMESTAMP '1970-01-01')"


def _bucket(w: str, ts: str = "ts") -> str:
    return _B.format(w=w, ts=ts)


_MS = "(epoch_us(ts) // 1000)"
_TEXT = ("'{user=''' || CAST(user_id AS VARCHAR) || ''', action=''' || event_type || ''', times=' "
         "|| CAST(" + _MS + " AS VARCHAR) || '}'")
_SEQ = "PARTITION BY user_id ORDER BY ts, event_id"

_SLIDING_COUNTS = f"""
SELECT ws AS window_start, ws + INTERVAL '2 hours' AS window_end, event_type, count(*) AS n
FROM (SELECT event_type, {_bucket('1 hour')} - k * INTERVAL '1 hour' AS ws
      FROM events, (VALUES (0), (1)) v(k)) x
GROUP BY ws, event_type
"""

_TOPN = f"""
SELECT window_start, window_end, event_type, n, rk FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end ORDER BY n DESC, event_type) AS BIGINT) AS rk
  FROM ({_SLIDING_COUNTS}) c) r
WHERE rk <= 2
"""

_APP = "(SELECT user_id, event_id, ts FROM events WHERE event_type = 'click')"
_THIRD = "(SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')"

ORACLE_SQL: dict[str, str] = {
    "sliding_counts": _SLIDING_COUNTS,
    "topn_sliding": _TOPN,
    "topn_array": f"""
SELECT window_start, window_end, string_agg(event_type || ':' || CAST(n AS VARCHAR), ',' ORDER BY rk) AS top
FROM ({_TOPN}) t GROUP BY window_start, window_end
""",
    "word_count": """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS v FROM documents),
toks AS (
  SELECT unnest(CASE WHEN v = '' THEN ['']
                     WHEN rtrim(v, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(v, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS n FROM toks GROUP BY word
""",
    "user_totals": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "running_count": f"""
SELECT user_id, event_id, ts, count(*) OVER ({_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
FROM events
""",
    "running_value_sum": f"""
SELECT user_id, event_id, ts,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER ({_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38, 2)) AS total
FROM events
""",
    "event_scan": f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS "user", event_type AS action, {_MS} AS times FROM events
""",
    "event_unpivot": f"""
SELECT event_id, 'user' AS key, CAST(user_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'action', event_type FROM events
UNION ALL SELECT event_id, 'times', CAST({_MS} AS VARCHAR) FROM events
""",
    "user_pairs": 'SELECT CAST(user_id AS VARCHAR) AS "user", CAST(1 AS BIGINT) AS n FROM events',
    "event_text": f"SELECT event_id, {_TEXT} AS value FROM events",
    "running_pair_text": f"""
SELECT '(' || CAST(user_id AS VARCHAR) || ',' ||
       CAST(count(*) OVER ({_SEQ} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS VARCHAR) || ')' AS value
FROM events
""",
    "route_events": """
SELECT event_id, user_id, event_type,
       CASE event_type WHEN 'click' THEN 'tag1' WHEN 'view' THEN 'tag2' ELSE 'main' END AS route
FROM events
""",
    "merge_tagged": f"""
SELECT '第一条流：' || {_TEXT} AS value FROM events WHERE event_type = 'click'
UNION ALL
SELECT '第二条流：' || {_TEXT} AS value FROM events WHERE event_type = 'view'
""",
    "tumbling_counts": f"""
SELECT {_bucket('5 hours')} AS window_start, {_bucket('5 hours')} + INTERVAL '5 hours' AS window_end,
       user_id, count(*) AS n
FROM events GROUP BY 1, 2, 3
""",
    "sliding_user_counts": f"""
SELECT ws AS window_start, ws + INTERVAL '2 hours' AS window_end, user_id, count(*) AS n
FROM (SELECT user_id, {_bucket('1 hour')} - k * INTERVAL '1 hour' AS ws
      FROM events, (VALUES (0), (1)) v(k)) x
GROUP BY ws, user_id
""",
    "session_counts": f"""
WITH o AS (SELECT user_id, event_id, ts, lag(ts) OVER ({_SEQ}) AS pts FROM events),
s AS (SELECT *, sum(CASE WHEN pts IS NULL OR ts - pts > INTERVAL '2 hours' THEN 1 ELSE 0 END)
                OVER ({_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o)
SELECT min(ts) AS session_start, max(ts) + INTERVAL '2 hours' AS session_end, user_id, count(*) AS n
FROM s GROUP BY user_id, sid
""",
    "dynamic_session_counts": f"""
WITH g AS (SELECT user_id, event_id, ts, ts + to_seconds(length(event_type) * 1800) AS te FROM events),
o AS (SELECT *, max(te) OVER ({_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pend FROM g),
s AS (SELECT *, sum(CASE WHEN pend IS NULL OR ts > pend THEN 1 ELSE 0 END)
                OVER ({_SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o)
SELECT min(ts) AS session_start, max(te) AS session_end, user_id, count(*) AS n
FROM s GROUP BY user_id, sid
""",
    "count_window_tumbling": f"""
SELECT user_id, (rn - 1) // 10 AS win, count(*) AS n, min(ts) AS start_ts, max(ts) AS end_ts
FROM (SELECT user_id, ts, row_number() OVER ({_SEQ}) AS rn FROM events) x
GROUP BY user_id, (rn - 1) // 10 HAVING count(*) = 10
""",
    "count_window_sliding": f"""
SELECT user_id, event_id, ts, count(*) OVER ({_SEQ} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n
FROM events
""",
    "count_window_sliding_10_5": f"""
SELECT user_id, event_id, ts, n FROM (
  SELECT user_id, event_id, ts, row_number() OVER ({_SEQ}) AS rn,
         count(*) OVER ({_SEQ} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
  FROM events) x
WHERE rn % 5 = 0
""",
    "count_window_sum": f"""
SELECT user_id, event_id, ts,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER ({_SEQ} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
            AS DECIMAL(38, 2)) AS total
FROM events
""",
    "window_join": f"""
SELECT a.user_id, {_bucket('1 day', 'a.ts')} AS window_start, {_bucket('1 day', 'a.ts')} + INTERVAL '1 day' AS window_end,
       a.event_id AS app_event_id, a.ts AS app_ts, b.event_id AS third_event_id, b.ts AS third_ts
FROM {_APP} a JOIN {_THIRD} b
  ON a.user_id = b.user_id AND {_bucket('1 day', 'a.ts')} = {_bucket('1 day', 'b.ts')}
""",
    "window_cogroup": f"""
SELECT user_id, {_bucket('1 day')} AS window_start, {_bucket('1 day')} + INTERVAL '1 day' AS window_end,
       CASE event_type WHEN 'click' THEN 'app' ELSE 'third' END AS side,
       row_number() OVER (PARTITION BY user_id, {_bucket('1 day')}, event_type ORDER BY event_id) AS rank, event_id
FROM events WHERE event_type IN ('click', 'purchase')
""",
    "reconcile_one_to_one": f"""
WITH t AS (SELECT user_id, event_id, {_MS} AS ms, CAST(event_type = 'purchase' AS INT) AS side FROM events
           WHERE event_type IN ('click', 'purchase')),
p AS (SELECT *, lag(event_id) OVER k AS pid, lag(ms) OVER k AS pms, lag(side) OVER k AS pside
      FROM t WINDOW k AS (PARTITION BY user_id ORDER BY ms, side, event_id)),
r AS (SELECT *, sum(CASE WHEN pside <> side AND ms - pms <= 3600000 THEN 0 ELSE 1 END)
                OVER (PARTITION BY user_id ORDER BY ms, side, event_id) AS run FROM p),
n AS (SELECT *, row_number() OVER k AS nth, count(*) OVER (PARTITION BY user_id, run) AS size
      FROM r WINDOW k AS (PARTITION BY user_id, run ORDER BY ms, side, event_id))
SELECT user_id,
       CASE WHEN side = 0 THEN event_id WHEN nth % 2 = 0 THEN pid END AS app_event_id,
       CASE WHEN side = 0 THEN ms WHEN nth % 2 = 0 THEN pms END AS app_ms,
       CASE WHEN side = 1 THEN event_id WHEN nth % 2 = 0 THEN pid END AS third_event_id,
       CASE WHEN side = 1 THEN ms WHEN nth % 2 = 0 THEN pms END AS third_ms,
       CASE WHEN nth % 2 = 0 THEN 'MATCHED' WHEN side = 0 THEN 'MISSING_THIRD' ELSE 'MISSING_APP' END AS status
FROM n WHERE nth % 2 = 0 OR nth = size
""",
    "event_time": f"""
SELECT event_id, make_timestamp({_MS} * 1000) AS ts,
       time_bucket(INTERVAL '5 hours', make_timestamp({_MS} * 1000), TIMESTAMP '1970-01-01') AS window_start,
       {_MS} AS times
FROM events
""",
    "interval_join": f"""
SELECT a.user_id, a.event_id AS app_event_id, a.ts AS app_ts, b.event_id AS third_event_id, b.ts AS third_ts
FROM {_APP} a JOIN {_THIRD} b
  ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '1 hour' AND a.ts + INTERVAL '2 hours'
""",
    "reconcile": f"""
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.event_id AS app_event_id, a.ts AS app_ts,
       b.event_id AS third_event_id, b.ts AS third_ts,
       CASE WHEN a.event_id IS NOT NULL AND b.event_id IS NOT NULL THEN 'MATCHED'
            WHEN b.event_id IS NULL THEN 'MISSING_THIRD' ELSE 'MISSING_APP' END AS status
FROM {_APP} a FULL JOIN {_THIRD} b
  ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '1 hour' AND a.ts + INTERVAL '1 hour'
""",
    "reconcile_alerts": f"""
SELECT user_id, event_id, ts, 'MISSING_THIRD' AS status FROM {_APP} a
WHERE NOT EXISTS (SELECT 1 FROM {_THIRD} b WHERE b.user_id = a.user_id
                  AND b.ts BETWEEN a.ts - INTERVAL '1 hour' AND a.ts + INTERVAL '1 hour')
UNION ALL
SELECT user_id, event_id, ts, 'MISSING_APP' AS status FROM {_THIRD} b
WHERE NOT EXISTS (SELECT 1 FROM {_APP} a WHERE a.user_id = b.user_id
                  AND a.ts BETWEEN b.ts - INTERVAL '1 hour' AND b.ts + INTERVAL '1 hour')
""",
}
