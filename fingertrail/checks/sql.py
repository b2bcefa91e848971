"""Common table expressions of the check SQL, over the ``events`` table."""

from __future__ import annotations

_COMMON = """
  SELECT event_id, user_id, user_id // 10 AS session_id, CAST(user_id % 10 AS INTEGER) AS fingerId,
         epoch_us(ts) / 6e8 - 2840112.0 AS time, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
"""

TOUCH = f"""
raw AS ({_COMMON}),
base AS (
  SELECT event_id, user_id, session_id, fingerId, time,
         CASE event_type WHEN 'signup' THEN 'Began' WHEN 'click' THEN 'Moved' WHEN 'view' THEN 'Stationary'
                         WHEN 'purchase' THEN 'Ended' WHEN 'error' THEN 'Canceled' END AS touchPhase,
         CAST((event_id * 7919) % 1920 AS DOUBLE) AS x, CAST(k * 10 AS DOUBLE) AS y,
         ['Wall', 'Outside', 'Roof', 'Door'][k % 4 + 1] AS zone,
         ['Red', 'Green', 'Blue'][k % 3 + 1] AS color,
         least(100.0, value / 5) AS completionPerc
  FROM raw),
counted AS (
  SELECT *, CAST(sum(CASE WHEN touchPhase = 'Began' THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY time, event_id) AS BIGINT) AS cb
  FROM base),
touch AS (
  SELECT *, user_id * 1000 + cb AS Touchdata_id,
         row_number() OVER (PARTITION BY user_id, cb ORDER BY time, event_id) - 1 AS event_index
  FROM counted)
"""

TRACE = f"""
raw AS ({_COMMON}),
trace AS (
  SELECT event_id, session_id, fingerId, time,
         CASE event_type WHEN 'signup' THEN 'B' WHEN 'click' THEN 'M' WHEN 'view' THEN 'S'
                         WHEN 'purchase' THEN 'E' WHEN 'error' THEN 'X' END AS touchPhase,
         CAST(CASE WHEN event_id % 5 < 3 THEN user_id % 1920 ELSE (event_id * 7919) % 1920 END AS DOUBLE) AS x,
         CAST(CASE WHEN event_id % 5 < 3 THEN user_id % 1080 ELSE k * 10 END AS DOUBLE) AS y,
         ['Wall', 'Outside', 'Roof', 'Door'][k % 4 + 1] AS zone,
         value AS distance, event_id % 30 AS camFrame, event_type = 'click' AS isDragging
  FROM raw)
"""

# an open sequence is one whose latest begin or end so far is a begin
SEGMENT = TOUCH + """,
opened AS (
  SELECT *, coalesce(last_value(CASE WHEN touchPhase = 'Began' THEN 1
                                     WHEN touchPhase IN ('Ended', 'Canceled') THEN 0 END IGNORE NULLS)
           OVER (PARTITION BY session_id, fingerId ORDER BY time, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_before
  FROM touch),
numbered AS (
  SELECT *, CASE WHEN touchPhase = 'Began' OR open_before = 1 THEN cb ELSE 0 END AS seqId FROM opened),
looked AS (
  SELECT *, max(cb) OVER (PARTITION BY session_id, fingerId) AS last_cb,
         max(touchPhase IN ('Ended', 'Canceled')) OVER (PARTITION BY session_id, fingerId, seqId) AS has_end,
         max(touchPhase IN ('Moved', 'Stationary')) OVER (PARTITION BY session_id, fingerId, seqId) AS has_mid
  FROM numbered),
seg AS (
  SELECT event_id, session_id, fingerId, Touchdata_id, event_index, x, y, time, touchPhase, color,
         completionPerc, zone, seqId,
         seqId > 0 AND NOT has_end AND seqId < last_cb AS sequence_interrupted,
         seqId = 0 AND (touchPhase IN ('Ended', 'Canceled') OR cb > 0) AS orphaned_events,
         FALSE AS multiple_end_events,
         seqId > 0 AND ((NOT has_end AND seqId < last_cb) OR (has_end AND NOT has_mid)) AS improper_sequence_order
  FROM looked)
"""

TRACE_SEGMENT = TRACE + """,
t1 AS (
  SELECT *, CAST(sum(CASE WHEN touchPhase = 'B' THEN 1 ELSE 0 END) OVER f AS BIGINT) AS seqId,
         coalesce(last_value(CASE WHEN touchPhase = 'B' THEN 1 WHEN touchPhase = 'E' THEN 0 END IGNORE NULLS)
           OVER (PARTITION BY session_id, fingerId ORDER BY time, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_before,
         lag(x) OVER f AS px, lag(y) OVER f AS py, lag(distance) OVER f AS pd
  FROM trace WINDOW f AS (PARTITION BY session_id, fingerId ORDER BY time, event_id)),
t2 AS (
  SELECT *, max(touchPhase = 'E') OVER (PARTITION BY session_id, fingerId, seqId) AS has_e,
         CASE WHEN touchPhase = 'B' AND open_before = 0 THEN 1
              WHEN touchPhase = 'E' AND open_before = 1 THEN -1 ELSE 0 END AS delta
  FROM t1),
tseg AS (
  SELECT event_id, session_id, fingerId, time, touchPhase, x, y, zone, distance, camFrame, isDragging, seqId,
         touchPhase IN ('M', 'S', 'E') AND open_before = 0 AS ORPHANED_FINGER,
         seqId > 0 AND NOT has_e AS UNTERMINATED,
         coalesce(touchPhase = 'M' AND abs(x - px) < 0.01 AND abs(y - py) < 0.01 AND distance > pd, FALSE)
           AS PHANTOM_MOVE,
         delta = 1 AND coalesce(sum(delta) OVER (PARTITION BY session_id ORDER BY time, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS OVERLAPPING_FINGERIDS
  FROM t2)
"""

# regular expressions over the phase letters: another way to the pattern checks than counting
PATTERN = """,
letters AS (
  SELECT session_id, Touchdata_id,
         string_agg(CASE touchPhase WHEN 'Began' THEN 'B' WHEN 'Moved' THEN 'M' WHEN 'Stationary' THEN 'S'
                    WHEN 'Ended' THEN 'E' WHEN 'Canceled' THEN 'C' ELSE 'X' END, '' ORDER BY event_index) AS word
  FROM touch GROUP BY session_id, Touchdata_id),
pattern AS (
  SELECT session_id, Touchdata_id, word, regexp_full_match(word, 'B[MS]*C?E') AS is_valid,
         regexp_full_match(word, 'B[MS]*C?[MS]*E') AS is_loose
  FROM letters)
"""

FLAGS = SEGMENT + PATTERN + """,
stepped AS (
  SELECT seg.*, is_valid,
         time - lag(time) OVER (PARTITION BY session_id, fingerId, seqId ORDER BY time, event_id) AS step
  FROM seg JOIN pattern USING (session_id, Touchdata_id)),
seqs AS (
  SELECT session_id, fingerId, seqId,
         arg_min(is_valid, (time, event_id)) AS valid, arg_min(touchPhase, (event_index, time, event_id)) AS first_phase,
         min(time) AS startTime, max(time) FILTER (touchPhase = 'Ended') AS endTime, count(*) AS nPoints,
         bool_or(touchPhase = 'Canceled') AS hasCanceled, bool_or(coalesce(step > 100, FALSE)) AS gap,
         bool_or(sequence_interrupted) AS interrupted, bool_or(improper_sequence_order) AS improper
  FROM stepped GROUP BY session_id, fingerId, seqId),
listed AS (
  SELECT *, endTime - startTime AS durationSec,
         [f for f in [
           CASE WHEN NOT valid AND first_phase <> 'Began' THEN 'missing_Began' END,
           CASE WHEN NOT valid AND endTime IS NULL AND NOT interrupted THEN 'missing_Ended' END,
           CASE WHEN NOT valid AND gap THEN 'sequence_gap' END,
           CASE WHEN NOT valid AND endTime - startTime < 0.01 THEN 'short_duration' END,
           CASE WHEN NOT valid AND nPoints < 3 THEN 'too_few_points' END,
           CASE WHEN NOT valid AND hasCanceled THEN 'has_canceled' END,
           CASE WHEN interrupted THEN 'sequence_interrupted' END,
           CASE WHEN improper THEN 'improper_sequence_order' END] if f IS NOT NULL] AS flag_list
  FROM seqs),
flagged AS (
  SELECT seg.*, CASE WHEN seg.seqId > 0 THEN array_to_string(flag_list, ',')
                     WHEN orphaned_events THEN 'orphaned_events' ELSE 'missing_Began' END AS flags
  FROM seg JOIN listed USING (session_id, fingerId, seqId))
"""

TRACE_FLAGS = TRACE_SEGMENT + """,
tflagged AS (
  SELECT *, concat_ws(',', CASE WHEN ORPHANED_FINGER THEN 'ORPHANED_FINGER' END,
                           CASE WHEN UNTERMINATED THEN 'UNTERMINATED' END,
                           CASE WHEN OVERLAPPING_FINGERIDS THEN 'OVERLAPPING_FINGERIDS' END,
                           CASE WHEN PHANTOM_MOVE THEN 'PHANTOM_MOVE' END) AS flags
  FROM tseg)
"""


# step, movement and running columns of a touch
STEPS = """,
f1 AS (
  SELECT *, coalesce(time - lag(time) OVER s, 0) AS time_diff, coalesce(x - lag(x) OVER s, 0) AS x_diff,
         coalesce(y - lag(y) OVER s, 0) AS y_diff, lag(touchPhase) OVER s AS prev_phase,
         completionPerc - lag(completionPerc) OVER s AS c_step, zone IS DISTINCT FROM lag(zone) OVER s AS z_new,
         color IS DISTINCT FROM lag(color) OVER s AS k_new,
         sum(time) OVER (PARTITION BY session_id, Touchdata_id ORDER BY event_index) AS cumulative_time,
         count(*) OVER t AS n
  FROM touch
  WINDOW s AS (PARTITION BY session_id, Touchdata_id ORDER BY event_index),
         t AS (PARTITION BY session_id, Touchdata_id)),
f2 AS (
  SELECT *, sqrt(x_diff * x_diff + y_diff * y_diff) AS distance, atan2(y_diff, x_diff) AS direction_angle,
         sqrt(x_diff * x_diff + y_diff * y_diff) / (time_diff + 1e-8) AS velocity
  FROM f1),
f3 AS (
  SELECT *, coalesce(velocity - lag(velocity) OVER s, 0) AS acceleration,
         coalesce(direction_angle - lag(direction_angle) OVER s, 0) AS raw_turn,
         coalesce(time_diff - lag(time_diff) OVER s, 0) AS time_acceleration,
         sum(distance) OVER (PARTITION BY session_id, Touchdata_id ORDER BY event_index) AS cumulative_distance
  FROM f2 WINDOW s AS (PARTITION BY session_id, Touchdata_id ORDER BY event_index))
"""


def tidy(expression: str, digits: int = 6) -> str:
    """Rounding that never yields a negative zero."""
    return (f"CASE WHEN abs({expression}) < {0.5 * 10 ** -digits} THEN 0.0::DOUBLE "
            f"ELSE round({expression}, {digits}) END")


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"
