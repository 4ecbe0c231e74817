"""DuckDB oracle SQL for the count windows."""

from __future__ import annotations

from tripcast import schema as S
from tripcast.plans.oracle_base import BASE

K = S.DRIFT_WINDOW
ERR = """WITH e AS (SELECT event_id, ts, event_type, (value - 50.0)^2 AS sq_err,
        CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
             OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch FROM events),
 w AS (SELECT *, sqrt(avg(sq_err) OVER win) AS rmse, count(sq_err) OVER win AS window_size
       FROM e WHERE sq_err IS NOT NULL WINDOW win AS (ORDER BY event_id ROWS BETWEEN {k1} PRECEDING AND CURRENT ROW))
""".format(k1=K - 1)

ORACLES = {
    "sliding_rmse": ERR + f"""
SELECT event_id, round(rmse, 6) AS rmse, window_size, window_size = {K} AS window_full FROM w""",
    "validation_rmse": ERR + """
, last_row AS (SELECT CAST(ts AS DATE) AS call_date, max(event_id) AS event_id FROM w GROUP BY ALL),
  samples AS (SELECT CAST(ts AS DATE) AS call_date, count(*) AS samples FROM e GROUP BY ALL)
SELECT strftime(s.call_date, '%Y-%m-%d') AS call_date, s.samples, round(w.rmse, 6) AS current_rmse, w.window_size
FROM samples s LEFT JOIN last_row l USING (call_date) LEFT JOIN w ON w.event_id = l.event_id""",
    "drift_alert": ERR + f"""
SELECT epoch, min(event_id) AS event_id, round(arg_min(rmse, event_id), 6) AS rmse
FROM w WHERE window_size = {K} AND rmse > 60.0 GROUP BY epoch""",
    "rolling_7d": BASE + """
, d AS (SELECT date_int, sum(trip_duration) / count(trip_duration) AS avg_duration FROM trips_feat GROUP BY date_int)
SELECT date_int, round(avg_duration, 4) AS avg_duration,
       round(CASE WHEN count(avg_duration) OVER r = 7 THEN avg(avg_duration) OVER r END, 4) AS rolling_7d
FROM d WINDOW r AS (ORDER BY date_int ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
}
