"""DuckDB oracle SQL for the streaming queries: a drained stream must equal
the batch result."""

from __future__ import annotations

from tripcast.plans.oracles_clean import ORACLES as _C
from tripcast.plans import common as Q
from tripcast.plans.oracle_base import feature_select
from tripcast.plans.oracles_models import BASE, BASELINE
from tripcast.plans.oracles_windows import ORACLES as _W
from tripcast.plans.queries_streams import MODELS

STREAM_SCORE = BASE + f"""
, corr AS (SELECT pickup_hour, avg(ln(1 + trip_duration) - ln(1 + {BASELINE})) AS log_correction
           FROM tr CROSS JOIN coef GROUP BY pickup_hour),
  rq AS (SELECT tpep_pickup_datetime, trip_distance, PULocationID, passenger_count IS NOT NULL AS is_valid,
                {feature_select()} FROM trips_raw WHERE year(tpep_pickup_datetime) >= {Q.TEST_FROM_YEAR})
SELECT CASE WHEN is_valid THEN tpep_pickup_datetime END AS tpep_pickup_datetime,
       CASE WHEN is_valid THEN round(trip_distance, 4) END AS trip_distance,
       CASE WHEN is_valid THEN CAST(PULocationID AS DOUBLE) END AS PULocationID,
       CASE WHEN is_valid THEN round({BASELINE} * exp(log_correction) / 60.0, 4) END AS duration_minutes, is_valid
FROM rq CROSS JOIN coef LEFT JOIN corr USING (pickup_hour)"""

DRIFT_MODELS = f"""WITH e AS (SELECT event_id, CAST(user_id % {MODELS} AS VARCHAR) AS model, (value - 50.0)^2 AS sq_err,
        CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id % {MODELS} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS epoch FROM events),
 w AS (SELECT *, sqrt(avg(sq_err) OVER win) AS rmse, count(sq_err) OVER win AS window_size
       FROM e WHERE sq_err IS NOT NULL WINDOW win AS (PARTITION BY model ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT model, epoch, min(event_id) AS event_id, round(arg_min(rmse, event_id), 6) AS rmse
FROM w WHERE window_size = 5 AND rmse > 60.0 GROUP BY model, epoch"""

ORACLES = {
    "stream_drift_models": DRIFT_MODELS,
    "stream_ingest": "SELECT * FROM events",
    "stream_preprocess": _C["preprocess"],
    "stream_score": STREAM_SCORE,
    "stream_drift": _W["drift_alert"],
    "stream_daily_stats": _C["daily_stats"],
}
