"""DuckDB oracle SQL for the trend model and the stub-corrected hybrid."""

from __future__ import annotations

from tripcast import schema as S
from tripcast.plans import common as Q
from tripcast.plans.oracle_base import CLEAN_BASE, TRIPS_FEATP, TRIPS_RAW, with_ctes

A = S.RIDGE_ALPHA


def _det(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a})*(({e})*({i})-({f})*({h})) - ({b})*(({d})*({i})-({f})*({g})) + ({c})*(({d})*({h})-({e})*({g})))"


_M = [[f"dd + {A}", "ds", "dc"], ["ds", f"ss + {A}", "sc"], ["dc", "sc", f"cc + {A}"]]
_R = ["dy", "sy", "cy"]


def _w(j):
    m = [[_R[i] if k == j else _M[i][k] for k in range(3)] for i in range(3)]
    return f"{_det(m)} / {_det(_M)}"


RIDGE = f"""
 tr AS (SELECT * FROM trips_featp WHERE pickup_year < {Q.TRAIN_BEFORE_YEAR}),
 te AS (SELECT * FROM trips_featp WHERE pickup_year >= {Q.TEST_FROM_YEAR}),
 daily AS (SELECT date_int, min(sin_time) AS s, min(cos_time) AS c,
                  ln(1 + sum(trip_duration) / count(trip_duration)) AS y, sum(trip_duration) / count(trip_duration) AS avg_duration
           FROM tr GROUP BY date_int),
 mu AS (SELECT avg(date_int) AS md, avg(s) AS ms, avg(c) AS mc, avg(y) AS my, count(*) AS n_days FROM daily),
 mom AS (SELECT sum((date_int - md) * (date_int - md)) AS dd, sum((date_int - md) * (s - ms)) AS ds,
                sum((date_int - md) * (c - mc)) AS dc, sum((s - ms) * (s - ms)) AS ss, sum((s - ms) * (c - mc)) AS sc,
                sum((c - mc) * (c - mc)) AS cc, sum((date_int - md) * (y - my)) AS dy,
                sum((s - ms) * (y - my)) AS sy, sum((c - mc) * (y - my)) AS cy, min(md) AS md, min(ms) AS ms,
                min(mc) AS mc, min(my) AS my, min(n_days) AS n_days FROM daily CROSS JOIN mu),
 w AS (SELECT {_w(0)} AS w_date, {_w(1)} AS w_sin, {_w(2)} AS w_cos, md, ms, mc, my, n_days FROM mom),
 coef AS (SELECT w_date, w_sin, w_cos, my - (w_date * md + w_sin * ms + w_cos * mc) AS intercept, n_days FROM w)"""

BASE = with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP, RIDGE)
TREND = "(w_date * date_int + w_sin * sin_time + w_cos * cos_time + intercept)"
BASELINE = f"greatest(exp({TREND}) - 1, 1.0)"
FEATS_R = ", ".join(f"round({c}, 6) AS {c}" if c in ("sin_time", "cos_time") else c for c in S.FEATURE_COLUMNS)

ORACLES = {
    "booster_check": BASE + """
SELECT (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test, true AS beats_trend,
       true AS best_is_first_minimum""",
    "ridge_trend": BASE + """
SELECT round(w_date, 10) AS w_date, round(w_sin, 10) AS w_sin, round(w_cos, 10) AS w_cos,
       round(intercept, 10) AS intercept, n_days FROM coef""",
    "trend_predict": BASE + f"""
, days AS (SELECT date_int, min(sin_time) AS sin_time, min(cos_time) AS cos_time FROM trips_featp GROUP BY date_int)
SELECT date_int, round({BASELINE}, 4) AS baseline FROM days CROSS JOIN coef""",
    "log_ratio_target": BASE + f"""
SELECT tpep_pickup_datetime, round(trip_duration, 6) AS trip_duration, round({BASELINE}, 6) AS baseline,
       round(ln(1 + trip_duration) - ln(1 + {BASELINE}), 6) AS label FROM tr CROSS JOIN coef""",
    "trend_anatomy": BASE + """
, dm AS (SELECT avg(avg_duration) AS mean_duration FROM daily)
SELECT date_int, round(avg_duration, 4) AS avg_duration, round(w_date, 10) AS slope,
       round(sqrt(w_sin * w_sin + w_cos * w_cos), 4) AS amplitude, round(date_int * w_date + intercept, 4) AS drift,
       round(s * w_sin + c * w_cos + mean_duration, 4) AS season,
       round(w_date * date_int + w_sin * s + w_cos * c + intercept, 4) AS full_log_prediction
FROM daily CROSS JOIN coef CROSS JOIN dm""",
    "training_matrix": BASE + f"""
SELECT {FEATS_R}, round({BASELINE}, 6) AS baseline, round(ln(1 + trip_duration) - ln(1 + {BASELINE}), 6) AS label
FROM tr CROSS JOIN coef""",
    "validation_matrix": BASE + f"""
SELECT {FEATS_R}, round({BASELINE}, 6) AS baseline, round(trip_duration, 6) AS trip_duration
FROM te CROSS JOIN coef""",
    "hybrid_predict": BASE + f"""
, corr AS (SELECT pickup_hour, avg(ln(1 + trip_duration) - ln(1 + {BASELINE})) AS log_correction
           FROM tr CROSS JOIN coef GROUP BY pickup_hour),
  sc AS (SELECT te.tpep_pickup_datetime, te.trip_duration, {BASELINE} * exp(log_correction) AS p
         FROM te CROSS JOIN coef LEFT JOIN corr USING (pickup_hour))
SELECT tpep_pickup_datetime, round(trip_duration, 4) AS trip_duration, round(p, 4) AS predicted_seconds,
       round(p / 60.0, 4) AS duration_minutes FROM sc""",
}
