"""DuckDB oracle SQL for sampling (L), aggregates (A), J1 and U1."""

from __future__ import annotations

from tripcast import schema as S
from tripcast.plans import common as Q
from tripcast.plans.oracle_base import (CLEAN_BASE, RAW_ORDER, TRIPS_FEATP, TRIPS_RAW, dur, holiday, below, mix,
                                        with_ctes)
from tripcast.plans.oracles_models import BASE as TREND_BASE
from tripcast.plans.oracles_models import BASELINE

CAP_BATCHES = 3
PICK = "tpep_pickup_datetime"
CLEAN_ORDER = ("tpep_pickup_datetime, tpep_dropoff_datetime, VendorID, PULocationID, DOLocationID, "
               "trip_distance, passenger_count")
RAW_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
            "PULocationID, DOLocationID, fare_amount")

RAW_B = f"""
 raw_b AS (SELECT *, CAST(year({PICK}) AS INTEGER) AS file_year,
        CAST(floor((row_number() OVER (PARTITION BY year({PICK}) ORDER BY {RAW_ORDER}) - 1)
                   / {Q.FIXTURE_BATCH_ROWS}) AS BIGINT) AS batch_no FROM trips_raw),
 raw_bn AS (SELECT *, count(*) OVER (PARTITION BY file_year, batch_no) AS bn FROM raw_b)"""

L1 = f""" l1 AS (SELECT {RAW_COLS}, file_year, batch_no FROM raw_bn WHERE bn <= 1000 OR {below(124961, 0.10)})"""
L2 = f""" l2r AS (SELECT *, row_number() OVER (PARTITION BY file_year, batch_no
                      ORDER BY {mix(42)}, {RAW_ORDER}) AS rk FROM raw_bn),
 l2 AS (SELECT {RAW_COLS}, file_year, batch_no FROM l2r WHERE rk <= round_even(bn * 0.075, 0))"""


def _clean_from(src: str, carry: str = "") -> str:
    """The cleaning chain over another source relation, carrying columns."""
    extra = f", {carry}" if carry else ""
    return f"""
 cv AS (SELECT VendorID, {PICK}, passenger_count, trip_distance, PULocationID, DOLocationID,
        tpep_dropoff_datetime{extra} FROM {src}
        WHERE {PICK} IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0),
 cd AS (SELECT *, {dur()} AS trip_duration FROM cv),
 cc AS (SELECT * REPLACE (COALESCE(passenger_count, 1.0) AS passenger_count) FROM cd
        WHERE trip_duration BETWEEN 60 AND 10800 AND trip_distance BETWEEN 0.1 AND 100
        AND trip_distance / (trip_duration / 3600.0) BETWEEN 0.5 AND 65)"""


EVAL = f"""
 tr AS (SELECT * FROM trips_featp WHERE pickup_year < {Q.TRAIN_BEFORE_YEAR}),
 te AS (SELECT * FROM trips_featp WHERE pickup_year >= {Q.TEST_FROM_YEAR}),
 hourly AS (SELECT pickup_hour, avg(trip_duration) AS predicted FROM tr GROUP BY pickup_hour),
 ev AS (SELECT te.{PICK}, te.pickup_hour, trip_duration AS actual, predicted, trip_duration - predicted AS residual
        FROM te LEFT JOIN hourly USING (pickup_hour))"""

FEAT = with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP)
FEAT_EVAL = with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP, EVAL)
Y, M, D = Q.VALIDATION_DATE


def _runs() -> str:
    from tripcast.plans.queries_analytics import STUB_RUNS

    parts = []
    for run_no, name, keys in STUB_RUNS:
        if keys:
            k = ", ".join(keys)
            src = f"(SELECT {k}, avg(trip_duration) AS predicted FROM tr GROUP BY {k})"
            join = f"te LEFT JOIN {src} m USING ({k})"
        else:
            join = "te CROSS JOIN (SELECT avg(trip_duration) AS predicted FROM tr) m"
        parts.append(f"""SELECT {run_no} AS run_no, '{name}' AS model, count(trip_duration - predicted) AS n,
       sqrt(avg((trip_duration - predicted)^2)) AS rmse, avg(abs(trip_duration - predicted)) AS mae
       FROM {join}""")
    return "\nUNION ALL\n".join(parts)


ORACLES = {
    "sample_fraction": with_ctes(TRIPS_RAW, RAW_B, L1) + "SELECT * FROM l1",
    "sample_exact": with_ctes(TRIPS_RAW, RAW_B, L2) + "SELECT * FROM l2",
    "sample_small_batches": with_ctes(TRIPS_RAW, RAW_B, L1, L2) + """
SELECT n.file_year, n.batch_no, n.n_rows, COALESCE(a.c, 0) AS n_train_sample, COALESCE(b.c, 0) AS n_eval_sample
FROM (SELECT file_year, batch_no, count(*) AS n_rows FROM raw_b GROUP BY ALL) n
LEFT JOIN (SELECT file_year, batch_no, count(*) AS c FROM l1 GROUP BY ALL) a USING (file_year, batch_no)
LEFT JOIN (SELECT file_year, batch_no, count(*) AS c FROM l2 GROUP BY ALL) b USING (file_year, batch_no)""",
    "hard_case_sampling": TREND_BASE + f"""
, hc AS (SELECT *, {BASELINE} AS baseline FROM trips_featp CROSS JOIN coef)
SELECT {PICK}, trip_distance, round(trip_duration, 6) AS trip_duration, round(baseline, 6) AS baseline
FROM hc WHERE abs(trip_duration - baseline) / baseline > 0.2 OR {below(7, 0.05)}""",
    "cap_batches": with_ctes(TRIPS_RAW, RAW_B, L2, _clean_from(f"(SELECT * FROM l2 WHERE file_year >= {Q.TEST_FROM_YEAR})",
                                                              "file_year, batch_no")) + f"""
, kept AS (SELECT DISTINCT file_year, batch_no FROM cc ORDER BY file_year, batch_no LIMIT {CAP_BATCHES})
SELECT file_year, batch_no, count(*) AS n_rows FROM cc SEMI JOIN kept USING (file_year, batch_no) GROUP BY ALL""",
    "first_n": with_ctes(TRIPS_RAW, CLEAN_BASE) + f"""
SELECT * FROM trips_clean WHERE year({PICK}) >= {Q.TEST_FROM_YEAR} ORDER BY {CLEAN_ORDER} LIMIT 200""",
    "daily_partial": with_ctes(TRIPS_RAW, RAW_B, _clean_from("raw_b", "file_year, batch_no")) + """
SELECT file_year, batch_no, CAST(date_diff('day', DATE '1970-01-01', CAST(tpep_pickup_datetime AS DATE)) AS BIGINT)
       AS date_int, round(sum(trip_duration), 4) AS sum_duration, count(trip_duration) AS n_trips,
       round(min(sin(2*pi()*dayofyear(tpep_pickup_datetime)/365.25)), 4) AS sin_time,
       round(min(cos(2*pi()*dayofyear(tpep_pickup_datetime)/365.25)), 4) AS cos_time
FROM cc GROUP BY ALL""",
    "regression_metrics": FEAT_EVAL + """
SELECT count(actual - predicted) AS n, round(sqrt(avg((actual - predicted)^2)), 4) AS rmse,
       round(avg(abs(actual - predicted)), 4) AS mae,
       round(1 - sum((actual - predicted)^2) / (count(actual - predicted) * var_pop(actual)), 4) AS r2 FROM ev""",
    "batch_metrics": with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP, EVAL, RAW_B,
                               _clean_from(f"(SELECT * FROM raw_b WHERE file_year >= {Q.TEST_FROM_YEAR})",
                                           "file_year, batch_no")) + f"""
, bev AS (SELECT file_year, batch_no, trip_duration AS actual, predicted FROM cc
          LEFT JOIN hourly ON hourly.pickup_hour = CAST(hour(cc.{PICK}) AS INTEGER))
SELECT file_year, batch_no, count(actual - predicted) AS n, round(sqrt(avg((actual - predicted)^2)), 4) AS rmse,
       round(avg(abs(actual - predicted)), 4) AS mae, batch_no % 15 = 0 AS is_logged FROM bev GROUP BY file_year, batch_no""",
    "density_2d": FEAT_EVAL + """
SELECT CAST(floor(actual / 60.0) AS BIGINT) AS actual_bin, CAST(floor(predicted / 60.0) AS BIGINT) AS predicted_bin,
       count(*) AS n FROM ev GROUP BY ALL""",
    "density_hexbin": FEAT_EVAL + """
, rng AS (SELECT min(actual) - (max(actual) - min(actual)) * 1e-9 AS x0,
                 max(actual) + (max(actual) - min(actual)) * 1e-9 AS x1,
                 min(predicted) AS y0, max(predicted) AS y1 FROM ev),
  p AS (SELECT x0, y0, (x1 - x0) / 50.0 AS sx, (y1 - y0) / 28.0 AS sy,
               (actual - x0) / ((x1 - x0) / 50.0) AS ix, (predicted - y0) / ((y1 - y0) / 28.0) AS iy
        FROM ev CROSS JOIN rng WHERE actual IS NOT NULL AND predicted IS NOT NULL),
  q AS (SELECT *, (ix - round_even(ix, 0))^2 + 3.0 * (iy - round_even(iy, 0))^2
                  < (ix - floor(ix) - 0.5)^2 + 3.0 * (iy - floor(iy) - 0.5)^2 AS first FROM p),
  c AS (SELECT x0, y0, sx, sy, CASE WHEN first THEN 1 ELSE 2 END AS lattice,
               CAST(CASE WHEN first THEN round_even(ix, 0) ELSE floor(ix) END AS BIGINT) AS i,
               CAST(CASE WHEN first THEN round_even(iy, 0) ELSE floor(iy) END AS BIGINT) AS j FROM q)
SELECT lattice, i, j, count(*) AS n,
       round(min(x0 + sx * (i + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END)), 4) AS centre_x,
       round(min(y0 + sy * (j + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END)), 4) AS centre_y
FROM c GROUP BY lattice, i, j""",
    "residual_histogram": FEAT_EVAL + """
, rng AS (SELECT min(residual) AS lo, max(residual) AS hi FROM ev),
  b AS (SELECT CAST(CASE WHEN (hi - lo) / 100.0 = 0 THEN 0
                    ELSE least(floor((residual - lo) / ((hi - lo) / 100.0)), 99) END AS INTEGER) AS bin, lo, hi
        FROM ev CROSS JOIN rng)
SELECT bin, round(min(lo) + bin * (min(hi) - min(lo)) / 100, 4) AS bin_lo, count(*) AS n FROM b GROUP BY bin""",
    "residual_profile": FEAT_EVAL + """
SELECT CAST(floor(predicted / 60.0) AS BIGINT) AS predicted_bin, count(residual) AS n,
       round(avg(residual), 4) AS mean_residual, round(stddev_samp(residual), 4) AS sd_residual,
       round(quantile_cont(residual, 0.5), 4) AS median_residual FROM ev GROUP BY ALL""",
    "append_runs": FEAT_EVAL + f"""
, runs AS ({_runs()})
SELECT run_no, model, n, round(rmse, 4) AS rmse, round(mae, 4) AS mae FROM (SELECT * FROM runs UNION ALL SELECT * FROM runs)""",
    "predictions_body": FEAT_EVAL + f"""
SELECT strftime({PICK}, '%Y-%m-%d') AS request, '{{"predictions":[' ||
       string_agg(CAST(CAST(floor(predicted) AS BIGINT) AS VARCHAR), ',' ORDER BY {PICK}) || ']}}' AS body
FROM ev GROUP BY ALL""",
    "best_run": FEAT_EVAL + f"""
, runs AS ({_runs()})
SELECT run_no, model, n, round(rmse, 4) AS rmse, round(mae, 4) AS mae FROM runs
ORDER BY rmse, run_no LIMIT 1""",
    "validation_report": FEAT_EVAL + f"""
, day_rows AS (SELECT * FROM trips_raw WHERE CAST({PICK} AS DATE) = DATE '{Y:04d}-{M:02d}-{D:02d}'),
  vd AS (SELECT * FROM day_rows),
  se AS (SELECT row_number() OVER (ORDER BY {RAW_ORDER}) AS seq,
                (predicted / 60.0 - {dur()} / 60.0)^2 AS sq_err
         FROM vd LEFT JOIN hourly ON hourly.pickup_hour = CAST(hour(vd.{PICK}) AS INTEGER)),
  win AS (SELECT sq_err FROM se WHERE sq_err IS NOT NULL ORDER BY seq DESC LIMIT {S.DRIFT_WINDOW}),
  st AS (SELECT sqrt(avg(sq_err)) AS current_rmse, count(sq_err) AS window_size FROM win)
SELECT '{Y:04d}-{M:02d}-{D:02d}' AS validation_date, '{Y:04d}-{M:02d}' AS validation_month,
       (SELECT count(*) FROM vd) AS samples_validated, round(current_rmse, 4) AS current_rmse,
       CAST(window_size AS BIGINT) AS window_size, CAST({S.DRIFT_THRESHOLD_MIN} AS DOUBLE) AS threshold,
       window_size = {S.DRIFT_WINDOW} AND current_rmse > {S.DRIFT_THRESHOLD_MIN} AS retraining_triggered FROM st""",
    "holiday_join": with_ctes(TRIPS_RAW, CLEAN_BASE) + f"""
SELECT {PICK}, {holiday(f'CAST({PICK} AS DATE)')} AS is_holiday FROM trips_clean""",
    "union_batches": with_ctes(TRIPS_RAW) + f"""
SELECT VendorID, {PICK}, tpep_dropoff_datetime, passenger_count, trip_distance, PULocationID, DOLocationID,
       CASE WHEN year({PICK}) = 1997 THEN NULL ELSE fare_amount END AS fare_amount FROM trips_raw""",
}
