"""DuckDB oracle SQL for the queries of a served and watched model."""

from __future__ import annotations

from tripcast import schema as S
from tripcast.plans import common as Q
from tripcast.plans.oracle_base import CLEAN_BASE, RAW_ORDER, TRIPS_FEATP, TRIPS_RAW, dur, with_ctes
from tripcast.plans.oracles_analytics import EVAL, _runs
from tripcast.plans.oracles_clean import ORACLES as CLEAN_ORACLES
from tripcast.plans.queries_serving import CALLS, PAGE_ROWS, SKETCH_YEAR

PICK = "tpep_pickup_datetime"
FEAT_EVAL = with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP, EVAL)
PLACED = f"""
 placed AS (SELECT *, CAST(year({PICK}) AS INTEGER) AS file_year,
        row_number() OVER (PARTITION BY year({PICK}) ORDER BY {RAW_ORDER}) - 1 AS row_in_file FROM trips_raw)"""

_CALLS = ", ".join(f"({n}, DATE '{d}', {str(r).lower()})" for n, (d, r) in enumerate(CALLS, 1))
VALIDATION_CALLS = FEAT_EVAL + f"""
, calls AS (SELECT * FROM (VALUES {_CALLS}) AS c(call_no, day, reloaded)),
 day_rows AS (SELECT call_no, row_number() OVER (PARTITION BY call_no ORDER BY {RAW_ORDER}) AS seq,
        (predicted / 60.0 - {dur()} / 60.0)^2 AS sq_err
        FROM calls JOIN trips_raw ON CAST({PICK} AS DATE) = day LEFT JOIN hourly ON hourly.pickup_hour = CAST(hour({PICK}) AS INTEGER)),
 win AS (SELECT c.call_no, d.sq_err, row_number() OVER (PARTITION BY c.call_no ORDER BY d.call_no DESC, d.seq DESC) AS place
        FROM calls c JOIN day_rows d ON d.call_no <= c.call_no WHERE d.sq_err IS NOT NULL),
 st AS (SELECT call_no, sqrt(avg(sq_err)) AS current_rmse, count(*) AS window_size FROM win WHERE place <= {S.DRIFT_WINDOW} GROUP BY call_no),
 br AS (SELECT c.*, current_rmse, coalesce(window_size, 0) AS window_size,
        coalesce(window_size = {S.DRIFT_WINDOW} AND current_rmse > {S.DRIFT_THRESHOLD_MIN}, false) AS breach,
        sum(CAST(reloaded AS INTEGER)) OVER (ORDER BY call_no) AS epoch FROM calls c LEFT JOIN st USING (call_no)),
 al AS (SELECT *, breach AND sum(CAST(breach AS INTEGER)) OVER (PARTITION BY epoch ORDER BY call_no) = 1 AS fires,
        sum(CAST(breach AS INTEGER)) OVER (PARTITION BY epoch ORDER BY call_no) > 0 AS raised FROM br)
SELECT strftime(day, '%Y-%m-%d') AS validation_date, strftime(day, '%Y-%m') AS validation_month,
       (SELECT count(*) FROM day_rows d WHERE d.call_no = al.call_no) AS samples_validated, round(current_rmse, 4) AS current_rmse,
       CAST(window_size AS BIGINT) AS window_size, CAST({S.DRIFT_THRESHOLD_MIN} AS DOUBLE) AS threshold,
       fires AS retraining_triggered, raised AS alarm_raised, call_no FROM al"""

ORACLES = {
    "lost_rows": with_ctes(TRIPS_RAW, PLACED) + f"""
, kept AS (SELECT *, {dur()} AS secs FROM placed
           WHERE {PICK} IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0),
 good AS (SELECT file_year, row_in_file FROM kept WHERE secs BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}
          AND trip_distance BETWEEN {S.MIN_DISTANCE_MI} AND {S.MAX_DISTANCE_MI}
          AND trip_distance / (secs / 3600.0) BETWEEN {S.MIN_SPEED_MPH} AND {S.MAX_SPEED_MPH})
SELECT file_year, row_in_file, {PICK}, trip_distance FROM placed ANTI JOIN good USING (file_year, row_in_file)""",
    "validation_calls": VALIDATION_CALLS,
    "prediction_pages": with_ctes(TRIPS_RAW, CLEAN_BASE, TRIPS_FEATP, EVAL, PLACED) + f"""
SELECT file_year, row_in_file // {PAGE_ROWS} AS page, '{{"predictions":[' ||
       string_agg(CAST(CAST(floor(predicted) AS BIGINT) AS VARCHAR), ',' ORDER BY row_in_file) || ']}}' AS body
FROM placed LEFT JOIN hourly ON hourly.pickup_hour = CAST(hour({PICK}) AS INTEGER) GROUP BY ALL""",
    "log_runs": FEAT_EVAL + f"""
, runs AS ({_runs()}), best AS (SELECT run_no FROM runs ORDER BY rmse, run_no LIMIT 1)
SELECT run_id, run_no, model, round(rmse, 4) AS rmse, round(mae, 4) AS mae,
       run_id = 'a' AND run_no = (SELECT run_no FROM best) AS is_best
FROM runs CROSS JOIN (VALUES ('a'), ('b')) AS ids(run_id)""",
    "months_layout": CLEAN_ORACLES["months_slice"],
    "rescan_rows": with_ctes(TRIPS_RAW) + f"""
SELECT count(*) AS n_first, count(*) AS n_again, least(count(*) FILTER (year({PICK}) = 1995), {Q.FIXTURE_BATCH_ROWS}) AS k_first,
       true AS same_rows, true AS same_first_batch FROM trips_raw""",
    "transformer_round_trip": CLEAN_ORACLES["preprocess"],
    "density_curve": FEAT_EVAL + """
, one AS (SELECT min(residual) AS lo, max(residual) AS hi, count(residual) AS n,
                 stddev_samp(residual) * power(count(residual), -0.2) AS h FROM ev),
 cells AS (SELECT least(floor((residual - lo) / ((hi - lo) / 1000.0)), 999) AS cell, count(*) AS k
           FROM ev, one WHERE residual IS NOT NULL GROUP BY ALL),
 grid AS (SELECT CAST(p AS INTEGER) AS point, lo + p * (hi - lo) / 99.0 AS x FROM range(100) t(p), one)
SELECT point, round(x, 8) AS x, round(sum(k * exp(-0.5 * pow((x - (lo + (cell + 0.5) * (hi - lo) / 1000.0)) / h, 2)))
       / min(n * h * sqrt(2 * pi())), 8) AS density FROM grid, cells, one GROUP BY point, x""",
    "residual_sketch": FEAT_EVAL + f"""
SELECT CAST(floor(predicted / 60.0) AS BIGINT) AS predicted_bin, count(residual) AS n, true AS all_counted, true AS within_bound
FROM ev WHERE year({PICK}) = {SKETCH_YEAR} AND residual IS NOT NULL GROUP BY ALL""",
}
