"""DuckDB oracle SQL for the source (S), cleaning (P) and feature (F) queries."""

from __future__ import annotations

from tripcast.plans import common as Q
from tripcast.plans.oracle_base import (BASE, CLEAN_BASE, RAW_ORDER, TRIPS_RAW, dur, feature_select, holiday, r,
                                        with_ctes)

RAW = with_ctes(TRIPS_RAW)
CLEAN = with_ctes(TRIPS_RAW, CLEAN_BASE)
PICK = "tpep_pickup_datetime"
Y, M, D = Q.VALIDATION_DATE

ORACLES = {
    "rescan": "SELECT count(*) AS rows_first, count(*) AS rows_again FROM lineitem",
    "scan_trips": RAW + "SELECT * FROM trips_raw",
    "scan_batches": RAW + f"""
, b AS (SELECT *, CAST(year({PICK}) AS INTEGER) AS file_year,
        row_number() OVER (PARTITION BY year({PICK}) ORDER BY {RAW_ORDER}) - 1 AS row_in_file FROM trips_raw)
SELECT file_year, CAST(floor(row_in_file / {Q.FIXTURE_BATCH_ROWS}) AS BIGINT) AS batch_no, count(*) AS n_rows,
       min({PICK}) AS first_pickup, max({PICK}) AS last_pickup,
       min(row_in_file) AS first_row, max(row_in_file) AS last_row
FROM b GROUP BY ALL""",
    "file_count": "SELECT CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM lineitem",
    "months_slice": RAW + f"SELECT * FROM trips_raw WHERE year({PICK}) = 1998 AND month({PICK}) BETWEEN 1 AND 6",
    "validation_day": RAW + f"""
, day_rows AS (SELECT * FROM trips_raw WHERE CAST({PICK} AS DATE) = DATE '{Y:04d}-{M:02d}-{D:02d}')
SELECT * FROM day_rows
UNION ALL
SELECT * FROM (SELECT * FROM trips_raw WHERE year({PICK}) = {Y} AND month({PICK}) = {M}
               ORDER BY {RAW_ORDER} LIMIT 1000) WHERE NOT EXISTS (SELECT 1 FROM day_rows)""",
    "json_requests": RAW + f"""
SELECT CAST(CASE WHEN passenger_count IS NULL THEN NULL ELSE VendorID END AS DOUBLE) AS VendorID,
       CASE WHEN passenger_count IS NULL THEN NULL ELSE {PICK} END AS {PICK},
       passenger_count,
       CASE WHEN passenger_count IS NULL THEN NULL ELSE trip_distance END AS trip_distance,
       CAST(CASE WHEN passenger_count IS NULL THEN NULL ELSE PULocationID END AS DOUBLE) AS PULocationID,
       CAST(CASE WHEN passenger_count IS NULL THEN NULL ELSE DOLocationID END AS DOUBLE) AS DOLocationID,
       passenger_count IS NOT NULL AS is_valid
FROM trips_raw""",
    "keep_columns": RAW + f"""
SELECT VendorID, {PICK}, passenger_count, trip_distance, PULocationID, DOLocationID, tpep_dropoff_datetime
FROM trips_raw""",
    "parse_timestamps": RAW + f"""
SELECT VendorID, {PICK}, CASE WHEN passenger_count IS NULL THEN NULL ELSE tpep_dropoff_datetime END
       AS tpep_dropoff_datetime, passenger_count FROM trips_raw""",
    "parse_request_timestamps": RAW + f"SELECT VendorID, PULocationID, {PICK} FROM trips_raw",
    "drop_invalid": RAW + f"""
SELECT VendorID, {PICK}, passenger_count, trip_distance, PULocationID, DOLocationID, tpep_dropoff_datetime
FROM trips_raw WHERE {PICK} IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0""",
    "skip_validation": RAW + f"""
SELECT VendorID, COALESCE(passenger_count, 1.0) AS passenger_count, trip_distance, PULocationID, DOLocationID,
       {feature_select(PICK, digits=6)}
FROM trips_raw""",
    "trip_duration": RAW + f"""
SELECT VendorID, {PICK}, COALESCE(passenger_count, 1.0) AS passenger_count, trip_distance, PULocationID,
       DOLocationID, tpep_dropoff_datetime, {dur()} AS trip_duration
FROM trips_raw WHERE {PICK} IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0""",
    "remove_outliers": CLEAN + "SELECT * FROM trips_clean",
    "coerce_numeric": RAW + """
SELECT VendorID, PULocationID, DOLocationID,
       CASE WHEN passenger_count = 5 THEN NULL ELSE passenger_count END AS passenger_count, trip_distance
FROM trips_raw""",
    "fill_passengers": RAW + f"""
SELECT VendorID, {PICK}, COALESCE(passenger_count, 1.0) AS passenger_count, PULocationID FROM trips_raw""",
    "fill_categoricals": RAW + f"""
SELECT VendorID, {PICK},
       CASE WHEN passenger_count IS NULL THEN '0' ELSE CAST(PULocationID AS VARCHAR) END AS PULocationID,
       CAST(DOLocationID AS VARCHAR) AS DOLocationID FROM trips_raw""",
    "preprocess": BASE + f"""
SELECT VendorID, passenger_count, trip_distance, PULocationID, DOLocationID, {r('trip_duration')} AS trip_duration,
       pickup_hour, pickup_weekday, pickup_day, pickup_month, pickup_year, is_weekend, is_morning_rush,
       is_evening_rush, is_night, is_holiday, date_int, {r('sin_time')} AS sin_time, {r('cos_time')} AS cos_time
FROM trips_feat""",
    "cleaning_audit": RAW + f"""
, a AS (SELECT *, {dur()} AS t,
        COALESCE({PICK} IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance > 0, false) AS valid
        FROM trips_raw),
  b AS (SELECT *, COALESCE(t BETWEEN 60 AND 10800 AND trip_distance BETWEEN 0.1 AND 100
        AND trip_distance / (t / 3600.0) BETWEEN 0.5 AND 65, false) AS inlier FROM a)
SELECT count(*) AS rows_in, CAST(1 AS BIGINT) AS unused_columns,
       CAST(count_if(NOT valid) AS BIGINT) AS invalid_rows,
       CAST(count_if(valid AND NOT inlier) AS BIGINT) AS outlier_rows,
       CAST(count_if(valid AND inlier) AS BIGINT) AS rows_out FROM b""",
    "row_count_check": CLEAN + """
SELECT (SELECT count(*) FROM trips_raw) AS rows_in, (SELECT count(*) FROM trips_raw) AS rows_serving,
       (SELECT count(*) FROM trips_clean) AS rows_training, true AS serving_equal,
       (SELECT count(*) FROM trips_raw) - (SELECT count(*) FROM trips_clean) AS rows_removed""",
    "hour_weekday": CLEAN + f"SELECT {PICK}, {feature_select(PICK, full=False)} FROM trips_clean",
    "calendar_parts": CLEAN + f"""
SELECT {PICK}, CAST(day({PICK}) AS INTEGER) AS pickup_day, CAST(month({PICK}) AS INTEGER) AS pickup_month,
       CAST(year({PICK}) AS INTEGER) AS pickup_year FROM trips_clean""",
    "is_weekend": CLEAN + f"""
SELECT {PICK}, CAST(isodow({PICK}) - 1 AS INTEGER) AS pickup_weekday,
       CAST(isodow({PICK}) >= 6 AS INTEGER) AS is_weekend FROM trips_clean""",
    "rush_flags": CLEAN + f"""
SELECT {PICK}, CAST(hour({PICK}) BETWEEN 7 AND 10 AND isodow({PICK}) <= 5 AS INTEGER) AS is_morning_rush,
       CAST(hour({PICK}) BETWEEN 16 AND 19 AND isodow({PICK}) <= 5 AS INTEGER) AS is_evening_rush
FROM trips_clean""",
    "is_night": CLEAN + f"""
SELECT {PICK}, CAST(hour({PICK}) AS INTEGER) AS pickup_hour,
       CAST(hour({PICK}) >= 22 OR hour({PICK}) <= 6 AS INTEGER) AS is_night FROM trips_clean""",
    "is_holiday": RAW + f"""
, span AS (SELECT min(CAST({PICK} AS DATE)) AS lo, max(CAST({PICK} AS DATE)) AS hi FROM trips_raw),
  days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
SELECT strftime(day, '%Y-%m-%d') AS day, {holiday('day')} AS is_holiday FROM days""",
    "date_int": CLEAN + f"""
SELECT {PICK}, CAST(date_diff('day', DATE '1970-01-01', CAST({PICK} AS DATE)) AS BIGINT) AS date_int
FROM trips_clean""",
    "season_wave": CLEAN + f"""
SELECT {PICK}, round(sin(2*pi()*dayofyear({PICK})/365.25), 6) AS sin_time,
       round(cos(2*pi()*dayofyear({PICK})/365.25), 6) AS cos_time FROM trips_clean""",
    "speed_mph": CLEAN + f"""
SELECT {PICK}, trip_distance, {r('trip_duration')} AS trip_duration,
       {r('trip_distance / (trip_duration / 3600.0)')} AS speed_mph FROM trips_clean""",
    "feature_matrix": BASE + f"""
SELECT VendorID, passenger_count, trip_distance, PULocationID, DOLocationID, pickup_hour, pickup_weekday,
       pickup_day, pickup_month, pickup_year, is_weekend, is_morning_rush, is_evening_rush, is_night, is_holiday,
       {r('sin_time')} AS sin_time, {r('cos_time')} AS cos_time, {r('trip_duration')} AS trip_duration
FROM trips_feat""",
    "daily_stats": BASE + """
SELECT date_int, round(sum(trip_duration), 4) AS sum_duration, count(trip_duration) AS n_trips,
       round(min(sin_time), 4) AS sin_time, round(min(cos_time), 4) AS cos_time,
       round(sum(trip_duration) / count(trip_duration), 4) AS avg_duration
FROM trips_feat GROUP BY date_int""",
}

# the standardised names of the variant-named input
ORACLES["standardize_columns"] = RAW + """
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
       PULocationID, DOLocationID, fare_amount FROM trips_raw"""
