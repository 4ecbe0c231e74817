"""Column names, types and fixed constants of the trip data model.

Fixed values: these must equal the behaviour being reproduced, so they are
stated here plainly and in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw trip columns -------------------------------------
VENDOR = "VendorID"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PASSENGERS = "passenger_count"
DISTANCE = "trip_distance"
PU_ZONE = "PULocationID"
DO_ZONE = "DOLocationID"
TARGET = "trip_duration"

# --- fixed values: lower-cased name -> standard name ---------------------
COLUMN_ALIASES = {
    "vendorid": "VendorID",
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pulocationid": "PULocationID",
    "dolocationid": "DOLocationID",
    "pu_location_id": "PULocationID",
    "do_location_id": "DOLocationID",
}

# --- fixed values: columns kept by the cleaner (dropoff added when training)
KEEP_COLUMNS = [VENDOR, PICKUP, PASSENGERS, DISTANCE, PU_ZONE, DO_ZONE]
DATETIME_COLUMNS = [PICKUP, DROPOFF]
NUMERIC_COLUMNS = [PASSENGERS, DISTANCE]
CATEGORICAL_COLUMNS: list[str] = []

# --- fixed values: cleaning bounds -----------------------------------------
MIN_DURATION_S, MAX_DURATION_S = 60.0, 10800.0
MIN_DISTANCE_MI, MAX_DISTANCE_MI = 0.1, 100.0
MIN_SPEED_MPH, MAX_SPEED_MPH = 0.5, 65.0
DEFAULT_PASSENGERS = 1.0

# --- fixed values: the 17 model features, in order ------------------------
FEATURE_COLUMNS = [
    "VendorID", "passenger_count", "trip_distance", "PULocationID", "DOLocationID",
    "pickup_hour", "pickup_weekday", "pickup_day", "pickup_month", "pickup_year",
    "is_weekend", "is_morning_rush", "is_evening_rush", "is_night", "is_holiday",
    "sin_time", "cos_time",
]
TREND_COLUMNS = ["date_int", "sin_time", "cos_time"]

# --- fixed values: model and monitoring parameters ------------------------
RIDGE_ALPHA = 100.0
DRIFT_WINDOW = 5
DRIFT_THRESHOLD_MIN = 0.1
TREND_FLOOR_S = 1.0
SAMPLE_MIN_BATCH_ROWS = 1000
BATCH_SIZE_DEFAULT = 50_000
GBT_GRID = [{"stepSize": lr, "num_leaves": nl} for lr in (0.05, 0.1) for nl in (127, 255)]

# --- fixed values: sampling (rate, seed) of each training phase ------------
TUNE_SAMPLE = (0.01, 42)         # grid-search training rows, per batch
FINAL_SAMPLE = (0.10, 124961)    # final trend + booster rows, per batch

RAW_TRIP_SCHEMA = T.StructType([
    T.StructField(VENDOR, T.LongType()),
    T.StructField(PICKUP, T.TimestampNTZType()),
    T.StructField(DROPOFF, T.TimestampNTZType()),
    T.StructField(PASSENGERS, T.DoubleType()),
    T.StructField(DISTANCE, T.DoubleType()),
    T.StructField(PU_ZONE, T.LongType()),
    T.StructField(DO_ZONE, T.LongType()),
])

# request rows: pickup arrives as text, no dropoff
REQUEST_ROW_SCHEMA = T.StructType([
    T.StructField(VENDOR, T.LongType()),
    T.StructField(PICKUP, T.StringType()),
    T.StructField(PASSENGERS, T.DoubleType()),
    T.StructField(DISTANCE, T.DoubleType()),
    T.StructField(PU_ZONE, T.LongType()),
    T.StructField(DO_ZONE, T.LongType()),
])
