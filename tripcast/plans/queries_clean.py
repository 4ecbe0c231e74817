"""Registered queries: sources (S), cleaning (P) and features (F)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.functions import calendar as cal
from tripcast.operators import clean as C
from tripcast.operators.aggregates import daily_stats, round_doubles
from tripcast.plans import common as Q
from tripcast.sources import requests as R
from tripcast.sources import trips as T


# ---------------------------------------------------------------- sources
def q_scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan the table directory (lineitem file only) and derive trips."""
    li = T.scan_trips(spark, sf_dir, glob="lineitem.parquet")
    return T.trips_from_lineitem(li)


def q_scan_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loader batches (files = pickup years, FIXTURE_BATCH_ROWS rows each),
    one summary row per batch."""
    b = Q.loader_batches(spark, sf_dir)
    return (b.groupBy("file_year", "batch_no")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.min(S.PICKUP).alias("first_pickup"), F.max(S.PICKUP).alias("last_pickup"),
                  F.min("row_in_file").alias("first_row"), F.max("row_in_file").alias("last_row")))


def q_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: files behind the scan and rows in them (from parquet metadata)."""
    li = T.scan_trips(spark, sf_dir, glob="lineitem.parquet")
    return li.agg(F.count_distinct(F.col("_metadata.file_path")).cast("long").alias("n_files"),
                  F.count(F.lit(1)).alias("n_rows"))


def q_months_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of 1998 (a range predicate on the pickup time)."""
    return T.months_slice(Q.raw(spark, sf_dir), [1998], [1, 2, 3, 4, 5, 6])


def q_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second scan of the trip files gives the rows of the first."""
    path = T.trips_raw_path(spark, sf_dir)
    first = T.scan_trips(spark, path).agg(F.count(F.lit(1)).alias("rows_first"))
    again = T.scan_trips(spark, path).agg(F.count(F.lit(1)).alias("rows_again"))
    return first.crossJoin(again)


def q_validation_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the validation date in the test year."""
    y, m, d = Q.VALIDATION_DATE
    return T.validation_day(Q.raw(spark, sf_dir), y, m, d)


def q_json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw trip as a scoring request body, parsed back into rows;
    bodies of trips without passengers are malformed and come out rejected."""
    bodies = R.request_bodies(Q.raw(spark, sf_dir))
    out = R.parse_requests(bodies)
    # ids of rejected requests are NULL: typed double so both engines agree
    return out.withColumns({c: F.col(c).cast("double") for c in (S.VENDOR, S.PU_ZONE, S.DO_ZONE)})


# ---------------------------------------------------------------- cleaning
def _variant_names(df: DataFrame) -> DataFrame:
    return df.toDF("vendor_id", "pickup_datetime", "dropoff_datetime", "Passenger_Count",
                   "Trip_Distance", "pu_location_id", "DOLOCATIONID", "FARE_AMOUNT")


def q_standardize_columns(spark, sf_dir):
    return C.standardize_columns(_variant_names(Q.raw(spark, sf_dir)))


def q_keep_columns(spark, sf_dir):
    return C.keep_columns(Q.raw(spark, sf_dir), C.columns_to_keep(False))


def q_parse_timestamps(spark, sf_dir):
    """Pickup as epoch microseconds (long), dropoff as text; text that is a
    date rather than a number (rows without passengers) becomes NULL."""
    raw = Q.raw(spark, sf_dir)
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(S.DROPOFF))
    enc = raw.select(
        S.VENDOR,
        F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(S.PICKUP)).alias(S.PICKUP),
        F.when(F.col(S.PASSENGERS).isNull(), F.date_format(S.DROPOFF, "yyyy-MM-dd"))
         .otherwise(micros.cast("string")).alias(S.DROPOFF),
        S.PASSENGERS)
    return C.parse_timestamps(enc)


def q_parse_request_timestamps(spark, sf_dir):
    """ISO text pickups ('T' separator on odd zones) parsed back."""
    raw = Q.raw(spark, sf_dir)
    txt = raw.select(S.VENDOR, S.PU_ZONE,
                     F.when(F.col(S.PU_ZONE) % 2 == 1, F.date_format(S.PICKUP, "yyyy-MM-dd'T'HH:mm:ss"))
                      .otherwise(F.date_format(S.PICKUP, "yyyy-MM-dd HH:mm:ss")).alias(S.PICKUP))
    return C.parse_request_timestamps(txt)


def q_drop_invalid(spark, sf_dir):
    raw = Q.raw(spark, sf_dir)
    return C.drop_invalid(C.parse_timestamps(C.keep_columns(raw, C.columns_to_keep(False))))


def q_skip_validation(spark, sf_dir):
    """Serving path over every raw row: nothing is dropped."""
    out, _ = C.preprocess(Q.raw(spark, sf_dir), remove_outliers=False, create_features=True,
                          predicting=True, skip_validation=True)
    return round_doubles(out)


def q_trip_duration(spark, sf_dir):
    return Q.clean_rows(Q.raw(spark, sf_dir), remove_outliers=False)


def q_remove_outliers(spark, sf_dir):
    return Q.clean(spark, sf_dir)


def q_coerce_numeric(spark, sf_dir):
    """Numbers arriving as text; line-5 rows carry junk text."""
    raw = Q.raw(spark, sf_dir)
    txt = raw.select(S.VENDOR, S.PU_ZONE, S.DO_ZONE,
                     F.when(F.col(S.PASSENGERS) == 5, F.lit("n/a"))
                      .otherwise(F.col(S.PASSENGERS).cast("string")).alias(S.PASSENGERS),
                     F.col(S.DISTANCE).cast("string").alias(S.DISTANCE))
    return C.coerce_numeric(txt)


def q_fill_passengers(spark, sf_dir):
    raw = Q.raw(spark, sf_dir).select(S.VENDOR, S.PICKUP, S.PASSENGERS, S.PU_ZONE)
    return C.fill_passengers(raw)


def q_fill_categoricals(spark, sf_dir):
    """Zones as categoricals; zones of trips without passengers are
    missing and become '0'."""
    raw = Q.raw(spark, sf_dir)
    src = raw.select(S.VENDOR, S.PICKUP,
                     F.when(F.col(S.PASSENGERS).isNull(), F.lit(None)).otherwise(F.col(S.PU_ZONE)).alias(S.PU_ZONE),
                     F.col(S.DO_ZONE))
    return C.fill_categoricals(src, [S.PU_ZONE, S.DO_ZONE])


def q_preprocess(spark, sf_dir):
    return round_doubles(Q.featured(spark, sf_dir))


def q_cleaning_audit(spark, sf_dir):
    return C.cleaning_audit(Q.raw(spark, sf_dir))


def q_row_count_check(spark, sf_dir):
    """Rows in, rows out of the serving path (must be equal) and of the
    training path."""
    audit = C.cleaning_audit(Q.raw(spark, sf_dir))      # one scan counts what training keeps
    serving, _ = C.preprocess(Q.raw(spark, sf_dir), remove_outliers=False, create_features=True, predicting=True,
                              skip_validation=True)
    n = serving.agg(F.count(F.lit(1)).alias("rows_serving"))
    return (audit.crossJoin(n).select(
        "rows_in", "rows_serving", F.col("rows_out").alias("rows_training"),
        (F.col("rows_in") == F.col("rows_serving")).alias("serving_equal"),
        (F.col("rows_in") - F.col("rows_out")).alias("rows_removed")))


# ---------------------------------------------------------------- features
def _feat(spark, sf_dir):
    return Q.featured_with_pickup(Q.raw(spark, sf_dir))


def q_hour_weekday(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "pickup_hour", "pickup_weekday")


def q_calendar_parts(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "pickup_day", "pickup_month", "pickup_year")


def q_is_weekend(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "pickup_weekday", "is_weekend")


def q_rush_flags(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "is_morning_rush", "is_evening_rush")


def q_is_night(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "pickup_hour", "is_night")


def q_is_holiday(spark, sf_dir):
    """the holiday flag of every calendar day from the first to the last
    pickup day (the rule, day by day)."""
    days = Q.raw(spark, sf_dir).select(F.to_date(S.PICKUP).alias("day"))
    out = cal.holiday_calendar(days)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "is_holiday")


def q_date_int(spark, sf_dir):
    return _feat(spark, sf_dir).select(S.PICKUP, "date_int")


def q_season_wave(spark, sf_dir):
    return round_doubles(_feat(spark, sf_dir).select(S.PICKUP, "sin_time", "cos_time"))


def q_speed_mph(spark, sf_dir):
    c = Q.clean(spark, sf_dir)
    return round_doubles(c.select(S.PICKUP, S.DISTANCE, S.TARGET,
                                  C.speed_mph(F.col(S.DISTANCE), F.col(S.TARGET)).alias("speed_mph")))


def q_feature_matrix(spark, sf_dir):
    """the 17 model features in order plus the target."""
    return round_doubles(Q.featured(spark, sf_dir).select(*S.FEATURE_COLUMNS, S.TARGET))


def q_daily_stats(spark, sf_dir):
    """A2 (flagship): per day, the sum / count / mean trip duration."""
    return round_doubles(daily_stats(Q.featured(spark, sf_dir)), 4)


QUERIES = {
    "scan_trips": q_scan_trips,
    "scan_batches": q_scan_batches,
    "file_count": q_file_count,
    "months_slice": q_months_slice,
    "rescan": q_rescan,
    "validation_day": q_validation_day,
    "json_requests": q_json_requests,
    "standardize_columns": q_standardize_columns,
    "keep_columns": q_keep_columns,
    "parse_timestamps": q_parse_timestamps,
    "parse_request_timestamps": q_parse_request_timestamps,
    "drop_invalid": q_drop_invalid,
    "skip_validation": q_skip_validation,
    "trip_duration": q_trip_duration,
    "remove_outliers": q_remove_outliers,
    "coerce_numeric": q_coerce_numeric,
    "fill_passengers": q_fill_passengers,
    "fill_categoricals": q_fill_categoricals,
    "preprocess": q_preprocess,
    "cleaning_audit": q_cleaning_audit,
    "row_count_check": q_row_count_check,
    "hour_weekday": q_hour_weekday,
    "calendar_parts": q_calendar_parts,
    "is_weekend": q_is_weekend,
    "rush_flags": q_rush_flags,
    "is_night": q_is_night,
    "is_holiday": q_is_holiday,
    "date_int": q_date_int,
    "season_wave": q_season_wave,
    "speed_mph": q_speed_mph,
    "feature_matrix": q_feature_matrix,
    "daily_stats": q_daily_stats,
}
