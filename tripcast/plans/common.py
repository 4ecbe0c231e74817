"""Shared building blocks of the registered queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import clean as C
from tripcast.session import scratch_path
from tripcast.sources.trips import group_offsets, trips_raw, trips_raw_path, with_group_batches, write_in_order

# --- fixed values: how the registered queries use the fixture ---------------
TRAIN_BEFORE_YEAR = 2000      # train on pickup years < 2000
TEST_FROM_YEAR = 2000         # evaluate / validate on 2000 and later
FIXTURE_BATCH_ROWS = 2000     # loader batch size on the fixture (files = pickup years)
VALIDATION_DATE = (2000, 3, 15)
RAW_ORDER = [S.PICKUP, S.DROPOFF, S.VENDOR, S.PU_ZONE, S.DO_ZONE, S.DISTANCE, S.PASSENGERS, "fare_amount"]
CLEAN_ORDER = [S.PICKUP, S.DROPOFF, S.VENDOR, S.PU_ZONE, S.DO_ZONE, S.DISTANCE, S.PASSENGERS]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_raw(spark, sf_dir)


BATCH = ["file_year", "batch_no"]
_LOADER: dict[str, tuple] = {}


def loader_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with loader batch ids (``BATCH``; a year of pickups is the
    loader's file) and ``row_in_file``.

    The files that the loader goes through are written once per session, in
    order, like the trip table itself; after that a row's batch is a matter of
    its file and its index there."""
    source = trips_raw_path(spark, sf_dir)
    if source not in _LOADER:
        path, offsets = scratch_path(spark, "loader-files"), scratch_path(spark, "loader-offsets")
        write_in_order(raw(spark, sf_dir).withColumn("file_year", F.year(S.PICKUP).cast("int")), "file_year", RAW_ORDER, path)
        group_offsets(spark.read.parquet(path), "file_year").coalesce(1).write.parquet(offsets)
        _LOADER[source] = path, offsets, spark.read.parquet(offsets).count()
    path, offsets, n = _LOADER[source]
    return with_group_batches(spark.read.parquet(path), spark.read.parquet(offsets), "file_year", FIXTURE_BATCH_ROWS, n_offsets=n)


def clean_rows(df: DataFrame, remove_outliers: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned trips with their timestamps and duration (P2, P3, P5, P7, P8,
    P9, P10 in the contractual order, features not yet made).  ``carry``
    columns (batch ids) ride along untouched."""
    df = C.keep_columns(df, C.columns_to_keep(False) + list(carry))
    df = C.parse_timestamps(df)
    df = C.drop_invalid(df)
    df = C.add_trip_duration(df)
    if remove_outliers:
        df = C.remove_outliers(df)
    df = C.coerce_numeric(df)
    return C.fill_passengers(df)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(raw(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 with the full feature set (timestamps dropped)."""
    out, _ = C.preprocess(raw(spark, sf_dir), create_features=True)
    return out


def featured_with_pickup(df: DataFrame) -> DataFrame:
    """Cleaned rows plus features, keeping the pickup time (for ordering)."""
    return clean_rows(df).withColumns(C.feature_columns(F.col(S.PICKUP), True))


def split_years(df: DataFrame, year_col: str = "pickup_year") -> tuple[DataFrame, DataFrame]:
    return (df.filter(F.col(year_col) < TRAIN_BEFORE_YEAR), df.filter(F.col(year_col) >= TEST_FROM_YEAR))
