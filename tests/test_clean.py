"""Cleaning and features on the five-row trip fixture (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import clean as C

BASE = 1356999000000000  # 2013-01-01 00:10:00 UTC in microseconds


@pytest.fixture()
def raw5(spark):
    rows = [
        (1, BASE, BASE + 1200_000_000, 1.0, 2.5, 100, 200, 1),
        (2, BASE + 600_000_000, BASE + 900_000_000, 2.0, 3.0, 101, 201, 1),
        (1, BASE + 1200_000_000, BASE + 1200_005_000, None, 1.5, 102, 202, 1),
        (2, BASE + 1800_000_000, BASE + (1800 + 4 * 3600) * 1_000_000, 1.0, 10.0, 103, 203, 1),
        (1, BASE, BASE + 2400_000_000, 0.0, 5.0, 104, 204, 1),
    ]
    return spark.createDataFrame(rows, "VendorID long, tpep_pickup_datetime long, tpep_dropoff_datetime long, "
                                       "passenger_count double, trip_distance double, PULocationID long, "
                                       "DOLocationID long, payment_type long")


def test_runs_and_drops_extra_column(raw5):
    out, _ = C.preprocess(raw5)
    assert "payment_type" not in out.columns
    assert out.count() > 0


def test_micros_become_timestamps(raw5):
    df = C.parse_timestamps(C.keep_columns(raw5, C.columns_to_keep(False)))
    r = df.select(F.year(S.PICKUP).alias("y")).first()
    assert r["y"] == 2013
    assert df.schema[S.PICKUP].dataType.typeName() == "timestamp_ntz"


def test_duration_seconds(raw5):
    df = C.add_trip_duration(C.parse_timestamps(C.keep_columns(raw5, C.columns_to_keep(False))))
    got = [r[S.TARGET] for r in df.collect()]
    assert got == pytest.approx([1200.0, 300.0, 0.005, 14400.0, 2400.0])


def test_outlier_rules_keep_three(raw5):
    out, _ = C.preprocess(raw5)
    rows = out.orderBy(S.PU_ZONE).collect()
    assert [r[S.PU_ZONE] for r in rows] == [100, 101, 104]
    assert all(60 <= r[S.TARGET] <= 10800 for r in rows)


def test_missing_passengers_default_to_one(raw5):
    out, _ = C.preprocess(raw5, remove_outliers=False)
    by_zone = {r[S.PU_ZONE]: r[S.PASSENGERS] for r in out.collect()}
    assert by_zone[102] == 1.0
    assert by_zone[104] == 0.0  # a zero stays zero


def test_features(raw5):
    out, _ = C.preprocess(raw5, create_features=True)
    for c in S.FEATURE_COLUMNS + ["date_int", S.TARGET]:
        assert c in out.columns
    assert S.PICKUP not in out.columns and S.DROPOFF not in out.columns
    r = out.filter(F.col(S.PU_ZONE) == 100).first()
    assert r["pickup_year"] == 2013 and r["is_weekend"] == 0
    assert r["is_holiday"] == 1 and r["is_night"] == 1 and r["pickup_hour"] == 0
    assert r["date_int"] == 15706
    assert r["pickup_weekday"] == 1  # a Tuesday, Monday = 0


def test_serving_path_keeps_every_row(raw5):
    req = raw5.drop(S.DROPOFF)
    out, _ = C.preprocess(req, remove_outliers=False, create_features=True, predicting=True,
                          skip_validation=True)
    assert out.count() == 5


def test_standardize_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "vendor_id long, PULocationID long, do_location_id long")
    assert C.standardize_columns(df).columns == ["VendorID", "PULocationID", "DOLocationID"]
    clash = spark.createDataFrame([(1, 2)], "vendorid long, vendor_id long")
    with pytest.raises(ValueError):
        C.standardize_columns(clash)


def test_missing_required_column(spark):
    df = spark.createDataFrame([(1,)], "VendorID long")
    with pytest.raises(KeyError):
        C.keep_columns(df, C.columns_to_keep(False))


def test_string_timestamps(spark):
    df = spark.createDataFrame([("1356999000000000",), ("2013-01-01",), ("junk",)], "t string")
    out = [r[0] for r in df.select(C.parse_timestamp_column(df, "t")).collect()]
    assert out[0] is not None and out[1] is None and out[2] is None


def test_transformer_round_trip(spark, raw5, tmp_dir):
    t = C.TripPreprocessor(createFeatures=True, standardizeColumns=False)
    t.write().overwrite().save(tmp_dir + "/pre")
    t2 = C.TripPreprocessor.load(tmp_dir + "/pre")
    assert t2.transform(raw5).count() == t.transform(raw5).count() == 3


def test_duration_is_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2000-04-02 01:30:00' AS a, TIMESTAMP_NTZ'2000-04-02 03:30:00' AS b")
        assert df.select(C.duration_seconds(F.col("a"), F.col("b"))).first()[0] == 7200.0
        assert df.select(F.hour("a")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_observed_cleaning_matches_audit(spark):
    from tripcast.plans import common as Q

    raw = Q.raw(spark, "/root/testdata/sf0.001")
    cleaned, counts = C.observed_cleaning(raw, create_features=True)
    cleaned.write.format("noop").mode("overwrite").save()
    got = counts()
    audit = C.cleaning_audit(raw).first()
    assert got["rows_in"] == audit["rows_in"]
    assert got["rows_in"] - got["rows_valid"] == audit["invalid_rows"]
    assert got["rows_out"] == audit["rows_out"] == C.preprocess(raw, create_features=True)[0].count()


def test_serving_row_check_one_pass(spark, raw5):
    got = C.serving_row_check(raw5.drop(S.DROPOFF))
    assert got == {"rows_in": 5, "rows_out": 5, "equal": True}


def test_nan_counts_as_missing(spark):
    from pyspark.sql import functions as F

    from tripcast.operators import clean as C

    df = spark.sql("""SELECT TIMESTAMP_NTZ'2013-01-01 08:00:00' AS tpep_pickup_datetime,
        TIMESTAMP_NTZ'2013-01-01 08:10:00' AS tpep_dropoff_datetime, 1L AS VendorID, CAST('NaN' AS DOUBLE) AS passenger_count,
        d AS trip_distance, 1L AS PULocationID, 2L AS DOLocationID FROM VALUES (CAST('NaN' AS DOUBLE)), (2.0D) AS t(d)""")
    assert df.filter(F.isnan("trip_distance")).count() == 1
    assert [r["trip_distance"] for r in C.drop_invalid(df).collect()] == [2.0]
    assert [r["passenger_count"] for r in C.fill_passengers(df).collect()] == [1.0, 1.0]
    text = spark.createDataFrame([("NaN",), ("x",), ("2.5",)], "trip_distance string")
    assert [r[0] for r in C.coerce_numeric(text).collect()] == [None, None, 2.5]
    audit = C.cleaning_audit(df).first()
    assert (audit["invalid_rows"], audit["outlier_rows"], audit["rows_out"]) == (1, 0, 1)
    assert C.preprocess(df)[0].count() == 1
