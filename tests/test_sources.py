"""Directory scans and batch identity (the loader tests, Spark form)."""

import datetime as dt
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import clean as C
from tripcast.sources import trips as T


@pytest.fixture()
def three_files(tmp_dir):
    rng = np.random.default_rng(7)
    start = dt.datetime(2011, 1, 1)
    frames = []
    for i in range(3):
        n = 1000
        t = pa.table({
            "vendor_id": rng.integers(1, 3, n),
            "tpep_pickup_datetime": pa.array([start + dt.timedelta(hours=i * n + j) for j in range(n)],
                                             pa.timestamp("us")),
            "passenger_count": rng.integers(1, 6, n),
            "trip_distance": rng.uniform(0.5, 20, n),
            "PULocationID": rng.integers(1, 265, n),
            "DOLocationID": rng.integers(1, 265, n),
        })
        pq.write_table(t, os.path.join(tmp_dir, f"file_{i}.parquet"), row_group_size=100)
        frames.append(t)
    return tmp_dir, pa.concat_tables(frames)


def test_scan_and_count(spark, three_files):
    path, table = three_files
    df = T.scan_trips(spark, path)
    assert T.file_count(df) == 3
    assert df.count() == 3000
    got = df.orderBy("tpep_pickup_datetime").toPandas()
    exp = table.to_pandas().sort_values("tpep_pickup_datetime").reset_index(drop=True)
    assert np.allclose(got["trip_distance"], exp["trip_distance"])


def test_batches_never_span_files(spark, three_files):
    path, _ = three_files
    b = T.with_batch_ids(T.scan_trips(spark, path), batch_size=300)
    sizes = b.groupBy("file_no", "batch_in_file").count().collect()
    assert len(sizes) == 3 * 4
    assert max(r["count"] for r in sizes) <= 300
    assert sorted(r["file_no"] for r in b.select("file_no").distinct().collect()) == [0, 1, 2]


def test_rescan_is_equal(spark, three_files):
    path, _ = three_files
    df = T.scan_trips(spark, path)
    a = df.orderBy("tpep_pickup_datetime").limit(5).collect()
    b = df.orderBy("tpep_pickup_datetime").limit(5).collect()
    assert a == b


def test_empty_dir_raises(spark, tmp_dir):
    with pytest.raises(ValueError, match="No parquet files found"):
        T.scan_trips(spark, tmp_dir)


def test_serving_path_on_loader_files(spark, three_files):
    path, _ = three_files
    df = T.scan_trips(spark, path)
    out, _ = C.preprocess(df, standardize_columns=True, remove_outliers=False, create_features=True,
                          predicting=True, skip_validation=True)
    assert out.count() == 3000
    assert "VendorID" in out.columns


def test_validation_day_fallback(spark):
    raw = T.trips_raw(spark, "/root/testdata/sf0.001")
    hit = T.validation_day(raw, 1998, 3, 15)
    assert hit.filter(F.to_date(S.PICKUP) != F.lit("1998-03-15").cast("date")).count() == 0
    assert hit.count() > 0
    assert T.validation_day(raw, 2030, 3, 15).count() == 0
    # a day without trips gives them only to a caller who asks for the month instead
    march = raw.filter(F.to_date(S.PICKUP) != F.lit("1998-03-15").cast("date"))
    assert T.validation_day(march, 1998, 3, 15).count() == 0
    month = T.validation_day_or_month(march, 1998, 3, 15, 5, [S.PICKUP]).collect()
    assert len(month) == 5 and all(r["is_fallback"] and r[S.PICKUP].month == 3 for r in month)
    same = T.validation_day_or_month(raw, 1998, 3, 15, 5, [S.PICKUP])
    assert same.count() == hit.count() and same.filter("is_fallback").count() == 0


def test_shared_folder_is_required_off_the_local_master():
    from types import SimpleNamespace

    from tripcast.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_files_of_different_schema_lose_no_rows(spark, tmp_dir):
    import datetime as dt

    at = dt.datetime(2013, 1, 1, 8)
    one = [(1, at, at + dt.timedelta(minutes=10), 2, 1.5, 1, 2)]
    spark.createDataFrame(one, "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                               "passenger_count int, trip_distance double, PULocationID long, DOLocationID long"
                          ).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/months")
    spark.createDataFrame([(*one[0][:3], 2.0, *one[0][4:])], "vendor_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
                               "Passenger_Count double, Trip_Distance double, pu_location_id long, do_location_id long"
                          ).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/months")
    df = T.scan_trips(spark, f"{tmp_dir}/months")
    rows = df.select(S.VENDOR, S.PICKUP, S.PASSENGERS, S.DISTANCE).collect()
    assert [tuple(r) for r in rows] == [(1, at, 2.0, 1.5)] * 2
    assert T.with_batch_ids(df, 10).select("file_no").distinct().count() == 2
    from tripcast.operators.clean import preprocess

    assert preprocess(df, standardize_columns=True)[0].count() == 2
    spark.createDataFrame([(1,)], "VendorID long").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/months")
    with pytest.raises(ValueError, match="lack"):
        T.scan_trips(spark, f"{tmp_dir}/months")


def test_small_fractions_keep_their_share(spark):
    from tripcast.operators.sampling import sample_fraction

    raw = T.trips_raw(spark, "/root/testdata/sf0.1")
    assert 8 <= sample_fraction(raw, 4e-5, 1).count() <= 48      # 24 of 600,000 expected
