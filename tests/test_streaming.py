import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcast.operators import windows as W
from tripcast.streaming import streams as ST

SCHEMA = "key long, sq_err double, is_reload boolean"


def arrive(spark, folder, rows, per_file):
    """Files of ``per_file`` rows that the file source takes one by one, in order."""
    import os
    import time

    for n, i in enumerate(range(0, len(rows), per_file)):
        path = f"{folder}/stage-{rows[i][0]:08d}"
        spark.createDataFrame(rows[i:i + per_file], SCHEMA).coalesce(1).write.parquet(path)
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        target = f"{folder}/in/{rows[i][0]:08d}.parquet"
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{path}/{part}", "rb") as source, open(target, "wb") as out:
            out.write(source.read())
        stamp = time.time() - 10_000 + rows[i][0]
        os.utime(target, (stamp, stamp))
    return f"{folder}/in"


def alerts(df):
    return [(r["epoch"], r["key"]) for r in df.orderBy("key").collect()]


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    return [(i, None if rng.random() < 0.2 else float("nan") if rng.random() < 0.05 else float(rng.exponential(3000)),
             bool(rng.random() < 0.15)) for i in range(n)]


@pytest.mark.parametrize(("per_file", "n"), [(1, 9), (2, 14), (3, 18), (80, 240)])
def test_drift_stream_equals_batch(spark, tmp_dir, per_file, n):
    rows = random_rows(n, per_file)
    df = spark.createDataFrame(rows, SCHEMA)
    folder = arrive(spark, tmp_dir, rows, per_file)
    got = ST.drift_stream(ST.file_stream(spark, folder, df.schema), "key", "is_reload", 40.0)
    assert alerts(got) == alerts(W.drift_alerts(df, "key", F.col("is_reload"), 40.0, chunk_rows=32))


def test_reload_without_an_error_clears_the_latch(spark, tmp_dir):
    big = 100.0 ** 2
    rows = [(i, big, False) for i in range(6)] + [(6, None, True)] + [(i, big, False) for i in range(7, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    folder = arrive(spark, tmp_dir, rows, 7)
    got = ST.drift_stream(ST.file_stream(spark, folder, df.schema), "key", "is_reload", 60.0)
    assert alerts(got) == [(0, 4), (1, 7)] == alerts(W.drift_alerts(df, "key", F.col("is_reload"), 60.0))


def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_dir):
    rows = random_rows(18, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    places = {"alerts_path": f"{tmp_dir}/alerts", "checkpoint": f"{tmp_dir}/ckpt"}
    for part in (rows[:9], rows[9:]):
        folder = arrive(spark, tmp_dir, part, 3)
        got = ST.drift_stream(ST.file_stream(spark, folder, df.schema), "key", "is_reload", 40.0, **places)
    assert alerts(got) == alerts(W.drift_alerts(df, "key", F.col("is_reload"), 40.0))


def test_models_keep_their_own_state(spark, tmp_dir):
    """Three models in one stream, stopped and gone on with, each as alone."""
    rows = random_rows(90, 6)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("model", F.col("key") % 3)
    places = {"alerts_path": f"{tmp_dir}/alerts", "checkpoint": f"{tmp_dir}/ckpt"}
    for part in (rows[:50], rows[50:]):
        folder = arrive(spark, tmp_dir, part, 10)
        stream = ST.file_stream(spark, folder, spark.createDataFrame(rows, SCHEMA).schema).withColumn("model", F.col("key") % 3)
        got = ST.drift_stream(stream, "key", "is_reload", 40.0, model_col="model", **places)
    for m in range(3):
        alone = W.drift_alerts(df.filter(F.col("model") == m), "key", F.col("is_reload"), 40.0)
        assert alerts(got.filter(F.col("model") == str(m))) == alerts(alone)
    assert got.select("model").distinct().count() == 3


def test_a_null_flag_is_rejected_not_lost(spark, tmp_dir):
    rows = [(1, 1.0, True), (2, 2.0, False), (3, 3.0, None)]
    folder = arrive(spark, tmp_dir, rows, 3)
    stream = ST.file_stream(spark, folder, spark.createDataFrame(rows, SCHEMA).schema)
    yes, no = ST.split_by_flag(stream, "is_reload", "split")
    assert [r["key"] for r in yes.collect()] == [1] and sorted(r["key"] for r in no.collect()) == [2, 3]


def test_nan_errors_raise_no_alarm(spark):
    rows = [(i, float("nan") if i < 6 else 1.0, False) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert df.filter(F.isnan("sq_err")).count() == 6
    assert alerts(W.drift_alerts(df, "key", F.col("is_reload"), 60.0)) == []
    assert W.sliding_rmse(df, "key").filter(F.isnan("rmse")).count() == 0


def test_nothing_written_is_an_empty_table_and_other_errors_are_raised(spark, tmp_dir):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("a long")
    assert ST.read_if_written(spark, f"{tmp_dir}/nowhere", schema).collect() == []
    with open(f"{tmp_dir}/broken.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|magic"):
        ST.read_if_written(spark, f"{tmp_dir}/broken.parquet", schema).collect()
