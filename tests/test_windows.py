"""Chunked count windows against a brute-force pandas fold."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripcast.operators import windows as W


def brute(df: pd.DataFrame, k: int, thr: float):
    df = df.sort_values("key").reset_index(drop=True)
    buf, latch, epoch, alerts, rows = [], False, 0, [], []
    for r in df.itertuples():
        if r.reload:
            epoch += 1
            latch = False
        if r.sq_err is not None and not np.isnan(r.sq_err):
            buf = (buf + [r.sq_err])[-k:]
            rmse = float(np.sqrt(np.mean(buf)))
            rows.append((r.key, rmse, len(buf)))
            if len(buf) == k and rmse > thr and not latch:
                alerts.append((epoch, r.key, rmse))
                latch = True
    return rows, alerts


@pytest.fixture()
def errors():
    rng = np.random.default_rng(3)
    n = 700
    keys = np.sort(rng.choice(np.arange(5000), n, replace=False))  # sparse keys: uneven chunks
    se = rng.exponential(2500, n)
    se[rng.random(n) < 0.05] = np.nan
    reload = rng.random(n) < 0.1
    return pd.DataFrame({"key": keys.astype("int64"), "sq_err": se, "reload": reload})


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_sliding_and_alerts_match_fold(spark, errors, chunk):
    sdf = spark.createDataFrame(errors)
    rows, alerts = brute(errors, 5, 60.0)
    got = W.sliding_rmse(sdf, "key", "sq_err", 5, chunk).select("key", "rmse", "window_size").toPandas()
    got = got.sort_values("key").reset_index(drop=True)
    exp = pd.DataFrame(rows, columns=["key", "rmse", "window_size"])
    assert len(got) == len(exp)
    assert (got["key"].values == exp["key"].values).all()
    assert np.allclose(got["rmse"].values, exp["rmse"].values)
    assert (got["window_size"].values == exp["window_size"].values).all()
    a = W.drift_alerts(sdf, "key", F.col("reload"), 60.0, "sq_err", 5, chunk).toPandas()
    a = a.sort_values("key").reset_index(drop=True)
    assert list(a["key"]) == [x[1] for x in alerts]
    assert list(a["epoch"]) == [x[0] for x in alerts]


@pytest.mark.parametrize("chunk", [50, 1 << 20])
def test_call_window(spark, errors, chunk):
    e = errors.copy()
    # one hot call holding most rows, then small ones
    e["call"] = np.where(e["key"] < 3500, 0, 1 + (e["key"] - 3500) // 400)
    sdf = spark.createDataFrame(e)
    got = W.call_window_rmse(sdf, "key", "call", chunk_rows=chunk).toPandas().set_index("call").sort_index()
    valid = e.dropna(subset=["sq_err"]).sort_values("key")
    for c, row in got.iterrows():
        upto = valid[valid["call"] <= c]["sq_err"].values[-5:]
        assert row["window_size"] == len(upto)
        assert np.isclose(row["current_rmse"], np.sqrt(np.mean(upto)))
        assert row["samples"] == (e["call"] == c).sum()


def test_running_count(spark, errors):
    sdf = spark.createDataFrame(errors)
    got = W.running_count(sdf, "key", F.col("reload"), "n", 50).orderBy("key").toPandas()
    assert (got["n"].values == errors.sort_values("key")["reload"].cumsum().values).all()


def test_repeated_keys_use_a_dense_sequence(spark):
    # a third of the rows share one key: the window still runs in bounded chunks
    keys = np.concatenate([np.full(300, 5, dtype="int64"), np.arange(10, 610, dtype="int64")])
    pdf = pd.DataFrame({"key": keys, "sq_err": np.full(900, 4.0)})
    out = W.sliding_rmse(spark.createDataFrame(pdf), "key", "sq_err", 5, chunk_rows=64,
                         key_is_unique=False).toPandas()
    assert len(out) == 900
    assert np.allclose(out["rmse"], 2.0)
    assert (out["window_size"] == 5).sum() == 896


def test_dense_sequence_spreads_copies(spark):
    from tripcast.operators.sequence import dense_sequence

    pdf = pd.DataFrame({"a": np.concatenate([np.zeros(3000), np.arange(6000)]).astype("int64")})
    got = dense_sequence(spark.createDataFrame(pdf).repartition(8), ["a"], num_partitions=8).toPandas()
    assert sorted(got["seq"]) == list(range(9000))
    assert (got.sort_values("seq")["a"].values == np.sort(pdf["a"].values)).all()


def test_alerts_with_repeated_keys_match_fold(spark, errors):
    e = errors.copy()
    e["key"] = e["key"] // 20  # many repeated keys; ties keep input order in the fold
    e = e.sort_values("key", kind="stable").reset_index(drop=True)
    sdf = spark.createDataFrame(e)
    got = W.drift_alerts(sdf, "key", F.col("reload"), 60.0, chunk_rows=16, key_is_unique=False).toPandas()
    # ties on the key keep their input order (the sequence's last sort key)
    _, alerts = brute(e, 5, 60.0)
    got = got.sort_values("epoch").reset_index(drop=True)
    assert list(got["epoch"]) == [a[0] for a in alerts]
    assert list(got["key"]) == [a[1] for a in alerts]
