"""Trend fit (closed form vs MLlib vs numpy), hybrid pipeline persistence,
request scoring (the end-to-end serving assertions), run records."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import boost as B
from tripcast.operators import hybrid as H
from tripcast.operators import trend as TR
from tripcast.plans import common as Q
from tripcast.sources import requests as R
from tripcast.sources.trips import TRIPS_RAW_SCHEMA

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def daily(spark):
    train, _ = Q.split_years(Q.featured_with_pickup(Q.raw(spark, SF)))
    return A.daily_stats(train).checkpoint(eager=True)


def test_closed_form_equals_numpy_and_mllib(spark, daily):
    pdf = daily.toPandas()
    X = pdf[S.TREND_COLUMNS].to_numpy(float)
    y = np.log1p(pdf["avg_duration"].to_numpy(float))
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + S.RIDGE_ALPHA * np.eye(3), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    got = TR.fit_ridge(daily).first()
    assert np.allclose([got["w_date"], got["w_sin"], got["w_cos"]], w, rtol=1e-8, atol=1e-12)
    assert got["intercept"] == pytest.approx(b, rel=1e-9)
    m = TR.fit_ridge_mllib(daily)
    assert np.allclose(m.coefficients.toArray(), w, rtol=1e-6, atol=1e-10)
    assert m.intercept == pytest.approx(b, rel=1e-7)


@pytest.fixture(scope="module")
def fitted(spark):
    train, _ = Q.split_years(Q.featured_with_pickup(Q.raw(spark, SF)))
    coefs = TR.fit_ridge(A.daily_stats(train)).checkpoint(eager=True)
    tm = B.assemble(H.training_matrix(train, coefs)).checkpoint(eager=True)
    booster = B.gbt_estimator({"min_data_in_leaf": 20, "num_leaves": 8}, max_iter=3).fit(tm)
    return H.scoring_pipeline(H.coefs_dict(coefs), booster)


def _requests(spark, n):
    import json

    rows = [{"VendorID": 1 + i % 2, "tpep_pickup_datetime": f"2013-01-01 {i:02d}:20:00",
             "passenger_count": i % 5 + 1, "trip_distance": 2.0 + 0.5 * i,
             "PULocationID": 100 + i, "DOLocationID": 200 + i} for i in range(n)]
    return spark.createDataFrame([(json.dumps({"data": rows}),)], "body string")


def test_one_and_ten_requests(spark, fitted):
    serve = H.serving_pipeline(fitted)
    for n in (1, 10):
        rows = R.parse_requests(_requests(spark, n)).drop("is_valid")
        out = serve.transform(rows).select("duration_minutes").collect()
        assert len(out) == n
        for r in out:
            assert r[0] == r[0] and 0 < r[0] < 180  # minutes: 3 hours


def test_bad_request_rejected(spark):
    bad = spark.createDataFrame([('{"invalid_field":"test"}',)], "body string")
    rows = R.parse_requests(bad).collect()
    assert len(rows) == 1 and rows[0]["is_valid"] is False


def test_model_save_load_round_trip(spark, fitted, tmp_dir):
    _, test = Q.split_years(Q.featured_with_pickup(Q.raw(spark, SF)))
    H.save_model(fitted, tmp_dir + "/m")
    a = fitted.transform(test).select("predicted_seconds").toPandas()
    b = H.load_model(tmp_dir + "/m").transform(test).select("predicted_seconds").toPandas()
    assert np.allclose(a.values, b.values)


def test_runs_append(spark, tmp_dir):
    runs = H.runs_frame(spark, "r1", [{"run_no": 0, "stepSize": 0.1, "rmse": 2.0, "mae": 1.0, "r2": 0.5},
                                      {"run_no": 1, "stepSize": 0.05, "rmse": 2.0, "mae": 1.5, "r2": 0.4}])
    H.append_runs(runs, tmp_dir + "/runs")
    H.append_runs(runs, tmp_dir + "/runs")
    back = spark.read.parquet(tmp_dir + "/runs")
    assert back.count() == 4
    best = A.best_run(runs).collect()
    assert len(best) == 1 and best[0]["run_no"] == 0  # tie on rmse: earliest run


def test_runs_without_a_metric_cannot_win(spark):
    rows = [(0, None), (1, float("nan")), (2, 3.0), (3, 2.0)]
    runs = spark.createDataFrame(rows, "run_no int, rmse double")
    assert [tuple(r) for r in A.best_run(runs).collect()] == [(3, 2.0)]
    assert A.best_run(runs.filter("run_no < 2")).collect() == []


def test_median_of_a_bin_is_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(float(p), float(e)) for p, e in zip(rng.choice([10, 70, 130], 999), np.round(rng.normal(0, 50, 999), 1))]
    rows += [(10.0, None), (190.0, 5.0), (250.0, None)]
    df = spark.createDataFrame(rows, "predicted double, residual double")
    got = {r["predicted_bin"]: (r["n"], r["median_residual"]) for r in A.residual_profile(df).collect()}
    for b in (0, 1, 2, 3):
        own = [e for p, e in rows if p // 60 == b and e is not None]
        assert got[b][0] == len(own) and got[b][1] == pytest.approx(np.median(own))
    assert got[4] == (0, None)


def test_depth_ladder():
    assert B.depth_for_leaves(255) == 8 and B.depth_for_leaves(127) == 7
    assert B.depth_for_leaves(8) == 3 and B.depth_for_leaves(9) == 4


def test_predictions_go_back_to_their_request(spark):
    import json

    rows = [{"VendorID": 1, "tpep_pickup_datetime": "2013-01-01 08:20:00", "passenger_count": 1, "trip_distance": float(d),
             "PULocationID": 1, "DOLocationID": 2} for d in (3, 1, 2)]
    bodies = spark.createDataFrame([("a", json.dumps({"data": rows})), ("b", json.dumps({"data": rows[:1]})), ("c", "{}")],
                                   "request string, body string")
    parsed = R.parse_requests(bodies, carry=("request",))
    assert parsed.filter("request = 'c'").select("is_valid").first()[0] is False
    out = R.predictions_body(parsed.filter("is_valid"), "position", S.DISTANCE, ("request",)).collect()
    assert {r["request"]: json.loads(r["body"])["predictions"] for r in out} == {"a": [3.0, 1.0, 2.0], "b": [3.0]}


def test_predictions_body_keeps_request_order(spark):
    import json

    scored = spark.createDataFrame([(2, 7.5), (0, 3.0), (1, 12.25)], "req_pos int, duration_minutes double")
    body = R.predictions_body(scored, "req_pos").first()["body"]
    assert json.loads(body) == {"predictions": [3.0, 12.25, 7.5]}


def test_hexbin_matches_numpy(spark):
    import math

    import pandas as pd

    rng = np.random.default_rng(4)
    x, y = rng.normal(1000, 300, 2000), rng.normal(900, 250, 2000)
    got = A.hexbin_density(spark.createDataFrame(pd.DataFrame({"actual": x, "predicted": y}))).toPandas()
    # the hexagonal binning rule, written with numpy
    nx, ny = 50, int(50 / math.sqrt(3))
    pad = 1e-9 * (x.max() - x.min())
    x0, x1, y0, y1 = x.min() - pad, x.max() + pad, y.min(), y.max()
    ix, iy = (x - x0) / ((x1 - x0) / nx), (y - y0) / ((y1 - y0) / ny)
    ix1, iy1, ix2, iy2 = np.round(ix), np.round(iy), np.floor(ix), np.floor(iy)
    first = (ix - ix1) ** 2 + 3 * (iy - iy1) ** 2 < (ix - ix2 - 0.5) ** 2 + 3 * (iy - iy2 - 0.5) ** 2
    cells = pd.DataFrame({"lattice": np.where(first, 1, 2), "i": np.where(first, ix1, ix2).astype(int),
                          "j": np.where(first, iy1, iy2).astype(int)})
    exp = cells.value_counts().rename("n").reset_index().sort_values(["lattice", "i", "j"]).reset_index(drop=True)
    got = got.sort_values(["lattice", "i", "j"]).reset_index(drop=True)
    assert (got[["lattice", "i", "j", "n"]].values == exp[["lattice", "i", "j", "n"]].values).all()


def test_a_run_logged_twice_counts_once(spark, tmp_dir):
    run = {"run_no": 0, "stepSize": 0.1, "rmse": 2.0, "mae": 1.0, "r2": 0.5}
    for run_id, rmse in (("a", 2.0), ("b", 1.5), ("a", 1.75)):
        H.log_runs(H.runs_frame(spark, run_id, [{**run, "rmse": rmse}]), tmp_dir + "/log")
    log = H.read_runs(spark, tmp_dir + "/log")
    assert sorted((r["run_id"], r["rmse"], r["params"]["stepSize"]) for r in log.collect()) == [("a", 1.75, "0.1"), ("b", 1.5, "0.1")]


def test_pages_hold_a_bounded_part_of_a_request(spark):
    import json

    scored = spark.range(2500).select(F.lit("a").alias("request"), "id", F.col("id").alias("v")).union(
        spark.range(3).select(F.lit("b"), "id", F.col("id") * 10))
    pages = R.prediction_pages(scored, ("request",), "id", 1000, "v").collect()
    found = {(r["request"], r["page"]): json.loads(r["body"])["predictions"] for r in pages}
    assert found[("b", 0)] == [0, 10, 20] and sorted(found) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert sum((found[("a", p)] for p in range(3)), []) == list(range(2500))


def test_density_curve_is_a_gaussian_kernel_estimate(spark):
    x = np.random.default_rng(2).normal(3, 2, 4000)
    got = A.density_curve(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "residual double")).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["density"], want, rtol=0.01, atol=1e-4) and len(got) == 100
    assert A.density_curve(spark.createDataFrame([(1.0,), (1.0,)], "residual double")).collect() == []


def test_merged_sketches_equal_one_over_all(spark):
    rng = np.random.default_rng(3)
    rows = [(int(d), float(p), float(r)) for d, p, r in zip(rng.integers(0, 20, 30_000), rng.choice([30.0, 90.0], 30_000), rng.normal(size=30_000))]
    df = spark.createDataFrame(rows, "day int, predicted double, residual double")
    for r in A.merged_profile(A.residual_sketches(df, ["day"]).filter("day < 15")).collect():
        own = np.array([e for d, p, e in rows if d < 15 and p // 60 == r["predicted_bin"]])
        assert r["n"] == len(own)
        for q in (25, 50, 75):
            assert abs((own <= r[f"q{q}"]).mean() - q / 100) < 0.02


def test_the_latch_lasts_from_call_to_call(spark, tmp_dir):
    from tripcast.operators import monitoring as M

    def call(n, errors, reloaded=False):
        rows = spark.createDataFrame([(i, e) for i, e in enumerate(errors)], "i int, sq_err double")
        M.validate_call(spark, rows, [F.col("i")], "2000-01-0" + str(n), tmp_dir + "/r", n, reloaded, threshold=2.0)

    call(1, [100.0, 100.0, None])                # window not full
    call(2, [100.0, 100.0, 100.0])               # full with what the first call left: alarm
    call(3, [100.0])                             # still breached, latched
    call(4, [], reloaded=True)                   # reloaded: alarm again on the same window
    call(5, [0.0, 0.0, 0.0, 0.0, float("nan")])  # newest errors push the old ones out
    call(5, [0.0, 0.0, 0.0, 0.0, float("nan")])  # the call repeated replaces its report
    got = M.reports(spark, tmp_dir + "/r").orderBy("call_no").collect()
    assert [r["window_size"] for r in got] == [2, 5, 5, 5, 5]
    assert [r["retraining_triggered"] for r in got] == [False, True, False, True, False]
    assert [r["alarm_raised"] for r in got] == [False, True, True, True, True]
    assert [r["samples_validated"] for r in got] == [3, 3, 1, 0, 5]
    assert got[4]["tail"] == [100.0, 0.0, 0.0, 0.0, 0.0]


def test_lost_requests_are_listed(spark):
    from tripcast.operators import monitoring as M

    sent = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 0)], "request string, position int")
    answered = spark.createDataFrame([("a", 1, 2.5), ("b", 0, 3.5)], "request string, position int, minutes double")
    assert [tuple(r) for r in M.lost_rows(sent, answered, ["request", "position"]).collect()] == [("a", 0)]


def test_code_of_a_matrix_row_is_small_enough_to_be_compiled(spark, tmp_dir):
    """The JVM interprets methods of more than 8,000 bytes."""
    spark.createDataFrame([], TRIPS_RAW_SCHEMA).write.parquet(f"{tmp_dir}/none")
    raw = spark.read.schema(TRIPS_RAW_SCHEMA).parquet(f"{tmp_dir}/none")
    for rows in (H.with_draw(Q.featured_with_pickup(raw)), H._featurize(raw)):
        plan = H.boosting_matrix(rows, H.TrendBaseline(wDate=1e-5, wSin=0.01, wCos=0.01, intercept=6.0))
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan._jdf.queryExecution().executedPlan())
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and max(sizes) < 8000


def test_a_written_matrix_runs_its_plan_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(100).select(F.col("id").alias("draw"), F.lit(1.0).alias("label"), F.lit("x").alias("other"))
    out = H.written(rows.mapInArrow(look, rows.schema))
    assert out.columns == ["draw", "label"] and out.count() == 100 and out.count() == 100 and seen.value == 100


def test_a_training_matrix_holds_what_boosting_reads(spark):
    from tripcast.plans.queries_models import _matrices

    _, train, valid = _matrices(spark, SF)
    assert sorted(train.columns) == sorted([*S.FEATURE_COLUMNS, "label", "draw"])
    held = H.written(valid, H.SCORED)
    assert sorted(held.columns) == sorted([*S.FEATURE_COLUMNS, S.TARGET, "baseline", "label"]) and held.count() == valid.count()
