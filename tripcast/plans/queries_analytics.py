"""Registered queries: sampling (L), aggregates (A), the holiday join
and the schema-drift union (U1).

Aggregates that need a prediction use a stub model that SQL can state
exactly: the mean training-year duration of the pickup hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import clean as C
from tripcast.operators import sampling as L
from tripcast.operators import trend as TR
from tripcast.operators import windows as W
from tripcast.operators.hybrid import append_runs
from tripcast.operators.joins import holiday_join, join_small
from tripcast.operators.sequence import dense_sequence
from tripcast.plans import common as Q
from tripcast.session import scratch_path
from tripcast.sources.requests import predictions_body
from tripcast.sources.trips import scan_trips

BATCH = Q.BATCH
CAP_BATCHES = 3               # batches that the L5 query asks for


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with loader batch ids (files = pickup years)."""
    return Q.loader_batches(spark, sf_dir).drop("row_in_file")


def hourly_stub(train: DataFrame) -> DataFrame:
    return train.groupBy("pickup_hour").agg(F.avg(S.TARGET).alias("predicted"))


def eval_frame(spark: SparkSession, sf_dir: str, keep_cols: list[str] | None = None) -> DataFrame:
    """Test-year trips with actual, stub prediction and residual (seconds)."""
    feat = Q.featured_with_pickup(Q.raw(spark, sf_dir))
    train, test = Q.split_years(feat)
    ev = join_small(test, hourly_stub(train), "pickup_hour", "left")
    cols = keep_cols or [S.PICKUP, "pickup_hour"]
    return ev.select(*cols, F.col(S.TARGET).alias("actual"), "predicted",
                     (F.col(S.TARGET) - F.col("predicted")).alias("residual"))


# ---------------------------------------------------------------- sampling
def q_sample_fraction(spark, sf_dir):
    """L1: final-phase rate (10 %, seed 124961) per batch; batches of at most
    1000 rows stay whole."""
    return L.sample_fraction(raw_batches(spark, sf_dir), 0.10, 124961, BATCH, S.SAMPLE_MIN_BATCH_ROWS)


def q_sample_exact(spark, sf_dir):
    """L2: exactly round-half-even(7.5 % of n) rows of every batch, seed 42."""
    return L.sample_exact(raw_batches(spark, sf_dir), 0.075, 42, BATCH, Q.RAW_ORDER)


def q_sample_small_batches(spark, sf_dir):
    """L3: per batch, rows kept by the training rule (whole when <= 1000
    rows, else the 10 % draw) and by the evaluation rule (always the exact
    7.5 %) -- both conditions evaluated in one windowed pass, one aggregate."""
    b = raw_batches(spark, sf_dir)
    x = L.with_exact_rank(b, 42, BATCH, Q.RAW_ORDER)
    train_keep = (F.col("_n") <= S.SAMPLE_MIN_BATCH_ROWS) | L.fraction_keep(b, 0.10, 124961)
    return x.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_if(train_keep).alias("n_train_sample"),
                                 F.count_if(L.exact_keep(0.075)).alias("n_eval_sample"))


def q_hard_case_sampling(spark, sf_dir):
    """L4: trips more than 20 % off the trend fitted on the training years,
    plus a 5 % draw (seed 7) of all trips."""
    feat = Q.featured_with_pickup(Q.raw(spark, sf_dir))
    train, _ = Q.split_years(feat)
    coefs = TR.fit_ridge(A.daily_stats(train))
    out = L.hard_case_sample(TR.trend_predict(feat, coefs), S.TARGET, "baseline", 7)
    return A.round_doubles(out.select(S.PICKUP, S.DISTANCE, S.TARGET, "baseline"))


def q_cap_batches(spark, sf_dir):
    """Evaluation batches of the test years: 7.5 % exact sample, cleaning,
    the first CAP_BATCHES non-empty batches; rows kept per batch."""
    b = raw_batches(spark, sf_dir).filter(F.col("file_year") >= Q.TEST_FROM_YEAR)
    s = L.sample_exact(b, 0.075, 42, BATCH, Q.RAW_ORDER)
    cleaned = Q.clean_rows(s, carry=tuple(BATCH))
    capped = L.cap_batches(cleaned, BATCH, CAP_BATCHES)
    return capped.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("n_rows"))


def q_first_n(spark, sf_dir):
    """The first 200 cleaned trips of the test year in pickup order."""
    c = Q.clean(spark, sf_dir).filter(F.year(S.PICKUP) >= Q.TEST_FROM_YEAR)
    return L.first_n(c, 200, Q.CLEAN_ORDER)


# ---------------------------------------------------------------- aggregates
def q_daily_partial(spark, sf_dir):
    """A1: per batch and day, sum and count of cleaned durations."""
    b = raw_batches(spark, sf_dir)
    cleaned = Q.clean_rows(b, carry=tuple(BATCH))
    feat = cleaned.withColumns(C.feature_columns(F.col(S.PICKUP), True))
    return A.round_doubles(A.daily_partial(feat, BATCH), 4)


def q_regression_metrics(spark, sf_dir):
    return A.round_doubles(A.regression_metrics(eval_frame(spark, sf_dir)), 4)


def q_batch_metrics(spark, sf_dir):
    """A4: RMSE / MAE of each batch of the test years, every 15th marked."""
    feat = Q.featured_with_pickup(Q.raw(spark, sf_dir))
    train, _ = Q.split_years(feat)
    b = raw_batches(spark, sf_dir).filter(F.col("file_year") >= Q.TEST_FROM_YEAR)
    cleaned = Q.clean_rows(b, carry=tuple(BATCH))
    cleaned = cleaned.withColumn("pickup_hour", F.hour(S.PICKUP).cast("int"))
    ev = join_small(cleaned, hourly_stub(train), "pickup_hour", "left").withColumnRenamed(S.TARGET, "actual")
    return A.round_doubles(A.batch_metrics(ev, BATCH), 4)


def q_density_2d(spark, sf_dir):
    return A.density_2d(eval_frame(spark, sf_dir))


def q_density_hexbin(spark, sf_dir):
    """A5 as the plot draws it: 50 hexagons over the actual x predicted range."""
    return A.round_doubles(A.hexbin_density(eval_frame(spark, sf_dir)), 4)


def q_residual_histogram(spark, sf_dir):
    return A.round_doubles(A.residual_histogram(eval_frame(spark, sf_dir)), 4)


def q_residual_profile(spark, sf_dir):
    return A.round_doubles(A.residual_profile(eval_frame(spark, sf_dir)), 4)


# --- fixed values: the stub runs compared by best_run -----------------------
STUB_RUNS = [
    (0, "global", []),
    (1, "hour", ["pickup_hour"]),
    (2, "weekday", ["pickup_weekday"]),
    (3, "hour_weekday", ["pickup_hour", "pickup_weekday"]),
    (4, "pickup_zone", ["PULocationID"]),
]


def stub_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per stub run: group-mean models over different keys, scored on
    the test year (the runs table that S10 writes).

    All five models come from one aggregate pass over the training rows
    (GROUPING SETS; the result is a few hundred rows, checkpointed), and all
    five predictions are scored in one pass over the test rows (one
    size-checked broadcast join per model, then one aggregate)."""
    feat = Q.featured_with_pickup(Q.raw(spark, sf_dir))
    train, test = Q.split_years(feat)
    all_keys = sorted({k for _, _, keys in STUB_RUNS for k in keys})
    sets = [[F.col(k) for k in keys] for _, _, keys in STUB_RUNS]
    means = (train.groupingSets(sets, *all_keys)
                  .agg(F.avg(S.TARGET).alias("predicted"), F.grouping_id(*all_keys).alias("_gid"))
                  .checkpoint(eager=True))
    scored = test.select(S.TARGET, *all_keys)
    for run_no, _, keys in STUB_RUNS:
        gid = sum(1 << (len(all_keys) - 1 - i) for i, k in enumerate(all_keys) if k not in keys)
        model = means.filter(F.col("_gid") == gid).select(*keys, F.col("predicted").alias(f"_p{run_no}"))
        scored = (join_small(scored, model, keys, "left") if keys
                  else scored.crossJoin(F.broadcast(model)))
    aggs = []
    for run_no, _, _ in STUB_RUNS:
        err = F.col(S.TARGET) - F.col(f"_p{run_no}")
        aggs += [F.count(err).alias(f"n{run_no}"), F.sqrt(F.avg(err * err)).alias(f"rmse{run_no}"),
                 F.avg(F.abs(err)).alias(f"mae{run_no}")]
    # one row of 3 x 5 metrics -> 5 rows (stack), without re-reading the input
    args = ", ".join(f"{run_no}, '{name}', n{run_no}, rmse{run_no}, mae{run_no}" for run_no, name, _ in STUB_RUNS)
    return scored.agg(*aggs).select(
        F.expr(f"stack({len(STUB_RUNS)}, {args}) AS (run_no, model, n, rmse, mae)"))


def q_append_runs(spark, sf_dir):
    """The stub runs appended to a runs table twice, read back."""
    path = scratch_path(spark, "runs")
    runs = stub_runs(spark, sf_dir).checkpoint(eager=True)
    append_runs(runs, path)
    append_runs(runs, path)
    return A.round_doubles(spark.read.parquet(path), 4)


def q_predictions_body(spark, sf_dir):
    """One answer body per day of the test years, the day's trips as one
    request in pickup order, whole seconds."""
    ev = eval_frame(spark, sf_dir).select(F.date_format(S.PICKUP, "yyyy-MM-dd").alias("request"), S.PICKUP,
                                          F.floor("predicted").alias("seconds"))
    return predictions_body(ev, S.PICKUP, "seconds", ("request",))


def q_best_run(spark, sf_dir):
    """The stub run with the lowest RMSE (earliest run on a tie)."""
    return A.round_doubles(A.best_run(stub_runs(spark, sf_dir)), 4)


def q_validation_report(spark, sf_dir):
    """One summary row for a validate call on VALIDATION_DATE: the day's
    trips scored (stub, minutes) without validation, last-5 error window,
    threshold and alarm flag."""
    from tripcast.sources.trips import validation_day

    y, m, d = Q.VALIDATION_DATE
    feat = Q.featured_with_pickup(Q.raw(spark, sf_dir))
    train, _ = Q.split_years(feat)
    day = validation_day(Q.raw(spark, sf_dir), y, m, d)
    day = dense_sequence(day, Q.RAW_ORDER, "seq")
    day = day.withColumn("pickup_hour", F.hour(S.PICKUP).cast("int"))
    scored = join_small(day, hourly_stub(train), "pickup_hour", "left")
    y_min = C.duration_seconds(F.col(S.PICKUP), F.col(S.DROPOFF)) / 60.0
    errs = scored.select("seq", F.lit(1).alias("call"),
                         F.pow(F.col("predicted") / 60.0 - y_min, 2).alias("sq_err"))
    st = W.call_window_rmse(errs, "seq", "call")
    return A.round_doubles(st.select(
        F.lit(f"{y:04d}-{m:02d}-{d:02d}").alias("validation_date"),
        F.lit(f"{y:04d}-{m:02d}").alias("validation_month"),
        F.col("samples").alias("samples_validated"),
        "current_rmse", F.col("window_size").cast("long").alias("window_size"),
        F.lit(S.DRIFT_THRESHOLD_MIN).alias("threshold"),
        ((F.col("window_size") == S.DRIFT_WINDOW) & (F.col("current_rmse") > S.DRIFT_THRESHOLD_MIN))
        .alias("retraining_triggered")), 4)


# ---------------------------------------------------------------- joins / unions
def q_holiday_join(spark, sf_dir):
    """Holiday flag by a calendar join (equal to F6 per trip)."""
    return holiday_join(Q.clean(spark, sf_dir).select(S.PICKUP, S.TARGET), S.PICKUP).select(S.PICKUP, "is_holiday")


def q_union_batches(spark, sf_dir):
    """A folder of trip files whose schemas drifted (odd years use other
    column names and whole passenger counts, 1997 lacks fare_amount), read
    per schema, standardised, widened and united by name."""
    raw = Q.raw(spark, sf_dir)
    yr = F.year(S.PICKUP)
    even = raw.filter(yr % 2 == 0)
    odd = raw.filter((yr % 2 == 1) & (yr != 1997)).toDF(
        "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        "pu_location_id", "do_location_id", "fare_amount")
    y97 = raw.filter(yr == 1997).drop("fare_amount").toDF(
        "VendorID", "TPEP_PICKUP_DATETIME", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
        "PULocationID", "DOLocationID")
    odd = odd.withColumn("passenger_count", F.col("passenger_count").cast("int"))
    folder = scratch_path(spark, "drifted-months")
    for part in (even, odd, y97):
        part.write.mode("append").parquet(folder)
    return scan_trips(spark, folder).drop("file_path", "row_index")


QUERIES = {
    "sample_fraction": q_sample_fraction,
    "sample_exact": q_sample_exact,
    "sample_small_batches": q_sample_small_batches,
    "hard_case_sampling": q_hard_case_sampling,
    "cap_batches": q_cap_batches,
    "first_n": q_first_n,
    "daily_partial": q_daily_partial,
    "regression_metrics": q_regression_metrics,
    "batch_metrics": q_batch_metrics,
    "density_2d": q_density_2d,
    "density_hexbin": q_density_hexbin,
    "residual_histogram": q_residual_histogram,
    "residual_profile": q_residual_profile,
    "append_runs": q_append_runs,
    "predictions_body": q_predictions_body,
    "best_run": q_best_run,
    "validation_report": q_validation_report,
    "holiday_join": q_holiday_join,
    "union_batches": q_union_batches,
}
