"""Registered queries: what a served and watched model needs over time: lost
requests (P14), validate calls with a latch (A9), answers in pages (S8), runs
logged once (S10), months loaded again (S1, S5), scans and transformers that
come back the same (S4, X3), and residual summaries that merge (A6, A7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import clean as C
from tripcast.operators import hybrid as H
from tripcast.operators import monitoring as M
from tripcast.operators.joins import join_small
from tripcast.plans import common as Q
from tripcast.plans.queries_analytics import eval_frame, hourly_stub, stub_runs
from tripcast.session import scratch_path
from tripcast.sources import trips as T
from tripcast.sources.requests import prediction_pages

PAGE_ROWS = 1000
#: validate calls (date, model reloaded just before) in order
CALLS = [("2000-03-15", False), ("2000-03-16", False), ("2000-03-18", True), ("2000-03-19", False)]
SKETCH_YEAR = 2000            # its days are merged out of the stored sketches
RANK_BOUND = 0.02             # rank error allowed; SKETCH_K gives about 0.006


def q_lost_rows(spark, sf_dir):
    """The raw trips that cleaning answers nothing for, by their place in
    the loader's files."""
    sent = Q.loader_batches(spark, sf_dir)
    key = ["file_year", "row_in_file"]
    answered = Q.clean_rows(sent, carry=tuple(key))
    return M.lost_rows(sent.select(*key, S.PICKUP, S.DISTANCE), answered, key)


def q_validation_calls(spark, sf_dir):
    """The validate calls of ``CALLS`` one after another, each reading the
    report before it; their reports."""
    train, _ = Q.split_years(Q.featured_with_pickup(Q.raw(spark, sf_dir)))
    hourly = hourly_stub(train).checkpoint(eager=True)
    path = scratch_path(spark, "reports")
    for n, (date, reloaded) in enumerate(CALLS, 1):
        day = T.validation_day(Q.raw(spark, sf_dir), *map(int, date.split("-"))).withColumn("pickup_hour", F.hour(S.PICKUP).cast("int"))
        actual = C.duration_seconds(F.col(S.PICKUP), F.col(S.DROPOFF)) / 60.0
        errors = join_small(day, hourly, "pickup_hour", "left").withColumn("sq_err", F.pow(F.col("predicted") / 60.0 - actual, 2))
        M.validate_call(spark, errors, [F.col(c) for c in Q.RAW_ORDER], date, path, n, reloaded)
    return A.round_doubles(M.reports(spark, path).drop("tail"), 4)


def q_prediction_pages(spark, sf_dir):
    """A year's raw trips as one request, answered in pages of
    ``PAGE_ROWS`` whole seconds."""
    train, _ = Q.split_years(Q.featured_with_pickup(Q.raw(spark, sf_dir)))
    rows = Q.loader_batches(spark, sf_dir).select("file_year", "row_in_file", F.hour(S.PICKUP).cast("int").alias("pickup_hour"))
    scored = join_small(rows, hourly_stub(train), "pickup_hour", "left").withColumn("seconds", F.floor("predicted"))
    return prediction_pages(scored, ("file_year",), "row_in_file", PAGE_ROWS, "seconds")


def q_log_runs(spark, sf_dir):
    """The stub runs logged as run a, as run b, and as run a again
    (a retry); the log, with the best run of it marked."""
    path = scratch_path(spark, "run-log")
    runs = stub_runs(spark, sf_dir).checkpoint(eager=True)
    for run_id in ("a", "b", "a"):
        H.log_runs(runs.select(F.lit(run_id).alias("run_id"), F.col("run_no").cast("long").alias("run_no"),
                               F.lit(None).cast("timestamp_ntz").alias("logged_at"),
                               F.create_map(F.lit("model"), F.col("model")).alias("params"), "rmse", "mae",
                               F.lit(None).cast("double").alias("r2")), path)
    log = H.read_runs(spark, path)
    best = A.best_run(log.filter("run_id = 'a'")).select("run_id", "run_no", F.lit(True).alias("is_best"))
    out = log.join(F.broadcast(best), ["run_id", "run_no"], "left").fillna(False, ["is_best"])
    return A.round_doubles(out.select("run_id", "run_no", F.col("params")["model"].alias("model"), "rmse", "mae", "is_best"), 4)


def q_months_layout(spark, sf_dir):
    """Trips laid out by month, one month loaded again; the first half
    of 1998 by its folders."""
    path = scratch_path(spark, "months")
    raw = Q.raw(spark, sf_dir)
    T.write_months(raw, path)
    T.write_months(T.months_slice(raw, [1998], [3]), path)
    return T.read_months(spark, path, T.TRIPS_RAW_SCHEMA, [1998], [1, 2, 3, 4, 5, 6])


def q_rescan_rows(spark, sf_dir):
    """Two scans of the loader's files give the same rows, and the same
    first batch: order-free hashes of both."""
    Q.loader_batches(spark, sf_dir)

    def scan(name: str):
        rows = Q.loader_batches(spark, sf_dir)
        value = F.xxhash64(*rows.columns).cast("decimal(38,0)")
        first = (F.col("file_year") == 1995) & (F.col("batch_no") == 0)
        return rows.agg(F.count(F.lit(1)).alias(f"n_{name}"), F.sum(value).alias(f"rows_{name}"),
                        F.sum(F.when(first, value)).alias(f"batch_{name}"), F.count_if(first).alias(f"k_{name}"))

    both = scan("first").crossJoin(scan("again"))       # one row each
    return both.select("n_first", "n_again", "k_first", (F.col("rows_first") == F.col("rows_again")).alias("same_rows"),
                       F.col("batch_first").eqNullSafe(F.col("batch_again")).alias("same_first_batch"))


def q_transformer_round_trip(spark, sf_dir):
    """The cleaning transformer saved, loaded and applied."""
    path = scratch_path(spark, "transformer")
    C.TripPreprocessor(standardizeColumns=False, createFeatures=True).save(path)
    return A.round_doubles(C.TripPreprocessor.load(path).transform(Q.raw(spark, sf_dir)))


def q_density_curve(spark, sf_dir):
    """The density curve of the residuals at 100 places."""
    return A.round_doubles(A.density_curve(eval_frame(spark, sf_dir)), 8)


def q_residual_sketch(spark, sf_dir):
    """Sketches per day and bin, stored; those of one year merged; per bin
    the count, and whether each quantile's rank is within ``RANK_BOUND``."""
    ev = eval_frame(spark, sf_dir).select(F.to_date(S.PICKUP).alias("day"), "predicted", "residual").checkpoint(eager=True)
    path = scratch_path(spark, "sketches")
    A.residual_sketches(ev, ["day"]).write.parquet(path)
    merged = A.merged_profile(spark.read.parquet(path).filter(F.year("day") == SKETCH_YEAR)).checkpoint(eager=True)
    # against the trips themselves: the ranks that the estimates really have
    rows = ev.filter(F.year("day") == SKETCH_YEAR).withColumn("predicted_bin", F.floor(F.col("predicted") / 60.0).cast("long"))
    ranks = join_small(rows, merged, "predicted_bin", "inner").groupBy("predicted_bin").agg(
        F.min("n").alias("n"), F.count("residual").alias("n_trips"),
        *[F.count_if(F.col("residual") < F.col(f"q{q}")).alias(f"below{q}") for q in (25, 50, 75)],
        *[F.count_if(F.col("residual") <= F.col(f"q{q}")).alias(f"upto{q}") for q in (25, 50, 75)])
    slack = F.col("n") * RANK_BOUND + 1
    good = [(F.col(f"below{q}") <= F.col("n") * q / 100 + slack) & (F.col(f"upto{q}") >= F.col("n") * q / 100 - slack) for q in (25, 50, 75)]
    return ranks.select("predicted_bin", "n", (F.col("n") == F.col("n_trips")).alias("all_counted"),
                        (good[0] & good[1] & good[2]).alias("within_bound"))


QUERIES = {
    "lost_rows": q_lost_rows,
    "validation_calls": q_validation_calls,
    "prediction_pages": q_prediction_pages,
    "log_runs": q_log_runs,
    "months_layout": q_months_layout,
    "rescan_rows": q_rescan_rows,
    "transformer_round_trip": q_transformer_round_trip,
    "density_curve": q_density_curve,
    "residual_sketch": q_residual_sketch,
}
