"""Registered queries: streaming forms (T1-T5), drained with availableNow and
returned as batch DataFrames read from their parquet sinks."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import clean as C
from tripcast.operators.joins import join_small
from tripcast.plans import common as Q
from tripcast.plans.queries_windows import ALERT_THRESHOLD, EVENT_TARGET, RELOAD_TYPE
from tripcast.session import scratch_path
from tripcast.sources import requests as R
from tripcast.sources.trips import TRIPS_RAW_SCHEMA, read_table, trips_raw_path
from tripcast.streaming import streams as ST

TRIP_FILES_PER_TRIGGER = 4
EVENT_PARTS, MODELS, ALL_FILES = 3, 7, 1_000_000     # of the stream with several models


def _trip_stream(spark: SparkSession, sf_dir: str):
    """Trip files (the Spark-derived trip table's part files) arriving
    TRIP_FILES_PER_TRIGGER files per micro-batch."""
    return ST.file_stream(spark, trips_raw_path(spark, sf_dir), T.StructType.fromDDL(TRIPS_RAW_SCHEMA),
                          glob="*.parquet", files_per_trigger=TRIP_FILES_PER_TRIGGER)


def q_stream_ingest(spark, sf_dir):
    """The events file picked up by a file stream, one file per trigger."""
    schema = read_table(spark, sf_dir, "events").schema
    return ST.run_available_now(ST.file_stream(spark, sf_dir, schema, glob="events.parquet"), "ingest")


def q_stream_preprocess(spark, sf_dir):
    """The cleaning transformer on a stream of trip files."""
    trips = _trip_stream(spark, sf_dir)
    out, _ = C.preprocess(trips, create_features=True)
    return A.round_doubles(ST.run_available_now(out, "preprocess"))


def q_stream_score(spark, sf_dir):
    """Request bodies scored as they stream in: trend baseline x the stub
    hourly correction (both fitted on the batch training years).  Serving
    drops nothing: every row of a body comes back, readable ones with their
    minutes from one sink, the others from the reject sink."""
    from tripcast.operators import hybrid as H
    from tripcast.operators import trend as TR
    from tripcast.plans.queries_models import trend_coefs

    train, _ = Q.split_years(Q.featured_with_pickup(Q.raw(spark, sf_dir)))
    c = H.coefs_dict(trend_coefs(train))
    base = H.TrendBaseline(wDate=c["w_date"], wSin=c["w_sin"], wCos=c["w_cos"], intercept=c["intercept"])
    corr = TR.log_ratio_target(base.transform(train)).groupBy("pickup_hour").agg(F.avg("label").alias("log_correction"))
    bodies = R.request_bodies(Q.raw(spark, sf_dir).filter(F.year(S.PICKUP) >= Q.TEST_FROM_YEAR))
    folder = scratch_path(spark, "request-bodies")
    bodies.write.parquet(folder)
    stream = ST.file_stream(spark, folder, bodies.schema, glob="*.parquet", files_per_trigger=TRIP_FILES_PER_TRIGGER)
    rows = R.parse_requests(stream).withColumns(C.feature_columns(F.col(S.PICKUP), True))
    scored = join_small(base.transform(rows), corr, "pickup_hour", "left")
    minutes = F.when(F.col("is_valid"), F.col("baseline") * F.exp(F.col("log_correction")) / 60.0)
    answers, rejects = ST.split_by_flag(scored.select(
        S.PICKUP, S.DISTANCE, F.col(S.PU_ZONE).cast("double").alias(S.PU_ZONE), minutes.alias("duration_minutes"),
        "is_valid"), "is_valid", "score")
    return A.round_doubles(answers.unionByName(rejects).drop("batch_id"), 4)


def q_stream_drift(spark, sf_dir):
    """T4: the events table as it arrives, latched alerts with their state
    carried from micro-batch to micro-batch."""
    schema = read_table(spark, sf_dir, "events").schema
    stream = ST.file_stream(spark, sf_dir, schema, glob="events.parquet")
    errors = stream.select("event_id", (F.col("event_type") == RELOAD_TYPE).alias("is_reload"),
                           F.pow(F.col("value") - F.lit(EVENT_TARGET), 2).alias("sq_err"))
    alerts = ST.drift_stream(errors, "event_id", "is_reload", ALERT_THRESHOLD)
    return A.round_doubles(alerts.select("epoch", "event_id", "rmse"))


def q_stream_drift_models(spark, sf_dir):
    """T4 for many models at once: the events arrive in ``EVENT_PARTS`` parts;
    after each the stream takes what is new and stops, and goes on with its
    state after the next.  A user's number says which model scored."""
    events = read_table(spark, sf_dir, "events")
    folder, alerts, checkpoint = (scratch_path(spark, f"models-{x}") for x in ("files", "alerts", "state"))
    ends = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    part = F.least(F.floor((F.col("event_id") - ends["lo"]) * EVENT_PARTS / (ends["hi"] - ends["lo"] + 1)), F.lit(EVENT_PARTS - 1))
    for n in range(EVENT_PARTS):
        events.filter(part == n).write.mode("append").parquet(folder)
        stream = ST.file_stream(spark, folder, events.schema, glob="*.parquet", files_per_trigger=ALL_FILES)
        errors = stream.select("event_id", (F.col("user_id") % MODELS).alias("model"),
                               (F.col("event_type") == RELOAD_TYPE).alias("is_reload"),
                               F.pow(F.col("value") - F.lit(EVENT_TARGET), 2).alias("sq_err"))
        found = ST.drift_stream(errors, "event_id", "is_reload", ALERT_THRESHOLD, model_col="model", alerts_path=alerts,
                                checkpoint=checkpoint)
    return A.round_doubles(found)


def q_stream_daily_stats(spark, sf_dir):
    """T5: daily duration statistics kept up to date as trip files arrive."""
    trips = _trip_stream(spark, sf_dir)
    feat, _ = C.preprocess(trips, create_features=True)
    return A.round_doubles(ST.daily_stats_stream(feat), 4)


QUERIES = {
    "stream_ingest": q_stream_ingest,
    "stream_preprocess": q_stream_preprocess,
    "stream_score": q_stream_score,
    "stream_drift": q_stream_drift,
    "stream_drift_models": q_stream_drift_models,
    "stream_daily_stats": q_stream_daily_stats,
}
