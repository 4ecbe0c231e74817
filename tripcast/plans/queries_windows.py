"""Registered queries: count windows and drift alerts.

The ordered stream is the ``events`` table: squared error = (value - 50)^2,
arrival order = event_id, a reload marker = an event of type 'signup'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators import aggregates as A
from tripcast.operators import windows as W
from tripcast.plans import common as Q
from tripcast.sources.trips import read_table

# --- fixed values: how the events table is read as a scored stream ---------
EVENT_TARGET = 50.0
ALERT_THRESHOLD = 60.0
RELOAD_TYPE = "signup"
CHUNK_ROWS = 4096


def event_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    return ev.select("event_id", "ts", "event_type",
                     F.pow(F.col("value") - F.lit(EVENT_TARGET), 2).alias("sq_err"))


def q_sliding_rmse(spark, sf_dir):
    """RMSE of the last 5 squared errors at every event."""
    s = W.sliding_rmse(event_errors(spark, sf_dir), "event_id", k=S.DRIFT_WINDOW, chunk_rows=CHUNK_ROWS)
    return A.round_doubles(s.select("event_id", "rmse", F.col("window_size").cast("long"), "window_full"))


def q_validation_rmse(spark, sf_dir):
    """Window state after each daily validate call."""
    e = event_errors(spark, sf_dir).withColumn("call_date", F.to_date("ts"))
    st = W.call_window_rmse(e, "event_id", "call_date")
    return A.round_doubles(st.withColumn("window_size", F.col("window_size").cast("long"))
                             .withColumn("call_date", F.date_format("call_date", "yyyy-MM-dd")))


def q_drift_alert(spark, sf_dir):
    """Latched alerts (first breach of RMSE > 60 per reload epoch)."""
    e = event_errors(spark, sf_dir)
    alerts = W.drift_alerts(e, "event_id", F.col("event_type") == RELOAD_TYPE, ALERT_THRESHOLD,
                            chunk_rows=CHUNK_ROWS)
    return A.round_doubles(alerts)


def q_rolling_7d(spark, sf_dir):
    """7-row rolling mean of the daily mean trip duration."""
    from tripcast.operators.aggregates import daily_stats

    d = daily_stats(Q.featured(spark, sf_dir)).select("date_int", "avg_duration")
    return A.round_doubles(W.rolling_mean(d, "date_int", "avg_duration"), 4)


QUERIES = {
    "sliding_rmse": q_sliding_rmse,
    "validation_rmse": q_validation_rmse,
    "drift_alert": q_drift_alert,
    "rolling_7d": q_rolling_7d,
}
