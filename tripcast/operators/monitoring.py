"""Watching a served model: requests that got no answer (P14), and validate
calls whose drift window and alarm latch last from call to call (A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast import schema as S
from tripcast.streaming.streams import read_if_written

REPORT_SCHEMA = T.StructType([
    T.StructField("validation_date", T.StringType()),
    T.StructField("validation_month", T.StringType()),
    T.StructField("samples_validated", T.LongType()),
    T.StructField("current_rmse", T.DoubleType()),
    T.StructField("window_size", T.LongType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("retraining_triggered", T.BooleanType()),
    T.StructField("alarm_raised", T.BooleanType()),
    T.StructField("tail", T.ArrayType(T.DoubleType())),
    T.StructField("call_no", T.IntegerType()),
])


def lost_rows(sent: DataFrame, answered: DataFrame, key_cols: list[str]) -> DataFrame:
    """The rows sent whose key has no answer.  One shuffle of keys; the
    answers' other columns are not read."""
    return sent.join(answered.select(*key_cols).distinct(), key_cols, "left_anti")


def validate_call(spark: SparkSession, errors: DataFrame, order_cols: list, label: str, reports_path: str, call_no: int,
                  reloaded: bool = False, threshold: float = S.DRIFT_THRESHOLD_MIN, k: int = S.DRIFT_WINDOW) -> None:
    """Validate call ``call_no`` (from 1) on the rows of ``errors``
    (``sq_err``; NULL and NaN do not count), ``label`` its date.

    The last ``k`` errors and the latch come from the report of the call
    before.  A breach raises the alarm unless one was raised since the model
    was last reloaded; ``reloaded`` says it was, just before this call.  The
    report is written under the call's number, so a repeated call replaces its
    own report."""
    before = read_if_written(spark, f"{reports_path}/call_no={call_no - 1}", T.StructType(REPORT_SCHEMA.fields[:-1]))
    state = before.select("alarm_raised", "tail").collect()
    latched = bool(state) and state[0]["alarm_raised"] and not reloaded
    carried = spark.createDataFrame([(float(e), -i) for i, e in enumerate(reversed(state[0]["tail"] if state else []), 1)],
                                    "sq_err double, place long")
    valid = errors.filter(F.col("sq_err").isNotNull() & ~F.isnan("sq_err"))
    last = valid.orderBy(*[c.desc() for c in order_cols]).limit(k).select("sq_err")     # at most k rows a task
    # newest first: this call's rows, then those carried over
    newest = last.withColumn("place", F.monotonically_increasing_id()).unionByName(
        carried.withColumn("place", (1 << 40) - F.col("place")))
    tail = newest.groupBy().agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("place", "sq_err"))), lambda e: e["sq_err"]),
                                        1, k).alias("newest"))
    n = errors.agg(F.count(F.lit(1)).alias("samples_validated"))
    size, total = F.size("newest"), F.aggregate("newest", F.lit(0.0), lambda a, e: a + e)
    report = tail.crossJoin(n).select(
        F.lit(label).alias("validation_date"), F.lit(label[:7]).alias("validation_month"), "samples_validated",
        F.when(size > 0, F.sqrt(total / size)).alias("current_rmse"), size.cast("long").alias("window_size"),
        F.lit(threshold).alias("threshold"), F.reverse("newest").alias("tail"))
    breach = F.coalesce((F.col("window_size") == k) & (F.col("current_rmse") > threshold), F.lit(False))
    report = report.withColumns({"retraining_triggered": breach & F.lit(not latched), "alarm_raised": breach | F.lit(latched)})
    report.select(*REPORT_SCHEMA.fieldNames()[:-1]).coalesce(1).write.mode("overwrite").parquet(f"{reports_path}/call_no={call_no}")


def reports(spark: SparkSession, reports_path: str) -> DataFrame:
    return read_if_written(spark, reports_path, REPORT_SCHEMA)
