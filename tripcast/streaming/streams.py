"""Structured Streaming forms of the pipeline.

Every stream reads parquet files as they arrive (``maxFilesPerTrigger`` keeps
the reference's file-at-a-time pacing), runs the same row-local DataFrame
operators as the batch path, and writes to a parquet sink with its
checkpoint in the session's shared checkpoint folder.  ``run_available_now``
drains what is there (``trigger(availableNow=True)``) and returns the sink
as a batch DataFrame.

T4 (drift) keeps the last k-1 squared errors and the alert latch of each model
in Spark's keyed state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tripcast import schema as S
from tripcast.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of ``path`` as a stream, ``files_per_trigger`` at a
    time, with a declared schema (no inference on a stream)."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def run_available_now(df: DataFrame, name: str, mode: str = "append", sink: str | None = None,
                      checkpoint: str | None = None) -> DataFrame:
    """Write a stream to a parquet sink until the input is drained, then read
    the sink back as a batch DataFrame.  With the ``sink`` and ``checkpoint``
    folders of an earlier call it goes on where that one stopped."""
    spark = df.sparkSession
    sink = sink or scratch_path(spark, f"{name}-out")
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", sink)
           .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-ckpt"))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    # read with the stream's own schema: an input that produced no rows gives
    # an empty frame rather than a schema-inference error
    return spark.read.schema(df.schema).parquet(sink)


def run_foreach_batch(df: DataFrame, name: str, fn, mode: str = "append", checkpoint: str | None = None) -> None:
    spark = df.sparkSession
    q = (df.writeStream.outputMode(mode).foreachBatch(fn)
           .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-ckpt"))
           .trigger(availableNow=True).start())
    q.awaitTermination()


def split_by_flag(df: DataFrame, flag: str, name: str, accepted: str | None = None, rejected: str | None = None,
                  checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the rows of a stream to two sinks, by ``flag`` (a NULL flag counts
    as false); nothing is dropped.  Each micro-batch is rewritten by its id, so a retried one counts
    once.  Returns both sinks as batch DataFrames."""
    spark = df.sparkSession
    accepted, rejected = accepted or scratch_path(spark, f"{name}-out"), rejected or scratch_path(spark, f"{name}-rejects")

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        yes = F.col(flag).eqNullSafe(F.lit(True))
        for path, rows in ((accepted, held.filter(yes)), (rejected, held.filter(~yes))):
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        held.unpersist()

    run_foreach_batch(df, name, write, checkpoint=checkpoint)
    return tuple(read_if_written(spark, path, df.schema) for path in (accepted, rejected))


def read_if_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, empty if nothing was written there; any other
    storage error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def daily_stats_stream(featured: DataFrame, name: str = "daily", out: str | None = None,
                       checkpoint: str | None = None) -> DataFrame:
    """T5: per-day sum and count kept in the streaming state store (one entry
    per day) and merged as files arrive; each micro-batch writes the complete
    (small, one row per day) result under its id, so the result before it
    stands until the new one is whole.  Returns the last."""
    spark = featured.sparkSession
    out = out or scratch_path(spark, f"{name}-table")
    agg = (featured.groupBy("date_int")
                   .agg(F.sum(S.TARGET).alias("sum_duration"), F.count(S.TARGET).alias("n_trips"),
                        F.min("sin_time").alias("sin_time"), F.min("cos_time").alias("cos_time")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("avg_duration", F.col("sum_duration") / F.col("n_trips")) \
             .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run_foreach_batch(agg, name, write, "complete", checkpoint)
    schema = agg.schema.add("avg_duration", T.DoubleType())
    versions = read_if_written(spark, out, T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    newest = versions.agg(F.max("batch_id")).first()[0]
    return versions.filter(F.col("batch_id") == F.lit(newest)).drop("batch_id")


# ---------------------------------------------------------------- T4 drift
DRIFT_STATE = "tail array<double>, epoch long, alerted boolean"


def drift_stream(errors: DataFrame, key: str, reload_col: str, threshold: float, k: int = S.DRIFT_WINDOW,
                 model_col: str | None = None, name: str = "drift", alerts_path: str | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """T4: latched drift alerts over a stream of (model, key, sq_err, reload
    flag), one row per alert: model, epoch, key, rmse.

    Spark's keyed state holds what goes from one micro-batch to the next, per
    model: the last k-1 errors, the number of reloads so far, and the latch.
    Models run in parallel; a model's rows of one micro-batch (the files of
    one trigger) meet in one task, in ``key`` order.  Rows without an error do
    not enter the window, but their reload counts.  State and sink are Spark's
    own, so a retried micro-batch counts once, and with the two folders of an
    earlier call the stream goes on where that one stopped."""
    model = F.lit("") if model_col is None else F.col(model_col).cast("string")
    rows = errors.select(F.coalesce(model, F.lit("")).alias("model"), F.col(key).cast("long").alias("at"),
                         F.col("sq_err").cast("double"), F.coalesce(F.col(reload_col).cast("boolean"), F.lit(False)).alias("reload"))

    def fold(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(frames)).sort_values("at", kind="stable")
        before = state.get if state.exists else ([], 0, False)
        alerts, after = drift_step(batch["at"].to_numpy(), batch["sq_err"].to_numpy(np.float64),
                                   batch["reload"].to_numpy(bool), before, threshold, k)
        state.update(after)
        if alerts:
            yield pd.DataFrame([(group[0], *a) for a in alerts], columns=["model", "epoch", key, "rmse"])

    alerts = rows.groupBy("model").applyInPandasWithState(
        fold, f"model string, epoch long, {key} long, rmse double", DRIFT_STATE, "append", GroupStateTimeout.NoTimeout)
    return run_available_now(alerts, name, "append", alerts_path, checkpoint)


def drift_step(at: np.ndarray, error: np.ndarray, reload: np.ndarray, before: tuple, threshold: float, k: int,
               ) -> tuple[list[tuple], tuple]:
    """Alerts (epoch, key, rmse) of a micro-batch in order, and the state
    after it; a state is (last k-1 errors, reloads so far, alarm raised)."""
    tail, epoch0, alerted0 = list(before[0]), int(before[1]), bool(before[2])
    epoch = epoch0 + np.cumsum(reload)
    valid = np.flatnonzero(~np.isnan(error))
    seen = np.concatenate([np.array(tail, np.float64), error[valid]])
    alerts: dict[int, tuple] = {}
    if len(seen) >= k:
        rmse = np.sqrt(np.lib.stride_tricks.sliding_window_view(seen, k).mean(axis=1))
        full = valid[k - 1 - len(tail):]        # rows whose window is full
        for row, value in zip(full[rmse > threshold].tolist(), rmse[rmse > threshold].tolist(), strict=True):
            here = int(epoch[row])
            if here not in alerts and not (here == epoch0 and alerted0):
                alerts[here] = (here, int(at[row]), value)
    last = int(epoch[-1]) if len(epoch) else epoch0
    return list(alerts.values()), (seen[len(seen) - min(len(seen), k - 1):].tolist(), last,
                                   last in alerts or (alerted0 and last == epoch0))
