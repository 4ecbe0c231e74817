"""Joins of the trip table to small dimension tables (J1 and the per-day /
per-hour lookups), broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.functions.calendar import holiday_calendar
from tripcast.session import scratch_path

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join ``small`` to ``big``, broadcasting ``small`` only when it has at
    most ``max_rows`` rows and ``max_bytes`` on disk; above that, a plain join
    (sort-merge / shuffled hash, with AQE skew handling) is left to the
    planner.

    ``small`` is usually an aggregate of the big table, so it is first
    written to the shared folder: it is computed once, the size check reads
    what was written, and the join reads it again instead of recomputing the
    aggregate."""
    path = scratch_path(small.sparkSession, "small")
    small.write.parquet(path)
    small = small.sparkSession.read.schema(small.schema).parquet(path)
    n_bytes = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if n_bytes <= max_bytes and small.count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def holiday_join(trips: DataFrame, ts_col: str) -> DataFrame:
    """The holiday flag from a calendar dimension (one row per day of the
    span of ``trips``), joined by day."""
    with_day = trips.withColumn("_day", F.to_date(ts_col))
    cal = holiday_calendar(with_day.select(F.col("_day").alias("day"))).withColumnRenamed("day", "_day")
    return join_small(with_day, cal, "_day").drop("_day")
