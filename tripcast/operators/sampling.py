"""Sampling operators.

The reference samples each loader batch with a seeded pseudo-random draw.
Here the draw is a deterministic hash of the row (a multiplicative
congruential mix, stated in ``row_unit``) so that any engine computes the same
sample, a recomputed task draws the same rows, and no state is carried between
rows or partitions.  Per-batch rules (">1000 rows", "exactly round(f*n)") need
only a per-batch count (a window partitioned by batch, whose size is bounded
by the batch size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators.clean import epoch_ntz

# --- fixed values: the congruential mix --------------------------------------
_MOD = 2147483648          # 2^31
_MUL = 1103515245
_INC = 12345


def _step(x: Column) -> Column:
    return _pmod(x * F.lit(_MUL) + F.lit(_INC))


def _pmod(x: Column) -> Column:
    """x modulo 2^31, 0 or more: the low 31 bits."""
    return x.bitwiseAND(F.lit(_MOD - 1).cast("long"))


def mix(parts: list[Column], seed: int = 0) -> Column:
    """Mix long-valued parts into a value in [0, 2^31)."""
    h = _step(_pmod(F.lit(seed).cast("long")))
    for p in parts:
        h = _step(_pmod(h + p.cast("long")))
    return h


def trip_key_parts(df: DataFrame) -> list[Column]:
    """Row identity of a trip for hashing: pickup second, zones, vendor and
    distance in 1/100 mile."""
    parts = [F.coalesce(F.timestamp_diff("SECOND", epoch_ntz(), F.col(S.PICKUP)), F.lit(0))]
    for c in (S.PU_ZONE, S.DO_ZONE, S.VENDOR):
        parts.append(F.coalesce(F.col(c).cast("long"), F.lit(0)))
    parts.append(F.coalesce(F.floor(F.col(S.DISTANCE) * 100).cast("long"), F.lit(0)))
    return parts


def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def fraction_keep(df: DataFrame, fraction: float, seed: int) -> Column:
    """The L1 draw as a condition: the row's mix is below fraction x 2^31."""
    return mix(trip_key_parts(df), seed) < F.lit(fraction * _MOD)


def with_exact_rank(df: DataFrame, seed: int, batch_col, tie_cols: list[str]) -> DataFrame:
    """Adds ``_n`` (rows in the batch) and ``_rk`` (rank of the row's draw in
    its batch): one window per batch, bounded by the batch size."""
    w = Window.partitionBy(*_cols(batch_col))
    return (df.withColumn("_n", F.count(F.lit(1)).over(w))
              .withColumn("_rk", F.row_number().over(w.orderBy(mix(trip_key_parts(df), seed), *tie_cols))))


def exact_keep(fraction: float) -> Column:
    """The L2 rule over ``with_exact_rank`` columns."""
    return F.col("_rk") <= F.bround(F.col("_n") * F.lit(fraction), 0)


def sample_fraction(df: DataFrame, fraction: float, seed: int, batch_col=None,
                    min_batch_rows: int | None = None) -> DataFrame:
    """L1 + L3: keep a ``fraction`` of the rows; if the caller asks for it
    with ``min_batch_rows``, batches of at most that many rows stay whole."""
    keep = fraction_keep(df, fraction, seed)
    if batch_col is None or min_batch_rows is None:
        return df.filter(keep)
    # batches small enough to keep whole: a partial+final count per batch and
    # a size-checked broadcast semi-join -- the trip rows are not shuffled
    from tripcast.operators.joins import join_small

    bcols = _cols(batch_col)
    small = df.groupBy(*bcols).count().filter(F.col("count") <= min_batch_rows).select(*bcols)
    whole = join_small(df, small.withColumn("_whole", F.lit(True)), bcols, "left")
    return whole.filter(F.col("_whole").isNotNull() | keep).drop("_whole")


def sample_exact(df: DataFrame, fraction: float, seed: int, batch_col,
                 tie_cols: list[str]) -> DataFrame:
    """L2: exactly round-half-even(fraction * n) rows of each batch: the rows
    with the lowest draws (ties broken by ``tie_cols``).  Each window holds
    one batch, so its size is bounded by the batch size."""
    return with_exact_rank(df, seed, batch_col, tie_cols).filter(exact_keep(fraction)).drop("_n", "_rk")


def hard_case_sample(df: DataFrame, actual: str, baseline: str, seed: int,
                     threshold: float = 0.20, random_fraction: float = 0.05) -> DataFrame:
    """L4: rows whose relative error against the baseline exceeds
    ``threshold``, plus a ``random_fraction`` draw of all rows."""
    err = F.abs(F.col(actual) - F.col(baseline)) / F.col(baseline)
    return df.filter((err > threshold) | fraction_keep(df, random_fraction, seed))


def cap_batches(df: DataFrame, batch_cols: list[str], max_batches: int) -> DataFrame:
    """Keep only the first ``max_batches`` non-empty batches.

    The first batches are a top-k over the distinct batch ids (TakeOrdered,
    at most ``max_batches`` rows per task), so what is broadcast back is
    bounded by ``max_batches`` whatever the data size."""
    kept = df.select(*batch_cols).distinct().orderBy(*batch_cols).limit(max_batches)
    return df.join(F.broadcast(kept), batch_cols, "left_semi")


def first_n(df: DataFrame, n: int, order_cols: list) -> DataFrame:
    """The first ``n`` rows in an explicit order (TakeOrdered: each task
    keeps its own top n, the driver merges n x tasks rows)."""
    return df.orderBy(*order_cols).limit(n)
