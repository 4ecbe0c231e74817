"""Count-based windows over one global order (W1-W4), without a single-task
window.

A window "the last k rows in arrival order" has no partition key, and Spark
would run it in one task.  Here the order key is cut into chunks
(``floor(key / chunk_rows)``, at most ``chunk_rows`` rows each for a unique
integer key) and every chunk gets copies of the k-1 rows that precede it
globally, so a window partitioned by chunk gives exactly the global result:

* tails     = last k-1 rows of each chunk (window per chunk, parallel);
* T_c       = number of tail rows in chunks before c;
* the k-1 predecessors of chunk c are the tail rows with global tail index
  T_c, T_c-1, ..., T_c-k+2 -- an *equi*-join after exploding k-1 indexes per
  chunk, so no range or nested-loop join;
* window per chunk over (copies + own rows), copies dropped afterwards.

Sums over all earlier chunks (``sum_before``) go up and down a tree: chunk
numbers are grouped by their upper bits, sums of groups are summed the same
way, and only a level whose numbers have at most ``FAN_BITS`` bits left is
ordered as one.  So no window over anything that grows with the rows lacks a
partition key, also where keys are sparse and every row is a chunk of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.session import ensure_checkpoint_dir

CHUNK_ROWS_DEFAULT = 1 << 20
FAN_BITS = 20                # 2^20 sums at most are ordered in one task
KEY_BITS = 63


def _chunk(key: str, chunk_rows: int) -> Column:
    return F.floor(F.col(key) / F.lit(chunk_rows)).cast("long")


def sum_before(parts: DataFrame, number: str, value: str, out: str, bits: int = KEY_BITS) -> DataFrame:
    """``parts`` (one row per ``number``, a whole number of at most ``bits``
    bits and a sign) with the sum of ``value`` over all smaller numbers."""
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    if bits <= FAN_BITS:        # at most 2^FAN_BITS rows either side of 0
        return parts.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))
    up, total, base = (f"_{name}{bits}" for name in ("up", "sum", "base"))      # a level's own names
    group = parts.withColumn(up, F.shiftright(F.col(number), FAN_BITS))
    totals = sum_before(group.groupBy(up).agg(F.sum(value).alias(total)), up, total, base, bits - FAN_BITS)
    inner = F.coalesce(F.sum(value).over(Window.partitionBy(up).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return group.withColumn(out, inner).join(totals.select(up, base), up).withColumn(out, F.col(out) + F.col(base)).drop(up, base)


def with_predecessors(df: DataFrame, key: str, part_col: str, k: int) -> DataFrame:
    """Rows of ``df`` plus, in every ``part_col`` group, copies (``_copy`` =
    true) of the ``k`` rows that precede the group in the global ``key``
    order.  ``part_col`` must be monotone in ``key``, and its groups are
    bounded (key chunks, or groups already cut to their last rows)."""
    if k <= 0:
        return df.withColumn("_copy", F.lit(False))
    ensure_checkpoint_dir(df.sparkSession)
    w_tail = Window.partitionBy(part_col).orderBy(F.col(key).desc())
    # at most k rows a group, written once for both uses
    tails = (df.withColumn("_rk", F.row_number().over(w_tail)).filter(F.col("_rk") <= k)).checkpoint(eager=True)
    per_part = tails.groupBy(part_col).agg(F.count(F.lit(1)).alias("_nt"), F.min(key).cast("long").alias("_first"))
    starts = sum_before(per_part, "_first", "_nt", "_T").select(part_col, "_nt", "_T")
    # tail rows numbered through all groups
    numbered = tails.join(starts, part_col).withColumn("_ti", F.col("_T") + F.col("_nt") - F.col("_rk") + 1).drop("_T", "_nt", "_rk")
    wanted = (starts.select(F.col(part_col).alias("_for"), "_T", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_j"))
                    .select("_for", (F.col("_T") - F.col("_j")).alias("_ti")).filter(F.col("_ti") >= 1))
    copies = (numbered.join(wanted, "_ti").drop("_ti", part_col)
                      .withColumnRenamed("_for", part_col).withColumn("_copy", F.lit(True)))
    return df.withColumn("_copy", F.lit(False)).unionByName(copies)


def sliding_window_stats(df: DataFrame, key: str, value: str, k: int = S.DRIFT_WINDOW,
                         chunk_rows: int = CHUNK_ROWS_DEFAULT) -> DataFrame:
    """For every row, the mean and count of ``value`` over the last ``k``
    rows in ``key`` order (itself included).  ``key`` must be a unique
    integer.  Adds ``win_mean`` and ``win_n``."""
    with_chunk = df.withColumn("_chunk", _chunk(key, chunk_rows))
    ext = with_predecessors(with_chunk, key, "_chunk", k - 1)
    w = Window.partitionBy("_chunk").orderBy(key).rowsBetween(-(k - 1), 0)
    out = ext.withColumn("win_mean", F.avg(value).over(w)).withColumn("win_n", F.count(value).over(w))
    return out.filter(~F.col("_copy")).drop("_copy", "_chunk")


def running_count(df: DataFrame, key: str, flag: Column, out_col: str,
                  chunk_rows: int = CHUNK_ROWS_DEFAULT, ties: tuple[Column, ...] = ()) -> DataFrame:
    """Inclusive running count of ``flag`` in the order of ``key`` and
    ``ties``: per-chunk running sum + the sum of all chunks before."""
    d = df.withColumn("_chunk", _chunk(key, chunk_rows)).withColumn("_f", flag.cast("long"))
    totals = d.groupBy("_chunk").agg(F.sum("_f").alias("_tot"))
    offs = sum_before(totals, "_chunk", "_tot", "_off", KEY_BITS - (chunk_rows.bit_length() - 1)).select("_chunk", "_off")
    w = Window.partitionBy("_chunk").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_run", F.sum("_f").over(w)).join(offs, "_chunk")
    return d.withColumn(out_col, (F.col("_off") + F.col("_run")).cast("long")).drop("_chunk", "_f", "_run", "_off")


def sliding_rmse(errors: DataFrame, key: str, sq_err: str = "sq_err", k: int = S.DRIFT_WINDOW,
                 chunk_rows: int = CHUNK_ROWS_DEFAULT, key_is_unique: bool = True) -> DataFrame:
    """RMSE over the last ``k`` squared errors at every row; ``window_full``
    marks rows that have ``k`` errors behind them.  Rows without an error
    (NULL or NaN) do not enter the window.  With ``key_is_unique=False`` (an arrival
    order with ties or repeated keys) the rows are first given a dense
    sequence in key order, which bounds every chunk by ``chunk_rows``."""
    valid = errors.filter(F.col(sq_err).isNotNull() & ~F.isnan(sq_err))
    if not key_is_unique:
        from tripcast.operators.sequence import dense_sequence

        seq = dense_sequence(valid, [key], "_wseq")
        s = sliding_window_stats(seq, "_wseq", sq_err, k, chunk_rows).drop("_wseq")
        return (s.withColumn("rmse", F.sqrt("win_mean"))
                 .withColumn("window_full", F.col("win_n") == k)
                 .drop("win_mean").withColumnRenamed("win_n", "window_size"))
    s = sliding_window_stats(valid, key, sq_err, k, chunk_rows)
    return (s.withColumn("rmse", F.sqrt("win_mean"))
             .withColumn("window_full", F.col("win_n") == k)
             .drop("win_mean").withColumnRenamed("win_n", "window_size"))


def drift_alerts(errors: DataFrame, key: str, is_reload: Column, threshold: float,
                 sq_err: str = "sq_err", k: int = S.DRIFT_WINDOW,
                 chunk_rows: int = CHUNK_ROWS_DEFAULT, key_is_unique: bool = True) -> DataFrame:
    """One alert per reload epoch, at the first row whose full window
    RMSE exceeds ``threshold``.  The epoch is the running count of reloads
    (a reload clears the latch before its own row is checked); the window is
    not cleared by a reload.  Output: epoch, key, rmse.  A non-unique key is
    replaced by a dense sequence in key order first (bounded chunks).

    The window is the only pass over all errors; epochs are counted over the
    reloads and the breaches alone."""
    order = key
    errors = errors.withColumn("_reload", F.coalesce(is_reload, F.lit(False)))
    if not key_is_unique:
        from tripcast.operators.sequence import dense_sequence

        errors, order = dense_sequence(errors, [key], "_wseq"), "_wseq"
    scored = sliding_rmse(errors, order, sq_err, k, chunk_rows)
    no = F.lit(None).cast("double")
    breaches = scored.filter(F.col("window_full") & (F.col("rmse") > threshold)).select(
        F.col(order).alias("_o"), F.col(key).alias("_key"), "rmse", F.lit(False).alias("_reload"))
    reloads = errors.filter("_reload").select(F.col(order).alias("_o"), F.col(key).alias("_key"), no.alias("rmse"), "_reload")
    # of a row that is both, the reload comes first
    with_epoch = running_count(reloads.unionByName(breaches), "_o", F.col("_reload"), "epoch", chunk_rows, (F.col("_reload").desc(),))
    first = with_epoch.filter("rmse is not null").groupBy("epoch").agg(F.min(F.struct("_o", "_key", "rmse")).alias("b"))
    return first.select("epoch", F.col("b._key").alias(key), F.col("b.rmse").alias("rmse"))


def last_k_per_group(df: DataFrame, key: str, group_col: str, k: int,
                     chunk_rows: int = CHUNK_ROWS_DEFAULT) -> DataFrame:
    """The ``k`` rows with the largest ``key`` of every group, without a
    window over a whole group (one group may hold a third of all rows): first
    the top k of every (group, key chunk) -- windows of at most ``chunk_rows``
    rows for a unique integer key -- then the top k of those per group, a
    window over at most k rows per chunk."""
    w1 = Window.partitionBy(group_col, "_c").orderBy(F.col(key).desc())
    pre = (df.withColumn("_c", _chunk(key, chunk_rows))
             .withColumn("_rk", F.row_number().over(w1)).filter(F.col("_rk") <= k).drop("_rk", "_c"))
    w2 = Window.partitionBy(group_col).orderBy(F.col(key).desc())
    return pre.withColumn("_rk", F.row_number().over(w2)).filter(F.col("_rk") <= k).drop("_rk")


def call_window_rmse(errors: DataFrame, key: str, call_col: str, sq_err: str = "sq_err",
                     k: int = S.DRIFT_WINDOW, chunk_rows: int = CHUNK_ROWS_DEFAULT) -> DataFrame:
    """State after each validate call (``call_col`` groups, monotone in
    ``key``): RMSE over the last ``k`` errors of all calls so far.  Needs only
    the last k rows per call plus the carry-over from earlier calls."""
    valid = errors.filter(F.col(sq_err).isNotNull() & ~F.isnan(sq_err))
    tails = last_k_per_group(valid, key, call_col, k, chunk_rows)
    ext = with_predecessors(tails, key, call_col, k)
    w_last = Window.partitionBy(call_col).orderBy(F.col(key).desc())
    last_k = ext.withColumn("_rk", F.row_number().over(w_last)).filter(F.col("_rk") <= k)
    samples = errors.groupBy(call_col).agg(F.count(F.lit(1)).alias("samples"))
    state = last_k.groupBy(call_col).agg(F.sqrt(F.avg(sq_err)).alias("current_rmse"),
                                         F.count(sq_err).alias("window_size"))
    return samples.join(state, call_col, "left")


def rolling_mean(df: DataFrame, order_col: str, value: str, days: int = 7, out_col: str = "rolling_7d") -> DataFrame:
    """Mean of the last ``days`` rows, NULL until ``days`` rows exist.
    For a per-day table (one row per day, so its size is the number of
    days) a single ordered window is bounded."""
    w = Window.orderBy(order_col).rowsBetween(-(days - 1), 0)
    return df.withColumn(out_col, F.when(F.count(value).over(w) == days, F.avg(value).over(w)))
