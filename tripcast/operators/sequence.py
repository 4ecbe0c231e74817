"""Dense row numbers in a total order, computed without a single-task window.

``dense_sequence`` gives every row its 0-based position in the order of
``order_cols``:

1. range-partition + sort on the full key tuple (Spark samples the tuple, so a
   hot leading value is split by the following columns);
2. ``monotonically_increasing_id`` = (partition << 33) + position in partition;
3. one row per partition with its row count (bounded by the partition count;
   joined back by a size-checked broadcast), prefix-summed into offsets;
4. position = offset(partition) + local position.

The sorted frame is checkpointed to the session's shared checkpoint folder
first, so both uses of it see the same partitioning and a lost executor
cannot renumber rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcast.operators.joins import join_small
from tripcast.session import ensure_checkpoint_dir

_LOCAL_BITS = 33


def dense_sequence(df: DataFrame, order_cols: list[str], seq_col: str = "seq",
                   num_partitions: int | None = None) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    # as many range partitions as the input has splits (so partition size
    # follows spark.sql.files.maxPartitionBytes at any scale), at least one
    # per core
    parts = num_partitions or max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)
    # last sort key: the row's position in the input, so that copies of one
    # row (which may be a third of the table) still spread over many range
    # partitions; copies are interchangeable, so the result does not depend
    # on which copy gets which number
    keys = list(order_cols) + ["_tb"]
    ordered = (df.withColumn("_tb", F.monotonically_increasing_id())
                 .repartitionByRange(parts, *keys)
                 .sortWithinPartitions(*keys)
                 .drop("_tb")
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    out = join_small(ordered.withColumn("_pid", pid), offsets, "_pid", "inner")
    return out.withColumn(seq_col, (F.col("_off") + local).cast("long")).drop("_mid", "_pid", "_off")


def batch_numbers(df: DataFrame, file_col: str, order_cols: list[str], batch_size: int,
                  batch_col: str = "batch_no") -> DataFrame:
    """Batches of ``batch_size`` consecutive rows of one "file" (``file_col``),
    in the order of ``order_cols``, as the reference loader cuts them.

    ``row_in_file`` = global position - first position of the file; the
    per-file first positions are one row per file (size-checked broadcast)."""
    seq = dense_sequence(df, [file_col] + order_cols, "_gseq")
    starts = seq.groupBy(file_col).agg(F.min("_gseq").alias("_start"))
    out = join_small(seq, starts, file_col, "inner")
    return (out.withColumn("row_in_file", F.col("_gseq") - F.col("_start"))
               .withColumn(batch_col, F.floor(F.col("row_in_file") / F.lit(batch_size)).cast("long"))
               .drop("_gseq", "_start"))
