"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass 1 scatters every record into one of ``ceil(bytes / bucket_bytes)``
buckets by a seeded hash of its position in the input, so buckets hold about
``bucket_bytes`` whatever the records contain: equal records, a hot source or
repeated ids spread like any others.  Pass 2 takes one bucket at a time into
memory, brings it into hash order (so a retried task sees the same list) and
applies Spark's seeded ``shuffle``, a Fisher-Yates permutation, then writes
the bucket.  The buckets laid end to end are the shuffled corpus; shard ``s``
is its ``s``-th run of consecutive positions, and run lengths differ by one at
most (law ``rows``).

Cases: a null text has no bytes, size 1 and checksum 0, and stays null in the
output; an empty table gives no rows; fewer records than shards leave the last
shards empty; repeated rows are kept, each with a slot of its own; extra
columns ride along, but the names in ``ADDED`` and columns of map type (they
have no order) are refused.  Input positions come from the scan, so the input
must be a table read, not the result of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import table, written

SHARDS = 8
SEED = 20240229
BUCKET_BYTES = 32 << 20      # text of one bucket, held in one task's memory
MOST_BROADCAST = 1_000_000   # buckets whose keys are broadcast, 12 bytes each
GROUP = 1024                 # buckets per step of the two-level running sum
ADDED = ("size", "bucket", "shard", "slot", "key__")


def bucket_offsets(buckets: DataFrame) -> DataFrame:
    """(bucket, n) -> (bucket, before): rows in earlier buckets, summed over
    groups of buckets first so no window holds more than one group or one
    total per group."""
    inner = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    grouped = buckets.withColumn("g", F.floor(F.col("bucket") / GROUP))
    totals = grouped.groupBy("g").agg(F.sum("n").alias("n")).select(
        "g", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("base"))
    return grouped.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(totals, "g").select(
        "bucket", (F.col("base") + F.col("inside")).alias("before"))


def bucket_keys(spark: SparkSession, n: int) -> DataFrame:
    """(bucket, key__): for each bucket a number that Spark's hash puts into
    the partition of its own, of ``n``.  Of 40 n numbers none hits a given
    partition with a chance of e^-40; the first that does is taken."""
    key = F.col("id").cast("int")
    tried = spark.range(40 * n).select(key.alias("key__"), F.pmod(F.hash(key), F.lit(n)).cast("long").alias("bucket"))
    found = written(tried.groupBy("bucket").agg(F.min("key__").alias("key__")), "bucket-keys")
    if found.count() != n:
        raise RuntimeError("a bucket has no key")
    return found


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED,
                        bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """All columns of ``df`` plus ``size``, ``bucket``, ``shard`` and ``slot``,
    read from the written buckets."""
    if clash := set(ADDED) & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    total = df.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    n_buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))

    place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    scattered = df.select(F.struct(place.alias("place"), *df.columns, size.alias("size")).alias("record")).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("record.place", 3), F.lit(n_buckets)))
    keys = bucket_keys(df.sparkSession, n_buckets)
    placed = scattered.join(F.broadcast(keys) if n_buckets <= MOST_BROADCAST else keys, "bucket").repartition(n_buckets, "key__")
    # the scatter has put one bucket into each task: this groups without another exchange
    shuffled = placed.groupBy("key__").agg(
        F.min("bucket").alias("bucket"),
        F.shuffle(F.sort_array(F.collect_list("record")), F.lit(seed)).alias("records"))
    rows = written(shuffled.select("bucket", F.posexplode("records").alias("pos", "r")).select(
        "bucket", "pos", *[F.col(f"r.`{c}`").alias(c) for c in df.columns], "r.size"), "shuffled-buckets")

    # written as well, so its size is known when the join is planned
    offsets = written(bucket_offsets(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))), "bucket-offsets")
    n = total["rows"]
    short, longer = n // shards, n % shards
    p = F.col("before") + F.col("pos")
    edge = longer * (short + 1)
    shard = F.when(p < edge, F.floor(p / (short + 1))).otherwise(longer + F.floor((p - edge) / max(short, 1)))
    start = F.when(p < edge, F.col("shard") * (short + 1)).otherwise(edge + (F.col("shard") - longer) * short)
    return rows.join(offsets, "bucket").withColumn("shard", shard.cast("int")).withColumn(
        "slot", (p - start).cast("long")).drop("pos", "before")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within and across its files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("bucket") \
        .write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shuffle_into_shards(table(spark, sf_dir, "documents", "doc_id", "text"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return sharded.select("doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "bucket")
