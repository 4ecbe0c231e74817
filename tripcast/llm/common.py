"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.session import scratch_path

HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Only the named columns of a table, so others can't clash."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def held_out(key: Column) -> Column:
    """True for the fold that no model may learn from (crc32 of the key's
    text, modulo 5, is 0); a null key counts as the empty text, held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_FOLDS == 0


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared folder and read back: later steps
    start from files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spans(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Cuts a batch where its texts would pass ``most`` characters together; a
    longer text goes alone."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield begin, i
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def crc32_sql() -> str:
    """For a DuckDB query: the one-row table ``crc_table`` of the 256 steps; what
    names it in its FROM may call ``crc32_of(x)``, see ``with_crc32``."""
    return """crc_table AS (SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i)))"""


def with_crc32(sql: str) -> str:
    """``sql`` with each ``crc32_of(x)`` written out as a fold over the bytes."""
    return re.sub(r"crc32_of\(([^()]*)\)", r"""xor(4294967295, list_reduce([4294967295] || list_transform(
        range(length(hex(encode(\1))) // 2), lambda p: CAST('0x' || substr(hex(encode(\1)), 2 * p + 1, 2) AS BIGINT)),
        lambda c, y: xor(c >> 8, steps[(xor(c, y) & 255) + 1])))""", sql)
