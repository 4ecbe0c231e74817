"""Resampling of documents towards a target distribution by importance.

A document's features are its runs of 1 to ``n`` consecutive words, hashed by
CRC-32 into buckets.  The log ratio of a bucket's share of the target to its
share of the documents is its gain; a document's weight is the mean gain of its
features, and drawing without replacement by weight is taking the highest
weights after Gumbel noise, which a seeded hash of the document's id gives.

CRCs of a chunk are made together: distinct feature bytes of one length form a
two-dimensional uint8 array, all CRCs of which are updated column by column,
and the buckets are scattered back to where the features stand.

Bucket counts leave a task as at most ``buckets`` rows.  The driver holds
``buckets`` counts, and one row per distinct score: scores are whole
thousandths of natural logarithms, so there are at most some 115,000 of them
at any size (gains lie within 44,000 of 0, noise between -3,101 and 22,180).
A drawn document's rank is its score's offset plus its place among equal
scores, so no task ever sorts the whole table.

Cases: null and wordless texts have no features and weight 0; a null id counts
as the empty text in the noise and comes last among ties; repeated rows are
documents of their own (equal ids with equal scores take following ranks);
without documents of ``least_words`` words nothing is drawn; an empty target
gives gains of the documents' shares alone; an empty table gives no rows; texts
are taken whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import crc32_sql, spans, table, with_crc32, written
from tripcast.llm.decontaminate import LOWER, UPPER

BUCKETS, N, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
CHUNK_CHARS = 1 << 20        # characters handled at once; a longer text goes alone
GRID_BYTES = 1 << 22         # bytes of one two-dimensional array
FEW = 4                      # features of one length that need no array
ADDED = ("n_words", "n_features", "weight", "score", "rank")

#: the bytes of the contract's words: digits, a-z (A-Z after folding) and all beyond ASCII
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def column_crcs(grid: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of bytes."""
    c = np.full(len(grid), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(grid.T):
        c = CRC[(c ^ column) & 0xFF] ^ (c >> 8)
    return ~c


def distinct_rows(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each kind, kind of each row)."""
    wide = np.zeros((len(grid), -(-grid.shape[1] // 8) * 8), np.uint8)
    wide[:, :grid.shape[1]] = grid
    kind = np.zeros(len(grid), np.int64)
    for eight in wide.view(np.uint64).T:
        code, seen = pd.factorize(np.ascontiguousarray(eight))
        kind = pd.factorize(kind * len(seen) + code)[0]
    first = np.empty(kind.max() + 1, np.int64)
    first[kind[::-1]] = np.arange(len(kind) - 1, -1, -1)
    return first, kind


def crcs(b: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch of ``b``."""
    size, out = end - begin, np.zeros(len(begin), np.uint32)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(size[order]) > 0, True]) if len(order) else []
    for x, y in zip(cuts, cuts[1:], strict=False):
        length = int(size[order[x]])
        step = max(1, GRID_BYTES // length)
        for z in range(x, y, step):
            rows = order[z:min(y, z + step)]
            if len(rows) < FEW:
                out[rows] = [zlib.crc32(b[begin[r]:end[r]]) for r in rows]
                continue
            grid = b[begin[rows][:, None] + np.arange(length)]
            first, kind = distinct_rows(grid)
            out[rows] = column_crcs(grid[first])[kind]
    return out


def hashed(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, CRC of each feature)."""
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    b = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    word = IS_WORD[b]
    # words with one blank after each
    keep = word | np.r_[False, word[:-1]]
    place = np.cumsum(keep)
    edge = np.diff(np.r_[False, word].astype(np.int8))
    begin = np.flatnonzero(edge == 1)
    doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), begin, side="right")
    start = place[begin] - 1
    stop = place[np.flatnonzero(edge == -1)] - 1
    packed = np.where(word, b, np.uint8(0x20))[keep]
    docs, values = [], []
    for k in range(1, n + 1):
        m = max(0, len(doc) - k + 1)
        inside = np.flatnonzero(doc[:m] == doc[k - 1:k - 1 + m])
        docs.append(doc[inside])
        values.append(crcs(packed, start[inside], stop[inside + k - 1]))
    return np.bincount(doc, minlength=len(raws)), np.concatenate(docs), np.concatenate(values)


def bucket_counts(rows: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in spans([t or "" for t in texts], CHUNK_CHARS):
                total += np.bincount(hashed(texts[a:b], n)[2] % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = rows.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    all_s, all_t, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + k) / ((s + 1) * (all_t + k))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text", n: int = N) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(series: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else "" for t in series.tolist()]
        rows = np.zeros((len(texts), 3), np.int64)
        for a, b in spans(texts, CHUNK_CHARS):
            words, doc, crc = hashed(texts[a:b], n)
            count = np.bincount(doc, minlength=b - a)
            # exact: sums of whole numbers far below 2^53
            total = np.bincount(doc, gain[crc % np.uint32(len(gain))], b - a).astype(np.int64)
            rows[a:b] = np.stack([words, count, total // np.maximum(count, 1)], axis=1)
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return docs.withColumn("weighed__", weigh(F.col(text))).withColumns(
        {c: F.col(f"weighed__.{c}") for c in ADDED[:3]}).drop("weighed__")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, n: int = N, buckets: int = BUCKETS, seed: int = SEED,
             keep_text: bool = True) -> DataFrame:
    """``docs`` (without their text unless ``keep_text``) with ``n_words``,
    ``n_features``, ``weight``, ``score`` and ``rank``: the drawn ``percent``
    of the documents of at least ``least_words`` words are those with a rank."""
    if clash := set(ADDED) & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    gain = gains(bucket_counts(docs, text, n, buckets), bucket_counts(target, target_text, n, buckets))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"),
                                256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = weighted(docs, gain, text, n).withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))))
    scored = written(scored if keep_text else scored.drop(text), "weighted")

    long_enough = F.col("n_words") >= least_words
    shares = scored.filter(long_enough).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    drawn = sum(r["n"] for r in shares) * percent // 100
    offsets, before = [], 0
    for r in sorted(shares, key=lambda r: -r["score"]):
        if before >= drawn:
            break
        offsets.append((r["score"], before))
        before += r["n"]
    spark = docs.sparkSession
    high = spark.createDataFrame(offsets, "score__ long, before__ long")
    lowest = F.lit(offsets[-1][0] if offsets else None).cast("long")
    in_reach = F.coalesce(long_enough & (F.col("score") >= lowest), F.lit(False))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col(key).asc_nulls_last()))
    top = (scored.filter(in_reach).join(F.broadcast(high), F.col("score") == F.col("score__"))
           .withColumn("rank", F.col("before__") + place)
           .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("score__", "before__"))
    return top.unionByName(scored.filter(~in_reach).withColumn("rank", F.lit(None).cast("long")))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"),
                    keep_text=False).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = with_crc32(f"""
WITH {crc32_sql()},
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark),
dw AS (SELECT r, x, count(*) AS c FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY r, x),
bw AS (SELECT x, count(*) AS c FROM (SELECT unnest(w) AS x FROM b) GROUP BY x),
known AS (SELECT x, crc32_of(x) % {BUCKETS} AS k FROM (SELECT x FROM dw UNION SELECT x FROM bw), crc_table),
s AS (SELECT k, sum(c) AS s FROM dw JOIN known USING (x) GROUP BY k),
t AS (SELECT k, sum(c) AS t FROM bw JOIN known USING (x) GROUP BY k),
alls AS (SELECT coalesce(sum(s), 0) AS all_s FROM s), allt AS (SELECT coalesce(sum(t), 0) AS all_t FROM t),
gain AS (SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + {BUCKETS}) AS DOUBLE)
                   / CAST((coalesce(s, 0) + 1) * (all_t + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS g
         FROM (SELECT DISTINCT k FROM known) LEFT JOIN s USING (k) LEFT JOIN t USING (k), alls, allt),
total AS (SELECT r, sum(c * g) AS g, sum(c) AS n FROM dw JOIN known USING (x) JOIN gain USING (k) GROUP BY r),
weighed AS (SELECT doc_id, r, CAST(len(w) AS BIGINT) AS n_features,
              CASE WHEN n IS NULL THEN 0 ELSE CAST((g - ((g % n) + n) % n) // n AS BIGINT) END AS weight,
              CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
            FROM d LEFT JOIN total USING (r)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
           FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= ({PERCENT} * n) // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
""")
