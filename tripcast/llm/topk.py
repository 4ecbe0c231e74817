"""Exact top-k by inner product over an impact-ordered index.

Each task indexes a block of vectors.  For every dimension its values are
quantised into ``LEVELS`` steps; the vectors of one step are a posting segment
with its smallest and largest value.  A query takes the segments of all
dimensions in descending order of what they add to a score (score at a time)
and keeps for every vector a lower bound; what a dimension may still hide, be
it an open segment or the width of a step, bounds how far any true score can
lie above.  It stops once the vectors whose bound still reaches the k-th best
lower bound are few, and scores exactly those from the full vectors; if that
proof never comes all segments are used up and what remains possible is
scored.  So a stop never loses a member.  Each block's k best per query meet
in a window over (query, blocks x k) rows.

Queries travel to the tasks in blocks of at most ``QUERY_BLOCK`` vectors, one
pass over the vectors for each.

Cases: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; a shorter vector counts as filled up with zeros;
rows with the query's own id are not its candidates; equal scores go to the
smaller id; a repeated row is a candidate each time, a repeated query is
answered once; fewer than k candidates are all returned; empty tables give no
rows.  Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import table, written

K = 5
SCALE = 256
QUERY_STEP = 50              # rows whose id this divides are queries
QUERY_BLOCK = 4096
VECTOR_BLOCK = 32_768        # vectors indexed together
LEVELS = 8
LOOKS = 8                    # times a query checks for its proof
FEW = 64                     # possible members worth scoring at once


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): the usable rows, components floored to whole steps."""
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    limit = float(np.finfo(np.float64).max)
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= limit))
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(key).cast("long").alias("id"), v.alias("v"))


def matrix(rows: list, width: int = 0) -> np.ndarray:
    width = max([width, *map(len, rows)])
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


class ImpactIndex:
    """Posting segments of a block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, levels: int = LEVELS):
        self.ids, self.x = ids, x
        dims, low, high, self.rows = [], [], [], []
        for d, column in enumerate(x.T):
            bottom, top = int(column.min()), int(column.max())
            step = (column - bottom) * levels // (top - bottom + 1)
            order = np.argsort(step, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(step[order])) + 1):
                dims.append(d)
                low.append(column[part].min())
                high.append(column[part].max())
                self.rows.append(part)
        self.dim, self.low, self.high = np.array(dims), np.array(low), np.array(high)
        self.starts = np.flatnonzero(np.r_[True, np.diff(self.dim) > 0])

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, by score, then id."""
        weight = q[self.dim]
        least = np.where(weight >= 0, weight * self.low, weight * self.high)
        most = np.where(weight >= 0, weight * self.high, weight * self.low)
        worst = np.minimum.reduceat(least, self.starts)
        gain = least - worst[self.dim]
        order = np.argsort(-gain, kind="stable")
        bound = np.full(len(self.ids), worst.sum())
        bound[self.ids == own] = np.iinfo(np.int64).min // 2
        members = np.flatnonzero(self.ids != own)
        used = np.zeros(len(gain), bool)
        for turn in np.array_split(order, LOOKS):
            for s in turn[gain[turn] > 0]:
                bound[self.rows[s]] += gain[s]
            used[turn] = True
            # what each dimension may hide: the best of its open segments, or the width of a used one
            slack = np.maximum.reduceat(np.where(used, most - least, most - worst[self.dim]), self.starts).sum()
            if len(members) > k:
                reach = np.partition(bound[members], -k)[-k]
                members = members[bound[members] + slack >= reach]
            if len(members) <= max(k, FEW):
                break
        scores = self.x[members] @ q
        best = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][best], scores[best]


def search_block(vectors: DataFrame, queries: list, k: int) -> tuple[Broadcast, DataFrame]:
    """The queries as sent to the executors, and the k best of each block of
    ``vectors`` for each of them."""
    shared = vectors.sparkSession.sparkContext.broadcast(
        (np.array([r["id"] for r in queries], np.int64), matrix([r["v"] for r in queries])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, q = shared.value

        def answer(block: list[pd.DataFrame]) -> pd.DataFrame:
            rows = pd.concat(block)
            x = matrix(rows["v"].tolist(), q.shape[1])
            index = ImpactIndex(rows["id"].to_numpy(np.int64), x)
            wide = np.pad(q, ((0, 0), (0, x.shape[1] - q.shape[1])))
            out = [(n, name, *index.search(v, name, k)) for n, (name, v) in enumerate(zip(names, wide, strict=True))]
            return pd.DataFrame({
                "n": np.repeat([o[0] for o in out], [len(o[2]) for o in out]),
                "query_id": np.repeat([o[1] for o in out], [len(o[2]) for o in out]),
                "vec_id": np.concatenate([o[2] for o in out]), "score": np.concatenate([o[3] for o in out])})

        block, held = [], 0
        for pdf in batches:
            block.append(pdf)
            held += len(pdf)
            if held >= VECTOR_BLOCK:
                yield answer(block)
                block, held = [], 0
        if held:
            yield answer(block)

    return shared, vectors.mapInPandas(search, "n long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; both frames as ``integer_vectors``."""
    asked = written(queries.distinct(), "queries")
    stored = written(vectors, "vectors")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = stored.repartition(max(1, -(-stored.count() // VECTOR_BLOCK)))
    best = Window.partitionBy("n", "query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id", "v").collect()
        if part or found is None:
            shared, near = search_block(dealt, part, k)
            one = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
                "query_id", "rank", "vec_id", "score")
            if blocks > 1:      # a block's queries go before the next block's come
                one = written(one, "nearest")
                shared.destroy()
            found = one if found is None else found.union(one)
    return found


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return top_k(vectors, vectors.filter(F.col("id") % QUERY_STEP == 0))


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
