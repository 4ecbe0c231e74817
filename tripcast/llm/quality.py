"""Document quality by histogram gradient-boosted trees.

Statistics of the whole text (shape of words, lines, symbols, repetition) are
computed in one pass.  Fitting takes at most ``max_rows`` labelled rows, those
with the smallest hash of their id: features are cut at quantiles into at most
``BINS`` bins, and each tree is grown level by level from histograms of the
gradient and curvature of the logistic loss.  The trees become flat arrays
(feature, threshold, left, right, value); scoring moves all rows of a batch
down a tree together.

Cases: a null text counts as empty, whose statistics are all 0; a document
labelled more than once takes the mean of its labels; labels other than 0 and
1 and null ones are ignored; without labels of any use the score is the prior
0.5; an empty table gives no rows; repeated rows each get their row; a null
doc_id is never learned from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import held_out, table

MAX_ROWS = 20_000            # labelled rows to fit on
BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 64, 4, 80, 0.1, 1.0, 10
THRESHOLD = 0.3
SYMBOLS = "!|%$&*#@=<>{}[]\\/_~^+"
WORDS = re.compile(r"\S+")


def statistics(text: str | None) -> list[float]:
    """Numbers that describe one text, none of which depends on its language."""
    text = text or ""
    n = len(text)
    if not n:
        return [0.0] * N_FEATURES
    raw = text.encode("utf-8", "surrogatepass")
    low = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if x.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    folded = [w.lower() for w in words]
    distinct = set(folded)
    pairs = set(zip(folded, folded[1:], strict=False))
    p = low[low > 0] / len(raw)
    letters = max(1, int(low[65:91].sum() + low[97:123].sum() + low[128:].sum()))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(), float(lengths.max()),
        low[65:91].sum() / letters, low[97:123].sum() / len(raw), low[48:58].sum() / len(raw),
        low[128:].sum() / len(raw), low[10] / len(raw), low[32] / len(raw), (low[44] + low[46]) / len(raw),
        low[33:48].sum() / len(raw), sum(low[ord(c)] for c in SYMBOLS) / len(raw),
        *[low[ord(c)] / n_words for c in "!|%$&*#"],
        len(distinct) / n_words, len(pairs) / n_words, len(set(lines)) / n_lines,
        sum(a == b for a, b in zip(folded, folded[1:], strict=False)) / n_words,
        float(np.mean(lengths <= 2)), float(np.mean(lengths == 1)), float(np.mean(lengths >= 15)),
        sum(w[0].isupper() for w in words) / n_words, sum(w.isupper() for w in words) / n_words,
        sum(w[-1] in ".,;:" for w in words) / n_words, sum(not w[-1].isalnum() for w in words) / n_words,
        sum(x.rstrip()[-1] in ".!?" for x in lines) / n_lines, sum("|" in x for x in lines) / n_lines,
        float(-(p * np.log2(p)).sum()), len(zlib.compress(raw, 1)) / len(raw),
    ]


N_FEATURES = len(statistics("a"))


def features(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), N_FEATURES)


class Forest(NamedTuple):
    """Trees as arrays, one row each; a leaf points to itself."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.prior), np.arange(len(x))
        for k in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                goes_left = x[rows, self.feature[k, at]] <= self.threshold[k, at]
                at = np.where(goes_left, self.left[k, at], self.right[k, at])
            total += self.value[k, at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, bins: int = BINS, trees: int = TREES) -> Forest:
    """Boosted trees on features ``x`` and labels ``y`` (0 to 1)."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, d = x.shape
    nodes = 2 ** (DEPTH + 1) - 1
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    out = Forest(float(np.log(mean / (1 - mean))), *(np.zeros((trees, nodes), t) for t in (np.int64, float)),
                 *(np.tile(np.arange(nodes), (trees, 1)) for _ in range(2)), np.zeros((trees, nodes)))
    total, offset = np.full(n, out.prior), np.arange(d) * bins
    for k in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first = 2 ** level - 1
            width = 2 ** level
            live = at >= first
            key = ((at[live] - first) * d * bins)[:, None] + offset + binned[live]
            size = width * d * bins
            hist = [np.bincount(key.ravel(), np.repeat(w[live], d), size).reshape(width, d, bins).cumsum(axis=2)
                    for w in (g, h, np.ones(n))]
            gl, hl, nl = hist
            gt, ht, nt = (a[:, :, -1:] for a in hist)
            gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
            gain[(nl < LEAST) | (nt - nl < LEAST)] = -1
            flat = gain.reshape(width, -1)
            for i in range(width):
                f, b = divmod(int(flat[i].argmax()), bins)
                if flat[i].max() <= 1e-6 or b >= len(edges[f]):
                    continue
                node = first + i
                out.feature[k, node], out.threshold[k, node] = f, edges[f][b]
                out.left[k, node], out.right[k, node] = 2 * node + 1, 2 * node + 2
                here = np.flatnonzero(at == node)
                at[here] = np.where(binned[here, f] <= b, 2 * node + 1, 2 * node + 2)
        num, den = np.bincount(at, g, nodes), np.bincount(at, h, nodes)
        out.value[k] = -RATE * num / (den + RIDGE)
        total += out.value[k, at]
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> Forest | None:
    """A forest learned from at most ``max_rows`` labelled rows of ``docs``."""
    chosen = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
              .groupBy(key).agg(F.avg(label).alias("label"))
              .orderBy(F.xxhash64(key), key).limit(max_rows))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"label": pdf["label"], "x": list(features(pdf["text"].tolist()))})

    # at most max_rows ids and labels, so the broadcast is bounded
    rows = docs.join(F.broadcast(chosen.withColumnRenamed(key, "id__")), F.col(key) == F.col("id__")).select(
        "label", F.col(text).alias("text")).mapInPandas(measure, "label double, x array<double>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["label"], r["x"]))   # any task order gives the same trees
    return grow(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]))


def score(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the chance of label 1."""
    if "score" in {c.lower() for c in docs.columns}:
        raise ValueError("column score is named like the added one")
    if forest is None:
        return docs.withColumn("score", F.lit(0.5))

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series(forest.score(features(texts.tolist())))

    return docs.withColumn("score", apply(F.col(text)))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(~held_out(F.col("doc_id")))
    forest = fit(docs.filter(~F.col("held_out")), labels)
    return score(docs, forest).select("doc_id", "held_out", "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
