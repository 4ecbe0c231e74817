"""Quality rules: fixed limits on counts, then a calibrated linear classifier.

The classifier is a logistic regression on hashed features, pairs of words,
words and byte trigrams (character trigrams of ASCII text), each counting
log(1 + n) over the document's number of words and bytes.  It is fitted on at
most ``max_rows`` labelled rows, those with the smallest hash of their id, a
fifth of which (by another hash) fits nothing but the calibration: a logistic
curve from the linear score to the chance of label 1 (Platt's).  Documents are
then scored in Arrow batches against the fixed threshold ``KEEP``.

Base counts come from the same pass.  Equality of words and windows is exact:
words get numbers by comparing their bytes, and a window's number comes from
the numbers of its halves.

A fitting row has at most ``DIMS`` features however long its text, so the
driver holds at most ``max_rows`` times ``DIMS`` pairs; on prose it is about a
thousand a row.

Cases: null, empty and wordless texts have counts of 0 and fail the base rules
(too few words); with labels of one kind or none, the classifier keeps all and
the base rules decide; a document labelled more than once takes the mean of
its labels, from 0.5 on as 1; labels other than 0 and 1, null labels and null
ids are ignored; repeated rows each get their row; an empty table gives no
rows; texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import held_out, spans, table
from tripcast.llm.resampling import crcs
from tripcast.llm.shingles import mix

MAX_ROWS = 4_000             # labelled rows to fit on
DIMS = 1 << 17               # buckets of features
CHUNK_CHARS = 1 << 19        # characters handled at once; a longer text goes alone
ROUNDS, STEP, PART, PENALTY = 30, 0.5, 256, 1e-6
SCALE = 100.0                # of feature values, so that weights stay near 1
#: fixed values of the contract
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: a document stays if the calibrated chance of label 1 is at least this
KEEP = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(number: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``window`` words found twice
    or more in that text.  ``number``: equal for equal words."""
    n = len(number) - window + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    code, span = number, 1
    while span < window:
        step = min(span, window - span)
        m = len(code) - step
        code = pd.factorize(code[:m] * (code.max() + 1) + code[step:])[0]
        span += step
    start = np.flatnonzero(doc[:n] == doc[window - 1:])
    kind = pd.factorize(code[start] * n_docs + doc[start])[0]
    start = start[np.bincount(kind)[kind] > 1] if len(kind) else start
    edge = np.zeros(len(number) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return np.bincount(doc, np.cumsum(edge[:-1]) > 0, n_docs).astype(np.int64)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


class Chunk(NamedTuple):
    """What a chunk of texts has: the base counts, and the distinct features
    (text, bucket, value), sorted by text."""

    counts: np.ndarray
    doc: np.ndarray
    bucket: np.ndarray
    value: np.ndarray


def examined(texts: list[str], dims: int = DIMS, with_features: bool = True) -> Chunk:
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raws]       # at the contract's six characters
    sizes = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    words = np.empty(len(doc), object)
    words[:] = [w for ws in split for w in ws]
    number, known = pd.factorize(words) if len(words) else (np.zeros(0, np.int64), [])
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    counts[:, 0] = sizes
    counts[:, 1] = [len(t) - sum(map(t.count, SPACES)) for t in texts]
    counts[:, 2] = [sum(map(t.count, SYMBOLS)) for t in texts]
    counts[:, 3] = [repeated_lines(t) for t in texts]
    counts[:, 4] = repeated_words(number, doc, len(texts))
    nothing = np.zeros(0, np.int64)
    if not with_features or not len(words):
        return Chunk(counts, nothing, nothing, np.zeros(0, np.float32))

    ends = np.cumsum([len(w) for w in known])
    flat = np.frombuffer(b"".join(known), np.uint8)
    h = mix(crcs(flat, np.r_[0, ends[:-1]], ends).astype(np.uint64) + np.uint64(1))[number]
    together = doc[1:] == doc[:-1]
    pair = mix(h[:-1] * np.uint64(3) + h[1:])[together]
    b = np.frombuffer(b"".join(raws), np.uint8).astype(np.uint64)
    at = np.repeat(np.arange(len(raws)), [len(r) for r in raws])
    inside = at[2:] == at[:-2]
    three = mix((b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16))[inside] + np.uint64(1 << 40))
    owner = np.concatenate([doc, doc[1:][together], at[2:][inside]])
    shift = np.uint64(64 - (dims - 1).bit_length())
    key = np.sort(owner * dims + (np.concatenate([h, pair, three]) >> shift).astype(np.int64))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n = np.diff(np.r_[first, len(key)])
    owner, bucket = key[first] // dims, key[first] % dims
    total = sizes + np.array([len(r) for r in raws])
    return Chunk(counts, owner, bucket, (np.log1p(n) * SCALE / total[owner]).astype(np.float32))


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def chances(self, chunk: Chunk) -> np.ndarray:
        """The calibrated chance of label 1 of each text of a chunk."""
        raw = np.bincount(chunk.doc, self.weights[chunk.bucket] * chunk.value, len(chunk.counts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def fitted(bucket: np.ndarray, value: np.ndarray, cut: np.ndarray, y: np.ndarray, dims: int) -> tuple[np.ndarray, float]:
    """Logistic regression by adaptive steps over parts of rows; row i has the
    features from ``cut[i]`` to ``cut[i + 1]``.  Both labels weigh the same."""
    w, seen = np.zeros(dims), np.full(dims, 1e-8)
    bias, bias_seen = 0.0, 1e-8
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    order = np.random.default_rng(13)
    for _ in range(ROUNDS):
        rows = order.permutation(len(y))
        for z in range(0, len(rows), PART):
            part = rows[z:z + PART]
            size = cut[part + 1] - cut[part]
            at = np.repeat(cut[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
            which = np.repeat(np.arange(len(part)), size)
            b, v = bucket[at], value[at]
            score = np.bincount(which, w[b] * v, len(part)) + bias
            slack = (1 / (1 + np.exp(-np.clip(score, -500, 500))) - y[part]) * balance[part] / len(part)
            g = np.bincount(b, slack[which] * v, dims) + PENALTY * w
            seen += g * g
            w -= STEP * g / np.sqrt(seen)
            bias_seen += slack.sum() ** 2
            bias -= STEP * slack.sum() / np.sqrt(bias_seen)
    return w, bias


def calibrated(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from scores to labels, by
    Newton's steps on smoothed labels."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return 1.0, 0.0
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([score, np.ones(len(score))], axis=1)
    fit = np.array([1.0, 0.0])

    def loss(f: np.ndarray) -> float:
        z = x @ f
        return float((np.logaddexp(0, z) - goal * z).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -500, 500)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (p - goal))
        while loss(fit - move) > loss(fit) and np.abs(move).max() > 1e-9:
            move = move / 2
        fit = fit - move
    return (float(fit[0]), float(fit[1])) if fit[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, key: str = "doc_id", text: str = "text",
        label: str = "quality", dims: int = DIMS) -> Model | None:
    """A model from at most ``max_rows`` labelled rows; None where they have
    one label or none."""
    chosen = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
              .groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64(key), key).limit(max_rows))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for a, b in spans(texts, CHUNK_CHARS):
                c = examined(texts[a:b], dims)
                cuts = np.searchsorted(c.doc, np.arange(b - a + 1))
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[a:b], "label": pdf["label"].iloc[a:b],
                    "buckets": [c.bucket[i:j].astype(np.int32).tobytes() for i, j in zip(cuts, cuts[1:], strict=False)],
                    "values": [c.value[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)]})

    # at most max_rows ids and labels, so the broadcast is bounded
    rows = docs.join(F.broadcast(chosen.withColumnRenamed(key, "id__")), F.col(key) == F.col("id__")).select(
        F.col(key).cast("string").alias("id"), "label", F.col(text).alias("text")).mapInPandas(
        features, "id string, label int, buckets binary, values binary").withColumn(
        "aside", F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(5)) == 0).collect()
    rows.sort(key=lambda r: (r["id"], r["label"], bytes(r["buckets"])))     # any task order gives the same model
    if len({r["label"] for r in rows if not r["aside"]}) < 2:
        return None

    def arrays(part: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        buckets = [np.frombuffer(r["buckets"], np.int32) for r in part]
        values = [np.frombuffer(r["values"], np.float32) for r in part]
        cut = np.cumsum([0, *map(len, buckets)])
        return np.concatenate(buckets), np.concatenate(values), cut, np.array([r["label"] for r in part])

    w, bias = fitted(*arrays([r for r in rows if not r["aside"]]), dims)
    slope, offset = 1.0, 0.0
    if aside := [r for r in rows if r["aside"]]:
        bucket, value, cut, y = arrays(aside)
        doc = np.repeat(np.arange(len(y)), np.diff(cut))
        slope, offset = calibrated(np.bincount(doc, w[bucket] * value, len(y)) + bias, y)
    return Model(w.astype(np.float32), bias, slope, offset)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and ``chance``, the calibrated chance of
    label 1 (1 without a model)."""
    if clash := {*COUNTS, "chance", "examined__"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    schema = ", ".join(f"{c} long" for c in COUNTS) + ", chance double"

    @F.pandas_udf(schema)
    def examine(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = [t if isinstance(t, str) else "" for t in series.tolist()]
            counts, chance = np.zeros((len(texts), len(COUNTS)), np.int64), np.ones(len(texts))
            for a, b in spans(texts, CHUNK_CHARS):
                c = examined(texts[a:b], len(model.weights) if model else DIMS, model is not None)
                counts[a:b] = c.counts
                if model:
                    chance[a:b] = model.chances(c)
            yield pd.DataFrame(counts, columns=list(COUNTS)).assign(chance=chance)

    return docs.withColumn("examined__", examine(F.col(text))).withColumns(
        {c: F.col(f"examined__.{c}") for c in (*COUNTS, "chance")}).drop("examined__")


def base_failed(least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    """Too short, or more than ``most_repeated`` per cent of the words in
    repeated windows."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(~held_out(F.col("doc_id")))
    scored = score(docs, fit(docs.filter(~held_out(F.col("doc_id"))), labels)).withColumn("base_failed", base_failed())
    return scored.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("chance") >= KEEP)).alias("kept"),
                         "chance")
