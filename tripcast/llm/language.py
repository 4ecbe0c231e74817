"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point.  A
trigram is bound by multiplying its letters' vectors, each permuted (rotated)
by its place; a word is padded with a blank on both sides.  A text is the
bundle (sum) of its trigrams' vectors, a language prototype the bundle of its
texts, each text weighing the same.  A text is compared with every prototype
by cosine.

Fitting is one pass: each task adds up its texts' vectors per language and
hands on one vector per language, which Spark sums.  Weights are whole
numbers, so the sums do not depend on task order.  Scoring is one pass with
the prototypes (languages x ``DIMS`` numbers) in the task closure.

Cases: ``und`` with score 0 for a text that is null, empty or without a
letter, and for every text when nothing could be learned; ties between
prototypes go to the first language by name; texts are read whole; an empty
table gives no rows; repeated rows each get their row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import held_out, spans, table

DIMS = 512
SEED = 5
UNIT = 1 << 20               # a text's trigram weights add up to this
CHUNK_CHARS = 500_000      # characters handled at once; a longer text goes alone
GRAM_BLOCK = 8192            # trigram vectors made at once
UNDETERMINED = "und"
BLANK = 0


class Grams:
    """Trigrams of texts as numbers, and their vectors."""

    def __init__(self, dims: int = DIMS, seed: int = SEED):
        self.dims, self.seed = dims, seed
        self.symbol = np.full(sys.maxunicode + 1, -1, np.int32)   # code point -> letter number, 0: not a letter
        self.vectors = [self._draw(-1)]

    def _draw(self, code: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, code + 1])
        return rng.integers(0, 2, self.dims, dtype=np.int8) * np.int8(2) - np.int8(1)

    def _learn(self, codes: np.ndarray) -> None:
        for code in np.unique(codes[self.symbol[codes] < 0]).tolist():
            if chr(code).isalpha():
                self.symbol[code] = len(self.vectors)
                self.vectors.append(self._draw(code))
            else:
                self.symbol[code] = BLANK

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, trigram, count), sorted; trigram = three letter
        numbers in base ``len(self.vectors)``."""
        codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        doc = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        self._learn(codes)
        s = self.symbol[codes].astype(np.int64)
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != BLANK) | (s[:-1] != BLANK) | (doc[1:] != doc[:-1])
        s, doc = s[keep], doc[keep]
        base = len(self.vectors)
        # the middle letter decides: blank there would join two words or texts
        at = np.flatnonzero(s[1:-1] != BLANK) + 1
        gram = (s[at - 1] * base + s[at]) * base + s[at + 1]
        key = np.sort(doc[at] * base ** 3 + gram)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.r_[first, len(key)])
        return key[first] // base ** 3, key[first] % base ** 3, n

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """One vector per trigram."""
        base, letters = len(self.vectors), np.stack(self.vectors)
        places = [np.roll(letters, k, axis=1) for k in (2, 1, 0)]
        out = places[0][grams // base ** 2]
        out *= places[1][grams // base % base]
        out *= places[2][grams % base]
        return out


def fit(docs: DataFrame, text: str = "text", label: str = "lang", dims: int = DIMS, seed: int = SEED,
        ) -> tuple[list[str], np.ndarray]:
    """Languages by name and their prototypes of length 1, from all rows of
    ``docs`` with a label and a letter.  The driver gets languages x ``dims``
    numbers."""

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, sums = Grams(dims, seed), {}
        for pdf in batches:
            for lang, part in pdf.groupby("label", sort=False):
                texts = part["text"].tolist()
                for a, b in spans(texts, CHUNK_CHARS):
                    doc, gram, n = grams.count(texts[a:b])
                    if not len(doc):
                        continue
                    total = np.bincount(doc, n, b - a)
                    weight = np.rint(n / total[doc] * UNIT).astype(np.int64)
                    vocabulary, where = np.unique(gram, return_inverse=True)
                    weight = np.bincount(where, weight, len(vocabulary))
                    for i in range(0, len(vocabulary), GRAM_BLOCK):
                        part_sum = weight[i:i + GRAM_BLOCK] @ grams.bound(vocabulary[i:i + GRAM_BLOCK])
                        sums[lang] = sums.get(lang, 0) + np.rint(part_sum).astype(np.int64)
        if sums:
            yield pd.DataFrame({"label": list(sums), "bundle": [v.tolist() for v in sums.values()]})

    learned = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    sums = (learned.mapInPandas(bundle, "label string, bundle array<bigint>")
            .select("label", F.posexplode("bundle").alias("dim", "v"))
            .groupBy("label", "dim").agg(F.sum("v").alias("v"))
            .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("dim", "v"))).alias("bundle"))
            .select("label", "bundle.v").orderBy("label").collect())
    langs, vectors = [], []
    for row in sums:
        v = np.array(row["v"], np.float64)
        if (length := np.linalg.norm(v)) > 0:
            langs.append(row["label"])
            vectors.append(v / length)
    return langs, np.array(vectors, np.float32).reshape(len(langs), dims)


def compare(texts: list[str], grams: Grams, prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best prototype (-1: no letter) and its cosine, for each text."""
    best, cosine = np.full(len(texts), -1), np.zeros(len(texts))
    for a, b in spans(texts, CHUNK_CHARS):
        doc, gram, n = grams.count(texts[a:b])
        vocabulary, where = np.unique(gram, return_inverse=True)
        bundles = np.zeros((b - a, grams.dims), np.float32)
        for i in range(0, len(vocabulary), GRAM_BLOCK):
            vectors = grams.bound(vocabulary[i:i + GRAM_BLOCK]).astype(np.float32)
            here = (where >= i) & (where < i + GRAM_BLOCK) if len(vocabulary) > GRAM_BLOCK else slice(None)
            rows, cols, counts = doc[here], where[here] - i, n[here].astype(np.float32)
            cuts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else []
            for j, k in zip(cuts, np.r_[cuts[1:], len(rows)].astype(int) if len(cuts) else [], strict=True):
                bundles[rows[j]] += counts[j:k] @ vectors[cols[j:k]]
        length = np.linalg.norm(bundles, axis=1)
        cos = bundles @ prototypes.T / np.maximum(length, 1e-9)[:, None]
        some = np.unique(doc)
        best[a + some] = cos[some].argmax(axis=1)
        cosine[a + some] = cos[some].max(axis=1)
    return best, np.clip(cosine, 0, 1)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, text: str = "text",
            seed: int = SEED, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its cosine (0 if negative)."""
    if clash := set(added) & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    if not langs:
        return docs.withColumns({added[0]: F.lit(UNDETERMINED), added[1]: F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, names = Grams(prototypes.shape[1], seed), np.array([*langs, UNDETERMINED], object)
        for texts in batches:
            best, cosine = compare(texts.fillna("").tolist(), grams, prototypes)
            yield pd.DataFrame({"lang": names[best], "score": cosine})

    return docs.withColumn("guess__", guess(F.col(text))).withColumns(
        {added[0]: F.col("guess__.lang"), added[1]: F.col("guess__.score")}).drop("guess__")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    langs, prototypes = fit(docs.filter(~F.col("held_out")))
    return predict(docs.drop("lang"), langs, prototypes).select("doc_id", "held_out", "lang_pred", "score")
