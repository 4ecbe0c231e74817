"""Benchmark decontamination by Wu-Manber search over words.

A test text's patterns are its windows of ``window`` consecutive words, or the
whole text if it has fewer.  The symbols of the search are words and a block
is two of them.  For patterns of one length ``m`` the shift table has, for
every block of a pattern, how many words the window can move on when the block
stands at its end; a block not in the table moves it by ``m - 1``.  Only where
the shift is 0 are the patterns that end in this block looked at: the bucket
is keyed by the block, and the words themselves are compared.

Distinct (pattern, item) pairs are dealt by hash into blocks of about
``block_pairs``, so what a block sends to the executors has a bound.  With more
blocks the documents are searched for one after another; the finds of each are
written before the driver takes the next one's patterns, and united by document
at the end.

Cases: null or wordless texts and items have no words and hit nothing; an item
counts once however often it occurs; repeated rows, items and ids each count
as they stand, a null item_id is left out of the item list's digest; an
overlapping word counts once; empty tables give no rows, or no hits; texts are
searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import table, written

WINDOW = 10
BLOCK_PAIRS = 200_000        # (pattern, item) pairs sent to the executors at once
#: fixed values: the words of the contract, and A-Z in lower case
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def words_of(text: str | None) -> list[str]:
    return re.findall(WORD, (text or "").translate(FOLD))


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def pattern_pairs(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (pattern, item): the pattern's words with blanks between."""
    words = items.select(F.col(key).cast("string").alias("item"), word_array(F.col(text)).alias("w")).filter(
        F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return words.select("item", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("pattern")).distinct()


class WuManber:
    """Finds patterns of ``m`` words each in a list of words."""

    def __init__(self, patterns: list[tuple[str, ...]]):
        self.m = len(patterns[0])
        self.block = min(2, self.m)
        self.shift: dict = {}
        self.bucket: dict = {}
        for p in patterns:
            for end in range(self.block, self.m + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.m), self.m - end)
            self.bucket.setdefault(p[-self.block:], set()).add(p)

    def find(self, words: list[str]) -> Iterator[tuple[int, tuple[str, ...]]]:
        """(first word, pattern) of every occurrence, in order."""
        m, shift, bucket, far = self.m, self.shift.get, self.bucket, self.m - self.block + 1
        end, n = m, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if self.block == 2 else (words[end - 1],)
            move = shift(key, far)
            if move:
                end += move
                continue
            here = tuple(words[end - m:end])
            if here in bucket[key]:
                yield end - m, here
            end += 1


def search(texts: list[str | None], matchers: list[WuManber], owners: dict[tuple[str, ...], list[str]],
           ) -> Iterator[tuple[int, list[int], set[str]]]:
    """(words, hit stretches as begin, end, begin, end, ..., items) of each text."""
    for text in texts:
        words = words_of(text)
        spans, found = [], set()
        for matcher in matchers:
            for at, pattern in matcher.find(words):
                spans.append((at, at + matcher.m))
                found.update(owners[pattern])
        yield len(words), merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


FOUND = "n_words long, hits array<int>, items array<string>"


def search_block(docs: DataFrame, pairs: list, text: str) -> tuple[Broadcast, DataFrame]:
    """The patterns as sent to the executors, and ``docs`` with the struct
    ``found__``."""
    owners: dict[tuple[str, ...], list[str]] = {}
    for row in pairs:
        owners.setdefault(tuple(row["pattern"].split(" ")), [])
        if row["item"] is not None:
            owners[tuple(row["pattern"].split(" "))].append(row["item"])
    by_length: dict[int, list] = {}
    for p in owners:
        by_length.setdefault(len(p), []).append(p)
    shared = docs.sparkSession.sparkContext.broadcast((list(by_length.values()), owners))

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lists, owner = shared.value
        matchers = [WuManber(x) for x in lists]
        for texts in batches:
            yield pd.DataFrame([(n, hits, sorted(items)) for n, hits, items in search(texts.tolist(), matchers, owner)],
                               columns=["n_words", "hits", "items"])

    return shared, docs.withColumn("found__", find(F.col(text)))


def find_contamination(docs: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
                       item_text: str = "text", window: int = WINDOW, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (begin and end word of each hit
    stretch, end exclusive) and ``items`` (ids found, sorted as text)."""
    if clash := {"found__", "row__", "n_words", "hits", "items"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    pairs = written(pattern_pairs(items, key, item_text, window).withColumn(
        "deal", F.xxhash64("pattern", "item")), "patterns")
    blocks = max(1, -(-pairs.count() // block_pairs))

    def part(b: int) -> list:
        return pairs.filter(F.pmod("deal", F.lit(blocks)) == b).select("pattern", "item").collect()

    if blocks == 1:
        return with_found(search_block(docs, part(0), text)[1])
    # one block after another, each with its finds written before the next one's patterns come
    rows = docs.withColumn("row__", F.monotonically_increasing_id())
    finds = []
    for b in range(blocks):
        shared, found = search_block(rows.select("row__", F.col(text).alias("text")), part(b), "text")
        finds.append(written(found.select("row__", "found__.*").filter((F.size("items") > 0) | (F.size("hits") > 0)), "block-hits"))
        shared.destroy()
    each = reduce(DataFrame.union, finds).groupBy("row__").agg(
        F.collect_list("hits").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    nothing = F.expr("cast(array() as array<int>)"), F.expr("cast(array() as array<string>)")
    joined = written(each.withColumn("hits", F.pandas_udf(unite, "array<int>")(F.flatten("hits"))), "all-hits")
    count = F.size(word_array(F.col(text))).cast("long")
    return rows.join(joined, "row__", "left").withColumns({
        "n_words": count, "hits": F.coalesce("hits", nothing[0]), "items": F.coalesce("items", nothing[1])}).drop("row__").select(
        *docs.columns, "n_words", "hits", "items")


def unite(lists: pd.Series) -> pd.Series:
    """Stretches (begin, end, begin, end, ...) of several blocks as one list."""
    return pd.Series([merged([(int(a), int(b)) for a, b in zip(x[::2], x[1::2], strict=True)]) for x in lists])


def with_found(docs: DataFrame) -> DataFrame:
    return docs.withColumns({c: F.col(f"found__.{c}") for c in ("n_words", "hits", "items")}).drop("found__")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                               table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate(F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"),
                        lambda a, x: a + x)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


ORACLE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS m, array_to_string(w[i:i + {WINDOW} - 1], ' ') AS pat
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM p),
spots AS (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m),
grams AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS pat FROM spots),
found AS (SELECT g.r, g.m, g.i, p.item FROM grams g JOIN p ON g.pat = p.pat AND g.m = p.m),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM found) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS l FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
