"""Repeated passages: paragraph MinHash banding, and verbatim stretches.

Two searches over whole texts, whose finds are united:

**Similar paragraphs.**  A paragraph is a line of ``WORDS`` words or more.

1. Each gets ``BANDS`` keys of ``ROWS`` min-hashes over its ``SHINGLE``-word
   shingles.  Where a key brings several classes (paragraphs with the same
   words) together, all are candidates of each other: up to ``FEW`` make a row
   per pair; more are compared in blocks of ``BLOCK_CLASSES``, each with
   itself and every other, and only links between classes not linked yet come
   out.
2. Candidates are confirmed by the exact Jaccard similarity of the shingle
   sets of the whole paragraphs, made anew from their text.
3. Confirmed pairs join classes into components, and a component found in two
   documents or more is repeated; its first document keeps it.

Two paragraphs of similarity 0.8 share no key with a chance of 0.36^6 (0.2 %).

**Verbatim stretches**, wherever lines break.

1. Winnowing takes windows of ``WORDS`` words: in every run of ``SPREAD``
   neighbouring starts the one whose shingle has the smallest hash.  Texts that
   share ``WORDS + SPREAD - 1`` words (50) share a window, and further ones at
   most ``SPREAD`` words apart along the stretch.
2. Of neighbouring windows the words from the first to the end of the second
   are looked up as one (a bridge).
3. Where no bridge goes on, the up to ``SPREAD - 1`` words before or after a
   window are compared with those of other occurrences of that window, the
   first two and the last two of the corpus, and the window is extended to the
   longest stretch it has in common with one of them.

So a verbatim passage of 50 words or more is found in every place where it
stands, and reported from its first word to its last wherever one of those
occurrences has it whole; else up to ``SPREAD - 1`` words of an end may be
missing.

Every look-up is a partial aggregate by a 64-bit hash, so what a third of all
documents share is combined before it moves; what comes back is joined from
tables by sort-merge, which Spark splits where a key is hot.

Cases: null, empty and short texts (under ``WORDS`` words) have neither and
never occur in the result; repetition inside one document alone is none, but a
passage of several documents is reported at each of its places, also those in
one document; repeated rows count as documents of their own; empty tables give
no rows; texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import spans, table, written
from tripcast.llm.components import components
from tripcast.llm.shingles import Shingler, mix

WORDS = 20                   # of a window, and the least of a paragraph
SPREAD = 31                  # neighbouring starts of which one is taken
SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 6, 2
FEW = 8                      # classes of a key that make a row per pair
BLOCK_CLASSES = 1024         # of a key with more, compared in one task with as many others
CHUNK_CHARS = 1 << 20        # characters handled at once; a longer text goes alone

_RNG = np.random.default_rng(4)
_MUL = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
BEFORE, AFTER, PARAGRAPH = 0, 1, 2


def taken(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that winnowing picks: of each run the first with
    the smallest hash."""
    x = shingles[:n_words - WORDS + 1]
    if len(x) <= SPREAD:
        return np.array([int(x.argmin())])
    picked = np.zeros(len(x), bool)
    for a in range(0, len(x) - SPREAD + 1, CHUNK_CHARS):
        runs = np.lib.stride_tricks.sliding_window_view(x[a:a + CHUNK_CHARS + SPREAD - 1], SPREAD).argmin(axis=1)
        picked[a + np.arange(len(runs)) + runs] = True
    return np.flatnonzero(picked)


def stretches(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, first of each) of the stretches laid end to end."""
    first = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(begin - first, size), first


class Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def least(self, n: int) -> None:
        if len(self.up) < n:
            back = np.uint64(pow(int(_PLACE), -1, 2**64))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(2 * n, s, np.uint64)]) for s in (_PLACE, back))


_POWERS = Powers()


def running(words: np.ndarray) -> np.ndarray:
    _POWERS.least(len(words) + 1)
    return np.r_[np.uint64(0), np.cumsum(words * _POWERS.up[:len(words)])]


def prints(total: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each stretch of words, from their running sums."""
    return mix((total[begin + size] - total[begin]) * _POWERS.down[begin] + size.astype(np.uint64))


def paragraphs(text: str) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(first word, words, line number) of the lines of ``WORDS`` words or more."""
    size = np.array([len(x.split()) for x in text.encode("utf-8", "surrogatepass").split(b"\n")], np.int64)
    long_enough = np.flatnonzero(size >= WORDS)
    return (np.cumsum(size) - size)[long_enough], size[long_enough], long_enough.tolist()


def band_keys(shingles: np.ndarray, begin: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The keys of the paragraphs at ``begin`` of ``size`` shingles each."""
    at, first = stretches(begin, size)
    own = shingles[at]
    low = [np.minimum.reduceat(own * a + b, first) for a, b in zip(_MUL, _ADD, strict=True)]
    out = []
    for band in range(BANDS):
        key = np.full(len(begin), band + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key + low[band * ROWS + r])
        out.append(key)
    return out


BAND_COLUMNS = [f"band{b}" for b in range(BANDS)]


def units_of(rows: DataFrame) -> DataFrame:
    """(row, start, size, fp, bridge, band keys) from (row, text).  Windows
    have as ``size`` the distance to the window before (0: none), and as
    ``bridge`` the hash of the words from there to their end; paragraphs have
    their words and band keys."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in spans(texts, CHUNK_CHARS):
                if made := list(units(texts[a:b], a)):
                    which, start, size, fp, bridge, keys = (np.concatenate(x) for x in zip(*made, strict=True))
                    windows = keys[:, 0] == 0
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(pa.array(which)), pa.array(start.astype(np.int32)),
                         pa.array(size.astype(np.int32)), pa.array(fp.view(np.int64)),
                         pa.array(bridge.view(np.int64), mask=~windows),
                         *(pa.array(k.view(np.int64), mask=windows) for k in keys.T)],
                        names=["row", "start", "size", "fp", "bridge", *BAND_COLUMNS])

    def units(texts: list[str], first: int) -> Iterator[tuple[np.ndarray, ...]]:
        shingler = Shingler(SHINGLE)
        for i, (text, words) in enumerate(zip(texts, shingler.word_hashes(texts), strict=True), first):
            if len(words) < WORDS:
                continue
            whole, total = shingler.join(words), running(words)
            at = taken(whole, len(words))
            gap = np.diff(at, prepend=at[0])
            yield (np.full(len(at), i), at, gap, prints(total, at, np.full(len(at), WORDS)), prints(total, at - gap, gap + WORDS),
                   np.zeros((len(at), BANDS), np.uint64))
            begin, size, _ = paragraphs(text)
            if len(begin):
                keys = np.stack(band_keys(whole, begin, size - SHINGLE + 1), axis=1) | np.uint64(1)    # none is 0
                yield (np.full(len(begin), i), begin, size, prints(total, begin, size), np.zeros(len(begin), np.uint64), keys)

    bands = ", ".join(f"{c} long" for c in BAND_COLUMNS)
    return rows.mapInArrow(cut, f"row long, start int, size int, fp long, bridge long, {bands}")


def shared(claims: DataFrame, key: str) -> DataFrame:
    """(key, low): what two documents or more have, with the first of them."""
    return claims.groupBy(key).agg(F.min("row").alias("low"), F.max("row").alias("high")).filter(
        "low <> high").select(key, "low")


def open_ends(matched: DataFrame, bridged: DataFrame) -> DataFrame:
    """(row, start, fp, side) of the windows that no bridge leaves on that side."""
    none = F.lit(None)
    sides = matched.select("row", "start", "fp", none.cast("int").alias("has")).unionByName(
        bridged.select("row", (F.col("start") - F.col("size")).alias("start"), none.cast("long").alias("fp"),
                       F.lit(AFTER).alias("has"))).unionByName(
        bridged.select("row", "start", none.cast("long").alias("fp"), F.lit(BEFORE).alias("has")))
    found = sides.groupBy("row", "start").agg(F.max("fp").alias("fp"), *[
        F.coalesce(F.max(F.col("has") == side), F.lit(False)).alias(f"has{side}") for side in (BEFORE, AFTER)])
    return found.select("row", "start", "fp", F.explode(F.array_compact(F.array(
        *[F.when(~F.col(f"has{side}"), F.lit(side)) for side in (BEFORE, AFTER)]))).alias("side"))


def examples(matched: DataFrame, ends: DataFrame) -> DataFrame:
    """(row, start, fp, side): the first two and the last two occurrences of
    every window that is an end somewhere.  Each task keeps four a window
    before anything is shuffled."""
    own, picked = matched.select("row", "start", "fp"), []
    for order in ((F.col("row"), F.col("start")), (F.col("row").desc(), F.col("start").desc())):
        place = F.row_number().over(Window.partitionBy("fp").orderBy(*order))
        picked.append(own.withColumn("place", place).filter("place <= 2").drop("place"))
    return picked[0].union(picked[1]).distinct().join(ends.select("fp", "side").distinct(), "fp")


def ask_texts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """For the (row, start, fp, side) asked for, from the texts: the hashes of
    the words on that side of the window, nearest first (``words``, at most
    ``SPREAD - 1`` of 4 bytes); for ``side`` ``PARAGRAPH`` the line that
    begins there (``text``)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            z = [pack((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(z, pa.binary())], names=["row", "z"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [unpack(z).decode("utf-8", "surrogatepass") for z in batch.column("z").to_pylist()]
            lists = [batch.column(c).to_pylist() for c in ("start", "fp", "side")]
            for a, b in spans(texts, CHUNK_CHARS):
                out = []
                for i, words in enumerate(Shingler(SHINGLE).word_hashes(texts[a:b]), a):
                    out += answers(i, texts[i], words.astype(np.uint32), *(x[i] for x in lists))
                if out:
                    which, *columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take(pa.array(which)),
                         *(pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.string()),
                                                          strict=True))],
                        names=["row", "start", "fp", "side", "words", "text"])

    def answers(i: int, text: str, words: np.ndarray, starts: list, fps: list, sides: list) -> Iterator[tuple]:
        lines = None
        for start, fp, side in zip(starts, fps, sides, strict=True):
            if side == BEFORE:
                yield i, start, fp, side, words[max(0, start - SPREAD + 1):start][::-1].tobytes(), None
            elif side == AFTER:
                yield i, start, fp, side, words[start + WORDS:start + WORDS + SPREAD - 1].tobytes(), None
            else:
                if lines is None:
                    split, (begin, _, number) = text.split("\n"), paragraphs(text)
                    lines = {s: split[k] for s, k in zip(begin.tolist(), number, strict=True)}
                yield i, start, fp, side, None, lines[start]

    lists = asked.groupBy("row").agg(F.collect_list(F.struct("start", "fp", "side")).alias("asked")).select(
        "row", "asked.start", "asked.fp", "asked.side")
    texts = rows.select("row", "text").mapInArrow(packed, "row long, z binary")
    return texts.join(lists.hint("merge"), "row").select("row", "z", "start", "fp", "side").mapInArrow(
        ask, "row long, start int, fp long, side int, words binary, text string")


def extended(ends: DataFrame, told: DataFrame, examples_: DataFrame) -> DataFrame:
    """(row, begin, end, low): windows with the words beside them that an
    example in another document has too."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [common(x, y) for x, y in zip(batch.column("words").to_pylist(), batch.column("theirs").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "start", "side", "low")), pa.array(n, pa.int32())],
                names=["row", "start", "side", "low", "length"])

    words = told.filter("text is null").select("row", "start", "fp", "side", "words")
    keys = ["row", "start", "fp", "side"]
    ours = words.join(ends.select(*keys).hint("merge"), keys, "left_semi")
    theirs = words.join(examples_.select(*keys).hint("merge"), keys, "left_semi").select(
        "fp", "side", F.col("row").alias("other"), F.col("words").alias("theirs"))
    pairs = ours.join(theirs.hint("merge"), ["fp", "side"]).filter("row <> other").select(
        "row", "start", "side", F.least("row", "other").alias("low"), "words", "theirs")
    best = pairs.mapInArrow(compare, "row long, start int, side int, low long, length int").groupBy("row", "start", "side").agg(
        F.max(F.struct("length", (-F.col("low")).alias("low"))).alias("far")).filter("far.length > 0")
    before = F.when(F.col("side") == BEFORE, F.col("far.length")).otherwise(0)
    return best.select("row", (F.col("start") - before).alias("begin"),
                       (F.col("start") + WORDS + F.col("far.length") - before).alias("end"), (-F.col("far.low")).alias("low"))


def common(x: bytes, y: bytes) -> int:
    """How many 4-byte words two lists begin with in common."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n // 4
    return next(i for i in range(0, n, 4) if x[i:i + 4] != y[i:i + 4]) // 4


def shingle_ids(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, int]:
    """(shingle numbers of all texts, first of each text and the end, kinds)."""
    sets = list(Shingler(SHINGLE).sets(texts.tolist()))
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    return ids, np.cumsum([0, *map(len, sets)]), len(known)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(SHINGLE)
        for pdf in batches:
            good = []
            for x, y in zip(shingler.sets(pdf["ta"].tolist()), shingler.sets(pdf["tb"].tolist()), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    half = pairs.join(sets.select(F.col("fp").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
    whole = half.join(sets.select(F.col("fp").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")
    return whole.select("a", "b", "ta", "tb").mapInPandas(check, "a long, b long")


def block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (a, b) that join the similar ones among the classes of two blocks
    of a key, or of one block with itself."""
    rows = rows.sort_values("block", ignore_index=True)
    fp, block = rows["fp"].to_numpy(), rows["block"].to_numpy()
    ids, cut, kinds = shingle_ids(rows["text"])
    sizes = np.diff(cut)
    marked = np.zeros(kinds, bool)
    label = np.arange(len(rows))
    second = int(np.searchsorted(block, block[0], side="right"))
    alone = rows["lo"][0] == rows["hi"][0]
    out = []
    for i in range(len(rows) if alone else second):
        first = i + 1 if alone else second
        j = first + np.flatnonzero(label[first:] != label[i])
        if not len(j):
            continue
        marked[ids[cut[i]:cut[i + 1]]] = True
        at, begin = stretches(cut[j], sizes[j])
        both = np.add.reduceat(marked[ids[at]].astype(np.int64), begin)
        marked[ids[cut[i]:cut[i + 1]]] = False
        for k in j[100 * both >= percent * (sizes[i] + sizes[j] - both)]:
            if label[k] != label[i]:
                out.append((fp[i], fp[k]))
                label[label == label[k]] = label[i]
    return pd.DataFrame(out, columns=["a", "b"])


def links_of(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between similar classes that share a key; ``met``: (band,
    fp), each once; ``sets``: (fp, text)."""
    sized = written(met.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band-sizes")
    listed = met.join(sized.filter(F.col("n") <= FEW).hint("merge"), "band", "left_semi").groupBy("band").agg(
        F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = listed.select(F.posexplode("fps").alias("at", "a"), "fps").select(
        "a", F.explode(F.slice("fps", F.col("at") + 2, F.lit(FEW))).alias("b")).distinct()
    few = confirmed(written(pairs, "paragraph-pairs"), sets, percent)

    blocks = sized.filter(F.col("n") > FEW).select("band", F.ceil(F.col("n") / BLOCK_CLASSES).alias("blocks"))
    parts = met.join(blocks.hint("merge"), "band").withColumn("block", F.pmod(F.xxhash64("fp"), "blocks"))
    parts = written(parts.select("band", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
                    .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other"),
                    "band-blocks")
    many = parts.join(sets.hint("merge"), "fp").groupBy("band", "lo", "hi").applyInPandas(
        lambda rows: block_links(rows, percent), "a long, b long")
    return few.union(many)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(row, begin, end, low): stretches of words of a document, end exclusive,
    that another document has too, or a similar paragraph; ``low`` is the row
    of the first document known to have it.  Stretches may overlap; ``row`` is
    the number that ``numbered`` gives a document."""
    rows = numbered(docs, key, text)
    units = written(units_of(rows), "passage-units")
    windows = units.filter("bridge is not null").select("row", "start", "size", "fp", "bridge")
    lines = units.filter("bridge is null").drop("bridge")

    # verbatim windows and bridges; keys that several classes of paragraphs have
    matched = written(windows.join(shared(windows, "fp").hint("merge"), "fp"), "windows")
    bridges = matched.filter("size > 0").select("row", "start", "size", "bridge")
    bridged = written(bridges.join(shared(bridges, "bridge").hint("merge"), "bridge").drop("bridge"), "bridged")
    ends = written(open_ends(matched, bridged), "ends")
    picked = written(examples(matched, ends), "examples")
    keyed = lines.select("fp", F.explode(F.array(*BAND_COLUMNS)).alias("band"))
    several = keyed.groupBy("band").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a <> z").select("band")
    met = written(keyed.join(several.hint("merge"), "band", "left_semi").distinct(), "met")
    classes = written(lines.select("fp", "row", "start").join(met.select("fp").distinct().hint("merge"), "fp", "left_semi")
                      .groupBy("fp").agg(F.min(F.struct("row", "start")).alias("at"), F.max("row").alias("high")).select(
                      "fp", "at.row", "at.start", "high"), "paragraph-classes")

    # one visit to the texts for both
    asked = ends.unionByName(picked).distinct().unionByName(classes.select("row", "start", "fp", F.lit(PARAGRAPH).alias("side")))
    told = written(ask_texts(rows, asked), "told")
    longer = extended(ends, told, picked)

    roots = components(links_of(met.select("band", "fp"), told.filter("text is not null").select("fp", "text"), percent))
    verbatim = lines.groupBy("fp").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    near = roots.join(classes.select("fp", F.col("row").alias("low"), "high"), F.col("node") == F.col("fp")).select(
        "fp", "root", "low", "high")
    whole = written(near.unionByName(verbatim.filter("low <> high").join(
        roots.select(F.col("node").alias("fp")).hint("merge"), "fp", "left_anti").select(
        "fp", F.col("fp").alias("root"), "low", "high")), "rooted")
    linked = whole.groupBy("root").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high")
    repeated = written(whole.select("fp", "root").join(linked.select("root", "low").hint("merge"), "root"), "repeated")
    similar = lines.select("row", "start", "size", "fp").join(repeated.select("fp", "low").hint("merge"), "fp")

    def stretch(df: DataFrame, begin: str, end: str) -> DataFrame:
        return df.selectExpr("row", f"{begin} as begin", f"{end} as end", "low")

    return stretch(matched, "start", f"start + {WORDS}").unionByName(
        stretch(bridged, "start - size", f"start + {WORDS}")).unionByName(longer).unionByName(
        stretch(similar, "start", "start + size"))


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))


def united(pairs: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(pairs):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def summed(lists: pd.Series) -> pd.DataFrame:
    rows = []
    for found in lists:
        both = united([(s["begin"], s["end"]) for s in found]), united([(s["begin"], s["end"]) for s in found if s["gone"]])
        rows.append((*(sum(b - a for a, b in x) for x in both), *(",".join(f"{a}-{b}" for a, b in x) for x in both)))
    return pd.DataFrame(rows, columns=["n_repeated", "n_removed", "repeated_words", "removed_words"])


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document with a repeated passage: how many of its
    words repeat and how many of them go, since an earlier document keeps
    them, and which (first-end, end exclusive)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lists = repeated_passages(docs).groupBy("row").agg(F.collect_list(F.struct(
        "begin", "end", (F.col("row") != F.col("low")).alias("gone"))).alias("found"))
    lists = lists.join(numbered(docs, "doc_id", "text").select("row", F.col("id").alias("doc_id")), "row")
    add_up = F.pandas_udf(summed, "n_repeated long, n_removed long, repeated_words string, removed_words string")
    return lists.withColumn("sum", add_up(F.col("found"))).select("doc_id", "sum.*")
