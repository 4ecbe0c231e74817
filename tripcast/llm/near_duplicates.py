"""Near-duplicate documents by a MinHash LSH forest.

1. Each text becomes its set of word shingles, a fingerprint of that set and a
   signature of ``TREES * DEPTH`` min-hashes.  Texts with one fingerprint are
   one class; from here on a class counts once, however many copies it has.
2. Each tree is a sort order: classes by the tree's own ``DEPTH`` min-hashes.
   In sorted order classes with a long common prefix stand together.  A run of
   neighbours that share at least ``least_depth`` min-hashes is a region.  In
   a region of up to ``REGION`` classes all are candidates of each other.  In
   a larger one each class takes the ``NEAR`` classes beside it, whose common
   prefix is longest, and the ``HUBS`` classes that agree best with the
   region's most frequent min-hashes, to which any class of one group of
   copies is closest.  That links most groups of copies cheaply.
3. Candidates that agree in too few min-hashes to be similar are passed over;
   every other pair is confirmed on the full sets.
4. Links become components by contraction.
5. The rest of the large regions: wherever one still holds several components,
   all its pairs of different components are compared, block by block, so a
   region of any size is many tasks of bounded size.  A pair that met in an
   earlier tree is not compared again.  The links found join the components.

Sort orders are dealt to tasks by ranges, which spreads a large region over
many tasks; the first and last classes of each range are paired across the
cut in a second step.

Cases: null, empty and wordless texts have no shingles, are linked with
nothing and form components of their own; a null id takes part and can't be a
component's id unless it is alone; equal rows are in one component; texts are
taken whole; empty tables give no rows; extra columns are kept if asked for,
and refused if named like an added one.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcast.llm.common import table, written
from tripcast.llm.components import components
from tripcast.llm.shingles import Shingler

WORDS, PERCENT = 5, 80       # shingle length and least similarity, unless the caller names others
TREES, DEPTH = 16, 8
MISS = 2e-5                  # chance that no tree brings a pair of just enough similarity together
REGION, NEAR, HUBS = 32, 6, 8
BLOCK = 4096                 # classes of one region looked at together
EDGE = 32                    # classes at either end of a range paired across the cut
REST_ROWS, REST_SHINGLES = 2048, 1_000_000   # of a large region compared in one task with as many others
ROWS_PER_RANGE = 200_000
SET_CACHE = 512
ROWS_AT_ONCE = 1000          # rows a task sketches before it hands them on
SEED = 9
ADDED = ("n_shingles", "component_id", "kept")
INNER = ("row__", "z__", "fp__", "sig__", "sketch__")

_RNG = np.random.default_rng(SEED)
_MUL = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """16 bits of each of the ``TREES * DEPTH`` min-hashes."""
    low = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(low, (shingles[None, i:i + 2048] * _MUL[:, None] + _ADD[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint16)


def least_depth(percent: int, trees: int = TREES) -> int:
    """Deepest common prefix that some tree still gives a pair of ``percent``
    similarity but for a chance of ``MISS``."""
    return max(1, max(d for d in range(1, DEPTH + 1) if d == 1 or (1 - (percent / 100) ** d) ** trees <= MISS))


def least_agreement(percent: int) -> float:
    """Share of equal 2-bit min-hashes below which a similar pair practically
    never falls (4.5 standard deviations)."""
    p = percent / 100 + (1 - percent / 100) / 4
    return p - 4.5 * (p * (1 - p) / (TREES * DEPTH)) ** 0.5


def sketched(docs: DataFrame, words: int, text: str) -> DataFrame:
    """All columns but the text, plus the row's number, its text compressed
    and its set's size, fingerprint, signature and 2-bit sketch."""
    rest = [c for c in docs.columns if c != text]
    rows = docs.withColumn("row__", F.monotonically_increasing_id())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, pack = Shingler(words), zstandard.ZstdCompressor(level=3).compress

        def sketch_part(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, out = batch.column(text).to_pylist(), []
            for t, s in zip(texts, shingler.sets(texts), strict=True):
                z = None if t is None else pack(t.encode("utf-8", "surrogatepass"))
                if not len(s):
                    out.append((z, 0, None, None, None))
                    continue
                sig = min_hashes(s)
                two = (sig & 3).astype(np.uint8).reshape(-1, 4)
                out.append((z, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                            sig.astype(">u2").tobytes(), (two @ np.array([64, 16, 4, 1], np.uint8)).tobytes()))
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in [*rest, "row__"]), *columns],
                names=[*rest, "row__", "z__", "n_shingles", "fp__", "sig__", "sketch__"])

        for batch in batches:
            for a in range(0, len(batch), ROWS_AT_ONCE):
                yield sketch_part(batch.slice(a, ROWS_AT_ONCE))

    made = T.StructType().add("row__", "long").add("z__", "binary").add("n_shingles", "long").add(
        "fp__", "binary").add("sig__", "binary").add("sketch__", "binary")
    schema = T.StructType([*(docs.schema[c] for c in rest), *made.fields])
    return written(rows.mapInArrow(sketch, schema), "sketches")


def neighbours(key: np.ndarray, sketch: np.ndarray, depth: int,
               agreement: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs (numbers of rows) among rows in sorted order, of one
    tree each, and the rows of large regions."""
    equal = key[1:] == key[:-1]
    prefix = np.where(equal.all(axis=1), key.shape[1], equal.argmin(axis=1))
    cuts = np.flatnonzero(np.r_[True, prefix < depth, True])
    left, right, large = [], [], [np.zeros(0, np.int64)]
    bits = ((sketch[:, :, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).reshape(len(sketch), -1)
    for a, b in zip(cuts, cuts[1:], strict=False):
        m = b - a
        if m < 2:
            continue
        if m <= REGION:
            i, j = np.triu_indices(m, 1)
        else:
            large.append(np.arange(a, b))
            i = np.concatenate([np.arange(m - d) for d in range(1, NEAR + 1)])
            j = np.concatenate([np.arange(d, m) for d in range(1, NEAR + 1)])
            here = bits[a:b]
            common = np.stack([(here == v).sum(axis=0) for v in range(4)]).argmax(axis=0)
            hubs = np.argsort(-(here == common).sum(axis=1), kind="stable")[:HUBS]
            i, j = np.r_[i, np.repeat(hubs, m)], np.r_[j, np.tile(np.arange(m), len(hubs))]
        left.append(a + i)
        right.append(a + j)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), large[0]
    i, j = np.concatenate(left), np.concatenate(right)
    near = np.concatenate([(bits[i[k:k + 65536]] == bits[j[k:k + 65536]]).mean(axis=1) >= agreement
                           for k in range(0, len(i), 65536)])
    return i[near & (i != j)], j[near & (i != j)], np.concatenate(large)


def pairs_of(rows: pd.DataFrame, depth: int, agreement: float) -> pd.DataFrame:
    """Candidates among sorted rows; the tree counts as the first part of the
    key.  Then the rows of large regions: the class as ``a``, no ``b``, its
    tree and the region's common prefix."""
    tree = rows["tree"].to_numpy(np.uint16)
    key = np.frombuffer(b"".join(rows["key"]), ">u2").reshape(len(rows), DEPTH)
    key = np.concatenate([tree[:, None], key], axis=1)
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
    i, j, large = neighbours(key, sketch, depth + 1, agreement)
    fp = rows["fp"].to_numpy()
    pairs = pd.DataFrame([(x, y) if x < y else (y, x) for x, y in zip(fp[i], fp[j], strict=True)],
                         columns=["a", "b"]).drop_duplicates().assign(tree=None, prefix=None)
    members = pd.DataFrame({"a": fp[large], "b": None, "tree": tree[large],
                            "prefix": [k[:2 * depth] for k in rows["key"].to_numpy()[large]]})
    return pd.concat([x.astype(object) for x in (pairs, members)], ignore_index=True)


def candidates(classes: DataFrame, depth: int, agreement: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) with a < b: pairs of fingerprints that some tree brings together;
    and (fp, tree, prefix): the classes of each large region."""
    rows = classes.select("fp", "sketch", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.substring("sig", t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)))).alias("tree", "key"))
    ranges = max(1, -(-classes.count() * TREES // ROWS_PER_RANGE))
    order = ["tree", "key", "fp"]
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId()

        def edge(part: pd.DataFrame, cut: int, side: int) -> pd.DataFrame:
            return part.assign(cut=cut, place=np.arange(len(part)) + side * EDGE)

        held = None
        for pdf in batches:
            for k in range(0, len(pdf), BLOCK):
                part = pdf.iloc[k:k + BLOCK]
                if held is None and len(part):
                    yield edge(part.head(EDGE), number - 1, 1)
                block = part if held is None else pd.concat([held, part], ignore_index=True)
                yield pairs_of(block, depth, agreement)
                held = block.tail(EDGE)
        if held is not None:
            yield edge(held, number, 0)

    columns = ["a", "b", "prefix", "cut", "place", "tree", "key", "sketch", "fp"]

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in walk(batches):
            out = pdf.reindex(columns=columns)
            yield out.astype({c: "Int64" for c in ("cut", "place", "tree")})

    found = written(ordered.mapInPandas(
        filled, "a binary, b binary, prefix binary, cut long, place long, tree long, key binary, sketch binary, fp binary"), "forest")

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        return pairs_of(pdf.sort_values("place"), depth, agreement)

    cut = written(found.filter("cut is not null").drop("a", "b", "prefix").groupBy("cut").applyInPandas(
        across, "a binary, b binary, tree long, prefix binary"), "forest-cuts")
    both = found.filter("a is not null").select("a", "b", "tree", "prefix").union(cut)
    return (both.filter("b is not null").select("a", "b").distinct(),
            both.filter("prefix is not null").select(F.col("a").alias("fp"), "tree", "prefix").distinct())


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity; ``texts``: (fp, z)."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, unpack = Shingler(words), zstandard.ZstdDecompressor().decompress
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def get(fp: bytes, z: bytes) -> np.ndarray:
            if fp not in known:
                known[fp] = next(shingler.sets([unpack(z).decode("utf-8", "surrogatepass")]))
                if len(known) > SET_CACHE:
                    known.popitem(last=False)
            known.move_to_end(fp)
            return known[fp]

        for pdf in batches:
            good = []
            for a, b, za, zb in zip(pdf["a"], pdf["b"], pdf["za"], pdf["zb"], strict=True):
                x, y = get(a, za), get(b, zb)
                # of the smaller set at least this share must be common, so sizes alone may rule a pair out
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    # one plan at every size: both sides sorted, which also lets Spark split a class with many candidates
    half = pairs.join(texts.select(F.col("fp").alias("a"), F.col("z").alias("za")).hint("merge"), "a")
    whole = half.join(texts.select(F.col("fp").alias("b"), F.col("z").alias("zb")).hint("merge"), "b")
    return whole.select("a", "b", "za", "zb").mapInPandas(check, "a binary, b binary")


def rest_links(rows: pd.DataFrame, words: int, percent: int, depth: int, agreement: float) -> pd.DataFrame:
    """Links between components (root a, root b) among the rows of two blocks
    of a large region, or of one block with itself: all pairs are compared but
    those of one component and those that met in an earlier tree."""
    rows = rows.sort_values("block", ignore_index=True)
    unpack = zstandard.ZstdDecompressor().decompress
    sets = list(Shingler(words).sets([unpack(z).decode("utf-8", "surrogatepass") for z in rows["z"]]))
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    del sets
    marked = np.zeros(len(known), bool)
    sketch = np.frombuffer(b"".join(rows["sketch"]), "<u8").reshape(len(rows), -1)
    sig = np.frombuffer(b"".join(rows["sig"]), ">u2").reshape(len(rows), TREES, DEPTH)
    # the regions of the earlier trees, 64 bits of prefix to a number
    wide = np.zeros((len(rows), TREES, -(-depth // 4) * 4), "<u2")
    wide[:, :, :depth] = sig[:, :, :depth]
    earlier = wide.view("<u8")[:, :int(rows["tree"][0])]
    roots = rows["root"].to_numpy()
    label = pd.factorize(roots)[0]
    block = rows["block"].to_numpy()
    second = int(np.searchsorted(block, block[0], side="right"))
    alone = rows["lo"][0] == rows["hi"][0]
    odd, least = np.uint64(0x5555555555555555), agreement * TREES * DEPTH
    out = []
    for i in range(len(rows) if alone else second):
        first = i + 1 if alone else second
        j = first + np.flatnonzero(label[first:] != label[i])
        j = j[100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])]
        differ = sketch[j] ^ sketch[i]
        same = TREES * DEPTH - np.bitwise_count((differ | (differ >> np.uint64(1))) & odd).sum(axis=1, dtype=np.int64)
        j = j[same >= least]
        if earlier.shape[1]:
            j = j[~(earlier[j] == earlier[i]).all(axis=2).any(axis=1)]
        if not len(j):
            continue
        marked[flat[ends[i] - sizes[i]:ends[i]]] = True
        begin = np.cumsum(sizes[j]) - sizes[j]
        at = np.arange(sizes[j].sum()) + np.repeat(ends[j] - sizes[j] - begin, sizes[j])
        both = np.add.reduceat(marked[flat[at]], begin, dtype=np.int64)
        marked[flat[ends[i] - sizes[i]:ends[i]]] = False
        for k in j[100 * both >= percent * (sizes[i] + sizes[j] - both)]:
            if label[k] != label[i]:
                out.append((roots[i], roots[k]))
                label[label == label[k]] = label[i]
    return pd.DataFrame(out, columns=["a", "b"])


def rest_of_regions(large: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int, depth: int,
                    agreement: float) -> DataFrame:
    """(a, b): links between the components that large regions still hold.
    ``large``: (fp, tree, prefix); ``classes``: (fp, root, sig, sketch, n);
    ``texts``: (fp, z)."""
    region = ["tree", "prefix"]
    members = written(large.join(classes.select("fp", "root", "n").hint("merge"), "fp"), "region-classes")
    # a block with all others of its region, itself included; more blocks where sets are long
    count = F.ceil(F.greatest(F.count(F.lit(1)) / REST_ROWS, F.sum("n") / REST_SHINGLES)).alias("blocks")
    mixed = written(members.groupBy(*region).agg(count, F.min("root").alias("low"), F.max("root").alias("high"))
                    .filter("low <> high").select(*region, "blocks"), "mixed-regions")
    parts = members.join(mixed.hint("merge"), region).withColumn("block", F.pmod(F.xxhash64("fp"), "blocks"))
    parts = written(parts.select("fp", "root", *region, "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(
        "other")).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other"), "region-blocks")
    full = classes.select("fp", "sig", "sketch").join(
        parts.select("fp").distinct().hint("merge"), "fp", "left_semi").join(texts.hint("merge"), "fp")
    met = parts.join(written(full, "region-texts").hint("merge"), "fp")
    return met.groupBy(*region, "lo", "hi").applyInPandas(
        lambda rows: rest_links(rows, words, percent, depth, agreement), "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id",
                    text: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows of ``docs`` (without the text unless ``keep_text``) with
    ``n_shingles``, ``component_id``, ``kept`` (the id is the component's) and
    ``first`` (one row of each component)."""
    if clash := {*ADDED, *INNER, "first"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")
    rows = sketched(docs, words, text)
    # of a class the row with the smallest id stands for it, by its number if the id repeats
    classes = written(rows.filter("fp__ is not null").groupBy(F.col("fp__").alias("fp")).agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("row__").alias("row"))).alias("rep"),
        F.min("sig__").alias("sig"), F.min("sketch__").alias("sketch"), F.min("n_shingles").alias("n")), "classes")

    depth, agreement = least_depth(percent), least_agreement(percent)
    pairs, large = (written(found, name) for found, name in zip(
        candidates(classes.select("fp", "sig", "sketch"), depth, agreement), ("candidates", "large-regions"), strict=True))
    nodes = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(large.select("fp")).distinct()
    wanted = written(classes.select("fp", F.col("rep.row").alias("row")).join(nodes.hint("merge"), "fp", "left_semi"), "nodes")
    texts = written(rows.select(F.col("fp__").alias("fp"), F.col("row__").alias("row"), F.col("z__").alias("z")).join(
        wanted.hint("merge"), ["fp", "row"]).select("fp", "z"), "node-texts")
    roots = components(confirmed(pairs, texts, words, percent))

    rooted = classes.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fp"))
    joined = rooted.select("fp", "rep", "root")
    if not large.isEmpty():
        more = components(rest_of_regions(large, rooted, texts, words, percent, depth, agreement))
        joined = joined.join(more.withColumnRenamed("root", "top").hint("merge"), F.col("root") == F.col("node"), "left").select(
            "fp", "rep", F.coalesce("top", "root").alias("root"))
    best = written(joined.groupBy("root").agg(F.min("rep").alias("best")), "component-ids")
    known = written(joined.join(best.hint("merge"), "root").select("fp", "best"), "class-ids")
    out = rows.drop("sig__", "sketch__") if keep_text else rows.drop("sig__", "sketch__", "z__")
    out = out.join(known.hint("merge"), F.col("fp__") == F.col("fp"), "left")
    out = out.withColumn("component_id", F.coalesce("best.id", F.col(key))).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id"))).withColumn(
        "first", F.col("best").isNull() | (F.col("best.row") == F.col("row__")))
    if not keep_text:
        return out.drop("row__", "fp__", "fp", "best")

    @F.pandas_udf("string")
    def unpacked(packed: pd.Series) -> pd.Series:
        unpack = zstandard.ZstdDecompressor().decompress
        return packed.map(lambda z: None if z is None else unpack(z).decode("utf-8", "surrogatepass"))

    return out.withColumn(text, unpacked("z__")).select(*docs.columns, *ADDED, "first")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, words=3, percent=85, keep_text=False).select(
        "doc_id", "n_shingles", "component_id", "kept")
