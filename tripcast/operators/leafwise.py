"""Leaf-wise histogram boosting (M5-M8): squared loss, best-first growth to a
number of leaves, L1 and L2 leaf penalties, bagging and feature fractions per
tree, training continued from a saved model.

**Bins.**  Two aggregates give each feature's range and the counts of 4,096
cells of it; cells are joined to at most ``max_bin`` bins of about equal count
(one bin per cell if there are no more cells than that).  A bin's upper edge is
the largest value in it, so a split ``x <= edge`` says the same on bins and on
raw values.

**Growth.**  The binned rows are kept in blocks, column by column, and beside
them the bag of the next tree: the bins of its features and the gradients, all
that a pass reads.  One pass adds up, per task, gradient and row counts for
(node, feature, bin) of the nodes whose best split is not known; of two
children only the smaller is counted, the other has the rest of their parent's
sums.  A task gives one row a node, and the driver gets the sums of a node as
one row.  It replays best-first growth over the splits
known so far; children that the replay opens without knowing their best split
are the nodes of the next pass.  When the replay needs none, the tree is the
one that splitting one leaf at a time gives.  A node of at most ``LOCAL_ROWS``
rows is finished by one task that gets its rows and finds the same splits, so
a tree takes about as many passes as it has levels above such nodes.

**Exact sums.**  Gradients are rounded to 1/65,536 and summed as whole
numbers, so trees depend neither on partitioning nor on retried tasks.

Rows not equal to any number (NaN, NULL) go to the right at every split.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators.sampling import _INC, _MOD, _MUL
from tripcast.session import drop_scratch, scratch_path

# --- fixed values: booster parameters of the reference's final model -------
DEFAULT_PARAMS = {
    "stepSize": 0.1, "num_leaves": 255, "max_bin": 63, "min_data_in_leaf": 100,
    "feature_fraction": 0.8, "bagging_fraction": 0.7, "lambda_l1": 1.0, "lambda_l2": 1.0, "num_boost_round": 20,
}
CELLS = 4096
SCALE = 65536.0
BLOCK_ROWS = 1 << 17         # binned rows that are kept together
GATHER_ROWS = 1 << 18        # rows that a task holds before it sends them to their nodes
LOCAL_ROWS = 1 << 21         # rows of a node below which one task finds all its splits; the tree is the same
SUM_ROWS = 1 << 16           # rows whose gradients are added up at a time
MASKED = 32                  # share of a block below which a node's rows are kept by number
TREE_STEP = 7919             # of the draw of a row, from tree to tree
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, n long"


# ---------------------------------------------------------------- bins
def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task, some ``BLOCK_ROWS`` at a time."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def cell_of(x: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """The cells of a column's numbers in its feature's range."""
    if hi == lo:
        return np.zeros(len(x), np.int64)
    with np.errstate(invalid="ignore"):
        return np.minimum(np.nan_to_num(np.floor((x - lo) * float(CELLS) / (hi - lo)), posinf=CELLS), CELLS - 1).astype(np.int64)


def whole(x: Column) -> Column:
    """``x`` rounded, halves away from 0, as ``round`` does by way of decimal numbers."""
    near = F.rint(x)
    return F.when(F.abs(x - near) == 0.5, x + F.signum(x) * 0.5).otherwise(near).cast("long")


def ranges_of(rows: DataFrame, features: list[str], *more: Column) -> Row:
    """``lo{i}`` and ``hi{i}`` of each feature's numbers (null if it has none),
    and ``more`` aggregates of the same pass."""
    numbers = [F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features]
    return rows.agg(*[of(x).alias(f"{name}{i}") for i, x in enumerate(numbers) for name, of in (("lo", F.min), ("hi", F.max))],
                    *more).first()


def bin_edges(rows: DataFrame, features: list[str], max_bin: int, ranges: Row | None = None) -> list[np.ndarray]:
    """Upper edges of all bins but the last, for each feature: one pass (and
    another for the ranges, if they are not given), the driver gets at most
    ``CELLS`` rows a feature."""
    ranges = ranges or ranges_of(rows, features)
    ends = {i: (ranges[f"lo{i}"], ranges[f"hi{i}"]) for i in range(len(features)) if ranges[f"lo{i}"] is not None}
    numbers = rows.select(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f"f{i}") for i, f in enumerate(features)])
    seen = sorted(ends)
    if not seen:
        return [np.zeros(0) for _ in features]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, top = np.zeros((len(seen), CELLS), np.int64), np.full((len(seen), CELLS), -np.inf)
        for block in in_blocks(batches):
            for k, i in enumerate(seen):
                x = block.column(k).to_numpy()
                if (missing := np.isnan(x)).any():
                    if ends[i][0] != ends[i][1]:        # what is no number counts with the largest
                        n[k, -1] += missing.sum()
                    x = x[~missing]
                cell = cell_of(x, *ends[i])
                n[k] += np.bincount(cell, minlength=CELLS)
                np.maximum.at(top[k], cell, x)
        k, cell = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(seen, np.int32)[k]), pa.array(cell.astype(np.int32)), pa.array(n[k, cell]),
             pa.array(top[k, cell])], names=["f", "cell", "n", "top"])

    cells = numbers.select(*[f"f{i}" for i in seen]).mapInArrow(
        count, "f int, cell int, n long, top double").groupBy("f", "cell").agg(
        F.sum("n").alias("n"), F.max("top").alias("top")).toPandas()
    out = [np.zeros(0) for _ in features]
    for f, part in cells.sort_values("cell").groupby("f"):
        n, top = part["n"].to_numpy(), part["top"].to_numpy()
        number_ = np.arange(len(n))
        if len(n) > max_bin:
            number_ = max_bin * (np.cumsum(n) - n) // n.sum()
        last = np.r_[number_[1:] != number_[:-1], True]
        out[f] = top[last][:-1]
    return out


@dataclass
class Bag:
    """What a tree is grown on: its number, the features it may split on, the share of the rows."""

    number: int
    chosen: list[int]
    fraction: float


def packed(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, so that the JVM moves fewer; their kind and size come first."""
    x = np.ascontiguousarray(x)
    return x.dtype.char.encode() + x.nbytes.to_bytes(8, "little") + pa.Codec("zstd", 1).compress(x.tobytes(), asbytes=True)


def unpacked(held: pa.Buffer) -> np.ndarray:
    kind, size = held[:1].to_pybytes().decode(), int.from_bytes(held[1:9].to_pybytes(), "little")
    return np.frombuffer(pa.Codec("zstd", 1).decompress(held[9:], size), kind)


def narrow(g: np.ndarray) -> np.ndarray:
    """Whole numbers in 4 bytes each, where these hold them."""
    return g.astype(np.float32) if np.abs(g).max(initial=0.0) < 2.0 ** 24 else g


@dataclass
class Block:
    """Binned rows: their bins feature by feature, and a column for each of the
    rest; ``kept``: those that are packed already."""

    bins: np.ndarray
    label: np.ndarray
    draw: np.ndarray
    score: np.ndarray
    kept: dict[str, bytes] = field(default_factory=dict)

    def gradient(self, rows: np.ndarray) -> np.ndarray:
        return np.rint((self.label[rows] - self.score[rows]) * SCALE)

    def as_batch(self, bag: Bag | None = None) -> pa.RecordBatch:
        """As a row of ``BINNED``, with what the tree of ``bag`` is grown on."""
        parts = {"bins": self.bins, "label": self.label, "draw": self.draw, "score": self.score}
        if bag:
            rows = np.flatnonzero(drawn(self.draw, bag.number, bag.fraction))
            parts |= {"bag": np.stack([self.bins[f][rows] for f in bag.chosen]), "g": narrow(self.gradient(rows))}
        held = {k: pa.array([self.kept[k] if k in self.kept else packed(parts[k]) if k in parts else None], pa.binary())
                for k in (c.split()[0] for c in BINNED.split(", "))}
        return pa.RecordBatch.from_pydict(held)


def blocks_of(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[Block]:
    for batch in batches:
        for r in range(batch.num_rows):
            held = {name: batch.column(name)[r].as_buffer() for name in ("bins", "label", "draw", "score")}
            parts = {name: unpacked(x) for name, x in held.items()}
            kept = {name: held[name].to_pybytes() for name in ("bins", "label", "draw")}
            yield Block(parts["bins"].reshape(n_features, -1), parts["label"], parts["draw"], parts["score"], kept)


def bags_of(batches: Iterator[pa.RecordBatch], bag: Bag) -> Iterator[tuple[dict, np.ndarray]]:
    """Of each block the bins of the bag's rows, by feature, and their gradients."""
    for batch in batches:
        for r in range(batch.num_rows):
            bins, g = (unpacked(batch.column(name)[r].as_buffer()) for name in ("bag", "g"))
            if len(g):
                yield dict(zip(bag.chosen, bins.reshape(len(bag.chosen), -1), strict=True)), g.astype(np.float64)


# ---------------------------------------------------------------- trees
@dataclass
class Node:
    """A node in growth: its sums, its best split if known, its children."""

    g: int = 0
    n: int = 0
    known: bool = False
    gain: float = 0.0
    feature: int = -1
    bin: int = 0
    left_g: int = 0
    left_n: int = 0
    children: tuple = ()
    sums: tuple | None = None       # per (feature, bin), until its children's are known


@dataclass
class Tree:
    """Nodes as arrays: a leaf has feature -1 and points to itself."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    n: np.ndarray
    depth: int = field(default=0)

    def members(self, columns: np.ndarray, cuts: np.ndarray, n: int, wanted: list[int] | None = None) -> dict:
        """Which of the ``n`` rows are in each leaf (if ``wanted`` is given, in
        those); ``columns`` has a row per feature, ``cuts`` are bins or
        thresholds, as its values are.  A node's rows go down as a mask over
        all while it has many of them, then as their numbers."""
        inner = self.left != np.arange(len(self.left))
        on_way = np.ones(len(inner), bool) if wanted is None else np.isin(np.arange(len(inner)), wanted)
        for i in np.flatnonzero(inner)[::-1]:       # children come after their parent
            on_way[i] = on_way[self.left[i]] or on_way[self.right[i]]
        found = {0: np.ones(n, bool)} if on_way[0] else {}
        for i in np.flatnonzero(inner & on_way):
            here, column = found.pop(i), columns[self.feature[i]]
            if here.dtype == bool:
                goes_left = column <= cuts[i]
                goes_left &= here
                sides = goes_left, here & ~goes_left
            else:
                goes_left = column[here] <= cuts[i]
                sides = here[goes_left], here[~goes_left]
            for child, rows in zip((self.left[i], self.right[i]), sides, strict=True):
                if on_way[child]:
                    few = rows.dtype == bool and np.count_nonzero(rows) * MASKED < n
                    found[child] = np.flatnonzero(rows) if few else rows
        return {i: np.flatnonzero(rows) if rows.dtype == bool else rows for i, rows in found.items()}

    def leaf(self, x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``x``."""
        at = np.zeros(len(x), np.int64)
        for leaf, rows in self.members(x.T, cuts, len(x)).items():
            at[rows] = leaf
        return at


def soft(g: int, l1: float) -> float:
    """A sum of gradients drawn towards 0 by the L1 penalty."""
    g = g / SCALE
    return max(g - l1, 0.0) if g > 0 else min(g + l1, 0.0)


def leaf_value(g: int, n: int, p: dict) -> float:
    weight = n + p["lambda_l2"]
    return p["stepSize"] * soft(g, p["lambda_l1"]) / weight if weight else 0.0


def replay(root: Node, num_leaves: int) -> tuple[list[Node], list[Node]]:
    """Best-first growth over the splits known: (nodes in the order of the
    splits, children of a split next to each other; nodes still to be known)."""
    nodes, needed, leaves = [root], [] if root.known else [root], 1
    heap = [(-root.gain, 0)] if root.feature >= 0 else []
    while heap and leaves < num_leaves:
        _, at = heapq.heappop(heap)
        node = nodes[at]
        if not node.children:
            node.children = (Node(node.left_g, node.left_n), Node(node.g - node.left_g, node.n - node.left_n))
        leaves += 1
        for child in node.children:
            nodes.append(child)
            if child.feature >= 0:
                heapq.heappush(heap, (-child.gain, len(nodes) - 1))
            elif not child.known and leaves < num_leaves:       # of the last split none is split again
                needed.append(child)
    return nodes, needed


def as_tree(nodes: list[Node], edges: list[np.ndarray], p: dict) -> Tree:
    place = {id(node): i for i, node in enumerate(nodes)}
    split = [bool(node.children) and id(node.children[0]) in place for node in nodes]
    level = [0] * len(nodes)
    left, right = list(range(len(nodes))), list(range(len(nodes)))
    for i, node in enumerate(nodes):
        if split[i]:
            left[i], right[i] = (place[id(c)] for c in node.children)
            level[left[i]] = level[right[i]] = level[i] + 1
    return Tree(np.array([node.feature if s else 0 for node, s in zip(nodes, split, strict=True)]),
                np.array([node.bin if s else 0 for node, s in zip(nodes, split, strict=True)]),
                np.array([edges[node.feature][node.bin] if s else 0.0 for node, s in zip(nodes, split, strict=True)]),
                np.array(left), np.array(right),
                np.array([0.0 if s else leaf_value(node.g, node.n, p) for node, s in zip(nodes, split, strict=True)]),
                np.array([node.gain if s else 0.0 for node, s in zip(nodes, split, strict=True)]),
                np.array([node.n for node in nodes]), max(level))


def drawn(draw: np.ndarray, tree: int, fraction: float) -> np.ndarray:
    """The rows in the bag of a tree."""
    low = _MOD - 1          # % 2^31
    return (((draw.astype(np.int64) + tree * TREE_STEP & low) * _MUL + _INC) & low) < fraction * _MOD


def features_of(tree: int, n: int, fraction: float, seed: int) -> list[int]:
    """The features a tree may split on, as many as ``fraction`` of all, rounded up."""
    order = sorted(range(n), key=lambda f: (((seed + tree * TREE_STEP + f * 104729) % _MOD * _MUL + _INC) % _MOD, f))
    return sorted(order[:max(1, -int(-n * fraction // 1))])


SENT = "node int, bins binary, g binary"
FOUND = "node int, id int, feature int, bin int, gain double, left_g long, left_n long, children int, g binary, n binary"


def sums_of(at: np.ndarray, g: np.ndarray, n_cells: int, lift: float | None) -> np.ndarray:
    """Gradient and row counts of each cell; with ``lift`` together, as
    ``g + lift`` of each row, else one beside the other."""
    if lift:
        return np.bincount(at, g, n_cells)
    return np.stack([np.bincount(at, w, n_cells) for w in (g, None)])


def histograms(columns: Sequence[np.ndarray], g: np.ndarray, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and row counts of each (feature, bin), as whole numbers (sums
    below 2^53 are exact).  Where there are rows enough, features are counted
    two at a time.  Both counts come from one sum, of gradients lifted by a
    power of 2 above all that they add up to, ``SUM_ROWS`` rows at a time;
    where that would not be exact, each has its own."""
    g_sum, n_sum = (np.zeros((len(columns), n_bins), np.int64) for _ in range(2))
    for start in range(0, len(g), SUM_ROWS):
        here = slice(start, start + SUM_ROWS)
        part, total = g[here], np.abs(g[here]).sum()
        lift = 2.0 ** (int(total).bit_length() + 1) if total < 2.0 ** 51 else None
        lift = lift if lift and len(part) * lift + total < 2.0 ** 53 else None
        weight = part + lift if lift else part
        step = 2 if len(part) >= n_bins * n_bins else 1
        for k in range(0, len(columns), step):
            both = [c[here] for c in columns[k:k + step]]
            at = both[0]
            if len(both) == 2:      # n_bins is at most 256
                at = np.multiply(at, n_bins, dtype=np.uint16)
                at += both[1]
            shape = (n_bins,) * len(both)
            found = sums_of(at, weight, n_bins ** len(both), lift).reshape(-1, *shape)
            for i in range(len(both)):
                own = found.sum(axis=tuple(1 + j for j in range(len(both)) if j != i))
                n_here = np.rint(own[0] / lift) if lift else own[1]
                n_sum[k + i] += n_here.astype(np.int64)
                g_sum[k + i] += (own[0] - n_here * lift if lift else own[0]).astype(np.int64)
    return g_sum, n_sum


def best_split(g_sum: np.ndarray, n_sum: np.ndarray, chosen: list[int], p: dict) -> tuple | None:
    """(gain, feature, bin, left_g, left_n) of the best split of a node with
    these sums per (feature, bin); of equal ones the first."""
    left_g, left_n = g_sum.cumsum(axis=1), n_sum.cumsum(axis=1)
    g, n = left_g[0, -1], left_n[0, -1]

    def worth(total: np.ndarray, rows: np.ndarray) -> np.ndarray:
        drawn_in = np.maximum(np.abs(total / SCALE) - p["lambda_l1"], 0.0)
        return drawn_in * drawn_in / np.maximum(rows + p["lambda_l2"], 1e-300)

    gain = worth(left_g, left_n) + worth(g - left_g, n - left_n) - worth(g, n)
    least = p["min_data_in_leaf"]
    gain[(left_n < least) | (n - left_n < least) | (n == left_n)] = 0.0
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    if not gain[f, b] > 0:
        return None
    return float(gain[f, b]), chosen[f], b, int(left_g[f, b]), int(left_n[f, b])


def grow_here(columns: np.ndarray, g: np.ndarray, chosen: list[int], n_bins: int, p: dict, most: int) -> list[tuple]:
    """Best-first growth below these rows (``columns``: the bins of the chosen
    features), of ``most`` splits: (id, feature, bin, gain, left_g, left_n,
    first child's id), and the best splits of the leaves left, which have no
    child yet (-1).  Only the smaller child of a split is counted; the other
    has the rest of the sums."""
    out, members, sums, heap = [], [np.arange(len(g))], {0: histograms(columns, g, n_bins)}, []

    def consider(at: int) -> None:
        if split := best_split(*sums[at], chosen, p):
            heapq.heappush(heap, (-split[0], at, split))
        else:
            del sums[at]

    consider(0)
    while heap and len(out) < most:
        _, at, (gain, f, b, left_g, left_n) = heapq.heappop(heap)
        rows, whole = members[at], sums.pop(at)
        goes_left = columns[chosen.index(f)][rows] <= b
        first = len(members)
        out.append((at, f, b, gain, left_g, left_n, first))
        members += [rows[goes_left], rows[~goes_left]]
        members[at] = None
        small = int(len(members[first]) > len(members[first + 1]))
        part = members[first + small]
        sums[first + small] = histograms(columns[:, part], g[part], n_bins)
        sums[first + 1 - small] = tuple(a - b for a, b in zip(whole, sums[first + small], strict=True))
        consider(first)
        consider(first + 1)
    return out + [(at, f, b, gain, left_g, left_n, -1) for _, at, (gain, f, b, left_g, left_n) in heap]


def slots_of(sizes: dict[int, int], n_slots: int) -> dict[int, int]:
    """A task for each node: the largest first, to the one with the fewest rows."""
    load, out = [(0, slot) for slot in range(n_slots)], {}
    for node in sorted(sizes, key=lambda w: (-sizes[w], w)):
        rows, out[node] = heapq.heappop(load)
        heapq.heappush(load, (rows + sizes[node] + 1, out[node]))
    return out


def one_pass(rows: DataFrame, tree: Tree, counted: list[int], few: list[int], bag: Bag, n_bins: int,
             p: dict | None = None) -> tuple[dict[int, tuple], pd.DataFrame]:
    """Of the nodes (leaves of ``tree``) ``counted``: gradient and row counts of
    each (feature of the bag, bin), if they have rows.  Of the ``few``, each of
    at most ``LOCAL_ROWS`` rows, which meet in one task per node: the splits
    below them.  Such a node grows somewhat more leaves than its share of the
    rows; if the tree needs still more, it asks again.  A node may be in both:
    its counts go by the number ``-1 - node``."""
    chosen, total = bag.chosen, int(tree.n[0])
    n_chosen, sizes = len(chosen), {w: int(tree.n[w]) for w in few} | {-1 - w: 0 for w in counted}
    # twice the tasks that would be full, so that a task has few nodes beside a large one
    n_slots = min(len(sizes), max(2 * rows.sparkSession.sparkContext.defaultParallelism, 2 * sum(sizes.values()) // max(LOCAL_ROWS, 1)))
    slot = slots_of(sizes, n_slots)

    def count(sums: np.ndarray, columns: dict, g: np.ndarray, parts: dict) -> None:
        large = [k for k, w in enumerate(counted) if len(parts[w]) >= n_bins * n_bins]
        for k in large:
            at = parts[counted[k]]
            own = columns if len(at) == len(g) else {f: columns[f][at] for f in chosen}
            sums[k] += histograms([own[f] for f in chosen], g[at], n_bins)
        small = [k for k in range(len(counted)) if k not in set(large)]
        if small:       # together, in as many calls as for one
            at = np.concatenate([parts[counted[k]] for k in small])
            first = np.repeat(np.arange(len(small)) * n_bins, [len(parts[counted[k]]) for k in small])
            for i, f in enumerate(chosen):
                cell = first + columns[f][at]
                for j, w in enumerate((g[at], None)):
                    sums[small, j, i] += np.bincount(cell, w, len(small) * n_bins).astype(np.int64).reshape(len(small), n_bins)

    def as_batch(nodes: list[int], bins: list[bytes], g: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array(bins, pa.binary()), pa.array(g, pa.binary())],
                                          names=["node", "bins", "g"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, n = np.zeros((len(counted), 2, n_chosen, n_bins), np.int64), {}, 0

        def send() -> pa.RecordBatch:
            return as_batch(list(held), [np.concatenate([b for b, _ in parts], axis=1).tobytes() for parts in held.values()],
                            [narrow(np.concatenate([g for _, g in parts])).tobytes() for parts in held.values()])

        for columns, g in bags_of(batches, bag):
            parts = tree.members(columns, tree.bin, len(g), [*counted, *few])
            if counted:
                count(sums, columns, g, parts)
            for w in few:
                if len(parts[w]):
                    held.setdefault(w, []).append((np.array([columns[f][parts[w]] for f in chosen]), g[parts[w]]))
                    n += len(parts[w])
            if n >= GATHER_ROWS:
                yield send()
                held, n = {}, 0
        if held:
            yield send()
        some = [k for k in range(len(counted)) if sums[k, 1, 0].any()]
        yield as_batch([-1 - counted[k] for k in some], [sums[k, 1].tobytes() for k in some], [sums[k, 0].tobytes() for k in some])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for r, node in enumerate(batch.column("node").to_pylist()):
                held.setdefault(node, []).append(tuple(batch.column(c)[r].as_buffer() for c in ("bins", "g")))
        names = [c.split()[0] for c in FOUND.split(", ")]
        schema = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[kind])
                            for c, kind in (x.split() for x in FOUND.split(", "))])
        while held:
            node, parts = held.popitem()
            if node < 0:
                n, g = (np.sum([np.frombuffer(part[i], np.int64) for part in parts], axis=0).tobytes() for i in range(2))
                found = [(-1 - node, 0, 0, 0, 0.0, 0, 0, 0, g, n)]
            else:
                columns = np.concatenate([np.frombuffer(b, np.uint8).reshape(n_chosen, -1) for b, _ in parts], axis=1)
                kinds = [np.float64 if b.size * 8 == g.size * n_chosen else np.float32 for b, g in parts]
                g = np.concatenate([np.frombuffer(x[1], kind) for x, kind in zip(parts, kinds, strict=True)]).astype(np.float64)
                del parts
                most = min(p["num_leaves"] - 1, 32 + 4 * p["num_leaves"] * len(g) // max(total, 1))
                found = [(node, *x, None, None) for x in grow_here(columns, g, chosen, n_bins, p, most)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in found], schema)

    sent = rows.select("bag", "g").mapInArrow(read, SENT)
    where = F.element_at(F.create_map(*[F.lit(x) for w in slot for x in (w, slot[w])]), F.col("node"))
    found = sent.repartitionById(n_slots, where).mapInArrow(finish, FOUND).toPandas()
    summed = found["g"].notna()
    sums = {int(r.node): tuple(np.frombuffer(x, np.int64).reshape(n_chosen, n_bins) for x in (r.g, r.n)) for r in found[summed].itertuples()}
    return sums, found[~summed].drop(columns=["g", "n"])


def node_sums(rows: DataFrame, tree: Tree, wanted: list[int], bag: Bag, n_bins: int) -> dict[int, tuple]:
    """For each wanted node (a leaf of ``tree``) that has rows: gradient and
    row counts of each (feature of the bag, bin)."""
    return one_pass(rows, tree, wanted, [], bag, n_bins)[0]


def local_splits(rows: DataFrame, tree: Tree, wanted: list[int], bag: Bag, n_bins: int, p: dict) -> pd.DataFrame:
    """The splits below the wanted nodes, each of at most ``LOCAL_ROWS`` rows."""
    return one_pass(rows, tree, [], wanted, bag, n_bins, p)[1]


def attach(node: Node, splits: pd.DataFrame) -> None:
    """Makes the splits found below a node known."""
    places = {0: node}
    node.known = True
    for r in splits.itertuples():
        at = places[r.id]
        at.gain, at.feature, at.bin, at.left_g, at.left_n = r.gain, int(r.feature), int(r.bin), int(r.left_g), int(r.left_n)
        if r.children < 0:      # known, not split: its children are found when the tree asks for them
            continue
        at.children = (Node(at.left_g, at.left_n, True), Node(at.g - at.left_g, at.n - at.left_n, True))
        places[r.children], places[r.children + 1] = at.children


def grow(rows: DataFrame, bag: Bag, edges: list[np.ndarray], p: dict) -> Tree:
    """One tree on blocks of binned rows that hold its bag."""
    n_bins = max(len(e) for e in edges) + 1
    root = Node()
    nodes, needed = replay(root, p["num_leaves"])
    while needed:
        place, so_far = {id(node): i for i, node in enumerate(nodes)}, as_tree(nodes, edges, p)
        few = [c for c in needed if c is not root and c.n <= LOCAL_ROWS]
        many = {id(c): c for c in needed if c is root or c.n > LOCAL_ROWS}
        parents = [node for node in nodes if any(id(c) in many for c in node.children)]
        counted = [root] if root in many.values() else [min(node.children, key=lambda c: c.n) for node in parents]
        at, small, found = [place[id(c)] for c in counted], [place[id(c)] for c in few], {}
        if at and small:
            found, below = one_pass(rows, so_far, at, small, bag, n_bins, p)
        elif at:
            found = node_sums(rows, so_far, at, bag, n_bins)
        else:
            below = local_splits(rows, so_far, small, bag, n_bins, p)
        for node in counted:
            node.sums = found.get(place[id(node)])
        for parent in parents:
            small = min(parent.children, key=lambda c: c.n)
            other = parent.children[small is parent.children[0]]
            other.sums = tuple(a - b for a, b in zip(parent.sums, small.sums, strict=True))
            parent.sums = None
        for node in many.values():
            node.known = True
            if node.sums:
                node.g, node.n = int(node.sums[0][0].sum()), int(node.sums[1][0].sum())
                if split := best_split(*node.sums, bag.chosen, p):
                    node.gain, node.feature, node.bin, node.left_g, node.left_n = split
        finished = dict(list(below.groupby("node"))) if few else {}
        for node in few:
            attach(node, finished.get(place[id(node)], pd.DataFrame()))
        nodes, needed = replay(root, p["num_leaves"])
    return as_tree(nodes, edges, p)


# ---------------------------------------------------------------- the model
class TreeWriter(MLWriter):
    def __init__(self, model: "BoostedTrees"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.node_table(self.sparkSession).coalesce(1).write.parquet(f"{path}/nodes")


class TreeReader(MLReader):
    def load(self, path: str) -> "BoostedTrees":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedTrees()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.trees = trees_from(self.sparkSession.read.parquet(f"{path}/nodes").toPandas())
        return model


def trees_from(nodes: pd.DataFrame) -> list[Tree]:
    """Trees from a node table (leaves have feature -1)."""
    out = []
    for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
        left, right = t["left"].to_numpy(), t["right"].to_numpy()
        level = np.zeros(len(t), np.int64)
        for i in np.flatnonzero(t["feature"].to_numpy() >= 0):      # children come after their parent
            level[[left[i], right[i]]] = level[i] + 1
        out.append(Tree(np.maximum(t["feature"].to_numpy(), 0), np.zeros(len(t), np.int64), t["threshold"].to_numpy(),
                        left, right, t["value"].to_numpy(), t["gain"].to_numpy(), t["n"].to_numpy(), int(level.max())))
    return out


class BoostedTrees(Transformer, MLWritable, MLReadable):
    """A boosted ensemble: ``base`` plus the value of one leaf of each tree.

    Scores in Arrow batches, all rows of a batch moving down a tree together:
    measured as fast as the same trees as one compiled CASE expression, and
    its plan does not grow with the trees.  Saves its node table as parquet
    beside the metadata, and training may go on from a loaded model.
    """

    featureCols = Param(Params._dummy(), "featureCols", "features, in the order of the node table", TypeConverters.toListString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "score before the first tree", TypeConverters.toFloat)

    def __init__(self, features: list[str] | None = None, base: float = 0.0, trees: list[Tree] | None = None,
                 prediction: str = "log_correction"):
        super().__init__()
        self.trees: list[Tree] = list(trees or [])
        self._set(featureCols=list(features or S.FEATURE_COLUMNS), base=float(base), predictionCol=prediction)

    def write(self) -> MLWriter:
        return TreeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TreeReader()

    def first_trees(self, n: int) -> "BoostedTrees":
        return BoostedTrees(self.getOrDefault(self.featureCols), self.getOrDefault(self.base), self.trees[:n],
                            self.getOrDefault(self.predictionCol))

    def node_rows(self) -> pd.DataFrame:
        parts = [pd.DataFrame({"tree": k, "node": np.arange(len(t.left)),
                               "feature": np.where(t.left == np.arange(len(t.left)), -1, t.feature), "threshold": t.threshold,
                               "left": t.left, "right": t.right, "value": t.value, "gain": t.gain, "n": t.n})
                 for k, t in enumerate(self.trees)]
        columns = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
        return pd.concat(parts, ignore_index=True)[columns] if parts else pd.DataFrame(columns=columns)

    def node_table(self, spark) -> DataFrame:
        rows = list(self.node_rows().itertuples(index=False, name=None))
        return spark.createDataFrame([tuple(x.item() if hasattr(x, "item") else x for x in r) for r in rows], NODE_SCHEMA)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.getOrDefault(self.base))
        for t in self.trees:
            total += t.value[t.leaf(x, t.threshold)]
        return total

    def numbers(self) -> list:
        return [F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in self.getOrDefault(self.featureCols)]

    def _transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(self.score(np.stack([c.to_numpy(np.float64) for c in columns]).T))

        return df.withColumn(self.getOrDefault(self.predictionCol), score(*self.numbers()))


# ---------------------------------------------------------------- fitting
BINNED = "bins binary, label binary, draw binary, score binary, bag binary, g binary"


def binned(train: DataFrame, model: BoostedTrees, edges: list[np.ndarray], label: str, draw: str, bag: Bag | None = None) -> DataFrame:
    """Blocks of rows: a byte per feature, its bin, and label, draw and the
    score of the trees so far; and the next tree's bag."""
    n = len(edges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_blocks(batches):
            x = np.stack([rows.column(i).to_numpy() for i in range(n)])
            bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x, strict=True)]).astype(np.uint8)
            drawn_by = (rows.column(n + 1).to_numpy() % _MOD).astype(np.int32)      # bagging goes by no more of it
            yield Block(bins, rows.column(n).to_numpy(), drawn_by, model.score(x.T)).as_batch(bag)

    numbers = [c.alias(f"f{i}") for i, c in enumerate(model.numbers())]
    return train.select(*numbers, F.col(label).cast("double").alias("label"), F.col(draw).cast("long").alias("draw")).mapInArrow(
        cut, BINNED)


def rescored(rows: DataFrame, tree: Tree, n: int, bag: Bag) -> DataFrame:
    """The binned rows with the tree's values added to their scores, and the
    next tree's bag."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, n):
            block.score = block.score + tree.value[tree.leaf(block.bins.T, tree.bin)]
            yield block.as_batch(bag)

    return rows.select("bins", "label", "draw", "score").mapInArrow(step, BINNED)


@dataclass
class Prepared:
    """What the fits of several candidates on the same rows have in common."""

    edges: list[np.ndarray]
    model: BoostedTrees
    first: str          # the binned rows with the first tree's bag


def written_blocks(rows: DataFrame) -> str:
    path = scratch_path(rows.sparkSession, "binned")
    # blocks are packed already; small row groups: a reader holds one of them at a time
    rows.write.options(**{"compression": "none", "parquet.block.size": str(1 << 24)}).parquet(path)
    return path


def bag_of(number: int, n_features: int, p: dict, seed: int) -> Bag:
    return Bag(number, features_of(number, n_features, p["feature_fraction"], seed), p["bagging_fraction"])


def prepare(train: DataFrame, p: dict, features: list[str], label: str = "label", draw: str = "draw", seed: int = 42,
            start: BoostedTrees | None = None, prediction: str = "log_correction") -> Prepared:
    """Bins, the score before the first (new) tree, and the binned rows, written."""
    total = ranges_of(train, features, F.sum(whole(F.col(label) * SCALE)).alias("g"), F.count(label).alias("n"))
    edges = bin_edges(train, features, p["max_bin"], total)
    model = start.first_trees(len(start.trees)) if start else BoostedTrees(
        features, total["g"] / total["n"] / SCALE if total["n"] else 0.0, [], prediction)
    bag = bag_of(len(model.trees), len(features), p, seed)
    return Prepared(edges, model, written_blocks(binned(train.filter(F.col(label).isNotNull()), model, edges, label, draw, bag)))


def fit(train: DataFrame, params: dict | None = None, rounds: int | None = None, features: list[str] | None = None,
        label: str = "label", draw: str = "draw", seed: int = 42, start: BoostedTrees | None = None,
        prediction: str = "log_correction", prepared: Prepared | None = None) -> BoostedTrees:
    """M5: a booster on the rows of ``train``; ``draw`` is a whole number per
    row (0 to 2^31 - 1) that bagging goes by.  With ``start`` training goes
    on: its trees give the first scores and the new ones are added to it.

    The binned rows are written once, and again with the new score after each
    tree; the table before is dropped then.  Rows ``prepared`` by the caller
    (for these features and fractions) are left for their owner to drop."""
    p = {**DEFAULT_PARAMS, **(params or {})}
    features = list(features or S.FEATURE_COLUMNS)
    spark, rounds = train.sparkSession, rounds or p["num_boost_round"]
    own = prepared or prepare(train, p, features, label, draw, seed, start, prediction)
    model, path = own.model.first_trees(len(own.model.trees)), own.first
    for k in range(rounds):
        held, number = spark.read.schema(BINNED).parquet(path), len(model.trees)
        model.trees.append(grow(held, bag_of(number, len(features), p, seed), own.edges, p))
        if k + 1 < rounds:
            before, path = path, written_blocks(rescored(held, model.trees[-1], len(features), bag_of(number + 1, len(features), p, seed)))
            if not (prepared and before == prepared.first):
                drop_scratch(spark, before)
    if not (prepared and path == prepared.first):
        drop_scratch(spark, path)
    return model


def losses_of(models: list[BoostedTrees], valid: DataFrame, label: str = "label") -> list[list[float]]:
    """M7: for each model (all of the same features) the mean squared error of
    its first 1, 2, ... trees, in one pass: each task adds up one sum per model
    and number of trees.  Tasks' sums are added in their own order, so trees
    that change nothing leave the loss as it is."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [np.zeros(len(m.trees)) for m in models], 0
        for rows in in_blocks(batches):
            x = np.stack([c.to_numpy() for c in rows.columns[:-1]]).T
            for own, model in zip(total, models, strict=True):
                error = model.getOrDefault(model.base) - rows.columns[-1].to_numpy()
                for k, t in enumerate(model.trees):
                    error = error + t.value[t.leaf(x, t.threshold)]
                    own[k] += (error ** 2).sum()
            n += len(x)
        for m, own in enumerate(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), m, np.int32)), pa.array(np.arange(len(own), dtype=np.int32)),
                                              pa.array(own), pa.array(np.full(len(own), n))], names=["model", "tree", "e", "n"])

    numbers = [c.alias(f"f{i}") for i, c in enumerate(models[0].numbers())]
    found = valid.select(*numbers, F.col(label).cast("double").alias("label")).mapInArrow(
        measure, "model int, tree int, e double, n long").groupBy("model", "tree").agg(
        F.aggregate(F.sort_array(F.collect_list("e")), F.lit(0.0), lambda a, b: a + b).alias("e"), F.sum("n").alias("n")).orderBy("model", "tree").collect()
    return [[r["e"] / r["n"] if r["n"] else float("nan") for r in found if r["model"] == m] for m in range(len(models))]


def losses(model: BoostedTrees, valid: DataFrame, label: str = "label") -> list[float]:
    """M7: the losses of one model."""
    return losses_of([model], valid, label)[0]


def first_minimum(found: list[float]) -> int:
    return min(range(len(found)), key=lambda i: (found[i], i)) + 1


def best_prefix(model: BoostedTrees, valid: DataFrame, label: str = "label") -> tuple[int, list[float]]:
    """M7: the best number of trees (the first minimum) and all losses: with a
    patience of at least the rounds, early stopping only picks the best."""
    found = losses(model, valid, label)
    return first_minimum(found), found


def fit_incremental(train: DataFrame, group_col: str, params: dict | None = None, trees_per_group: int = 2,
                    start: BoostedTrees | None = None, features: list[str] | None = None, label: str = "label",
                    draw: str = "draw", seed: int = 42) -> BoostedTrees:
    """M6: boosting continued group by group, ``trees_per_group`` trees on each
    group's rows.  The matrix is written once, partitioned by group, so a
    group is read alone and scored once by the ensemble so far; ``start`` (a
    loaded model, for instance) goes on with more groups."""
    spark = train.sparkSession
    features = list(features or S.FEATURE_COLUMNS)
    path = scratch_path(spark, "incremental-train")
    stored = train.select(*features, label, draw, F.col(group_col).alias("group__"))
    stored.write.partitionBy("group__").parquet(path)
    rows = spark.read.schema(stored.schema).parquet(path)
    groups = sorted(r[0] for r in rows.select("group__").distinct().collect())
    model = start
    for g in groups:
        model = fit(rows.filter(F.col("group__") == g).drop("group__"), params, trees_per_group, features, label, draw, seed, model)
    drop_scratch(spark, path)
    return model


def grid_search(train: DataFrame, valid: DataFrame, grid: list[dict], evaluate: Callable[[BoostedTrees], dict],
                rounds: int | None = None, parallelism: int = 2, seed: int = 42) -> list[dict]:
    """M8: fit every candidate on the training rows, which are binned once for
    all (several at once, from a pool of driver threads), cut each to its best
    prefix on ``valid`` and score it with ``evaluate``.  One dict per run, in
    grid order."""

    shared = ("max_bin", "feature_fraction", "bagging_fraction")        # by which the first binned rows may differ
    kinds = [tuple({**DEFAULT_PARAMS, **params}[c] for c in shared) for params in grid]
    prepared = {kind: prepare(train, {**DEFAULT_PARAMS, **dict(zip(shared, kind, strict=True))}, list(S.FEATURE_COLUMNS), seed=seed)
                for kind in dict.fromkeys(kinds)}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(lambda i: fit(train, grid[i], rounds, seed=seed, prepared=prepared[kinds[i]]), range(len(grid))))
        for own in prepared.values():
            drop_scratch(train.sparkSession, own.first)
        found = losses_of(models, valid) if models else []
        best = [first_minimum(own) for own in found]
        scores = list(pool.map(lambda i: evaluate(models[i].first_trees(best[i])), range(len(grid))))
    return [{"run_no": i, **{k: float(v) for k, v in params.items()}, "rounds": len(found[i]), "best_iteration": best[i], **scores[i]}
            for i, params in enumerate(grid)]
