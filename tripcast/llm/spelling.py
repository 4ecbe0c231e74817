"""Spelling variants grouped by k-d trees over letter-count vectors.

One edit (a code point inserted, deleted or replaced) changes the vector of a
word's letter counts by at most two in L1: by one where the lengths differ, by
two where they are equal.  So near words are searched in k-d trees over the
distinct vectors of one length, by boxes: a word looks among the words of its
own length within distance two, and among those one letter longer within
distance one.  What the trees give is verified by the order of the letters.

1. Words are counted per task before they are shuffled.
2. For each length a k-d tree over a bounded sample of vectors (``SAMPLE``
   words in all, those with the smallest hashes) cuts the space into cells.
   The sample places the cuts only: every word has the cell that holds its
   vector, and is sent to each other cell whose box its search reaches.
3. In a cell the vectors of its words make another k-d tree, searched by all
   that came.  Words with equal vectors (anagrams) share a point.  Points in
   reach are compared word by word, or, where they hold many words, by the
   words with one letter left out, which takes time in proportion to the
   words; either way gives the same links.
4. A word's form is its near word of largest count, if that is at least
   ``RATIO`` times its own; roots follow forms by doubling, so their rounds
   grow with the logarithm of a chain that is itself logarithmic in counts.

Each pair is found once: the shorter word asks the longer, and of two equally
long words the one whose vector is smaller at the first difference.

Cases: null, empty and letterless texts have no words; a null id counts as the
empty text before the colon; repeated rows count again; a word near none has
``n_near`` 0 and no form; ties between forms go to the smallest word by code
points; an empty table gives no rows; texts are taken whole, however long a
run of letters is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import crc32_sql, table, with_crc32, written
from tripcast.llm.decontaminate import FOLD, LOWER, UPPER

LEAST_LENGTH, LEAST_COUNT, RATIO, SLIP = 6, 5, 5, 199
SAMPLE = 50_000              # words that place the cells' cuts
CELL = 2_000                 # words a cell should hold, as far as the sample goes
LEAF = 24                    # points of a leaf of the tree in a cell
HELD = 200_000               # different words a task counts before it hands them on
COMPARED = 1 << 22           # numbers compared at once
MANY = 4_096                 # word pairs of two points from which letters left out are matched
#: fixed values: the contract's runs, and their code points after folding, one dimension each
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
DIMENSION = np.full(256, -1, np.int64)
DIMENSION[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def slipped(key: str, run: str) -> str:
    """The run, or where ``SLIP`` divides its hash the run less one letter."""
    h = zlib.crc32(f"{key}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all words of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()),
                                              "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return out

        for batch in batches:
            for k, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for run, n in Counter(RUN.findall((t or "").translate(FOLD))).items():
                    word = slipped(k or "", run)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= HELD:
                    yield counted()
        yield counted()

    return (docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
            .mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def coded(words: list[str]) -> np.ndarray:
    """Letters of words of one length as their code points, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word."""
    n, length = codes.shape
    flat = np.arange(n)[:, None] * len(LETTERS) + DIMENSION[codes]
    return np.bincount(flat.ravel(), minlength=n * len(LETTERS)).reshape(n, -1).astype(
        np.int16 if length < 2**15 else np.int32)


class Tree:
    """A k-d tree: inner nodes are (dimension, cut, left, right) with counts of
    at most ``cut`` to the left; a leaf is a number."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.members: list[np.ndarray] = []      # of each leaf
        self.root = self._grow(points, np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int):
        if len(rows) > leaf:
            here = points[rows].astype(np.float32)
            dim = int(here.var(axis=0).argmax())
            values = np.sort(here[:, dim])
            if values[0] < values[-1]:
                cut = int(values[(len(values) - 1) // 2])
                cut -= cut == values[-1]
                left = points[rows, dim] <= cut
                return dim, cut, self._grow(points, rows[left], leaf), self._grow(points, rows[~left], leaf)
        self.members.append(rows)
        return len(self.members) - 1

    def reached(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) wherever a leaf's box holds a point that has at most
        ``up`` letters more and ``down`` letters fewer than the query."""
        most = np.iinfo(queries.dtype).max
        rows = np.arange(len(queries))
        stack = [(self.root, {}, rows, np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int32))]
        while stack:
            node, box, at, more, fewer = stack.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield node, at
                continue
            dim, cut, *children = node
            q = queries[at, dim].astype(np.int32)
            low, high = box.get(dim, (0, most))
            for child, new_low, new_high in ((children[0], low, min(cut, high)), (children[1], max(cut + 1, low), high)):
                m = more + np.maximum(new_low - q, 0) - np.maximum(low - q, 0)
                f = fewer + np.maximum(q - new_high, 0) - np.maximum(q - high, 0)
                ok = (m <= up) & (f <= down)
                stack.append((child, {**box, dim: (new_low, new_high)}, at[ok], m[ok], f[ok]))


def without_each(word: str, letter: str, mark: str) -> list[str]:
    return [word[:i] + mark + word[i + 1:] for i, c in enumerate(word) if c == letter]


def matched(ours: list[str], theirs: list[str]) -> set[tuple[int, int]]:
    """Near pairs of two points in reach: words of each with the letter left
    out that the other point lacks."""
    count = Counter(theirs[0])
    count.subtract(ours[0])
    gained = next(c for c, k in count.items() if k > 0)
    lost = next((c for c, k in count.items() if k < 0), None)
    mark = "" if lost is None else "*"
    known: dict[str, list[int]] = {}
    for i, w in enumerate(ours):
        for key in ([w] if lost is None else without_each(w, lost, mark)):
            known.setdefault(key, []).append(i)
    return {(i, j) for j, w in enumerate(theirs) for key in without_each(w, gained, mark) for i in known.get(key, ())}


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words of two lists of codes are one edit apart, row by row."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    lead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    trail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return lead + trail >= a.shape[1]


class Points:
    """Words of one length by their vectors."""

    def __init__(self, words: list[str]):
        codes = coded(words)
        vecs = vectors(codes)
        kinds, which = np.unique(vecs, axis=0, return_inverse=True)
        self.at, which = kinds, which.ravel()
        order = np.argsort(which, kind="stable")
        self.order, self.codes, self.words = order, codes[order], [words[i] for i in order]
        self.first = np.searchsorted(which[order], np.arange(len(kinds) + 1))


def links_of_points(ours: Points, theirs: Points) -> list[tuple[int, int]]:
    """Pairs (one of ours, one of theirs) that are one edit apart, where
    theirs are as long, or longer by one; numbers are those of the lists that
    made the points."""
    same = ours.codes.shape[1] == theirs.codes.shape[1]
    tree = Tree(theirs.at, LEAF)
    sizes_a, sizes_b = np.diff(ours.first), np.diff(theirs.first)
    out = []
    for leaf, at in tree.reached(ours.at, 1, int(same)):
        members = tree.members[leaf]
        step = max(1, COMPARED // (len(members) * len(LETTERS)))
        for z in range(0, len(at), step):
            part = at[z:z + step]
            gap = theirs.at[members][None] - ours.at[part][:, None]
            p, m = np.nonzero(np.abs(gap).sum(axis=2) == (2 if same else 1))
            if same:     # once: the first letter that differs is one more on their side
                first = (gap[p, m] != 0).argmax(axis=1)
                ok = gap[p, m, first] > 0
                p, m = p[ok], m[ok]
            a, b = part[p], members[m]
            product = sizes_a[a] * sizes_b[b]
            for x, y in zip(a[product >= MANY], b[product >= MANY], strict=True):
                fa, fb = ours.first[x], theirs.first[y]
                out += [(int(ours.order[fa + i]), int(theirs.order[fb + j])) for i, j in
                        matched(ours.words[fa:ours.first[x + 1]], theirs.words[fb:theirs.first[y + 1]])]
            a, b, product = a[product < MANY], b[product < MANY], product[product < MANY]
            if len(a):
                which = np.repeat(np.arange(len(a)), product)
                k = np.arange(product.sum()) - np.repeat(np.cumsum(product) - product, product)
                i = ours.first[a][which] + k // sizes_b[b][which]
                j = theirs.first[b][which] + k % sizes_b[b][which]
                slab = max(1, COMPARED // ours.codes.shape[1])
                for y in range(0, len(i), slab):
                    good = near(ours.codes[i[y:y + slab]], theirs.codes[j[y:y + slab]])
                    out += zip(ours.order[i[y:y + slab][good]].tolist(), theirs.order[j[y:y + slab][good]].tolist(),
                               strict=True)
    return out


def cells_of(words: DataFrame, sample: int, cell: int) -> dict[int, Tree]:
    """For each length a tree whose leaves are the cells, cut by a sample of
    ``words``; a length not in the sample is one cell."""
    total = words.count()
    chosen = words.select("word").orderBy(F.xxhash64("word"), "word").limit(sample).collect()
    share = max(2, int(cell * len(chosen) / max(total, 1)))
    by_length: dict[int, list[str]] = {}
    for r in chosen:
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    return {length: Tree(vectors(coded(w)), share) for length, w in by_length.items()}


VISIT = "length int, cell int, visits boolean, word string, n long"


def visits(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Every word in its own cell, and as a visitor in each cell that its
    searches reach."""
    shared = words.sparkSession.sparkContext.broadcast({k: t.root for k, t in trees.items()})

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {}
        for length, root in shared.value.items():
            known[length] = Tree.__new__(Tree)
            known[length].root = root
        for pdf in batches:
            if not len(pdf):
                continue
            for length, part in pdf.groupby(pdf["word"].str.len()):
                vecs = vectors(coded(part["word"].tolist()))
                for other, comes, up, down in ((length, False, 0, 0), (length, True, 1, 1), (length + 1, True, 1, 0)):
                    reached = known[other].reached(vecs, up, down) if other in known else [(0, np.arange(len(part)))]
                    for cell, at in reached:
                        yield pd.DataFrame({"length": np.int32(other), "cell": np.int32(cell), "visits": comes,
                                            "word": part["word"].to_numpy()[at], "n": part["n"].to_numpy()[at]})

    return words.select("word", "n").mapInPandas(send, VISIT)


def links(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of ``words`` (word, n) one edit apart, each
    once."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        home = rows[~rows["visits"]]
        if len(home):
            theirs = Points(home["word"].tolist())
            came = rows[rows["visits"]]
            for _, part in came.groupby(came["word"].str.len()):
                names, counts = part["word"].tolist(), part["n"].tolist()
                out += [(names[i], home["word"].iat[j], counts[i], home["n"].iat[j])
                        for i, j in links_of_points(Points(names), theirs)]
        return pd.DataFrame(out, columns=["a", "b", "n_a", "n_b"])

    return visits(words, cells_of(words, sample, cell)).groupBy("length", "cell").applyInPandas(
        search, "a string, b string, n_a long, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root), by doubling.  Counts grow along forms, so
    no chain comes back."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, ratio: int = RATIO, sample: int = SAMPLE, cell: int = CELL,
                      ) -> DataFrame:
    """Every word with its form, root and counts."""
    words = written(word_counts(docs, key, text, least_length).filter(F.col("n") >= least_count), "words")
    found = written(links(words, sample, cell), "spelling-links")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"),
                                          F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")))
    near_words = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = written(words.join(near_words, "word", "left").withColumn(
        "is_form", -F.col("best.n") >= ratio * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("is_form"), F.col("best.word")).alias("form"),
        F.when(F.col("is_form"), -F.col("best.n")).alias("form_n")), "forms")
    ends = roots(known.filter("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                   "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = with_crc32(f"""
WITH RECURSIVE {crc32_sql()},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, w, count(*) AS c
         FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS w
               FROM documents) GROUP BY 1, 2),
keyed AS (SELECT w, c, id || ':' || w AS x FROM runs),
hashed AS (SELECT w, c, crc32_of(x) AS h FROM keyed, crc_table),
kept AS (SELECT c, CASE WHEN h % {SLIP} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w
         FROM hashed),
words AS (SELECT w, CAST(sum(c) AS BIGINT) AS n FROM kept WHERE length(w) >= {LEAST_LENGTH} GROUP BY w HAVING sum(c) >= {LEAST_COUNT}),
cuts AS (SELECT w, n, i, substr(w, 1, i) || '*' || substr(w, i + 2) AS same, substr(w, 1, i) || substr(w, i + 2) AS less
         FROM (SELECT w, n, unnest(range(length(w))) AS i FROM words)),
pairs AS (SELECT a.w AS a, b.w AS b, b.n AS n_b FROM cuts a JOIN cuts b ON a.same = b.same AND a.i = b.i AND a.w <> b.w
          UNION SELECT a.w, b.w, b.n FROM cuts a JOIN words b ON a.less = b.w
          UNION SELECT b.w, a.w, a.n FROM cuts a JOIN words b ON a.less = b.w),
best AS (SELECT a, count(*) AS n_near, max(n_b) AS most FROM pairs GROUP BY a),
forms AS (SELECT w, n, coalesce(n_near, 0) AS n_near,
            CASE WHEN most >= {RATIO} * n THEN (SELECT min(encode(b)) FROM pairs p WHERE p.a = w AND p.n_b = most) END AS f,
            CASE WHEN most >= {RATIO} * n THEN most END AS form_n FROM words LEFT JOIN best ON a = w),
named AS (SELECT w AS word, n, n_near, decode(f) AS form, form_n FROM forms),
walk AS (SELECT word, word AS at FROM named
         UNION ALL SELECT walk.word, named.form FROM walk JOIN named ON named.word = walk.at WHERE named.form IS NOT NULL)
SELECT named.word, named.form, walk.at AS root, named.n, CAST(named.n_near AS BIGINT) AS n_near, named.form_n
FROM named JOIN walk ON walk.word = named.word JOIN named e ON e.word = walk.at AND e.form IS NULL
""")
