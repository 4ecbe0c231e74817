"""Best-fit packing after Martello-Toth reduction.

Documents become token ids with an end id; one longer than a sequence is cut
into full pieces from its end, so its first piece may be shorter.  All that
packing needs is how many pieces there are of each length, at most
``capacity`` numbers, which Spark counts and the driver plans with:

* Reduction (Martello and Toth): for the longest open length, a set that
  provably dominates every other way to fill its sequence is fixed for as many
  copies as there are: the piece alone if nothing fits beside it; with the
  longest piece that fits if that fills the sequence exactly, or if no two
  others fit beside it; with the best pair if the pair's longer piece is at
  least as long as any single piece that fits, no three others fit, and the
  pair fills the sequence exactly.
* Best fit, longest first, packs what remains; alike sequences are handled
  together, so the work grows with the number of lengths, not of pieces.

A plan row says: of the pieces of one length, those numbered ``first`` to
``last`` go to consecutive sequences from ``sequence`` on, at offset
``offset``.  Pieces are numbered within their length by counting per input
task and length, so a length held by a third of all pieces is numbered by many
tasks; then each piece looks up its plan row in an array of bounded size.

Cases: a null or empty text is the end id alone; equal rows are packed each;
an empty table gives no rows; texts are tokenised whole; extra columns are not
carried.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcast.llm.common import spans, table, written

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
ENCODE_CHARS = 500_000       # characters whose pieces are handed on at once; a longer text goes alone
KNOWN_PARTS = 450_000        # parts whose ids a worker keeps
WORDS_AT_ONCE = 2000
BLANK = "\u0120"             # fixed value: how a byte-level vocabulary writes a blank


#: fixed values: letters and numbers up to U+024F, how a byte-level tokenizer splits a text,
#: and the characters for which that is beyond doubt
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
SPLIT = re.compile(rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")


class Encoder:
    """Token ids of texts by a ``tokenizers`` file.

    A byte-level tokenizer splits a text at ``SPLIT`` and merges bytes within
    each part alone, so the ids of a part are the same wherever it stands:
    they are asked for once and kept.  Texts that hold the content of an added
    token, which the tokenizer takes out before it splits, or characters that
    another Unicode version might split otherwise, and files of another kind,
    go through the tokenizer whole.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        form = json.loads(self.whole.to_str())
        cut = form.get("pre_tokenizer") or {}
        self.by_parts = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
                         and form.get("normalizer") is None and not form["model"].get("dropout"))
        added = [re.escape(t["content"]) for t in form.get("added_tokens") or []]
        self.added = re.compile("|".join(added) or "(?!)")
        vocabulary = self.whole.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)   # tokens that begin with a blank
        self.begins[[i for t, i in vocabulary.items() if t.startswith(BLANK)]] = True
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit little-endian numbers."""
        get, held = self.known.get, []
        # flat lists: a container for each new part would keep the garbage collector at work
        new, text_of, place = [], [], []
        for text in texts:
            if not self.by_parts or UNUSUAL.search(text) or self.added.search(text):
                held.append([array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()])
                continue
            parts = SPLIT.findall(text)
            found = list(map(get, parts))
            if None in found:
                missing = [at for at, ids in enumerate(found) if ids is None]
                new += [parts[at] for at in missing]
                place += missing
                text_of += [len(held)] * len(missing)
            held.append(found)
        learned = self._learn(list(set(new)))
        for part, i, at in zip(new, text_of, place, strict=True):
            held[i][at] = learned[part]
        if len(self.known) + len(learned) <= KNOWN_PARTS:
            self.known.update(learned)
        yield from map(b"".join, held)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Asks for the ids of new parts.  A blank with letters after it is a
        part of its own in any text, so many such are asked for as one text,
        which is cut where a token begins with a blank."""
        out, words, rest = {}, [], []
        for part in new:
            (words if part[0] == " " and part[1:].isalpha() else rest).append(part)
        for k in range(0, len(words), WORDS_AT_ONCE):
            some = words[k:k + WORDS_AT_ONCE]
            if self.added.search("".join(some)):
                rest += some
                continue
            e = self.whole.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            number = np.array(e.ids, "<u4")
            ids, cuts = number.tobytes(), (4 * np.flatnonzero(np.r_[self.begins[number], True])).tolist()
            if len(cuts) != len(some) + 1:
                rest += some
                continue
            out.update((w, ids[i:j]) for w, i, j in zip(some, cuts, cuts[1:], strict=False))
        for part, e in zip(rest, self.whole.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[part] = array("I", e.ids).tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids, task, place): ``ids`` are unsigned
    32-bit little-endian, ``place`` numbers the pieces of one length made by
    one task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, made = encoder(path).ids, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in spans(texts, ENCODE_CHARS):
                rows = []
                for row, ids in enumerate(encode(texts[a:b]), a):
                    ids += end_id.to_bytes(4, "little")
                    n, at = len(ids) // 4, 0
                    for piece, end in enumerate(range((n - 1) % capacity + 1, n + 1, capacity)):
                        rows.append((row, piece, at, end - at, ids[4 * at:4 * end], task, int(made[end - at])))
                        made[end - at] += 1
                        at = end
                row, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), *(pa.array(x, k) for x, k in zip(rest, kinds, strict=True))],
                    names=["key", "piece", "start", "length", "ids", "task", "place"])

    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
    keyed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return keyed.mapInArrow(cut, f"key {keyed.schema[0].dataType.simpleString()}, piece int, start long, length long, "
                                 "ids binary, task int, place long")


class Fill(NamedTuple):
    """``count`` alike sequences: the lengths in each, in order."""

    lengths: tuple[int, ...]
    count: int


def reduce(left: dict[int, int], capacity: int) -> list[Fill]:
    """Fixes dominating sets and takes them out of ``left`` (length: count)."""
    fixed: list[Fill] = []
    sizes = sorted(left)

    def take(*lengths: int) -> None:
        need = {n: lengths.count(n) for n in lengths}
        count = min(left[n] // k for n, k in need.items())
        fixed.append(Fill(lengths, count))
        for n, k in need.items():
            left[n] -= k * count
            if not left[n]:
                del left[n]
                sizes.pop(bisect_left(sizes, n))

    def others(j: int, room: int, above: int = 0) -> list[int]:
        """The shortest three open pieces longer than ``above`` beside one of length j."""
        out: list[int] = []
        for n in sizes[bisect_left(sizes, above + 1):]:
            out += [n] * min(3 - len(out), left[n] - (n == j))
            if len(out) == 3 or n > room:
                break
        return out[:3]

    def longest(room: int, *used: int) -> int:
        i = bisect_left(sizes, room + 1) - 1
        while i >= 0 and left[sizes[i]] - used.count(sizes[i]) <= 0:
            i -= 1
        return sizes[i] if i >= 0 else 0

    for j in sorted(left, reverse=True):
        while left.get(j):
            room = capacity - j
            few = [n for n in others(j, room) if n <= room]
            if not few:
                take(j)
                continue
            k = longest(room, j)
            if k == room or len(few) < 2 or few[0] + few[1] > room:
                take(j, k)
                continue
            if len(few) == 3 and sum(few) <= room:
                break
            # at most two others fit: k and the longest beside it dominate unless two longer than that one fit
            second = longest(room - k, j, k)
            if second and sum(others(j, room, second)[:2]) > room or len(others(j, room, second)) < 2:
                take(j, k, second)
                continue
            break
    return fixed


def best_fit(left: dict[int, int], capacity: int) -> list[Fill]:
    """Best fit, longest first, with alike sequences handled together."""
    open_: dict[int, list[Fill]] = {}
    rooms: list[int] = []

    def put(fill: Fill, room: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append(fill)

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            i = bisect_left(rooms, n)
            if i < len(rooms):
                room = rooms[i]
                fill = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
                # a sequence that took one piece is the tightest for the next, while it has the room
                each = min(room // n, count)
                used = min(fill.count, count // each)
                if used < fill.count:
                    put(Fill(fill.lengths, fill.count - used), room)
                put(Fill(fill.lengths + (n,) * each, used), room - n * each)
                count -= used * each
            else:
                each = min(capacity // n, count)
                used = count // each
                put(Fill((n,) * each, used), capacity - n * each)
                count -= used * each
    return [f for fills in open_.values() for f in fills]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """(length, first, last, sequence, step, offset): the pieces numbered
    first to last of a length go to sequences from ``sequence`` on."""
    left = {n: c for n, c in counts.items() if c > 0}
    fills = reduce(left, capacity)
    fills += best_fit(left, capacity)
    rows, sequence, used = [], 0, dict.fromkeys(counts, 0)
    for f in fills:
        offset = 0
        for n in f.lengths:
            rows.append((n, used[n], used[n] + f.count, sequence, offset))
            used[n] += f.count
            offset += n
        sequence += f.count
    assert used == {n: c for n, c in counts.items()}, "every piece has its place"
    return pd.DataFrame(rows, columns=["length", "first", "last", "sequence", "offset"]).sort_values(
        ["length", "first"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; the frame must be read
    from a table, so that its numbering stands."""
    counts = written(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(totals, capacity)
    # pieces of a length that earlier tasks made
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = written(counts.select("length", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before")),
                     "length-offsets")
    shared = pieces.sparkSession.sparkContext.broadcast(
        {n: part[["first", "sequence", "offset"]].to_numpy(np.int64) for n, part in rows.groupby("length")})

    @F.pandas_udf("sequence_id long, offset long")
    def find(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(lengths), 2), np.int64)
        n, at = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        for length in np.unique(n):
            here, table_ = n == length, shared.value[length]
            row = table_[np.searchsorted(table_[:, 0], at[here], side="right") - 1]
            out[here, 0] = row[:, 1] + at[here] - row[:, 0]
            out[here, 1] = row[:, 2]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    numbered = pieces.join(before, ["length", "task"])
    return numbered.withColumn("found__", find(F.col("length"), F.col("place") + F.col("before"))).select(
        *[c for c in pieces.columns if c not in ("task", "place")], "found__.sequence_id", "found__.offset")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, path: str | None = None, checksums: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids (or their crc32, as
    ``ids_crc32``), sequence_id, offset."""
    pieces = written(token_pieces(docs, key, text, capacity, end_id, path), "pieces")
    if checksums:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity).withColumnRenamed("key", key)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), checksums=True).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
