"""Spelling variants, resampling and quality rules against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import LONG, SF, docs, matches_oracle, odd, rows, write
from tripcast.llm import quality_rules, resampling, spelling
from tripcast.llm.registry import all_oracles, all_queries

Q = all_queries()
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize(("name", "tables"), [("op11_spelling", ("documents",)), ("op12_resampling", ("documents", "benchmark"))])
def test_sql(spark, name, tables):
    matches_oracle(Q[name](spark, SF), all_oracles()[name], SF, *tables)


# ---------------------------------------------------------------- spelling
def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(table: list[tuple]) -> set[tuple]:
    count: Counter = Counter()
    for key, text in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(FOLD)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 5}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def invented(seed: int) -> list[str]:
    """Texts of words near one another: variants, anagrams, chains of forms."""
    rng = random.Random(seed)
    words = []
    for base in ("garden", "überall", "straße", "aabbab", "chocolate"):
        words += [base] * 160
        for _ in range(12):
            w = list(base)
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], [rng.choice("abxé÷Þ")], [w[at], rng.choice("abxé")]])
            words += ["".join(w)] * rng.choice([5, 6, 31])
    words += ["gardenx"] * 31 + ["gardenxy"] * 6
    for _ in range(120):            # anagrams, many to one point
        words += ["".join(rng.sample("aabbbcc", 7))] * 5 + ["".join(rng.sample("aabbbccd", 8))] * 5
    words += ["Zwölfeck", "ZWÖLFECK", "zwölfeck"] * 4 + ["q" * 3000] * 5 + ["q" * 2999 + "r"] * 5
    rng.shuffle(words)
    return [" ".join(words[i:i + 60]) for i in range(0, len(words), 60)]


@pytest.mark.parametrize("small", [False, True])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, small):
    texts = [*invented(3), None, "", "12 .", "cut-off " * 6]
    folder = write(spark, documents=docs(*texts))
    if small:       # several cells, small leaves, letters left out for every pair of points
        monkeypatch.setattr(spelling, "MANY", 2)
        monkeypatch.setattr(spelling, "LEAF", 2)
        monkeypatch.setattr(spelling, "COMPARED", 64)
    found = spelling.spelling_variants(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"),
                                       **({"sample": 60, "cell": 8} if small else {}))
    assert set(rows(found, "word", "form", "root", "n", "n_near", "form_n")) == plain_variants(list(enumerate(texts)))


def test_variants_follow_chains(spark):
    texts = [" ".join(["abcdef"] * 400 + ["abcdefg"] * 60 + ["abcdefgh"] * 9)]
    found = {r["word"]: r for r in spelling.spelling_variants(spark.createDataFrame([(1, texts[0])], "doc_id long, text string"),
                                                              ).collect()}
    assert [found[w]["form"] for w in ("abcdef", "abcdefg", "abcdefgh")] == [None, "abcdef", "abcdefg"]
    assert {r["root"] for r in found.values()} == {"abcdef"} and found["abcdefg"]["n_near"] == 2


def test_variants_of_odd_rows(spark):
    table, schema = odd()
    found = rows(Q["op11_spelling"](spark, write(spark, documents=(table * 5, schema))), "word", "n")
    assert found == []      # "lang", "number words" under six letters, or a null id's few
    folder = write(spark, documents=([(None, "strange Strange STRANGE", "", "", 1, "", "", 1)] * 2, schema))
    assert rows(Q["op11_spelling"](spark, folder), "word", "form", "root", "n", "n_near", "form_n") == [
        ("strange", None, "strange", 6, 0, None)]


# ---------------------------------------------------------------- resampling
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def plain_resample(table, target, n=1, buckets=10_000, percent=10, least=20):
    def grams(text):
        w = re.findall(WORD, (text or "").translate(FOLD))
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)

    made = [grams(t) for _, t in table]
    s, t = Counter(b for g, _ in made for b in g), Counter(b for x in target for b in grams(x)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for (key, _), (g, words) in zip(table, made, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        out.append([key, words, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long_enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(long_enough[:percent * len(long_enough) // 100], 1):
        r[5] = place
    return sorted((tuple(r) for r in out), key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_draw_is_that_of_plain_crcs(spark, n):
    rng = random.Random(n)
    texts = [" ".join(rng.choice(["the", "Über", "x" * 9, "7up", "naïve-ish", "a.b", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(60)))
             for _ in range(300)] + [None, "", "...", LONG, "y" * 300_000]
    target = ["the naïve w1 w2 w3", "7up 7up", None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    found = resampling.resample(d, t, n=n, percent=30)
    assert found.columns[:2] == ["doc_id", "text"]
    assert rows(found, "doc_id", "n_words", "n_features", "weight", "score", "rank") == plain_resample(
        list(enumerate(texts)), target, n, percent=30)


def test_draw_of_odd_rows(spark):
    table, schema = odd()
    for target in ([(1, "six words"), (None, None)], []):
        folder = write(spark, documents=(table, schema), benchmark=([(*t, 7) for t in target], "item_id long, text string, rank int"))
        found = resampling.resample(*(spark.read.parquet(f"{folder}/{x}.parquet").select(*c) for x, c in
                                      (("documents", ("doc_id", "text")), ("benchmark", ("text",)))), percent=100, least_words=4)
        assert rows(found, "doc_id", "n_words", "n_features", "weight", "score", "rank") == sorted(plain_resample(
            [r[:2] for r in table], [t for _, t in target], percent=100, least=4), key=str)
    with pytest.raises(ValueError, match="score"):
        resampling.resample(spark.read.parquet(f"{folder}/documents.parquet"), found)


def test_column_crcs_are_crc32():
    rng = np.random.default_rng(0)
    b = rng.integers(0, 256, 5000).astype(np.uint8)
    begin = np.sort(rng.integers(0, 4900, 700))
    end = begin + rng.integers(1, 100, 700)
    begin, end = np.r_[begin, begin[:50]], np.r_[end, end[:50]]
    assert resampling.crcs(b, begin, end).tolist() == [zlib.crc32(b[x:y].tobytes()) for x, y in zip(begin, end, strict=True)]


# ---------------------------------------------------------------- quality rules
def plain_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


RULE_TEXTS = ["a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8, "one\n\none\n one\none\r\none\r\n \n ", "é😀 ñ #*$%&|<>",
              "a\x1cb\x85c d e", "p q r s t u v w x " * 3 + "y p q r s t u v w", None, "", " \n\t", LONG,
              " ".join(f"w{i}" for i in range(100)) + " " + " ".join(f"w{i}" for i in range(91, 100))]


def test_base_counts_are_those_of_plain_rules(spark):
    for folder in (SF, write(spark, documents=docs(*RULE_TEXTS), labels=([], "doc_id long, quality int"))):
        texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        found = Q["op13_quality_rules"](spark, folder).collect()
        assert len(found) == len(texts)
        for r in found:
            want = plain_counts(texts[r["doc_id"]])
            assert tuple(r[c] for c in quality_rules.COUNTS) == want
            assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
            assert not (r["kept"] and r["base_failed"]) and (folder == SF or r["kept"] != r["base_failed"])


def test_windows_do_not_cross_texts():
    texts = ["a b c d e", "f g h a b c d e f g h", "a b c d e f g h"]
    assert quality_rules.examined(texts).counts[:, 4].tolist() == [0, 0, 0]


def test_features_are_those_of_each_text_alone():
    together = quality_rules.examined(["one two one", "", "zwei größe\nzwei", "x"])
    cut = np.searchsorted(together.doc, np.arange(5))
    for i, t in enumerate(["one two one", "", "zwei größe\nzwei", "x"]):
        alone = quality_rules.examined([t])
        assert together.bucket[cut[i]:cut[i + 1]].tolist() == alone.bucket.tolist()
        assert together.value[cut[i]:cut[i + 1]].tolist() == alone.value.tolist()


def test_classifier_on_the_held_out_fold(spark):
    found = {r["doc_id"]: r for r in Q["op13_quality_rules"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(k, q) for k, q in labels.items() if zlib.crc32(str(k).encode()) % 5 == 0 and not found[k]["base_failed"]]
    right = sum((found[k]["chance"] >= quality_rules.KEEP) == bool(q) for k, q in held)
    assert right >= 0.9 * len(held) > 0
    good = [found[k]["kept"] for k, q in held if q]
    assert sum(good) >= 0.97 * len(good)


def test_calibration_gives_chances():
    rng = np.random.default_rng(1)
    score = rng.normal(size=20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2.5 * score - 0.7)))).astype(int)
    slope, offset = quality_rules.calibrated(score, y)
    assert abs(slope - 2.5) < 0.1 and abs(offset + 0.7) < 0.1
    assert quality_rules.calibrated(score, np.ones(20_000)) == (1.0, 0.0)


def test_labels_of_no_use_leave_the_base_rules(spark):
    text = " ".join(f"word{i}" for i in range(30))
    folder = write(spark, documents=docs(text, text, text), labels=([(0, None), (1, 2), (2, 1), (None, 0)], "doc_id long, quality int"))
    assert [r["kept"] for r in Q["op13_quality_rules"](spark, folder).collect()] == [True] * 3
    with pytest.raises(ValueError, match="n_words"):
        quality_rules.score(spark.createDataFrame([("a", 1)], "text string, n_words int"), None)
