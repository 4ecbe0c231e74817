"""The whole pipeline against a plain run of its five stages: dictionaries of
letter vectors, all pairs of shingle sets, a plain window search, plain
patterns and the whole tokenizer."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import docs, plain_shingles, write
from tests.llm.test_results import base_spans, components_of, plain_masked
from tripcast.llm import decontaminate, language, packing
from tripcast.llm.common import HELD_OUT_FOLDS


def plain_languages(table: dict, langs: dict) -> dict:
    """(language, cosine) of each text, learned outside the held-out fold."""
    grams = language.Grams()
    vector = {}

    def letter(c: str) -> np.ndarray:
        if c not in vector:
            vector[c] = grams._draw(ord(c) if c != " " else -1).astype(int)
        return vector[c]

    def bundle(text: str | None) -> tuple[np.ndarray, int]:
        total, n = np.zeros(language.DIMS), 0
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            padded = f" {word} "
            for i in range(len(padded) - 2):
                total += np.roll(letter(padded[i]), 2) * np.roll(letter(padded[i + 1]), 1) * letter(padded[i + 2])
                n += 1
        return total, n

    sums: dict = {}
    for k, t in table.items():
        total, n = bundle(t)
        if n and langs[k] and zlib.crc32(str(k).encode()) % HELD_OUT_FOLDS:
            sums[langs[k]] = sums.get(langs[k], 0) + total / n
    out = {}
    for k, t in table.items():
        total, n = bundle(t)
        cos = [(float(total @ s / np.linalg.norm(total) / np.linalg.norm(s)), name) for name, s in sums.items()] if n else []
        out[k] = max(cos) if cos else None
    return out


def plain_pipeline(table: dict, langs: dict, benchmark: list[str]) -> dict:
    """The masked texts of the documents that stay."""
    found = plain_languages(table, langs)
    table = {k: t for k, t in table.items() if found[k] and (
        found[k][0] >= corpus_pipeline.LEAST_COSINE or sum(map(str.isalpha, t)) < corpus_pipeline.ENOUGH_LETTERS)}
    roots = components_of(table, 5, 80)
    table = {k: t for k, t in table.items() if roots[k][1] == k}
    windows = set()
    for b in benchmark:
        w = decontaminate.words_of(b)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    clean = {}
    for k, t in table.items():
        w = decontaminate.words_of(t)
        if not any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1)):
            clean[k] = t
    out = {}
    for k, t in clean.items():
        spans = [(int(a), int(b), kind) for kind, a, b in (s.split(":") for s in base_spans(t).split(",") if s)]
        out[k] = plain_masked(t, spans)
    return out


def corpus(seed: int) -> tuple[dict, dict, list[str]]:
    """Prose in two invented languages: templates with near copies on both
    sides of the limit, exact copies, benchmark passages, personal data, junk."""
    rng = random.Random(seed)
    syllables = {"xa": ["tha", "ren", "ing", "so", "wel"], "yb": ["çéo", "ñu", "ßam", "ül", "kro"]}

    def prose(lang: str, n: int) -> list[str]:
        return ["".join(rng.choices(syllables[lang], k=rng.randrange(2, 4))) for _ in range(n)]

    texts, langs, benchmark = [], [], [" ".join(prose("xa", 14)), " ".join(prose("yb", 4)), ""]
    for k in range(24):
        lang = rng.choice(["xa", "yb"])
        words = prose(lang, rng.randrange(30, 90))
        texts.append(" ".join(words))
        for changes in (1, 2, 3, 5, 8) if k % 3 == 0 else ():
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = prose(lang, 1)[0]
            texts.append(" ".join(copy) + ("." if changes == 2 else ""))
        if k % 4 == 0:
            texts.append(texts[-1].upper() if k % 8 else texts[-1])
        if k % 5 == 0:
            texts.append(" ".join(prose("xa", 20)) + " " + " ".join(benchmark[0].split()[2:13]) + " " + " ".join(prose("xa", 9)))
        if k % 6 == 0:
            texts.append(" ".join(prose(lang, 40)) + f" a{k}@b.co and 10.0.{k}.1 or +49 30 12345{k:03d}0 " + " ".join(prose(lang, 12)))
        if k % 7 == 0:
            texts.append(" ".join(prose("yb", 12)) + "\n" + benchmark[1].upper())
        langs += [lang] * (len(texts) - len(langs))
    texts += [None, "", "12 34 !!", " ".join(prose("xa", 700)), "word"]
    langs += [None] * (len(texts) - len(langs))
    return dict(enumerate(texts)), dict(enumerate(langs)), benchmark


def test_pipeline_equals_a_plain_run(spark):
    table, langs, benchmark = corpus(11)
    want = plain_pipeline(table, langs, benchmark)
    folder = write(spark, documents=docs(*table.values(), langs=list(langs.values())),
                   benchmark=(list(enumerate(benchmark)), "item_id long, text string"))
    found = corpus_pipeline.run(spark, folder).collect()
    assert 5 < len(want) < len(table) - 10
    tokens = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    pieces = []
    for k, t in want.items():
        ids = [*tokens.encode(t, add_special_tokens=False).ids, packing.END_ID]
        first = (len(ids) - 1) % packing.CAPACITY + 1
        cuts = [0, *range(first, len(ids) + 1, packing.CAPACITY)]
        pieces += [(k, p, a, b - a, np.array(ids[a:b], "<u4").tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in found) == sorted(pieces)
    held: dict = {}
    for r in found:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in held.values():
        rows.sort()
        assert [a for a, _ in rows] == [sum(n for _, n in rows[:i]) for i in range(len(rows))]
        assert sum(n for _, n in rows) <= packing.CAPACITY


def test_nothing_learned_keeps_every_lettered_document(spark):
    d = spark.createDataFrame([(0, "some words", None), (1, "12", None), (2, None, None), (3, "ß", None)],
                              "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, d, "").collect()) == [0, 3]


def test_foreign_documents_go(spark):
    words = " ".join(plain[0].decode() for plain in sorted(plain_shingles("the of and in to that is was for it as", 1)))
    d = spark.createDataFrame([(i, words, "en") for i in range(1, 6)] + [(8, "жщю", None), (9, "жщю щюж южщ " * 20, None)],
                              "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, d, "").collect()) == [1, 2, 3, 4, 5, 8]
