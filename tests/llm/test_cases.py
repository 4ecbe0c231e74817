"""Nulls, empty and very long texts, repeated rows, empty tables and clashing
columns, for every query and every stage of the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.helpers import LONG, SF, docs, odd, rows, write
from tripcast.llm.registry import all_queries

Q = all_queries()
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"
PAGES = "page_id long, url string, html string, key string, top string"
VECTORS = "vec_id long, embedding array<float>, id string, score string"


def folder_of(spark, rows_=None) -> str:
    d = odd() if rows_ is None else rows_
    return write(spark, documents=d, labels=([(0, 1, None), (3, 0, 0), (3, None, 1), (None, 1, 1)] if rows_ is None else [], LABELS),
                 benchmark=([(1, "three four"), (None, None)] if rows_ is None else [], ITEMS),
                 pages=([(1, None, None, "a", "b"), (None, "u", "x", "a", "b")] if rows_ is None else [], PAGES),
                 embeddings=([(0, [1.0, 2.0], "a", "b"), (0, [1.0, 2.0], "a", "b"), (1, None, "", ""), (2, [None, 1.0], "", ""),
                              (3, [float("nan"), 1.0], "", ""), (4, [], "", ""), (None, [1.0, 1.0], "", ""), (5, [1.0], "", "")]
                             if rows_ is None else [], VECTORS))


@pytest.fixture(scope="module")
def odd_folder(spark):
    return folder_of(spark)


@pytest.fixture(scope="module")
def empty_folder(spark):
    return folder_of(spark, ([], odd()[1]))


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty_folder, name):
    assert Q[name](spark, empty_folder).collect() == []


@pytest.mark.parametrize("name", ["op1_quality", "op2_decontaminate", "op3_sharding", "op5_language", "op7_pii",
                                  "op9_near_duplicates", "op12_resampling", "op13_quality_rules"])
def test_every_row_has_its_result(spark, odd_folder, name):
    found = Q[name](spark, odd_folder).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((r[0] for r in odd()[0]), key=str)


def test_contamination_of_odd_rows(spark, odd_folder):
    found = rows(Q["op2_decontaminate"](spark, odd_folder), "doc_id", "n_words", "n_hit", "n_items")
    assert found.count((3, 6, 2, 1)) == 3 and (4, 30_000, 0, 0) in found and (0, 0, 0, 0) in found


def test_languages_of_odd_rows(spark, odd_folder):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in Q["op5_language"](spark, odd_folder).collect()}
    assert found[0] == found[1] == found[2] == ("und", 0.0) and found[4][0] == "en"


def test_components_of_odd_rows(spark, odd_folder):
    found = rows(Q["op9_near_duplicates"](spark, odd_folder), "doc_id", "n_shingles", "component_id", "kept")
    assert found.count((3, 4, 3, True)) == 3 and (0, 0, 0, True) in found and (4, 1, 4, True) in found
    assert (None, 2, None, True) in found


def test_packing_of_odd_rows(spark, odd_folder):
    found = Q["op10_packing"](spark, odd_folder).collect()
    assert sum(r["doc_id"] == 3 for r in found) == 3 and sum(r["doc_id"] == 4 for r in found) > 10
    assert [r["length"] for r in found if r["doc_id"] in (0, 1)] == [1, 1]


def test_search_of_odd_rows(spark, odd_folder):
    # the repeated query is asked once; its copies bear its own id; ties go to the smaller id
    found = rows(Q["op6_topk"](spark, odd_folder), "query_id", "rank", "vec_id", "score")
    assert found == [(0, 1, 5, 256 * 256), (0, 2, 4, 0)]


def test_archives_of_odd_rows(spark, odd_folder):
    found = rows(Q["op8_warc"](spark, odd_folder), "page_id", "payload_bytes", "record_type", "refers_to")
    assert found == [(1, 0, "response", None), (None, 1, "response", None)]


def test_passages_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    folder = write(spark, documents=docs(text, None, "", LONG, text))
    assert {r["doc_id"] for r in Q["op4_substrings"](spark, folder).collect()} == {0, 4}


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows(spark, odd_folder, empty_folder, number):
    name, stage = corpus_pipeline.STAGES[number]
    for folder in (odd_folder, empty_folder):
        d = spark.read.parquet(f"{folder}/documents.parquet").withColumns(
            {c: d_ for c, d_ in zip(("lang_pred", "hits", "spans", "component_id"), _nulls(), strict=True)})
        out = stage(spark, d, folder)
        found = out.collect()
        if name != "packing":
            assert out.columns == d.columns
        if folder == empty_folder:
            assert found == []
        elif name == "language":
            assert sorted((r["doc_id"] for r in found), key=str) == [3, 3, 3, 4, 5, None]
        elif name == "near_duplicates":
            assert sorted((r["doc_id"] for r in found), key=str) == [0, 1, 2, 3, 4, 5, None]
        elif name == "decontamination":
            assert 3 not in {r["doc_id"] for r in found} and len(found) == len(odd()[0]) - 3
        else:
            assert len({r["doc_id"] for r in found}) == 7


def _nulls():
    from pyspark.sql import functions as F

    return [F.lit("x")] * 4


def test_the_pipeline_takes_out_what_its_stages_reject(spark):
    words = " ".join(f"word{i}x" for i in range(40)).replace("0", "a").replace("1", "b")
    folder = write(spark, documents=docs(words, words, "mail a@b.co to me please", "12 34", None, "one two three four"),
                   benchmark=([(1, "two three")], ITEMS))
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted({r["doc_id"] for r in out}) == [0, 2]
    from tripcast.llm.packing import Encoder

    text = Encoder().whole.decode([int.from_bytes(r["ids"][i:i + 4], "little") for r in out if r["doc_id"] == 2
                                   for i in range(0, len(r["ids"]) - 4, 4)])
    assert text == "mail <email> to me please"


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and SF
