"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator and returns a
DataFrame that is written as Parquet and reread as the next stage's ``docs``.
All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm import decontaminate, language, near_duplicates, packing, pii
from tripcast.llm.common import held_out, table
from tripcast.session import scratch_path


def carried(docs: DataFrame) -> DataFrame:
    """Id and text for an operator, all other columns as one, so that no name
    of theirs can meet one that an operator adds."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("rest__"), "doc_id", "text")


def restored(carried_docs: DataFrame, docs: DataFrame) -> DataFrame:
    return carried_docs.select(*["text" if c == "text" else F.col(f"rest__.`{c}`").alias(c) for c in docs.columns])


#: documents of enough letters that are less similar than this to every learned profile are in none of the languages
LEAST_COSINE, ENOUGH_LETTERS = 0.1, 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that are in none of the learned languages: null, empty or
    letterless texts (``und``), and texts of ``ENOUGH_LETTERS`` letters or
    more whose cosine with every profile is below ``LEAST_COSINE``; the others
    stay as they are (a word or two say little).  The profiles are
    learned from the documents that have a language, but for the held-out
    fold; where none has one, nothing can be told apart and every document
    with a letter stays."""
    langs, prototypes = language.fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    if not langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    labelled = language.predict(carried(docs), langs, prototypes)
    foreign = (F.col("score") < LEAST_COSINE) & (F.length(F.regexp_replace("text", r"[^\p{L}]+", "")) >= ENOUGH_LETTERS)
    return restored(labelled.filter((F.col("lang_pred") != language.UNDETERMINED) & ~foreign), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the
    smallest id (five-word shingles, similarity of 0.8 or more).  Wordless
    documents are linked with nothing and stay."""
    return restored(near_duplicates.near_duplicates(carried(docs)).filter("first"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark text go."""
    found = decontaminate.find_contamination(carried(docs), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return restored(found.filter(F.size("hits") == 0), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its personal data becomes ``<email>`` and the
    like, and ``n_chars`` follows where a text changed."""
    found = pii.with_spans(carried(docs), pii.fit(docs.select("text")))
    found = found.withColumn("text", pii.masked(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        n = F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("rest__.n_chars"))
        found = found.withColumn("rest__", F.col("rest__").withField(
            "n_chars", n.cast(docs.schema["n_chars"].dataType)))
    return restored(found, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: the learned models, the approximate candidate search and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
