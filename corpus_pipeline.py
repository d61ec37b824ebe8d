"""The corpus pipeline over ``documents``: each stage is written as Parquet and reread by the next.

Language identification drops documents without a language it knows, toxicity
drops toxic ones, the near-duplicate join keeps one document of each class,
decontamination drops documents that hold a window of a benchmark item, and
packing returns the pieces of what is left. All but the last stage return the
columns they are given. Models learn from the labelled rows of ``sf_dir``;
each stage judges every row it is given, whole texts, and takes any columns
besides doc_id and text, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulaire.llm import decontaminate, language, near, toxicity
from tabulaire.llm.common import fold_of, forget, keep, only, table
from tabulaire.llm.packing import pack_documents
from tabulaire.llm.words import keep_rows

#: Documents whose best language is less probable than this are rejected.
LEAST_SURE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in no language that the model is sure of.

    So null and empty texts go. A probability of exactly ``LEAST_SURE`` is sure
    enough; of languages that tie the first by name counts. Repeated rows are
    judged alike and all kept or all rejected; a null doc_id has no part in
    learning and none in the decision. Without any labelled language nothing is
    known, and all documents go.
    """
    known = only(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    model = spark.sparkContext.broadcast(language.learn(known, fold_of(F.col("doc_id"), 4) != 2))

    def sure(texts: list) -> list[bool]:
        got = model.value.predict(texts)
        return [lang != language.UNKNOWN and score >= LEAST_SURE for lang, score in zip(got["lang_pred"], got["score"], strict=True)]

    return keep_rows(docs, sure)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the toxicity model predicts as toxic (a score of 0.5 or more).

    Null and empty texts have the score of a text without known words. Repeated
    rows are judged alike; a null doc_id has no part in learning. Without labels
    every score is about a half, but no document is rejected for that.
    """
    known = only(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", lang="lang")
    learned = toxicity.learn(known, toxicity.labels_of(table(spark, sf_dir, "labels"), "toxic"))
    if not learned.taught:
        return docs
    model = spark.sparkContext.broadcast(learned)
    return keep_rows(docs, lambda texts: model.value.score(texts)["predicted"] == 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of the smallest id of each class of near duplicates, as a whole row.

    Rows without a doc_id come last in a class; of rows that repeat as a whole
    one stays; rows that share a doc_id but no class all stay. Texts without
    words (null and empty ones too) are copies of each other.
    """
    return near.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item.

    Null and empty texts have no words and stay; repeated rows are judged
    alike; the doc_id has no part in it; an empty benchmark rejects nothing.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences.

    A null or empty text is one piece, its end id; repeated rows are packed once
    each; a null doc_id stays null; pieces of equal length are placed in the
    order of doc_id, piece and ids.
    """
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The learned stages have no SQL form; tests hold the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
