"""The queries of this subpackage: one per operator, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codes, decontaminate, near, quality, repair, toxicity, urls, warc
from .bpe import encode_documents
from .common import table
from .language import identify
from .media import media_round_trip
from .packing import pack_documents
from .tokens import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.page_outcomes(pages, table(spark, sf_dir, "labels"))).drop("bad_rate", "bad_bound")


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op5_bayes_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op6_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_round_trip(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_url_reputation, op3_warc_index, op4_suffix_decontamination, op5_bayes_jaccard_join, op6_media_chunks, op7_language_id, op8_best_fit_packing, op9_toxicity, op10_quality_neighbours, op11_bpe_round_trip, op12_conversation_repair, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_reputation": urls.sql(),
        "op3_warc_index": warc.sql(),
        "op4_suffix_decontamination": decontaminate.sql(),
        "op5_bayes_jaccard_join": near.sql(),
        "op12_conversation_repair": repair.sql(),
        "op13_vector_codes": codes.sql(),
    }
