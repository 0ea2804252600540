"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableferry.llm.common import new_folder, ship, table
from tableferry.llm.decontaminate import leaks
from tableferry.llm.hard_negatives import hard_negatives
from tableferry.llm.language import identify
from tableferry.llm.licenses import scan_licenses
from tableferry.llm.near_dups import SIMILARITY, near_duplicates
from tableferry.llm.pieces import encode_digest
from tableferry.llm.quality import quality
from tableferry.llm.secret_scan import scan
from tableferry.llm.spelling import spelling_variants
from tableferry.llm.templates import main_text
from tableferry.llm.token_counts import count_tokens
from tableferry.llm.token_files import token_files
from tableferry.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

def shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


@shipped
def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), SIMILARITY)


@shipped
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@shipped
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_files(spark, sf_dir, new_folder(spark, "ids"), vocabulary, end_id=1)


@shipped
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@shipped
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@shipped
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_digest(table(spark, sf_dir, "documents"), model)


@shipped
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


@shipped
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@shipped
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@shipped
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


@shipped
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_near_dups,
        op2_license_scan,
        op3_secret_scan,
        op4_token_files,
        op5_language_id,
        op6_html_text,
        op7_pieces,
        op8_token_counts,
        op9_quality_ledger,
        op10_decontaminate,
        op11_toxicity,
        op12_hard_negatives,
        op13_spelling_variants,
    )
}
