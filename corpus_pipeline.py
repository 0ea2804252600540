"""A training-data pipeline over ``documents``, stage by stage, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableferry.llm.common import new_folder, ship, table
from tableferry.llm.decontaminate import decontaminate
from tableferry.llm.language import identified
from tableferry.llm.near_dups import one_of_each
from tableferry.llm.pieces import encode_digest
from tableferry.llm.secret_scan import redact

#: Per cent of shared runs of five words from which the near-dedup stage takes texts for copies.
SIMILARITY = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the documents themselves."""
    ship(spark)
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return one_of_each(docs, SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return redact(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids, decoded text and source spans of what is left."""
    ship(spark)
    return encode_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: The learned and tokenizer stages have no SQL form; tests hold the run against its stages by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        folder = new_folder(spark, f"stage{place}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
