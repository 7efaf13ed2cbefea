"""A training corpus in five stages: known languages, one document of each near-duplicate group, no benchmark passages, personal data
masked, byte-level BPE ids. Each stage is written as Parquet and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import byte_bpe, decontaminate, language, near_join, pii
from gaugeworks.llm.common import held_out, table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; texts without letters and mixtures without a main language go."""
    return language.keep_known(docs, language.train(docs.where(~held_out())))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8 or more) the one of the least doc_id stays."""
    return near_join.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and checksums of ids and of the bytes they decode to."""
    keep = ["doc_id", "lang", "source"]
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark),
    ("personal_data", masked),
    ("byte_bpe", encoded),
]

#: The learned models and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
