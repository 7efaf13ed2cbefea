"""Registered queries of the thirteen operators, over the driver's tables, and their SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    byte_bpe, decontaminate, host_reputation, language, line_dedup, main_text, near_join, pii, quality_ranking, quality_rules, ranked_search,
    token_files, whitening,
)
from gaugeworks.llm.common import held_out, table
from gaugeworks.session import scratch_path

WORD_TOKENIZER, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
END_ID = 1
#: Rules of the URL query. Fixed values of its contract.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
#: The pages carry no labels of their own: a page with one of these words counts as bad.
BAD_WORDS = r"(?i)\b(clown|idiot|moron|pathetic|scum|stupid|trash|worthless)\b"
PREDICTED_FROM = 0.3


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return token_files.read_tokens(spark, path)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs.select("doc_id", F.col("text")), table(spark, folder, "benchmark"), keep=("doc_id",))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
        F.coalesce(F.array_max("matches.length"), F.lit(0)).alias("longest_match"),
    )


def op3_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    outcomes = pages.select(host_reputation.host_of(F.col("url")).alias("host"), F.col("html").rlike(BAD_WORDS).alias("bad"))
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    # the rule's path holds the slash that ends its host
    judged = host_reputation.judge(pages.select("page_id", "url"), outcomes, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("share", 9).alias("share"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents"))
    strict = F.filter("found", lambda s: s["strict"])
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(strict), 256).alias("base_sha256"), joined("found").alias("spans"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(~held_out()))
    return language.identify(docs.withColumn("held_out", held_out()), model, ("doc_id", "held_out"))


def op8_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_duplicates(table(spark, folder, "documents")).drop("fp")


def op9_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ranking = quality_ranking.train(docs, table(spark, folder, "labels").where(~held_out()), PREDICTED_FROM)
    scored = quality_ranking.score(docs.withColumn("held_out", held_out()), ranking, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED_FROM).cast("int"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, folder, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whiten(table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    digests = "n_lines long, n_dropped long, kept_sha256 string"
    return line_dedup.cut_texts(
        docs, line_dedup.keep_bitmaps(docs), ["doc_id"], digests, lambda text, n, lost: [n, lost, hashlib.sha256(text.encode()).hexdigest()]
    )


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_files, op2_decontaminate, op3_host_reputation, op4_pii, op5_quality_rules, op6_main_text, op7_language, op8_near_join,
            op9_quality_ranking, op10_byte_bpe, op11_ranked_search, op12_whitening, op13_line_dedup,
        )
    }


def statements() -> dict[str, str]:
    from gaugeworks.llm import oracle

    return oracle.statements()
