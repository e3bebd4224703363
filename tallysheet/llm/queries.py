"""Queries over the supplied tables: one for each operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.llm import (
    alignment,
    attentionlm,
    hardnegatives,
    hostrules,
    langid,
    lshforest,
    mixing,
    multiindex,
    oracles,
    packing,
    pii,
    toxicity,
    urlrules,
    wordpiece,
)
from tallysheet.llm.tables import read, stored

Query = Callable[[SparkSession, str], DataFrame]

# A parameter of the queries; on a cluster, the place where every executor has the file.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf_dir, "documents"), WORD_BPE)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # Sizes and digests are needed twice, the texts once.
    narrow = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.text_digest(F.col("text")).alias("digest"))
    mixed = mixing.mix_sources(stored(narrow, "sizes"), size="size", digest="digest")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; false for a null id."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", _held_out(4, 2).alias("held_out"))
    filters = langid.learn(docs.where("doc_id is not null and not held_out"))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), filters)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", _held_out(5, 0).alias("held_out"))
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(~_held_out(5, 0))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, model, with_sentences=True).select(
        "doc_id", "held_out", "score", "predicted", F.size("sentences").alias("n_sentences"),
        F.col("sentences").cast("string").alias("sentences"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpiece.count_tokens(docs, WORD_BPE).select("doc_id", "n_words", "n_tokens")


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    measured = hostrules.measure(docs.select("doc_id", "source", "text"))
    judged = hostrules.judge_measured(measured.drop("text"))
    return judged.select(
        "doc_id", *hostrules.MEASURES, "base_failed", "kept", "source", "host_docs", "host_failures", "host_rate",
        "host_verdict",
    )


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlrules.judge(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule", "mined_confidence")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lshforest.near_duplicates(docs, keep_text=False).select("doc_id", "class_id", "n_links")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs)
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    digest = lambda g: F.when(g == "", "").otherwise(F.sha2(g, 256))
    aligned = alignment.align(docs, BYTE_BPE, PIECE_BPE, BYTE_RANKS, groups=digest)
    return aligned.select("doc_id", *alignment.MEASURES[:-1], F.col("groups").alias("groups_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hardnegatives.mine(vectors, F.col("vec_id") % 50 == 0)


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", _held_out(7, 2).alias("held_out"))
    is_training = F.col("doc_id").isNotNull() & ~F.col("held_out")
    return attentionlm.score(docs, BYTE_RANKS, is_training, keep=("doc_id", "held_out"))


_QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_mix_sources": op2_mix_sources,
    "op3_language": op3_language,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_host_rules": op6_host_rules,
    "op7_url_rules": op7_url_rules,
    "op8_nearest": op8_nearest,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_personal_data": op10_personal_data,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lm_scoring": op13_lm_scoring,
}


def queries() -> dict[str, Query]:
    return {**_QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
