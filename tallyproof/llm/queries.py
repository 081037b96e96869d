"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm import binary_codes, kneser_ney, language_model, license_scan, merged_bwt, mixing, phrase_index, phrase_mining, probminhash, quality_mil, sequence_files, superkmers, token_alignment
from tallyproof.llm.common import fold, shared_folder, table


def op2_superkmer_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return superkmers.remove_repeats(docs, width=13, with_text=False)


def op3_binary_code_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.9)


def op4_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), held_out=fold("doc_id", 5) == 1)


def op5_probminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=0.8)


def op6_merged_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return merged_bwt.remove_repeated_bytes(docs, length=100, with_text=False)


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_mil.score_quality(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op9_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = kneser_ney.score_toxicity(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 4) != 2)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = phrase_index.contamination(docs, table(spark, sf_dir, "benchmark"), width=10)
    ids = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, "contaminated")


def op8_license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.default_templates(spark), least=0.8)
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), "n_templates")


#: Domains by the number in a source's name, and target weights; languages and sources not named weigh 1.
DOMAIN = "concat('domain', cast(try_cast(regexp_extract(source, '([0-9]+)', 1) as int) % 4 as string))"
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}


def op10_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, F.expr(DOMAIN), WEIGHTS, budget_share=(3, 5), max_epochs=2, seed=7)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), *paths)


def op12_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/sequences-{uuid4().hex}"
    sequence_files.write_sequences(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return sequence_files.read_documents(spark, folder)


def op13_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents").select("lang", "text"), longest=4, least=30, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_attention_quality": op1_attention_quality,
    "op2_superkmer_repeats": op2_superkmer_repeats,
    "op3_binary_code_links": op3_binary_code_links,
    "op4_recurrent_scores": op4_recurrent_scores,
    "op5_probminhash_classes": op5_probminhash_classes,
    "op6_merged_bwt_repeats": op6_merged_bwt_repeats,
    "op7_positional_index": op7_positional_index,
    "op8_license_bands": op8_license_bands,
    "op9_kneser_ney_toxicity": op9_kneser_ney_toxicity,
    "op10_hierarchical_mix": op10_hierarchical_mix,
    "op11_token_alignment": op11_token_alignment,
    "op12_arrow_sequences": op12_arrow_sequences,
    "op13_setm_phrases": op13_setm_phrases,
}
