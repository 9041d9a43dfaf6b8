"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from emberline.llm import (
    conversation_repair, embedding_dedup, exact_dedup, html_extract, line_dedup, mixing, packing, pii_surrogates, secret_scan, simhash_dedup, spelling_variants, substring_dedup, toxicity,
)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op2_source_mixing(spark, sf_dir):
    return mixing.taken_words(documents(spark, sf_dir))


def op3_sequence_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


def op4_pii_surrogates(spark, sf_dir):
    return pii_surrogates.replace_entities(documents(spark, sf_dir))


def op5_secret_scan(spark, sf_dir):
    return secret_scan.scan(documents(spark, sf_dir))


def op6_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(documents(spark, sf_dir), toxicity.fit(documents(spark, sf_dir), labels))


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op8_html_extract(spark, sf_dir):
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def op10_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_line_dedup(spark, sf_dir):
    return line_dedup.deduplicate(documents(spark, sf_dir)).drop("kept_text")


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.group_variants(documents(spark, sf_dir))


def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_source_mixing, op3_sequence_packing, op4_pii_surrogates, op5_secret_scan, op6_toxicity, op7_substring_dedup, op8_html_extract, op9_simhash_near_dedup,
    op10_embedding_near_dedup, op11_line_dedup, op12_spelling_variants, op13_conversation_repair,
)}
ORACLE = {"op1_exact_dedup": exact_dedup.ORACLE, "op7_substring_dedup": substring_dedup.ORACLE, "op10_embedding_near_dedup": embedding_dedup.ORACLE, "op11_line_dedup": line_dedup.ORACLE}
