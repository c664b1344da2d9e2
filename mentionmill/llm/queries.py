"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionmill.llm import centroid_clustering, decontaminate, embedding_dedup, extraction, line_dedup, minhash_dedup, packing, quality, sharding, substring_dedup, suffix_dedup, toxicity, vector_codes
from mentionmill.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"), length=400)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_windows(table(spark, sf_dir, "documents"), span=13)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave_shards(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.expected_severity(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def queries():
    return {f.__name__: f for f in (op1_near_dedup, op2_line_dedup, op3_suffix_dedup, op4_substring_dedup, op5_quality_rules, op6_sharding, op7_packing, op8_html_extraction, op9_decontamination, op10_toxicity, op11_centroid_clustering, op12_vector_codes, op13_embedding_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": minhash_dedup.SQL, "op2_line_dedup": line_dedup.SQL, "op3_suffix_dedup": suffix_dedup.SQL, "op4_substring_dedup": substring_dedup.SQL,
        "op5_quality_rules": quality.SQL, "op6_sharding": sharding.SQL, "op9_decontamination": decontaminate.SQL,
        "op11_centroid_clustering": centroid_clustering.SQL, "op12_vector_codes": vector_codes.SQL, "op13_embedding_dedup": embedding_dedup.SQL,
    }
