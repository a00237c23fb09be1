"""The operators' queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodlens.llm import conversation_trie, decontamination, near_dedup, packing, passages, phrases, pii, prefix_tree_join, quality, sharding, suffix_dedup, tokenfile, topk
from periodlens.llm.oracles import ORACLES
from periodlens.llm.rows import bounded_batches
from periodlens.llm.tokens import vocabulary
from periodlens.session import staging_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(spark, table(spark, sf_dir, "documents"))


def op3_vafile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"))


def op4_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op5_ranked_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "token-file")
    tokenfile.write(spark, table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    return tokenfile.digest(spark, folder)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), with_ids=False))


def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shuffle_to_shards(spark, table(spark, sf_dir, "documents")))


def op8_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find_contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))).drop("longest")


def op9_radix_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents")))


def op10_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents")).drop("n_spanning_links")


def op11_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree_join.similar_groups(spark, table(spark, sf_dir, "documents"))


def op12_phrase_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top(phrases.collocations(spark, table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(spark, table(spark, sf_dir, "conversations")).drop("k1", "k2")


_ALL = (
    op1_weak_label_quality, op2_collinear_passages, op3_vafile_topk, op4_pii_deobfuscation, op5_ranked_token_file, op6_best_fit_packing, op7_hypergeometric_shards,
    op8_suffix_decontamination, op9_radix_suffix_dedup, op10_bayesian_minhash, op11_prefix_tree_join, op12_phrase_streams, op13_conversation_trie,
)
QUERIES = {f.__name__: f for f in _ALL}
__all__ = ["ORACLES", "QUERIES"]
