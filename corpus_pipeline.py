"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes the documents that the one before it kept, and is written as Parquet and read
again before the next one starts; all but the last return the columns of documents.
Personal data is masked before packing, so none of it reaches the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodlens.llm import decontamination, near_dedup, packing, pii, quality
from periodlens.llm.rows import bounded_batches, discard_staged, stage, staged
from periodlens.llm.tokens import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return quality.filter_documents(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_pii(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(spark, docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("packing", packed_sequences),
]

#: no SQL expresses the trained classifier, the tokenizer or the packing; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = staged()
    for name, function in STAGES:
        docs = stage(spark, function(spark, docs, sf_dir), name.replace(" ", "-"))
        discard_staged(spark, before, keep=1)  # what this run wrote, but for the stage's result
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
