"""From raw documents to packed training sequences.

Each stage is written as Parquet and read again as the next one's input. All stages but the last
return the columns of ``documents``.

Edge cases: null and empty texts are no documents and go in the first stage, as texts of fewer than 50
words do; rows with null or repeated ids are told apart by their texts; of equal rows one stays; further
columns are carried, whatever their names, up to the last stage; empty tables go through all stages; a
missing column or table is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, nearcopies, packing, quality, substring
from tidemark.llm.workspace import checkpoint_root


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one(docs, width=5, similarity=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenized_pieces(docs, packing.tokenizer_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Tokenizers and XXH64 are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{checkpoint_root(spark)}/tidemark-stage-{name}-{uuid.uuid4().hex}"
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
