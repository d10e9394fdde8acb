"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. quality rules: documents that fail the base rules or the likelihood ratio go;
2. line dedup: lines found in five documents or more stay in the one with the largest doc_id;
3. near duplicates: of each class of linked documents the one with the smallest doc_id stays;
4. secret scan: reported spans are masked;
5. packing: the documents that are left, as pieces in sequences of at most 2048 tokens.

Where a stage changes a text, n_chars is counted anew. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.llm import lines, neardup, packing, quality, secrets
from seamark.llm.common import read, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def single_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs, "_n_lines", "_n_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", single_lines),
    ("near duplicates", one_of_each),
    ("secret scan", without_secrets),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
