"""From raw documents to token ids: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, contaminated documents go, and the rest is encoded.

Every stage takes the documents its predecessor kept and returns the columns of documents; the
last one returns doc_id, n_tokens, token_ids (little-endian unsigned 32-bit integers) and
decoded_sha256 (of the bytes the ids decode to). Null texts and ids, empty and repeated rows are
treated as the operators' modules say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import byte_bpe, decontaminate, line_dedup, near_dedup, toxicity
from orderloom.llm.common import written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate_lines(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_checked(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("byte_bpe", encode),
]

#: Sketches, models and merges are beyond SQL; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
