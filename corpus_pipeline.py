"""The pipeline from raw documents to token ids.

Each stage works on all rows that the one before kept, written as Parquet in between. Null or empty texts fail the quality
rules; rows with equal ids are handled one by one, and extra columns pass through all but the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ampline.llm import op2_bpe, op4_mixing, op8_simhash, op9_dedup, op10_quality
from ampline.llm.tokenizer import public_path
from ampline.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return op10_quality.keep_good(docs, public_path(op10_quality.TOKENIZER))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the largest id."""
    return op9_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each SimHash component, the one with the smallest id."""
    return op8_simhash.keep_one(docs, op8_simhash.SHINGLE_WORDS, op8_simhash.DISTANCE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that bring the clean, poor and toxic domains to their target weights."""
    return op4_mixing.thinned(docs, op4_mixing.labels_of(spark, sf_dir))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text by document."""
    return op2_bpe.digests(docs, public_path(op2_bpe.TOKENIZER), ["doc_id"])


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", bpe),
]

#: The second to fourth decisions need state, fingerprints and a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
