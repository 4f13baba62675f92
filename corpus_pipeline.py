"""Training-data pipeline over `documents`: language ID, near-duplicates, benchmark
decontamination, secrets, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's docs. All but the last return the columns of
`documents`. All rows and whole texts go through every stage.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import bpe, contamination, language, neardup, secrets
from tillstar.operators.scratch import scratch_root

TOKENIZER = "word_bpe_49k.json"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (`und`): no text, or no letter in it."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return language.keep_identified(docs, may_learn=remainder != 2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group (5 words, similarity 0.8)."""
    return neardup.drop_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold a window of a benchmark item."""
    return contamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in texts; n_chars follows the new text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids)."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.round_trip(docs, path, with_ids=True, keep=("lang", "source"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("token_ids", encode_tokens),
]

# Languages, signatures and token ids cannot be had from SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_root(spark)}/tillstar/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
