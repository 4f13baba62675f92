"""Registered queries over the whole text tables: op1 to op13 and the pipeline.

Each applies one operator of this package with production parameters to all rows and
derives the contract's columns from its result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillstar.llm import bpe, contamination, fingerprints, language, neardup, privacy, ranking, secrets, spelling, tokens, toxicity, urls, vectors

TOKENIZER = "word_bpe_49k.json"
# Of the registered query only; a real run passes a secret of its own.
SURROGATE_KEY = "registered-query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo: how the contracts deal out rows to learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find(_table(spark, sf_dir, "documents"), width=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _remainder(5) == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(_table(spark, sf_dir, "documents"), labels)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _remainder(4) == 2
    found = language.identify(_table(spark, sf_dir, "documents"), may_learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.replace(docs, SURROGATE_KEY)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.judge(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def misspelt_variants(docs: DataFrame) -> DataFrame:
    """Groups of the contract's words: a run loses a letter where 31 divides the crc32 of its
    document's id (none: the empty text) and itself."""
    run = F.col("run")
    named = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(named.cast("binary"))
    cut = F.pmod(h, F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), cut), F.substr(run, cut + 2))
    changed = F.when(F.pmod(h, F.lit(31)) == 0, shorter).otherwise(run)
    return spelling.variants(spelling.runs(docs).select(changed.alias("run")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return misspelt_variants(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.find(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_fingerprints": op3_fingerprints,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_surrogates": op7_surrogates,
    "op8_secrets": op8_secrets,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ranked_search": op12_ranked_search,
    "op13_vector_duplicates": op13_vector_duplicates,
    "pipeline": corpus_pipeline.run,
}
# The words of `misspelt_variants`: crc32 by its table of bytes, made by eight shifts each.
_MISSPELT_WORDS = r"""
    WITH RECURSIVE bytes AS (SELECT list(code ORDER BY i) AS codes FROM (
        SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS code
        FROM range(256) t(i))),
    runs AS (SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents) GROUP BY doc_id, run),
    coded AS (SELECT run, n, codes, flatten(list_transform(
        string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                  ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END)) AS b
        FROM runs, bytes),
    hashed AS (SELECT run, n, xor(list_reduce([4294967295] || b,
        lambda c, x: xor(c >> 8, codes[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM coded),
    words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                     ELSE run END AS word FROM (SELECT run, h, unnest(range(n)) FROM hashed))
"""
ORACLES: dict[str, str] = {
    "op1_url_filter": urls.oracle(),
    "op11_spelling_variants": spelling.oracle(_MISSPELT_WORDS),
    "op12_ranked_search": ranking.oracle(),
    "op13_vector_duplicates": vectors.oracle(),
}
