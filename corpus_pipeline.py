"""A corpus pipeline of dealt operators, stage by stage.

Every stage gets all its predecessor kept, is written as Parquet and read again by the next.

1. Language ID by the random field: documents without a letter, and those whose words the field
   does not give to one language with at least ``LANGUAGE_SCORE``, go.
2. Line dedup: lines that a source repeats on many of its documents are cut out of them.
3. N-gram Jaccard join (five words, 0.8): of each group the document with the smallest id stays.
4. Mixing sources to target weights: each document stands as often as the mix takes it.
5. Byte-level BPE: what a trainer would read, as counts and digests of ids and decoded bytes.

Missing columns are an error; null, empty and repeated rows follow the rules of the operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dimstar.llm import byte_bpe, language_crf, line_dedup, mixing, ngram_join, ready
from dimstar.session import shared_folder

LANGUAGE_SCORE = 0.4
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    field = language_crf.learn(docs)
    judged = language_crf.identify(docs, field)
    kept = (judged.lang_pred != language_crf.UND) & (judged.score >= LANGUAGE_SCORE)
    return judged.where(kept).select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return line_dedup.without_boilerplate(docs, "source")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return ngram_join.one_per_group(docs, ngram_join.Similarity(width=5, percent=80))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    return byte_bpe.round_trips(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE", token_stage),
]

# SQL expresses neither the random field nor the splitting tree nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
