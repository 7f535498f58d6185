"""The corpus pipeline: from raw documents to token digests, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's ``docs``.  All but the last return the columns
they were given.  ``run`` applies them to ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import bpe, gam, jaccard, mixing, pii, store

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return gam.quality(docs, labels).where("predicted = 1").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word similarity of 0.8 or more): the one with the smallest id."""
    return jaccard.keep_one(docs, k=5, num=80, den=100)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the text."""
    return pii.protect(docs, length_col="n_chars").select(*docs.columns)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probability."""
    return mixing.sample(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of each document."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("pii_surrogates", pii_surrogates),
    ("mixing", mixing_to_targets),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = store.saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# The learned model, the keyed surrogates and the merge loop have no SQL form: tests compare each stage
# with a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
