"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, gam, html_text, jaccard, licenses, line_quality, mixing, pii, resampling, rotated_codes, secret_scan, topk, zone_blocks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under 4-word shingle Jaccard similarity >= 0.85."""
    return jaccard.components(_table(spark, sf_dir, "documents"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query
def op1_site_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, without site templates."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


@query
def op2_layered_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, also below nested encodings."""
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text decoded from them, as counts and digests."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                       public_tokenizers.PATTERN)


@query
def op5_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line counts of every text, and the verdict of the base and line-frequency rules."""
    return line_quality.rules(_table(spark, sf_dir, "documents"))


ORACLES["op5_line_frequency_rules"] = line_quality.ORACLE


@query
def op5_line_frequency_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines that are frequent in its host, and the verdict."""
    return line_quality.cleaned(_table(spark, sf_dir, "documents")).select("doc_id", "text", "kept")


ORACLES["op5_line_frequency_texts"] = line_quality.ORACLE_TEXTS


@query
def op6_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, token weight, calibrated probability and draw of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


ORACLES["op6_raked_mixture"] = mixing.oracle()


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced, and the number of detections per kind."""
    safe = pii.protect(_table(spark, sf_dir, "documents"))
    counts = [safe["pii_counts"][k].alias(f"n_{kind}") for k, (kind, _) in enumerate(pii.KINDS)]
    return safe.select("doc_id", "text", *counts)


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text by an additive model of the labels that are not held out."""
    scored = gam.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every text: name, coverage and span."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


@query
def op10_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector with all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


ORACLES["op10_threshold_topk"] = """
with v as (
  select vec_id, [floor(256 * x::double) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
where rank <= 5
"""


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and draw of every document toward the benchmark texts."""
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op12_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector, by one-bit codes and reranking."""
    return rotated_codes.neighbours(_table(spark, sf_dir, "embeddings"))


@query
def op13_zone_block_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector: different labels, scores within 80 to 100 % of each positive's."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return zone_blocks.mine(zone_blocks.Candidates(rows))


ORACLES["op13_zone_block_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
  select a.vec_id as anchor_id, c.vec_id, c.label = a.label as same, list_inner_product(a.v, c.v)::bigint as score
  from v a join v c on c.vec_id <> a.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from pairs where same)
  where place <= 5),
negatives as (
  select p.*, n.vec_id as negative_id, n.score as negative_score,
         row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id)::int as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
    and 80 * positive_score <= 100 * n.score and n.score <= positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 5
"""
