"""Importance resampling of a corpus toward a target: hashed n-gram features, gains, Gumbel keys.

Both sides are counted into the same buckets: a feature is a run of 1 to ``n`` words, its bucket the CRC-32
of its bytes modulo ``buckets``, had from running CRCs (``crc.py``).  A bucket's gain is the
log ratio of its smoothed shares in target and corpus; a document's weight is the mean gain of its
features.  A keyed Gumbel number is added to the weight, so that taking the highest
scores draws documents without replacement in proportion to the exponential of their weights.

As Spark runs it: every task counts its features into one array (a hot feature is summed where it is
read); at most ``buckets`` sums per task are shuffled.  The gains, one number per bucket, go to all
tasks of the second scan.  Scores are ranked by a range-partitioned sort; the rank is the row's place in
its partition behind the rows of the partitions before.

Defined cases: a null or empty text has no words, no features, and weight 0; repeated rows and repeated ids
are documents of their own, ties by score and id are broken in an arbitrary, fixed order; a null id counts
as the empty text in its key and comes last among equal scores; extra columns are ignored; an empty corpus gives no
rows, an empty target the gains of counts 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import crc, store

N, BUCKETS, PERCENT, LEAST_WORDS, SEED = 2, 10_000, 25, 20, 7
IN_PARTITION = (1 << 33) - 1       # the low bits of monotonically_increasing_id


def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case form, whether a separator) of each byte; bytes of non-ASCII characters are word bytes."""
    b = np.arange(256)
    low = np.where((b >= 0x41) & (b <= 0x5A), b + 32, b)
    return low.astype(np.uint8), (low <= 0x2F) | ((low >= 0x3A) & (low <= 0x60)) | ((low >= 0x7B) & (low <= 0x7F))


def _count(n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, (lower, separator) = np.zeros(buckets, np.int64), byte_classes()
        for batch in batches:
            words = crc.Words(batch.column(0), lower, separator)
            for k in range(1, n + 1):
                total += np.bincount(words.grams(k)[1] % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])
    return run


def _weigh(n: int, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, separator = byte_classes()
        for batch in batches:
            words = crc.Words(batch.column(1), lower, separator)
            per_word = np.zeros(len(words.ends), np.int64)
            for k in range(1, n + 1):
                first, value = words.grams(k)
                per_word[first] += gains[value % np.uint32(len(gains))]
            so_far, last = np.append(0, np.cumsum(per_word)), np.cumsum(words.per_text)
            features = sum(np.maximum(words.per_text - k, 0) for k in range(n))
            weight = (so_far[last] - so_far[last - words.per_text]) // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words.per_text, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])
    return run


def bucket_counts(docs: DataFrame, n: int = N, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket met."""
    store.small_batches(docs.sparkSession)
    return (docs.select(F.col(text_col).alias("text")).mapInArrow(_count(n, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, text_col: str = "text",
                 target_col: str = "text") -> DataFrame:
    """(bucket, corpus, target, gain) for every bucket."""
    spark = docs.sparkSession
    both = (spark.range(buckets).select(F.col("id").alias("bucket"))
            .join(bucket_counts(docs, n, buckets, text_col).withColumnRenamed("n", "corpus"), "bucket", "left")
            .join(bucket_counts(target, n, buckets, target_col).withColumnRenamed("n", "target"), "bucket", "left")
            .na.fill(0))
    both = store.saved(both, "buckets")
    all_s, all_t = (float(x or 0) for x in both.agg(F.sum("corpus"), F.sum("target")).first())
    s, t = F.col("corpus").cast("double"), F.col("target").cast("double")
    ratio = (t + 1) * F.lit(all_s + buckets) / ((s + 1) * F.lit(all_t + buckets))
    return both.select("bucket", "corpus", "target", F.floor(1000 * F.ln(ratio)).alias("gain"))


def scores(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(docs, target, n, buckets, text_col, target_col).select("bucket", "gain").collect():   # one row per bucket
        gains[r["bucket"]] = r["gain"]
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    weighed = keyed.mapInArrow(_weigh(n, gains), "doc_id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / float(1 << 32))))
    return weighed.withColumn("score", F.col("weight") + gumbel)


def ranks(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank``, from 1 in the given order, by a range-partitioned sort; all ranks in one partition's sort
    are places there, and the sizes of the partitions (one row each) give where they start."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last key splits rows that are equal in all others over the partitions.
    rows = store.saved(rows.withColumn("tie", F.monotonically_increasing_id()), "to-rank")
    placed = (rows.repartitionByRange(parts, *order, "tie").sortWithinPartitions(*order, "tie")
              .withColumn("place", F.monotonically_increasing_id()))
    placed = store.saved(placed, "ranked").withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    rank = F.col("start") + F.col("place").bitwiseAND(IN_PARTITION) + 1
    return placed.join(F.broadcast(starts), "part").select(*[c for c in rows.columns if c != "tie"], rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, n: int = N,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document: ``percent`` of those with ``least_words`` words
    are drawn and have a rank, the others have none."""
    scored = store.saved(scores(docs, target, n, buckets, seed, id_col, text_col, target_col), "scored")
    able = F.col("n_words") >= least_words
    draw = scored.where(able).count() * percent // 100
    drawn = ranks(scored.where(able), F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return (drawn.select(*columns, rank.alias("rank"))
            .unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))))
