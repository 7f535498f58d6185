"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are dealt into blocks of bounded size, queries into groups; each (block, group) pair is
one task.  A task sorts its block once per dimension.  For a query, dimension i's list is read
from its best end (descending if the query's component is positive, else ascending); after depth d
no unseen vector can score more than the threshold, the sum over dimensions of the query's
component times the list value at d.  Unseen vectors met in the next stretch of the lists are
scored exactly; the scan stops when the k-th best score exceeds the threshold (on equality it
goes on, because a tie may go to a smaller id).  The k best of each block meet per query.

Defined cases: components are ``floor(scale * x)`` with x as double, as 64-bit integers (a component outside
64 bits counts as non-finite); vectors that are null or
hold null or non-finite components take no part; a vector meets queries of its own length only
(vectors of length 0 score 0); a row whose id equals the query's is not its candidate; rows with
a null id take no part; repeated (id, vector) rows count once, and an id with several vectors
keeps the best score per query vector; a score beyond 64 bits is cut to them.  Ties go to the smaller id; fewer than k candidates give
fewer rows; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
GROUP_ROWS = 1024
FIRST_DEPTH = 64
EXACT_DOUBLE = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Block:
    """The vectors of one block with their sorted per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], vectors[order]
        self.lists = np.argsort(self.v, axis=0, kind="stable")      # (rows, dims): ascending row numbers
        self.largest = np.abs(self.v.astype(np.float64)).sum(axis=1).max() if self.v.size else 0.0

    def top(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors for one query, by (score desc, id asc)."""
        n, dims = self.v.shape
        # In doubles while every partial sum is a whole number below 2**53.
        plain = self.largest * max(1.0, float(np.abs(q.astype(np.float64)).max(initial=0))) < EXACT_DOUBLE
        kind = np.float64 if plain else object
        q = q.astype(kind)
        active = np.flatnonzero(q != 0)
        seen = np.zeros(n, bool)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        depth, step = 0, FIRST_DEPTH
        forward = q[active] > 0
        while depth < n:
            upto = min(n, depth + step)
            if len(active):
                at = np.where(forward[None, :], n - 1 - np.arange(depth, upto)[:, None], np.arange(depth, upto)[:, None])
                rows = self.lists[at, active[None, :]]
                fresh = np.zeros(n, bool)
                fresh[rows.ravel()] = True
                fresh &= ~seen
                bound = (self.v[rows[-1], active].astype(kind) * q[active]).sum()
            else:                                                     # every vector scores 0
                fresh, bound, upto = ~seen, 0, n
            seen |= fresh
            found = np.flatnonzero(fresh)
            s = self.v[found].astype(kind) @ q
            cand, sc = self.ids[found], s
            own = cand != query_id
            ids, scores = np.append(ids, cand[own]), np.append(scores, sc[own])
            best = np.lexsort((ids, -scores))
            best = _distinct(ids, best, k)
            ids, scores = ids[best], scores[best]
            depth, step = upto, step * 2
            if len(ids) == k and scores[-1] > bound or seen.all():
                break
        return ids, scores


def _distinct(ids: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The first k entries of ``order`` with different ids."""
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def _task(k: int):
    """One (block, group) pair: rows (.., is_query, id, vector) sorted by pair, vectors first."""
    def results(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dims = table["dims"][0].as_py()
        ids, is_query = np.asarray(table["vec_id"]), np.asarray(table["is_query"])
        flat = np.asarray(table["v"].combine_chunks().flatten()).reshape(len(ids), dims)
        if is_query.all() or not is_query.any():
            return
        block = Block(ids[~is_query], flat[~is_query])
        for qid, q in zip(ids[is_query].tolist(), flat[is_query], strict=True):
            got, scores = block.top(qid, q, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(got), qid)), pa.array(got), pa.array([max(LEAST, min(MOST, int(s))) for s in scores], pa.int64())],
                names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pair = [], None
        for batch in batches:
            keys = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if z == a:
                    continue
                if held and keys[a] != pair:
                    yield from results(pa.Table.from_batches(held))
                    held = []
                pair = keys[a]
                held.append(batch.slice(a, z - a))
        if held:
            yield from results(pa.Table.from_batches(held))
    return run


def whole_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<bigint>, dims) of the rows that take part."""
    limit = float(1 << 63)
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
            .where(F.col("vec_id").isNotNull() & usable_of("x", scale, limit))
            .select("vec_id", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))
            .withColumn("dims", F.size("v")).distinct())


def usable_of(col: str, scale: int, limit: float):
    """Whether an array is there and every component is a number whose scaled floor fits 64 bits."""
    return F.coalesce(F.forall(col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                               & (F.abs(c.cast("double") * scale) < F.lit(limit))), F.lit(False))


def top_k(rows: DataFrame, every: int = 50, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all vectors for each query, the rows whose
    id is divisible by ``every``."""
    v = whole_vectors(rows, scale, id_col, vector_col)
    query = F.col("vec_id") % every == 0
    sizes = v.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(query).alias("q"))
    sizes = (sizes.where("q > 0")
             .select("dims", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
                     F.ceil(F.col("q") / GROUP_ROWS).cast("int").alias("groups")))
    dealt = (v.join(sizes, "dims")
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
             .withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("groups")).cast("int")))
    cols = [F.xxhash64("dims", "block", "group").alias("pair"), "is_query", "dims", "vec_id", "v"]
    vectors = (dealt.withColumn("group", F.explode(F.expr("sequence(0, groups - 1)")))
               .withColumn("is_query", F.lit(False)).select(cols))
    queries = (dealt.where(query).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
               .withColumn("is_query", F.lit(True)).select(cols))
    found = (vectors.unionAll(queries).repartition("pair").sortWithinPartitions("pair", "is_query", "vec_id")
             .mapInArrow(_task(k), "query_id long, vec_id long, score long"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
