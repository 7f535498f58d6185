"""Approximate nearest neighbours by inner product: randomly rotated one-bit codes with error bounds.

Index.  Vectors are dealt to lists (nearest of a few centres, fitted on a bounded sample) and
lists into blocks of bounded size.  A vector's residual from its list's centre is turned by one random
rotation into ``bits`` dimensions; its code is the sign bits, packed.  Two scalars correct it: the
residual's length, and the inner product of the unit residual with its code.  Every row is indexed.

Search.  The rotated query is rounded to ``PLANES`` bits a component; its bit planes and a code meet by AND
and a bit count, which gives the estimate of the inner product.  The estimate's error is normal about
0 in the choice of rotation; a vector whose estimate plus ``SIGMAS`` of its error cannot beat the k-th best
found is left out, all others are scored by their exact inner product in doubles.  A query first
searches the blocks of its own list; its k-th best there is the floor for all other blocks, and a block whose centre
and radius cannot reach the floor is left out whole.

Defined cases: vectors that are null, hold null or non-finite components, have no component or are zero take no part; rows with a null id
take no part; a vector meets queries of its own length only; a row whose id equals the query's is not its
candidate; repeated rows count once, several vectors of one id count as one with the best score; ties go to the smaller id; fewer
than k candidates give fewer rows; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import store, vectors

EVERY, K = 20, 20
LEAST_BITS = 128             # of a code; more where vectors have more dimensions
PLANES = 6
SIGMAS = 3.0
BLOCK_ROWS, GROUP_ROWS = 2048, 1024
SAMPLE = 16_384              # vectors of one length that centres are fitted on
LISTS = 256                  # at most, per length
ROUNDS = 8                   # of fitting centres
SEED = 12
SLACK = 1e-12
FEW = 128                    # queries whose estimates are held at a time


class Model:
    """Rotation and centres for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dims = sample.shape[1]
        self.bits = max(LEAST_BITS, -(-self.dims // 64) * 64)
        self.turn = np.linalg.qr(rng.standard_normal((self.bits, self.dims)))[0].T.copy()     # (dims, bits)
        centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
        for _ in range(ROUNDS if len(centres) > 1 else 0):
            near = nearest(sample, centres)
            centres = np.stack([sample[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(len(centres))])
        self.centres = centres if len(centres) > 1 else sample.mean(axis=0, keepdims=True)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.argmin(np.nan_to_num((centres ** 2).sum(axis=1) - 2 * x @ centres.T, nan=np.inf), axis=1)


class Block:
    """Codes and corrections of the vectors of one block."""

    def __init__(self, model: Model, centre: int, ids: np.ndarray, x: np.ndarray):
        self.model, self.ids, self.x = model, ids, x
        self.centre = model.centres[centre]
        with np.errstate(all="ignore"):
            off = x - self.centre
            self.length = np.sqrt((off ** 2).sum(axis=1))
            turned = off @ model.turn
            ones = turned > 0
            # Inner product of the unit residual and its code, of entries +-1 / sqrt(bits).
            self.fit = np.abs(turned).sum(axis=1) / np.sqrt(model.bits) / self.length
            spread = np.sqrt(np.maximum(0, 1 - self.fit ** 2)) / self.fit / np.sqrt(model.bits - 1)
        self.codes = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)
        self.counts = ones.sum(axis=1)
        self.spread = spread
        self.radius = self.length.max(initial=0)

    def estimates(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimate, its error bound) of the inner product of each query with each vector."""
        m = self.model
        turned = q @ m.turn
        low, width = turned.min(axis=1), np.ptp(turned, axis=1) / ((1 << PLANES) - 1)
        levels = np.rint((turned - low[:, None]) / np.maximum(width, 1e-300)[:, None]).astype(np.uint8)
        dot = np.zeros((len(q), len(self.x)), np.int32)
        for p in range(PLANES):
            plane = np.packbits((levels >> p) & 1, axis=1, bitorder="little").view(np.uint64)
            for w in range(self.codes.shape[1]):
                dot += np.bitwise_count(self.codes[None, :, w] & plane[:, w, None]).astype(np.int32) << p
        signed = 2 * (width[:, None] * dot + low[:, None] * self.counts) - turned.sum(axis=1)[:, None]
        scale = self.length / self.fit / np.sqrt(m.bits)
        norm = np.sqrt((q ** 2).sum(axis=1))
        # Of the code, and of rounding the query (uniform inside a step).
        error = norm[:, None] * (self.length * self.spread) + (width * np.sqrt(m.bits / 12))[:, None] * scale
        return (q @ self.centre)[:, None] + scale * signed, SIGMAS * error

    def search(self, q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query id, ids, scores, vectors scored) of the k best of each query that reach its floor."""
        with np.errstate(all="ignore"):
            reach = q @ self.centre + self.radius * np.sqrt((q ** 2).sum(axis=1))
            can = np.flatnonzero(~(reach < floors))
            for at in range(0, len(can), FEW):
                few = can[at: at + FEW]
                guess, error = self.estimates(q[few])
                # A vector on the centre has no code; its product is the centre's, but for rounding.
                centred = (q[few] @ self.centre)[:, None] + SLACK * np.sqrt((q[few] ** 2).sum(axis=1)[:, None] * (self.centre ** 2).sum())
                most = np.where(self.length == 0, centred, guess + error)
                most[~np.isfinite(most)] = np.inf
                guess = np.where(np.isfinite(guess), guess, most)
                for row, one in enumerate(few):
                    yield self._best(int(q_ids[one]), q[one], guess[row], most[row], floors[one], k)

    def _best(self, q_id: int, q: np.ndarray, guess: np.ndarray, most: np.ndarray, floor: float, k: int):
        n = len(guess)
        ahead = k + 1                                       # the query's own vector may be the best
        first = np.argpartition(guess, n - ahead)[n - ahead:] if n > ahead else np.arange(n)
        score = (self.x[first] * q).sum(axis=1)
        ids = self.ids[first]
        other = ids != q_id
        got = vectors.best(ids[other], score[other], k)
        if len(got) == k:
            floor = max(floor, score[other][got[-1]])
        left = most >= floor
        left[first] = False
        rest = np.flatnonzero(left)
        ids, score = np.append(ids, self.ids[rest]), np.append(score, (self.x[rest] * q).sum(axis=1))
        keep = (ids != q_id) & ~(score < floor)
        ids, score = ids[keep], score[keep]
        got = vectors.best(ids, score, k)
        return q_id, ids[got], score[got], len(first) + len(rest)


def _assign(models):
    """Adds each vector's list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            dims, lists = np.asarray(batch.column("dims")), np.zeros(batch.num_rows, np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                lists[at] = nearest(vectors.matrix(t.take(at)["x"], len(at)), models.value[int(d)].centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=[*batch.schema.names, "list"])
    return run


def _pairs(models, k: int):
    """Searches each (block, group of queries) row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != number:
                    number, dims = r["block"], r["dims"]
                    block = Block(models.value[dims], r["list"], vectors.unpacked(r["ids"], "i8"), vectors.unpacked(r["x"], "f8", dims))
                found = list(block.search(vectors.unpacked(r["q_ids"], "i8"), vectors.unpacked(r["q"], "f8", dims),
                                          vectors.unpacked(r["floors"], "f8"), k))
                ids = [x for _, x, _, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _, _ in found], [len(x) for x in ids]).astype(np.int64)),
                     pa.array(np.concatenate([np.zeros(0, np.int64), *ids])),
                     pa.array(np.concatenate([np.zeros(0), *(s for _, _, s, _ in found)]))],
                    names=["query_id", "vec_id", "score"])
    return run


class Index:
    """Blocks of coded vectors, written to the shared folder."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = SEED):
        spark = self.spark = rows.sparkSession
        v = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
             .where(F.col("vec_id").isNotNull() & vectors.usable("x"))
             .where(F.exists("x", lambda c: c != 0)).dropDuplicates()
             .withColumn("dims", F.size("x")))
        v = store.saved(v, "vectors")
        sizes = {r["dims"]: r["n"] for r in v.groupBy("dims").agg(F.count("*").alias("n")).collect()}   # a row per length
        self.models = spark.sparkContext.broadcast({d: self._model(v, d, n, seed) for d, n in sizes.items()})
        vectors.batch_rows(spark, vectors.BATCH_ROWS)
        types = dict(v.dtypes)
        self.rows = store.saved(v.mapInArrow(_assign(self.models), f"vec_id long, x {types['x']}, dims int, list int"), "assigned")
        # Blocks of each list, numbered one after the other (a row per list).
        lists = (self.rows.groupBy("dims", "list").agg(F.count("*").alias("n"))
                 .withColumn("pieces", F.ceil(F.col("n") / vectors.rows_per_block(F.col("dims"), BLOCK_ROWS)).cast("int")))
        before = Window.orderBy("dims", "list").rowsBetween(Window.unboundedPreceding, -1)
        self.lists = store.saved(lists.withColumn("first", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "lists")
        piece = F.pmod(F.xxhash64("vec_id", "x"), F.col("pieces"))
        dealt = self.rows.join(F.broadcast(self.lists), ["dims", "list"]).withColumn("block", F.col("first") + piece)
        packed = vectors.pack(dealt, "block", {"vec_id": "i8", "list": "i4"}, ["vec_id"])
        self.blocks = store.saved(packed.withColumnRenamed("vec_id", "ids"), "blocks")

    def _model(self, v: DataFrame, dims: int, n: int, seed: int) -> Model:
        """Fitted on up to ``SAMPLE`` vectors of the length, by hash."""
        some = v.where(F.col("dims") == dims)
        if n > SAMPLE:
            some = some.where(F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n)).limit(2 * SAMPLE)
        sample = some.select(F.transform("x", lambda c: c.cast("double")).alias("x")).toArrow()
        rows = vectors.matrix(sample["x"], sample.num_rows) if sample.num_rows else np.zeros((1, dims))
        return Model(rows, int(np.clip(n // BLOCK_ROWS, 1, LISTS)), seed)

    def _pairs(self, queries: DataFrame, own: bool, k: int) -> DataFrame:
        """Results of each query with the blocks of its own list, or with all others."""
        size = vectors.rows_per_block(F.col("dims"), GROUP_ROWS)
        groups = queries.groupBy("dims", "list").agg(F.count("*").alias("n")).withColumn("pieces", F.ceil(F.col("n") / size).cast("int"))
        before = Window.orderBy("dims", "list").rowsBetween(Window.unboundedPreceding, -1)
        groups = store.saved(groups.withColumn("first", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "groups")
        dealt = queries.join(F.broadcast(groups), ["dims", "list"])
        dealt = dealt.withColumn("group", F.col("first") + F.pmod(F.xxhash64("vec_id", "x", F.lit(1)), F.col("pieces")))
        packed = vectors.pack(dealt, "group", {"vec_id": "i8", "floor": "f8", "list": "i4"}, ["vec_id"])
        packed = store.saved(packed.select("group", F.col("vec_id").alias("q_ids"), F.col("floor").alias("floors"), F.col("x").alias("q")), "query-groups")
        numbers = groups.select("dims", F.col("list").alias("of"), F.explode(F.expr("sequence(first, first + pieces - 1)")).alias("group"))
        of = F.col("of") == F.col("list")
        # A row per list of blocks (at most LISTS a length) meets each group, then its blocks are spelt out.
        pairs = (numbers.join(F.broadcast(self.lists), "dims").where(of if own else ~of)
                 .select("group", F.explode(F.expr("sequence(first, first + pieces - 1)")).alias("block"), "list"))
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        asked = pairs.join(packed, "group").repartition(parts, "block")
        blocks = self.blocks.select("block", "dims", "ids", "x").repartition(parts, "block")
        vectors.batch_rows(self.spark, vectors.PACKED_BATCH_ROWS)
        met = asked.join(blocks.hint("merge"), "block").select("block", "list", "dims", "ids", "x", "q_ids", "floors", "q")
        return store.saved(met.mapInArrow(_pairs(self.models, k), "query_id long, vec_id long, score double"), "found")

    def search(self, every: int = EVERY, k: int = K) -> DataFrame:
        """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``."""
        queries = self.rows.where(F.col("vec_id") % every == 0)
        near = self._pairs(queries.withColumn("floor", F.lit(float("-inf"))), True, k)
        floors = top(near, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        queries = queries.join(floors, "vec_id", "left").na.fill(float("-inf"), ["floor"])
        far = self._pairs(queries, False, k)
        return top(near.unionAll(far), k)


def top(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of each query."""
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(rows: DataFrame, every: int = EVERY, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): indexes all rows, then searches with every ``every``-th id."""
    return Index(rows, id_col, vector_col).search(every, k)
