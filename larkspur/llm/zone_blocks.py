"""Hard negatives from Hilbert-ordered blocks with zone maps.

Candidates are ordered by label and, inside a label, along a Hilbert curve over their components, and cut into
blocks of bounded size: one row of a Parquet table each.  A block's zone map holds the least and
largest value per dimension and of the label.  Interval arithmetic over a zone map bounds the inner
product of an anchor with every vector of the block; a block is read for an anchor only where the bounds meet one of its windows:

* positives: own label, score from the anchor's ``positives``-th best inside its own block upward;
* negatives: another label, score between ``low`` / 100 of a positive's score and that score.

Zone maps are themselves packed in pages, so choosing blocks is a join of pages with groups of anchors; chosen
(block, group) pairs are then joined with the blocks and scored exactly, in doubles (exact below 2**53).

Defined cases: a row with a null id, a null label, a null vector, or a component that is null, not finite or whose scaled floor does not
fit 64 bits takes no part; a vector meets vectors of its own length only; repeated rows count once; several
rows of one id are several anchors, as candidates they count once with the best fitting score; an anchor's own id is
never its positive or negative; ties go to the smaller id; a positive of negative score has no window; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import store, vectors
from larkspur.llm.resampling import ranks

EVERY, POSITIVES, NEGATIVES, LOW, SCALE = 100, 5, 5, 80, 256
BLOCK_ROWS, GROUP_ROWS, PAGE_ZONES = 1024, 512, 512
CURVE_BITS = 2                   # of a dimension in the curve's grid
BY_LENGTH = 1 << 40              # numbers of blocks, groups and pages of one vector length start at its multiple


def curve_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bytes): place of each grid cell along the Hilbert curve, most significant byte first.

    Skilling's transform: undo the curve's rotations from the coarsest bit down, then Gray-code across dimensions.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        top, below = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(dims):
            flip = (x[i] & top) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(flip, below, swap).astype(np.uint32)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << b), np.uint32((1 << b) - 1), np.uint32(0)).astype(np.uint32)
    x ^= turn
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])         # (bits, dims, rows)
    return np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def _with_curve(lows: dict[int, np.ndarray], highs: dict[int, np.ndarray], bits: int):
    """Adds the curve key of each vector, on a grid over the table's range in each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            dims, keys = np.asarray(batch.column("dims")), np.empty(batch.num_rows, object)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x, low, high = vectors.matrix(t.take(at)["x"], len(at)), lows[int(d)], highs[int(d)]
                cell = (x - low) / np.maximum(high - low, 1e-300) * (1 << bits)
                made = curve_keys(np.minimum(cell.astype(np.int64), (1 << bits) - 1), bits) if d else np.zeros((len(at), 1), np.uint8)
                for k, row in zip(at, made, strict=True):
                    keys[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.tolist(), pa.binary())], names=[*batch.schema.names, "curve"])
    return run


def _zone(of: dict[str, np.ndarray], x: np.ndarray) -> list[pa.Array]:
    box = np.concatenate([x.min(axis=0), x.max(axis=0)])
    return [pa.array([of["label"].min()]), pa.array([of["label"].max()]), pa.array([box.tolist()], pa.list_(pa.float64()))]


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each anchor with any vector inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _best_in_row(score: np.ndarray, ids: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(fits)
    got = vectors.best(ids[at], score[at], k)
    return ids[at[got]], score[at[got]]


def _own_blocks(every: int, k: int):
    """The anchors of each block, each with its k-th best score inside the block among its own label (or -inf)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = vectors.unpacked(r["vec_id"], "i8"), vectors.unpacked(r["label"], "i8")
                x = vectors.unpacked(r["x"], "f8").reshape(len(ids), -1)
                at = np.flatnonzero(ids % every == 0)
                floors = []
                for a in at:
                    _, score = _best_in_row(x @ x[a], ids, (labels == labels[a]) & (ids != ids[a]), k)
                    floors.append(score[-1] if len(score) == k else -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), r["block"])), pa.array(ids[at]), pa.array(labels[at]),
                     pa.array(x[at].tolist(), pa.list_(pa.float64())), pa.array(floors, pa.float64())],
                    names=["block", "vec_id", "label", "x", "floor"])
    return run


def _wanted(same: bool, low: int):
    """Whether (anchor, block) pairs need reading, from label and score bounds; windows are the anchor's further columns."""
    def need(labels, windows, least, most, zone_low, zone_high) -> np.ndarray:
        if same:
            return ((labels[:, None] >= zone_low) & (labels[:, None] <= zone_high) & (most >= windows[:, :1]))
        meets = np.zeros(least.shape, bool)
        for w in windows.T[:, :, None]:                      # a missing window is NaN, which nothing meets
            meets |= (least <= w) & (100 * most >= low * w)
        return meets & ~((zone_low == labels[:, None]) & (zone_high == labels[:, None]))
    return need


def _choose(need):
    """(group, block, members) from pages of zone maps and groups of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                labels, blocks = vectors.unpacked(r["labels"], "i8"), vectors.unpacked(r["block"], "i8")
                q = vectors.unpacked(r["q"], "f8").reshape(len(labels), -1)
                box = vectors.unpacked(r["x"], "f8").reshape(len(blocks), -1)
                dims = box.shape[1] // 2
                least, most = bounds(q[:, :dims], box[:, :dims], box[:, dims:])
                meets = need(labels, q[:, dims:], least, most, vectors.unpacked(r["label_low"], "i8"), vectors.unpacked(r["label_high"], "i8"))
                for b in np.flatnonzero(meets.any(axis=0)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["group"]], pa.int64()), pa.array([int(blocks[b])], pa.int64()),
                         pa.array([np.flatnonzero(meets[:, b]).astype("i4").tobytes()], pa.binary())], names=["group", "block", "members"])
    return run


def _read(same: bool, k: int, low: int):
    """Scores the members of a group against a chosen block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = vectors.unpacked(r["vec_id"], "i8"), vectors.unpacked(r["label"], "i8")
                x, members = vectors.unpacked(r["x"], "f8").reshape(len(ids), -1), vectors.unpacked(r["members"], "i4")
                number, q_ids, q_labels = (vectors.unpacked(r[c], "i8")[members] for c in ("anchors", "q_ids", "labels"))
                q = vectors.unpacked(r["q"], "f8").reshape(r["q_n"], -1)[members]
                dims, out = x.shape[1], []
                for a, score in enumerate(q[:, :dims] @ x.T):
                    fits = (labels == q_labels[a]) if same else (labels != q_labels[a])
                    fits &= ids != q_ids[a]
                    for w in np.unique(q[a, dims:][~np.isnan(q[a, dims:])]):
                        inside = fits & (score >= w) if same else fits & (score <= w) & (100 * score >= low * w)
                        got, s = _best_in_row(score, ids, inside, k)
                        out.append((np.full(len(got), number[a]), np.full(len(got), w), got, s))
                cols = [np.concatenate([np.zeros(0), *c]) if j % 2 else np.concatenate([np.zeros(0, np.int64), *c])
                        for j, c in enumerate(zip(*out, strict=True))] if out else [np.zeros(0, np.int64), np.zeros(0)] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "window", "vec_id", "score"])
    return run


class Candidates:
    """The ordered blocks and their zone maps, written to the shared folder."""

    def __init__(self, rows: DataFrame, scale: int = SCALE, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"):
        spark = self.spark = rows.sparkSession
        fits = F.coalesce(F.forall(vector_col, lambda c: F.abs(c.cast("double") * scale) < float(1 << 63)), F.lit(False))
        v = (rows.where(vectors.usable(vector_col) & fits)
             .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                     F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("x"))
             .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).dropDuplicates()
             .withColumn("dims", F.size("x")))
        v = store.saved(v, "whole-vectors")
        # The range of each dimension (a row per length and dimension).
        ranges = (v.select("dims", F.posexplode("x").alias("i", "c")).groupBy("dims", "i").agg(F.min("c").alias("low"), F.max("c").alias("high"))
                  .orderBy("dims", "i").toArrow())
        dims, low, high = (np.asarray(ranges[c].combine_chunks()) for c in ("dims", "low", "high"))
        lows, highs = ({int(d): a[dims == d] for d in np.unique(dims)} for a in (low, high))
        lows, highs = {0: np.zeros(0)} | lows, {0: np.zeros(0)} | highs
        vectors.batch_rows(spark, vectors.BATCH_ROWS)
        keyed = v.mapInArrow(_with_curve(lows, highs, CURVE_BITS), "vec_id long, label long, x array<double>, dims int, curve binary")
        placed = ranks(keyed, "dims", "label", "curve", "vec_id")
        block = F.col("dims").cast("long") * BY_LENGTH + F.floor((F.col("rank") - 1) / vectors.rows_per_block(F.col("dims"), BLOCK_ROWS))
        packed = vectors.pack(placed.withColumn("block", block), "block", {"vec_id": "i8", "label": "i8"}, ["label", "vec_id"],
                              "label_low long, label_high long, zone array<double>", _zone)
        self.blocks = store.saved(packed, "candidate-blocks")
        zones = self.blocks.select("dims", "block", "label_low", "label_high", F.col("zone").alias("x"))
        self.pages = self._numbered(zones, "page", PAGE_ZONES, ["block"], {"block": "i8", "label_low": "i8", "label_high": "i8"})

    def _numbered(self, rows: DataFrame, key: str, most: int, order: list[str], scalars: dict[str, str]) -> DataFrame:
        """``rows`` in ``order`` packed ``most`` at a time; no pack mixes vector lengths."""
        number = F.col("dims").cast("long") * BY_LENGTH + F.floor((F.col("rank") - 1) / most)
        placed = ranks(rows, "dims", *order).withColumn(key, number)
        vectors_of = vectors.pack(placed.drop("dims"), key, scalars, order)
        return store.saved(vectors_of.withColumn("dims", F.floor(F.col(key) / BY_LENGTH).cast("int")), f"{key}s")

    def meet(self, anchors: DataFrame, same: bool, k: int, low: int = LOW) -> DataFrame:
        """(anchor, window, vec_id, score): the best k of every block that an anchor's windows must read.

        ``anchors`` has anchor, vec_id, label, block, dims, and x: the vector followed by its windows.
        """
        groups = self._numbered(anchors, "group", GROUP_ROWS, ["block", "anchor"], {"anchor": "i8", "vec_id": "i8", "label": "i8", "block": "i8"})
        groups = groups.select("dims", "group", F.col("n").alias("q_n"), F.col("anchor").alias("anchors"), F.col("vec_id").alias("q_ids"),
                               F.col("label").alias("labels"), F.col("x").alias("q"))
        spans = self.pages.groupBy("dims").agg(F.min("page").alias("first"), F.max("page").alias("last"))      # a row per length
        asked = (groups.select("dims", "group").join(F.broadcast(spans), "dims")
                 .select("group", F.explode(F.expr("sequence(first, last)")).alias("page")))
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        vectors.batch_rows(self.spark, vectors.PACKED_BATCH_ROWS)
        looked = (asked.join(groups.select("group", "labels", "q"), "group").repartition(parts, "page")
                  .join(self.pages.repartition(parts, "page").hint("merge"), "page"))
        chosen = store.saved(looked.select("group", "labels", "q", "block", "x", "label_low", "label_high")
                             .mapInArrow(_choose(_wanted(same, low)), "group long, block long, members binary"), "chosen")
        self.chosen = chosen
        vectors.batch_rows(self.spark, vectors.PACKED_BATCH_ROWS)
        read = (chosen.join(groups.drop("dims"), "group").repartition(parts, "block")
                .join(self.blocks.select("block", "vec_id", "label", "x").repartition(parts, "block").hint("merge"), "block"))
        return store.saved(read.mapInArrow(_read(same, k, low), "anchor long, window double, vec_id long, score double"), "met")


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best different ids of each ``keys``, with rank."""
    one = found.groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(candidates: Candidates, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, rows whose id is divisible by ``every``."""
    spark = candidates.spark
    vectors.batch_rows(spark, vectors.PACKED_BATCH_ROWS)
    own = candidates.blocks.select("block", "vec_id", "label", "x").mapInArrow(
        _own_blocks(every, positives), "block long, vec_id long, label long, x array<double>, floor double")
    anchors = store.saved(own.withColumn("dims", F.size("x")).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    found = candidates.meet(anchors.withColumn("x", F.concat("x", F.array("floor"))), True, positives)
    best = store.saved(ranked(found, ["anchor"], positives).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("window")), "positives")
    missing = F.array_repeat(F.lit(float("nan")), positives)
    windows = best.groupBy("anchor").agg(F.collect_set("window").alias("w"))                # at most ``positives`` each
    windows = windows.withColumn("w", F.slice(F.concat("w", missing), 1, positives))
    found = candidates.meet(anchors.join(windows, "anchor").withColumn("x", F.concat("x", "w")), False, negatives, low)
    hard = ranked(found, ["anchor", "window"], negatives)
    return (hard.join(best, ["anchor", "window"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    F.col("window").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score")))
