"""N-gram Jaccard join: documents linked by shingle overlap, with their components.

Two documents link when ``den * |A & B| >= num * |A | B|`` over their sets of ``k``-word
shingles (ASCII letters compare without case).  The plan, all sizes alike:

1. ``profiles``: one pass over the texts gives each document its set size and a 128-bit set
   digest, and counts shingles that are frequent inside a stretch of documents.  Equal sets
   collapse to one representative, so a group of exact copies costs one row from here on.
2. Shingles in at least one document of ``FREQUENT`` are listed (at most average set size *
   ``FREQUENT`` of them, whatever the corpus size) and ordered last.  Each representative
   sends the first ``n - ceil(num n / den) + 1`` shingles of that order: two linked documents
   share one of them.  A passage that many documents repeat is ordered last and so makes
   no group.
3. The smallest document of each such group is its head; (head, member) rows are *blocks*, the top
   nodes of the signature tree: every pair that can link is inside one block.
4. Heads are compared with their members: bitmap bound, then the exact sets.  Their
   components label the members.  Inside a block, members of close sizes form cells; cells with
   several labels go through the dual traversal (``signature_tree``), which passes over pairs of
   one label; a cell larger than ``NODE_ROWS`` is dealt out as pairs of nodes of bounded size.
   Cells of over ``LINK_ROWS`` members are traversed in linking rounds first, where every
   document proposes a few partners only: the links found join labels, so that the last
   traversal, which is complete for all cells, meets few pairs inside a group of near copies.
5. Pairs that the bitmaps cannot exclude are decided on the exact sets.  No pair, partner or
   candidate is capped.

Defined cases: a text of 1 to k-1 words has its word sequence as its one shingle; a null or
wordless text has the empty set, size 0, and no link.  Rows with the same id count as one
document with the links of all its rows.  A row with a null id links with nothing
and has a null component.  Extra columns are ignored; no rows give no rows.  Sets are compared by
64-bit hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import graph, store
from larkspur.llm import signature_tree as tree
from larkspur.llm.words import Hasher, byte_values, mix, non_space, shingle_sets

K, NUM, DEN = 4, 85, 100
FREQUENT = 1000          # a shingle in one of so many documents is frequent
STRETCH = 1 << 22        # shingles whose counts are kept before they are handed on
NODE_ROWS = 1024
LINK_ROWS, LINK_ROUNDS, PROPOSALS = 64, 1, 4
FILTER_BITS = 1 << 23    # of the fixed-size filter (1 MB) of ids whose sets are wanted

PROFILE = "doc_id long, n long, d1 long, d2 long, shingle long, docs long"
SIGNATURE = "doc_id long, n long, d1 long, d2 long, bits binary, keys array<long>"
PAIR = "a long, b long"


def _hasher() -> Hasher:
    return Hasher(non_space(), byte_values())


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    return tuple(int(_signed([mix(s ^ np.uint64(c)).sum()])[0]) for c in (0x51ED2701, 0x2545F4914F6CDD1D))


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, docs, size = _hasher(), [], 0, 0

        def frequent() -> pa.RecordBatch:
            nonlocal held, docs, size
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(2, docs // (2 * FREQUENT))
            keys, counts, none = _signed(keys[often]), counts[often], pa.nulls(int(often.sum()), pa.int64())
            held, docs, size = [], 0, 0
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(keys), pa.array(counts)],
                                              names=names)

        names = ["doc_id", "n", "d1", "d2", "shingle", "docs"]
        for batch in batches:
            n, d1, d2 = [], [], []
            for s in shingle_sets(hasher, batch.column(1), k):
                a, b = _digest(s)
                n.append(len(s))
                d1.append(a)
                d2.append(b)
                held.append(s)
                docs, size = docs + 1, size + len(s)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 none, none], names=names)
            if size >= STRETCH:
                yield frequent()
        if held:
            yield frequent()
    return run


def _signatures(k: int, num: int, den: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (often, ranks) = _hasher(), frequent.value
        for batch in batches:
            n, d1, d2, bits, keys = [], [], [], [], []
            for s in shingle_sets(hasher, batch.column(1), k):
                a, b = _digest(s)
                n.append(len(s))
                d1.append(a)
                d2.append(b)
                bits.append(tree.bitmap(s).tobytes() if len(s) else b"")
                first = len(s) - (-(-num * len(s) // den)) + 1 if len(s) else 0
                if len(often) and len(s):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    s = s[np.argsort(np.where(often[at] == s, ranks[at], 0), kind="stable")]
                keys.append(_signed(s[:first]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bits, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n", "d1", "d2", "bits", "keys"])
    return run


def _wanted_sets(k: int, wanted):
    """(doc_id, tokens) of documents whose id is in the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, on = _hasher(), np.unpackbits(np.frombuffer(wanted.value, np.uint8))
        for batch in batches:
            ids = batch.column(0)
            batch = batch.filter(pa.array(on[_slot(np.asarray(ids))].astype(bool)))
            sets = [_signed(s) for s in shingle_sets(hasher, batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["doc_id", "tokens"])
    return run


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - (FILTER_BITS.bit_length() - 1))).astype(np.int64)


def _id_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (byte, bit) of the filter that this task's ids set."""
    for batch in batches:
        slots = np.unique(_slot(np.asarray(batch.column(0))))
        yield pa.RecordBatch.from_arrays([pa.array(slots)], names=["slot"])


def _wanted_filter(ids: DataFrame) -> bytes:
    """The packed filter of ``ids``: FILTER_BITS bits whatever their number."""
    # Each row: 4096 bits as one long per 64, so the driver gets FILTER_BITS / 8 bytes at most.
    words = (ids.mapInArrow(_id_filter, "slot long")
             .groupBy(F.expr("slot div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")))
    table = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[np.asarray(table["word"])] = np.asarray(table["bits"]).view(np.uint64)
    # Bit i of a word is slot word * 64 + i; unpackbits reads the most significant bit of a byte first.
    return np.packbits(np.unpackbits(out.view(np.uint8), bitorder="little")).tobytes()


def _close_stars(num: int, den: int):
    """Of rows (a, b, na, nb, bits_a, bits_b) the pairs that sizes and bitmaps cannot exclude."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            keep = []
            for na, nb, x, y in zip(rows["na"], rows["nb"], rows["bits_a"], rows["bits_b"], strict=True):
                u, v = (np.frombuffer(m, np.uint8)[None, :] for m in (x, y))
                w = min(u.shape[1], v.shape[1])
                u, v = (np.ascontiguousarray(tree.fold(m, w)).view(np.uint64) for m in (u, v))
                keep.append(bool(tree.may_link(np.array([na]), np.array([nb]), u, v, num, den)[0]))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _traverse(num: int, den: int, proposals: int | None):
    """Document pairs that may link, of rows (task, side, doc_id, label, n, bits) sorted by task.

    With ``proposals`` a document is the first of at most so many pairs of a task.
    """
    def pairs(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        ids, side = np.asarray(t["doc_id"]), np.asarray(t["side"])
        sizes, labels, maps = np.asarray(t["n"]), np.asarray(t["label"]), t["bits"].to_pylist()
        used = np.zeros(len(ids), np.int64)
        sides = []
        for k in (0, 1):
            at = np.flatnonzero(side == k)
            sides.append(tree.trees(sizes[at], labels[at], [maps[i] for i in at], at))
        for i, j in tree.candidates(sides[0], sides[1] or None, num, den):
            if proposals is not None:
                order = np.argsort(i, kind="stable")
                i, j = i[order], j[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                keep = used[i] + nth < proposals
                i, j = i[keep], j[keep]
                np.add.at(used, i, 1)
            a, b = ids[i], ids[j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))],
                                             names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, task = [], None
        for batch in batches:
            keys = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if z == a:
                    continue
                if task is not None and keys[a] != task:
                    yield from pairs(held)
                    held = []
                task = keys[a]
                held.append(batch.slice(a, z - a))
        if held:
            yield from pairs(held)
    return run


def _open_cells(blocks: DataFrame, labels: DataFrame, num: int, den: int, over: int) -> DataFrame:
    """Members (head, cell, rows, doc_id, label, n) of cells with several labels and more than ``over`` members.

    A cell holds the members of a block (without its head, whose pairs are decided) whose sizes are
    close: cells are twice as wide as the size ratio of a link, on two grids shifted by half a cell, so
    two documents that can link share a cell of one grid or the other.  The second grid is for
    pairs that a border of the first parts: its cells count only with members on both sides.
    """
    step = F.log(F.lit(den / num)) * 1.001
    cells = [F.struct(F.lit(g).alias("grid"), F.floor((F.log("n") + g * step) / (2 * step)).alias("at")) for g in (0, 1)]
    members = (blocks.select("head", F.col("member").alias("doc_id"), "n")
               .join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
               .select("head", "doc_id", "n", F.coalesce("component", "doc_id").alias("label"))
               .withColumn("cells", F.array(*cells)).withColumn("side", F.col("cells")[0]["at"])
               .withColumn("cell", F.explode("cells")).drop("cells"))
    open_cells = (members.groupBy("head", "cell")
                  .agg(F.count("*").alias("rows"), F.min("label").alias("l0"), F.max("label").alias("l1"),
                       F.min("side").alias("s0"), F.max("side").alias("s1"))
                  .where((F.col("rows") > over) & (F.col("l0") != F.col("l1")))
                  .where((F.col("cell.grid") == 0) | (F.col("s0") != F.col("s1"))).select("head", "cell", "rows"))
    return members.drop("side").join(open_cells, ["head", "cell"])


def _tasks(members: DataFrame) -> DataFrame:
    """Rows (task, side, doc_id, label, n): whole cells, and node pairs of large ones."""
    cols = ["task", "side", "doc_id", "label", "n"]
    small = (members.where(F.col("rows") <= NODE_ROWS)
             .withColumn("task", F.xxhash64("head", "cell")).withColumn("side", F.lit(0)).select(cols))
    large = members.where(F.col("rows") > NODE_ROWS)
    if large.isEmpty():
        return small
    # Nodes of a large cell: parts of bounded size, those of a label with many members apart from the rest.
    place = ["head", "cell", "family"]
    pure = (large.groupBy("head", "cell", "label").count().where(F.col("count") > NODE_ROWS)
            .select("head", "cell", "label", F.col("label").alias("family")))
    grouped = large.join(pure, ["head", "cell", "label"], "left").fillna({"family": -1})
    nodes = (grouped.groupBy(place).count().withColumn("parts", F.ceil(F.col("count") / NODE_ROWS).cast("int")))
    node = F.struct("family", "part")
    dealt = (grouped.join(nodes.select(*place, "parts"), place)
             .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")).withColumn("node", node))
    listed = nodes.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn("node", node)
    one = listed.select("head", "cell", F.col("node").alias("x"))
    two = listed.select("head", "cell", F.col("node").alias("y"))
    met = (one.join(two, ["head", "cell"]).where("x <= y and not (x.family = y.family and x.family >= 0)")
           .withColumn("task", F.xxhash64("head", "cell", "x", "y")))
    left = dealt.withColumnRenamed("node", "x").join(met, ["head", "cell", "x"]).withColumn("side", F.lit(0))
    right = (dealt.withColumnRenamed("node", "y").join(met.where("x <> y"), ["head", "cell", "y"])
             .withColumn("side", F.lit(1)))
    return small.unionAll(left.select(cols)).unionAll(right.select(cols))


def _exact(spark: SparkSession, texts: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold; written to the shared folder."""
    with store.Scratch(spark) as scratch:
        pairs = scratch.saved(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            return spark.createDataFrame([], PAIR)
        ids = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b"))
        wanted = spark.sparkContext.broadcast(_wanted_filter(ids))
        sets = texts.mapInArrow(_wanted_sets(k, wanted), "doc_id long, tokens array<long>")
        sets = scratch.saved(sets.join(ids.distinct(), "doc_id", "left_semi"), "sets")
        a = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta"))
        b = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb"))
        shared = F.size(F.array_intersect("ta", "tb")).cast("long")
        return store.saved(pairs.join(a, "a").join(b, "b")
                           .withColumn("o", shared).withColumn("u", F.size("ta") + F.size("tb") - F.col("o"))
                           .where(f"{den} * o >= {num} * u").select("a", "b"), "links")


def join(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The similarity join: (one row per row of ``docs``: doc_id, n_shingles, component_id;
    verified links a < b between representatives that span every component).

    ``num / den`` must be over 1/2.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profiles = store.saved(texts.mapInArrow(_profiles(k), PROFILE), "profiles")
    rows = profiles.where("shingle is null").select("doc_id", "n", "d1", "d2")
    texts = texts.where("doc_id is not null")

    total = rows.count()
    often = (profiles.where("shingle is not null").groupBy("shingle").agg(F.sum("docs").alias("docs"))
             .where(F.col("docs") * FREQUENT >= total).toArrow())
    keys = np.asarray(often["shingle"].combine_chunks()).view(np.uint64)
    order = np.argsort(keys)
    counts = np.asarray(often["docs"].combine_chunks())[order]
    frequent = spark.sparkContext.broadcast((keys[order], counts))

    chosen = (rows.where("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")))
    chosen = store.saved(chosen, "representatives")
    # Rows that share an id are one document: the representatives of its texts are joined.
    owned = rows.join(chosen, ["d1", "d2", "n"]).select("doc_id", "rep")
    several = owned.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    joined = store.saved(owned.join(several, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b"), "same-ids")
    sigs = texts.mapInArrow(_signatures(k, num, den, frequent), SIGNATURE)
    sigs = store.saved(sigs.join(chosen.select(F.col("rep").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"])
                       .select("doc_id", "n", "bits", "keys").distinct(), "signatures")

    postings = sigs.select("doc_id", "n", F.explode("keys").alias("key"))
    heads = (postings.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("n", "doc_id")).alias("h"))
             .where("c > 1").select("key", F.col("h.doc_id").alias("head"), F.col("h.n").alias("head_n")))
    blocks = store.saved(postings.join(heads, "key").where("head <> doc_id")
                         .select("head", "head_n", F.col("doc_id").alias("member"), "n").distinct(), "blocks")

    a = sigs.select(F.col("doc_id").alias("head"), F.col("bits").alias("bits_a"))
    b = sigs.select(F.col("doc_id").alias("member"), F.col("bits").alias("bits_b"))
    # A head is its block's smallest document.  Sizes first, on narrow rows; the bitmaps of what is left follow.
    near = blocks.where(f"{den} * head_n >= {num} * n")
    stars = (near.join(b, "member").join(a, "head")
             .select(F.col("head").alias("a"), F.col("member").alias("b"), F.col("head_n").alias("na"),
                     F.col("n").alias("nb"), "bits_a", "bits_b")
             .mapInArrow(_close_stars(num, den), PAIR))
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    links = joined.unionAll(_exact(spark, texts, stars.select(ordered), k, num, den))
    labels = graph.components(links)

    for over in [LINK_ROWS] * LINK_ROUNDS + [1]:
        with store.Scratch(spark) as scratch:
            members = scratch.saved(_open_cells(blocks, labels, num, den, over), "open-cells")
            if members.isEmpty():
                continue
            rest = (_tasks(members).join(sigs.select("doc_id", "bits"), "doc_id")
                    .select("task", "side", "doc_id", "label", "n", "bits")
                    .repartition("task").sortWithinPartitions("task", "side", "doc_id")
                    .mapInArrow(_traverse(num, den, PROPOSALS if over > 1 else None), PAIR))
            found = _exact(spark, texts, rest, k, num, den)
            if not found.isEmpty():
                links = links.unionAll(found)
                labels = graph.components(links)

    reps = (chosen.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
            .select("d1", "d2", "n", F.coalesce("component", "rep").alias("found")))
    out = (rows.join(reps, ["d1", "d2", "n"], "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id")))
    return out, links.distinct()


def components(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; see ``join``."""
    return join(docs, **options)[0]


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document (the smallest id) of every component; rows with a null id stay."""
    kept = (components(docs, **options).where("component_id = doc_id").select("doc_id").distinct())
    return docs.join(kept, "doc_id", "left_semi").unionAll(docs.where("doc_id is null"))
