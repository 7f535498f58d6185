"""Connected components of an undirected edge table, by randomised contraction.

Each round every vertex points to the vertex of its closed neighbourhood with the smallest
hash (a new hash each round), and the edges are rewritten to the targets.  A random order
about halves the vertices per round, also on long paths.  The neighbourhood minimum is a
partial aggregate, so a vertex with very many edges is combined before the shuffle; each
round's tables are written to the shared folder, which cuts the lineage.  Rounds go on until at most
``LAST_EDGES`` edges are left; these are settled by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

LAST_EDGES = 200_000


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, to): the smallest vertex reachable from each vertex of a bounded edge table."""
    ends = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches if b.num_rows]
    if not ends:
        return
    ids, at = np.unique(np.concatenate([x for pair in zip(*ends, strict=True) for x in pair]), return_inverse=True)
    a, b = at[: len(at) // 2], at[len(at) // 2:]
    low = np.arange(len(ids))
    while True:
        least = np.minimum(low[a], low[b])
        if (least == low[a]).all() and (least == low[b]).all():
            break
        for ends_ in (a, b):
            np.minimum.at(low, low[ends_], least)
            np.minimum.at(low, ends_, least)
        while (low[low] != low).any():
            low = low[low]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[low])], names=["v", "to"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex reachable from each vertex of ``edges`` (a, b).

    Null ends and self loops are ignored; repeated edges count once; no edges give no rows.
    """
    spark = edges.sparkSession
    with store.Scratch(spark) as scratch:
        links = scratch.saved(edges.select("a", "b").where("a <> b").distinct(), "edges")
        steps: list[DataFrame] = []
        while links.count() > LAST_EDGES:
            order = F.xxhash64("b", F.lit(len(steps)))
            both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            own = both.select("a", F.col("a").alias("b"))
            step = (both.unionAll(own).groupBy("a").agg(F.min(F.struct(order.alias("h"), "b")).alias("m"))
                    .select(F.col("a").alias("v"), F.col("m.b").alias("to")))
            step = scratch.saved(step, "contraction")
            steps.append(step)
            to_a = step.select(F.col("v").alias("a"), F.col("to").alias("ta"))
            to_b = step.select(F.col("v").alias("b"), F.col("to").alias("tb"))
            links = scratch.saved(links.join(to_a, "a").join(to_b, "b").where("ta <> tb")
                                  .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
                                  "edges")
        last = links.coalesce(1).mapInArrow(_settle, "v long, to long")
        if not steps:
            return store.saved(last.select(F.col("v").alias("id"), F.col("to").alias("component")), "components")
        roots = steps[0].select(F.col("v").alias("id"), "to")
        for step in [*steps[1:], scratch.saved(last, "last")]:
            up = step.select(F.col("v").alias("to"), F.col("to").alias("up"))
            roots = roots.join(up, "to", "left").select("id", F.coalesce("up", "to").alias("to"))
        roots = scratch.saved(roots, "roots")
        least = roots.groupBy("to").agg(F.min("id").alias("component"))
        return store.saved(roots.join(least, "to").select("id", "component"), "components")
