"""Connected components of pairs, distributed: local union-find, hooking, pointer jumps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import discard, materialise


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node of the group that the pairs put each in."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(nodes))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
    while (up := parent[parent] != parent).any():
        parent[up] = parent[parent[up]]
    return nodes, nodes[parent]


#: Pairs that one call of union-find holds.
CHUNK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    live: list[np.ndarray] = []
    size = 0

    def emit() -> pa.RecordBatch:
        a, b = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        nodes, roots = union_find(a, b)
        keep = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep]), pa.array(np.full(int(keep.sum()), bool(np.concatenate(live).any())))], ["node", "root", "live"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        live.append(batch.column(2).to_numpy(zero_copy_only=False))
        size += batch.num_rows
        if size >= CHUNK:
            yield emit()
            held, live, size = [], [], 0
    if size:
        yield emit()


def connected_components(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``pairs`` has two bigint columns without nulls.  Each round hooks the roots of a
    node to the smallest of them and lets every node jump to the root of its root;
    tasks first contract their own pairs.  Rounds grow with the logarithm of the
    longest chain; each ends in a written table.
    """
    a, b = pairs.columns
    kind = "node bigint, root bigint, live boolean"
    edges = pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"), F.lit(True).alias("live"))
    edges = materialise(spark, edges.mapInArrow(_contract, kind))
    while True:
        # written, so that a root with very many nodes is a key that a join can split
        best = materialise(spark, edges.groupBy("node").agg(F.min("root").alias("up")))
        up = best.select(F.col("node").alias("via"), F.col("up").alias("top"))
        jump = best.join(up, F.col("up") == F.col("via"), "left").select("node", F.coalesce("top", "up").alias("root"), F.col("top").isNotNull().alias("live"))
        hook = edges.join(best, "node").where("root != up").select(F.col("root").alias("node"), F.col("up").alias("root"), F.lit(True).alias("live"))
        done = materialise(spark, jump.unionByName(hook))
        discard(best, edges)
        if done.where("live").limit(1).count() == 0:
            return done.select("node", "root")
        edges = materialise(spark, done.mapInArrow(_contract, kind))
        discard(done)
