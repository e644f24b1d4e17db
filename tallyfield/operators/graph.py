"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.plans.scratch import stage, unstage
from tallyfield.plans.ship import ship

#: A graph of so many edges at most (16 bytes each) is settled in one task.
SMALL = 1 << 20


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _settled(batches):
    """(node, component) of the edges (u, v) of all batches."""
    held = [np.stack([batch.column(k).to_numpy() for k in range(2)]) for batch in batches]
    if not held:
        return
    nodes, ends = np.unique(np.concatenate(held, axis=1), return_inverse=True)
    u, v = ends.reshape(2, -1)
    label = np.arange(len(nodes))  # nodes are in ascending order: a component's least number is its least node
    while len(u):
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        apart = low < high
        u, v = u[apart], v[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] < label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def components(edges: DataFrame, a: str, b: str, small: int = SMALL) -> DataFrame:
    """(node, component): the least node that each node of an edge can reach.

    Alternates the large-star and small-star steps (Kiveris et al. 2014), each round
    written to the shared folder, until the edges no longer change.  The number of
    rounds grows with the logarithm of the graph; each row stays one edge, whatever
    the size of a component.  A graph of `small` edges at most takes one task instead,
    with the same result.  Nulls and loops are no edges.
    """
    now = edges.filter(F.col(a) != F.col(b))
    now = stage(now.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct(), "edges")
    before = _print_of(now)
    if before[0] <= small:
        ship(now.sparkSession)
        return now.coalesce(1).mapInArrow(_settled, "node long, component long")
    while True:
        old, now = now, stage(_small_star(_large_star(now)).distinct(), "edges")
        unstage(old)
        after = _print_of(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
