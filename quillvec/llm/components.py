"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch


ROUNDS_BY_NUMBER = 3


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, whole numbers); the component is its smallest node.

    Each round merges every node into its first neighbour, or none if it comes before all of them, and goes on with
    the edges between what is left. The order is that of the numbers for a few rounds, which is enough for stars and
    what is close to one; then it is that of their hashes, where a good part of the nodes of any graph vanishes in
    each round, so the rounds are few even for long paths. Merges are tables of their own, so that the join of a node
    with very many edges can be split. Empty edges give no rows; loops and repeated edges are ignored.
    """
    edges = scratch.keep(edges.filter("a <> b").select("a", "b"), f"{name}-edges-0")
    label, number = None, 0
    while not edges.isEmpty():
        number += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
            .groupBy(F.col("a").alias("node"))
        if number <= ROUNDS_BY_NUMBER:
            merges = both.agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("into"))
        else:
            merges = both.agg(F.min(F.struct(F.xxhash64("b").alias("o"), F.col("b").alias("node"))).alias("m")) \
                .select("node", F.expr("IF(m.o < xxhash64(node), m.node, node) AS into"))
        merges = scratch.keep(merges, f"{name}-merges-{number}")
        left, right = (merges.select(F.col("node").alias(c), F.col("into").alias(f"{c}_into")) for c in "ab")
        edges = scratch.keep(edges.join(left, "a").join(right, "b").filter("a_into <> b_into").select(
            F.least("a_into", "b_into").alias("a"), F.greatest("a_into", "b_into").alias("b")).distinct(),
            f"{name}-edges-{number}")
        scratch.drop(f"{name}-edges-{number - 1}")
        if label is None:
            label = merges
        else:
            step = merges.select(F.col("node").alias("into"), F.col("into").alias("next"))
            label = label.join(step, "into", "left").select("node", F.coalesce("next", "into").alias("into"))
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if number <= ROUNDS_BY_NUMBER:  # each merged into the smallest node there is
        return label.select("node", F.col("into").alias("component"))
    label = scratch.keep(label, f"{name}-labels")
    least = scratch.keep(label.groupBy("into").agg(F.min("node").alias("component")), f"{name}-least")
    return label.join(least, "into").select("node", "component")
