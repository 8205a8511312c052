"""Connected components of a large edge list, and of small ones inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from clickloom.session import stage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node reachable.

    Alternates two rounds until nothing changes: every node ties its larger
    neighbours to its smallest neighbour, then its smaller ones and itself. Both
    are a minimum per node and a join; each round is written to the shared folder,
    so the plan does not grow. Nothing is gathered on the driver. Edges with a
    null end are ignored; an edge from a node to itself yields that node.
    """
    plain = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null")
    # the larger end first
    held = stage(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    nodes = held.select(F.col("u").alias("node")).union(held.select("v")).distinct()
    links = held.filter("u != v")
    seen = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        far = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = far.filter("u != v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(near.union(small.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "edges")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    # every link now runs from a node to the smallest node of its component
    return nodes.join(links.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("root")
    )


def settle(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index over the links i-j and earlier labels.

    ``labels`` are those of an earlier call or the indices themselves. Only roots are
    tied to lower roots, so whatever hangs on a root moves with it.
    """
    while len(i):
        high, low = np.maximum(labels[i], labels[j]), np.minimum(labels[i], labels[j])
        apart = high != low
        i, j = i[apart], j[apart]
        np.minimum.at(labels, high[apart], low[apart])
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped
    return labels
