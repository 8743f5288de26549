"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); the component is its smallest node.

    Alternating large and small stars: neighbours are hung on the least of them
    until nothing changes, which takes about as many rounds as the logarithm of
    the longest path.  Every step aggregates before it joins, and a hub is a
    skewed key of a plain join.  Each round's edges are written to the shared
    folder.  Loops and repeated edges are harmless; no edges give no rows.
    """
    greater, least = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.select(greater, least).where("a <> b").distinct(), "edges")
    before = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(low, "a")
        small = (
            hung.where("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        now = stored(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("a"), "b").distinct()
    return now.unionAll(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each of ``n`` nodes' components, for the edges (i, j) of one task."""
    labels = np.arange(n)
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
    return labels
