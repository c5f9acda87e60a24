"""Connected components of links that live in a table, and of links inside one tile."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.session import materialised


def joined_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` after linking rows a[i] and b[i]; a label is the smallest row of its component."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def tile_labels(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    labels = np.arange(n)
    for a, b in links:
        labels = joined_labels(labels, a, b)
    return labels


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the component's smallest node.

    Large-star and small-star steps in turn (Kiveris et al. 2014): each hangs a node's
    neighbours onto the smallest of them, until every node hangs on its root. A step is
    one aggregation and one join over links; its result is written, so nothing grows with
    the number of rounds, and the driver sees only two sums per round. A node with a third
    of all links is pre-aggregated for its minimum; minima are written, so that its join
    is of two plain shuffles, which adaptive execution can split.
    """
    now = materialised(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    for _ in range(most_rounds):
        both = now.union(now.select("b", "a"))
        least = materialised(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialised(large)
        least = materialised(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
        now = materialised(small.select("x.a", F.col("x.m").alias("b")).where("a <> b").distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)
