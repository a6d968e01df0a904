"""Connected components of a distributed link table, by repeated contraction."""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _undirected(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select("b", "a"))


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """(v, m): every vertex of some links with the smallest of its component, by union of trees."""
    vertices, at = np.unique(rows[["a", "b"]].to_numpy(np.int64), return_inverse=True)
    root = list(range(len(vertices)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for x, y in at.reshape(-1, 2).tolist():
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    return pd.DataFrame({"v": vertices, "m": vertices[[find(x) for x in range(len(vertices))]]})


def components(links: DataFrame, scratch: Scratch, name: str, at_once: int = 1 << 20) -> DataFrame:
    """(v, label): for each linked vertex the smallest vertex that it reaches.

    links: columns a and b, long. Each round orders the vertices by another hash, points
    every vertex to the first in its closed neighbourhood and contracts the links along
    the pointers. The last vertex of the order always goes, so the rounds end, and as no
    chain runs along every order, they are expected to grow with the logarithm of the
    vertices. Links are pre-aggregated before each shuffle, and every round is a written
    table, so nothing is recomputed from the start when an executor is lost. Once no more
    than `at_once` links are left (16 bytes each), one task joins them in memory, which
    gives what the rounds would.
    """
    links = scratch.write(links.where("a <> b").select("a", "b").distinct(), f"{name}-links")
    label = None
    for k in count():
        few = links.limit(at_once + 1).count() <= at_once
        order = lambda c, k=k: F.xxhash64(c, F.lit(k))  # noqa: E731  one-to-one in c, so no ties
        if few:
            least = links.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_joined, "v long, m long")
        else:
            least = _undirected(links).groupBy("v").agg(F.min_by("u", order("u")).alias("m"))
            least = least.select("v", F.when(order("v") < order("m"), F.col("v")).otherwise(F.col("m")).alias("m"))
        least = scratch.write(least, f"{name}-least-{k}")
        if few and label is None:  # the smallest of the component already
            return least.withColumnRenamed("m", "label")
        if label is None:
            label = least.withColumnRenamed("m", "label")
        else:
            moved = least.withColumnRenamed("v", "label")
            label = label.join(moved, "label", "left").select("v", F.coalesce("m", "label").alias("label"))
        label = scratch.write(label, f"{name}-label-{k}")
        if few:
            break
        by_a = least.select(F.col("v").alias("a"), F.col("m").alias("ma"))
        by_b = least.select(F.col("v").alias("b"), F.col("m").alias("mb"))
        links = links.join(by_a, "a").join(by_b, "b").where("ma <> mb").select(F.greatest("ma", "mb").alias("a"), F.least("ma", "mb").alias("b"))
        links = scratch.write(links.distinct(), f"{name}-links-{k}")
    smallest = scratch.write(label.groupBy("label").agg(F.min("v").alias("least")), f"{name}-smallest")
    return label.join(smallest, "label").select("v", F.col("least").alias("label"))
