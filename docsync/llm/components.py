"""Connected components: union-find inside partitions of bounded size, and star contraction in rounds of DataFrame joins between them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import join_skewed, materialize, tidy


#: Links that a task takes at a time.
LOCAL = 100_000


def contract_locally(edges: DataFrame) -> DataFrame:
    """The links of each partition replaced by links to the smallest node of their group there. Memory follows the size of a partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            top = v
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[v] != top:
                parent[v], v = top, parent[v]
            return top

        for frame in frames:
            for u, v in zip(frame["u"].tolist(), frame["v"].tolist(), strict=True):
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
        nodes = np.array(list(parent), np.int64)
        roots = np.array([root(v) for v in parent], np.int64)
        yield pd.DataFrame({"u": nodes, "v": roots})[nodes != roots]

    return edges.mapInPandas(tidy(run), "u long, v long")


def star_round(edges: DataFrame) -> DataFrame:
    """Every node passes the smallest node it knows to its larger neighbours, then to its smaller ones; distinct (u > v)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("w"))
    large = _with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    large = materialize(large, "star")
    down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("w"))
    small = _with_least(large, down).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return small.unionByName(down.select("u", F.col("m").alias("v"))).distinct()


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    least = materialize(least, "least")
    n = least.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    return join_skewed(edges, least, ["u"], "w", n, F.col("v"))


def settled(links: DataFrame) -> bool:
    """Whether the links (u > v) are stars: every node hangs on one centre, and no centre hangs on another."""
    hung = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    centre = links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = hung.unionByName(centre).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60, local: int = LOCAL) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long): component is the smallest node reachable. Each round contracts the links in partitions
    of ``local``; when more than one is left and the links are not stars yet, a round of joins passes the smallest nodes on."""
    links = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        parts = max(1, math.ceil(links.count() / local))
        links = materialize(contract_locally(links.repartition(parts)).distinct(), "links")
        if parts == 1 or settled(links):
            whole = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return whole.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        links = materialize(star_round(links), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
