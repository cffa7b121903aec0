"""Approximate nearest neighbours with multiprobe p-stable hashing.

A table hashes a vector by ``m`` functions floor((a . x + b) / w), a drawn from the normal
distribution, so that the bucket is the cell of a random grid. A query visits the buckets around its own
cell in the order of their estimated success: along each function a neighbour at distance s is off
by a normal step of deviation s, which gives each slot a probability, and a bucket the product. It stops
when the buckets visited add up to ``reach``, so the number of probes follows the data; there is no cap. The candidates of all
tables are compared with the original vectors in double precision, and each query's best are merged.

Width, m and s are fitted on at most SAMPLE rows (those with the smallest hash of their id); every row is indexed.
Buckets are dealt to groups of about GROUP rows; a bucket with more is cut into slices that each meet all of
its probes, so a vector that a third of the rows share is searched in blocks. Only the best k of each group leave
a task. A query's keys travel without its vector, which joins them once for each group that they lead to. Queries that find fewer than k
are compared with all rows, in blocks.

Defined results: vectors that are null, empty, zero, hold null or non-finite components or have another length than
most of the sample take no part; a null id takes no part; equal distances go by the smaller id; equal vectors have distance 0; rows that
repeat an id count once, with their smallest distance; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsync.llm.common import join_skewed, materialize

SAMPLE, GROUP, PER_BUCKET = 2048, 8192, 64
TABLES, REACH, WIDTH = 4, 0.56, 2.0


@dataclass
class Grid:
    """The hash functions: slopes (tables, dims, m), shifts (tables, m), slot width, and the step s of a neighbour."""

    slopes: np.ndarray
    shifts: np.ndarray
    width: float
    step: float

    def places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Places on the grid, in units of slots."""
        return (vectors @ self.slopes[table] + self.shifts[table]) / self.width

    def keys(self, slots: np.ndarray, table: int) -> np.ndarray:
        """One 64-bit key per cell."""
        key = np.full(len(slots), table + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(slots.shape[1]):
                key = (key ^ slots[:, k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
        return key.view(np.int64)


def fit(sample: np.ndarray, n_rows: int, k: int = 10, tables: int = TABLES, seed: int = 8) -> Grid:
    """Fit the slot width to the distance of near neighbours in the sample, and m to the number of rows."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    gaps = np.sqrt(np.maximum(((sample[:256, None] - sample[None]) ** 2).sum(-1), 0)) if len(sample) else np.ones((1, 1))
    gaps.sort(axis=1)
    near = gaps[:, min(max(1, round(k * len(sample) / max(1, n_rows))), gaps.shape[1] - 1)]  # the sample is thinner than the table
    step = float(np.median(near[near > 0])) if (near > 0).any() else 1.0
    width = WIDTH * step
    slots = np.floor(sample @ rng.standard_normal((dims, 32)) / width + rng.uniform(0, 1, 32))
    spread = []
    for column in slots.T:
        share = np.unique(column, return_counts=True)[1] / max(1, len(column))
        spread.append(-(share * np.log(share)).sum())
    each = max(0.1, float(np.mean(spread))) if len(sample) else 1.0
    m = max(1, min(24, math.ceil(math.log(max(1.0, n_rows / PER_BUCKET)) / each)))
    return Grid(rng.standard_normal((tables, dims, m)), rng.uniform(0, width, (tables, m)), width, step)


def _below(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def probes(place: np.ndarray, grid: Grid, reach: float) -> np.ndarray:
    """Slots of the buckets to visit, by falling probability, until these add up to ``reach``."""
    options = []
    for x in place:
        home = math.floor(x)
        found = []
        for slot in range(home - 40, home + 41):
            low = (slot - x) * grid.width / grid.step
            p = _below(low + grid.width / grid.step) - _below(low)
            if p > 1e-6:
                found.append((-math.log(p), slot))
        options.append(sorted(found))
    best = [(sum(o[0][0] for o in options), (0,) * len(options))]
    out, total = [], 0.0
    while best and total < reach:
        cost, at = heapq.heappop(best)
        out.append([o[i][1] for o, i in zip(options, at, strict=True)])
        total += math.exp(-cost)
        last = max((j for j, i in enumerate(at) if i), default=0)
        for j in range(last, len(at)):  # each set of steps is reached in one way only
            if at[j] + 1 < len(options[j]):
                more = cost - options[j][at[j]][0] + options[j][at[j] + 1][0]
                heapq.heappush(best, (more, at[:j] + (at[j] + 1,) + at[j + 1 :]))
    return np.array(out, np.int64).reshape(len(out), len(options))


def usable(vector: Column) -> Column:
    """Whether a vector is there, finite and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def _search(k: int):
    """The comparison of one group: the best k of each query among the rows of the buckets that it visits."""

    def search(base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(base) and len(asked):
            rows, ids, keys = _stack(base["vector"]), base["id"].to_numpy(), base["key"].to_numpy()
            each = asked["keys"].map(len).to_numpy()
            wants, names, visits = _stack(asked["vector"]), asked["query"].to_numpy(), np.concatenate(asked["keys"].tolist())
            who = np.repeat(np.arange(len(asked)), each)
            order = np.argsort(keys, kind="stable")
            rows, ids, keys = rows[order], ids[order], keys[order]
            by = np.argsort(visits, kind="stable")
            edges = np.flatnonzero(np.concatenate(([True], visits[by][1:] != visits[by][:-1], [True])))
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                key = visits[by[start]]
                lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                if lo == hi:
                    continue
                block = rows[lo:hi]
                repeated = len(np.unique(ids[lo:hi])) < hi - lo
                for i in who[by[start:end]]:
                    gap = np.sqrt(((block - wants[i]) ** 2).sum(axis=1))
                    other = np.flatnonzero(ids[lo:hi] != names[i])
                    if len(other) > k:
                        if repeated:  # the nearest row of each id
                            other = other[np.lexsort((gap[other], ids[lo:hi][other]))]
                            other = other[np.unique(ids[lo:hi][other], return_index=True)[1]]
                        limit = np.partition(gap[other], min(k, len(other)) - 1)[min(k, len(other)) - 1]
                        other = other[gap[other] <= limit]
                        other = other[np.lexsort((ids[lo:hi][other], gap[other]))[:k]]
                    found.append((np.full(len(other), names[i]), ids[lo:hi][other], gap[other]))
        if not found:
            return pd.DataFrame({"query": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})
        out = pd.DataFrame({c: np.concatenate([f[i] for f in found]) for i, c in enumerate(("query", "id", "score"))})
        return out.sort_values(["query", "score", "id"], kind="stable").drop_duplicates(["query", "id"]).groupby("query", sort=False).head(k)

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, reach: float = REACH) -> DataFrame:
    """(query_id, rank, id, score) of the k nearest rows found for every row where ``query`` holds."""
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(query, F.lit(False)).alias("asked"))
    given = given.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    sample = given.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()["vector"]
    sizes = sample.map(len).value_counts()
    dims = int(sizes.index[0]) if len(sizes) else 1
    given = materialize(given.filter(F.size("vector") == dims), "vectors")
    n_rows = given.count()
    grid = given.sparkSession.sparkContext.broadcast(fit(_stack(sample[sample.map(len) == dims]).reshape(-1, dims), n_rows, k, tables))
    kind = given.schema["vector"].dataType.simpleString()

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = _stack(frame["vector"]).reshape(len(frame), -1)
            for t in range(tables if len(frame) else 0):
                yield pd.DataFrame({"key": grid.value.keys(np.floor(grid.value.places(points, t)), t), "id": frame["id"], "vector": frame["vector"]})

    def visiting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, vector in zip(frame["id"], frame["vector"], strict=True):
                point = np.asarray(vector, np.float64)[None]
                for t in range(tables):
                    yield pd.DataFrame({"key": grid.value.keys(probes(grid.value.places(point, t)[0], grid.value, reach), t), "query": name})

    base = materialize(given.select("id", "vector").mapInPandas(hashed, f"key long, id long, vector {kind}"), "buckets")
    total = n_rows * tables
    crowded = materialize(base.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP), "crowded")
    groups = max(1, total // GROUP)
    part = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("part")
    slices = F.coalesce(F.ceil(F.col("n") / GROUP), F.lit(1)).cast("long")
    rows = join_skewed(base, crowded, ["key"], "n", total, F.col("id")).select("key", "id", "vector", part, F.pmod(F.xxhash64("id"), slices).alias("slice"))
    questions = given.filter("asked").select("id", "vector")
    visits = join_skewed(questions.mapInPandas(visiting, "key long, query long"), crowded, ["key"], "n", total, F.col("query"))
    visits = visits.select("key", "query", part, F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("slice"))
    visits = visits.groupBy("part", "slice", "query").agg(F.collect_set("key").alias("keys"))  # a query's vector goes to a group once
    visits = visits.join(questions.select(F.col("id").alias("query"), "vector").distinct(), "query").select("part", "slice", "query", "keys", "vector")
    result = "query long, id long, score double"
    found = rows.groupBy("part", "slice").cogroup(visits.groupBy("part", "slice")).applyInPandas(_search(k), result)
    found = materialize(_best(found, k), "found")
    short = questions.join(found.groupBy("query").agg(F.count("*").alias("n")), F.col("id") == F.col("query"), "left")
    short = materialize(short.filter(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.lit(n_rows - 1))).select("id", "vector"), "short")
    if short.count():  # these are compared with every row, block by block
        blocks = max(1, math.ceil(n_rows / GROUP))
        whole = given.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("key"), "id", "vector")
        again = short.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).cast("long").alias("key"), F.col("id").alias("query"), "vector")
        again = again.withColumn("keys", F.array("key"))
        more = whole.groupBy("key").cogroup(again.groupBy("key")).applyInPandas(_search(k), result)
        rest = found.join(short.select(F.col("id").alias("query")), "query", "left_anti")
        found = rest.unionByName(_best(more, k))
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
