"""Exact deduplication over an extendible-hash index on shared files, in DataFrame operations only.

The 64-bit hash of a text is its index key. The directory starts with one bucket and doubles:
a bucket whose prefix holds more than ``capacity`` distinct keys is split on the next bit, so the
directory is the set of shortest prefixes that are not overfull (at most ``2**MAX_DEPTH`` leaves,
a proven bound, so it is broadcast). A bucket is thus a range of keys, and the directory routes: every entry goes to the task that
owns its bucket. There equal keys are compared by their bytes, and equal keys with different bytes stay apart as links of one
chain. The finished buckets (no texts, one slot per distinct text) are shared files in key order, which the probes read by bucket and key.

Texts with many copies do not travel one by one: keys held by at least 1/REPEATED of all rows number at most REPEATED, so they
are broadcast, and their entries are combined on the map side before the owner gets them, a row for each map task and text.

Defined results: a null text counts as empty; a null id ranks below every id; rows that repeat both
id and text share one verdict; an empty table gives an empty result; columns beyond
id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import join_skewed, materialize, without

MAX_DEPTH, CAPACITY = 17, 4096
#: A key with at least MANY copies that holds at least 1/REPEATED of all rows is combined before it is sent.
REPEATED, MANY = 1 << 18, 16


def depth_for(n_keys: int, capacity: int = CAPACITY) -> int:
    """Bits by which a directory of ``n_keys`` is addressed: hashed keys fit well before, others chain at this depth."""
    return min(MAX_DEPTH, max(1, math.ceil(math.log2(max(1, n_keys / capacity))) + 3))


def cell_of(key: str, max_depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - max_depth).cast("int")


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(cell, depth, bucket) for every occupied cell of ``max_depth`` leading key bits: the local
    depth is the first at which the cell's prefix holds no more than ``capacity`` of ``keys``
    (one row per distinct key); the deepest level is never split further, its bucket chains. Prefixes number
    less than ``2**(max_depth + 1)``, so those that fit are broadcast."""
    cells = keys.groupBy(cell_of("key", max_depth).alias("cell")).agg(F.count("*").alias("n"))
    depth = F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    prefixes = cells.select("cell", "n", depth).withColumn("prefix", F.expr(f"shiftright(cell, {max_depth} - depth)"))
    loads = prefixes.groupBy("depth", "prefix").agg(F.sum("n").alias("load"))
    fits = loads.filter((F.col("load") <= capacity) | (F.col("depth") == max_depth)).select("depth", "prefix")
    leaf = prefixes.join(F.broadcast(fits), ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    name = F.expr(f"shiftleft(1, depth) + shiftright(cell, {max_depth} - depth)")
    return leaf.select("cell", "depth", name.alias("bucket"))


def addressed(rows: DataFrame, cells: DataFrame, max_depth: int) -> DataFrame:
    """``rows`` (key, ...) with the bucket that the directory has for them."""
    return rows.withColumn("cell", cell_of("key", max_depth)).join(F.broadcast(cells.select("cell", "bucket")), "cell").drop("cell")


def build_index(entries: DataFrame, keys: DataFrame, cells: DataFrame, max_depth: int) -> DataFrame:
    """One slot (bucket, key, sha, keep_id, group_size) per distinct text of ``entries`` (id, body, key); ``keys`` (key, n) are the distinct
    keys with their rows. Two links of a chain with one digest stop the job rather than merge."""
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = keys.filter((F.col("n") >= MANY) & (F.col("n") * F.lit(REPEATED) >= F.lit(total))).select("key")  # at most REPEATED keys
    rows = addressed(entries, cells, max_depth)
    one = rows.join(F.broadcast(often), "key", "left_anti").select("bucket", "key", "body", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    many = rows.join(F.broadcast(often), "key").groupBy("bucket", "key", "body").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
    owned = one.unionByName(many).repartition("bucket")  # the owner of a bucket gets all of it
    links = owned.groupBy("bucket", "key", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    links = links.select("bucket", "key", F.sha2(F.col("body"), 256).alias("sha"), "keep_id", "group_size")
    slot = links.groupBy("bucket", "key", "sha").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("links"))
    clash = F.when(F.col("links") > 1, F.raise_error(F.lit("two texts share one digest")).cast("long"))
    slot = slot.withColumn("group_size", F.coalesce(clash, F.col("group_size"))).drop("links")
    return slot.sortWithinPartitions("bucket", "key")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    key_of: Callable[[Column], Column] = F.xxhash64,
    capacity: int = CAPACITY,
    max_depth: int | None = None,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row: of equal texts the largest id stays."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    entries = docs.select(F.col(id_col).alias("id"), body.alias("body")).withColumn("key", key_of(F.col("body")))
    light = materialize(entries.select("id", "key", F.sha2(F.col("body"), 256).alias("sha")), "exact-entries")
    keys = materialize(light.groupBy("key").agg(F.count("*").alias("n")), "exact-keys")
    max_depth = max_depth or depth_for(keys.count(), capacity)
    cells = materialize(directory(keys, capacity, max_depth), "exact-directory")
    index = materialize(build_index(entries, keys, cells, max_depth), "exact-index")
    found = join_skewed(addressed(light, cells, max_depth), index, ["bucket", "key", "sha"], "group_size", light.count(), F.col("id"))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per distinct text, all columns kept: of equal texts the largest id stays, of equal ids the
    largest of the row numbers that are written with the table. Rows go by their number, so a text goes only for its own copies."""
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "exact-rows", compression="zstd")
    picks = rows.select(F.struct(id_col, "__row").alias("pick"), F.col(text_col).alias("text"))
    verdict = exact_dedup(picks, "pick", "text")
    return without(rows, verdict.filter(~F.col("kept")).select("pick.__row"), "__row").drop("__row")
