"""Near-duplicate detection with an LSH forest over MinHash signatures.

1. Texts with one token sequence form a class; only the class's smallest id goes on.
2. Each text's shingle set is hashed to a signature of TREES x DEPTH minima. Tree t sees
   the signature rotated to its own start. A region of a tree holds the texts that agree on the first
   values, as many as ``first_depth`` says; crowded regions are deepened by further values.
3. In each tree's sorted order the neighbours with the longest common prefixes are candidates: in small
   regions all pairs, in larger ones the adjacent texts.
4. Candidates are confirmed on the full sets, first each text's best one, then those that would still join
   two components.
5. In regions with more than SMALL texts the pairs that the neighbour rule leaves out are looked at as well, where their ends
   are in different components: first on the signatures alone, each text shipped once per SKETCH_BLOCK texts of its region outside the
   largest component, which leaves the texts that still have a candidate; then on the full sets of those, in blocks that give out links only.
   Links inside a component add nothing to it.

A pair at the threshold shares a region in some tree but for 1 in 1,000,000 cases, and its
signature passes the first comparison (least_estimate) but for 1 in 1,000,000.

Defined results: null and empty texts and texts without words have an empty set, link with nothing
and stay; a text with fewer than WIDTH words has one shingle, its whole sequence; ids are keys, and a row that
repeats an id is judged by its own text; rows with a null id get the component of their text's class, or null,
and stay; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import BooleanType, DoubleType

from docsync.llm.common import bounded_batches, join_skewed, materialize, tidy, without
from docsync.llm.components import connected_components

WIDTH, TREES, DEPTH, MISSED = 5, 20, 6, 1e-6
#: Regions up to SMALL texts are compared pair by pair; above CROWDED they are deepened. Texts that meet in a task by their signatures, and by their sets.
SMALL, CROWDED, SKETCH_BLOCK, BLOCK = 8, 4096, 4096, 512
#: Words whose hashes a task keeps.
MAX_WORDS = 100_000
_M = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def least_estimate(percent: int) -> float:
    """Share of equal signature values below which a pair is not confirmed: five standard deviations under the threshold."""
    p = percent / 100
    return p - 5 * (p * (1 - p) / (TREES * DEPTH)) ** 0.5


def first_depth(percent: int) -> int:
    """The most values by which regions can be keyed so that a pair at the threshold shares none in at most MISSED of all cases."""
    p = percent / 100
    return max([d for d in range(1, DEPTH + 1) if (1 - p**d) ** TREES <= MISSED], default=1)


class Shingler:
    """Tokens and shingle sets of texts; the hashes of words are kept, up to a bound."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}

    def tokens(self, text: str | None) -> list[bytes]:
        return text.encode("utf-8", "surrogatepass").lower().split() if text else []

    def word_hashes(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        new = {w for w in tokens if w not in known}
        if len(known) + len(new) > MAX_WORDS:
            known.clear()
            new = set(tokens)
        for w in new:
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def shingles(self, tokens: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles."""
        if not tokens:
            return np.zeros(0, np.uint64)
        words = self.word_hashes(tokens)
        n, width = max(1, len(words) - self.width + 1), min(self.width, len(words))
        with np.errstate(over="ignore"):
            sums = np.full(n, width, np.uint64)
            for k in range(width):
                sums = mixed(sums * _M + words[k : k + n])
        return np.unique(sums)


def permutations(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(9)
    a = rng.integers(1, 2**63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, trees * depth, dtype=np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 256) -> np.ndarray:
    """The minimum of each permutation, 32 bits each; long sets are taken in blocks."""
    least = np.full(len(a), 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), block):
            part = shingles[None, i : i + block] * a[:, None]
            part += b[:, None]
            part >>= np.uint64(32)
            np.minimum(least, part.min(axis=1).astype(np.uint32), out=least)
    return least


def forest_rows(docs: DataFrame, id_col: str, text_col: str, width: int, first_values: int) -> DataFrame:
    """(id, cls, n_shingles, sketch, regions) per row: cls is a digest of the token sequence, sketch one byte per
    signature value, regions one 64-bit key per tree."""
    a, b = permutations(TREES, DEPTH)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(width)
        for frame in frames:
            for start in range(0, len(frame), 512):
                part = frame.iloc[start : start + 512]
                cls, n, sketches, regions = [], [], [], []
                for text in part["text"]:
                    tokens = shingler.tokens(text)
                    found = shingler.shingles(tokens)
                    n.append(len(found))
                    if not tokens:
                        cls.append(None), sketches.append(None), regions.append(None)
                        continue
                    values = signature(found, a, b)
                    cls.append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest())
                    sketches.append((values & np.uint32(255)).astype(np.uint8).tobytes())
                    first = values.reshape(TREES, DEPTH)[:, :first_values].astype(np.uint64)
                    key = np.arange(TREES, dtype=np.uint64)
                    with np.errstate(over="ignore"):
                        for k in range(first_values):
                            key = mixed(key * _M + first[:, k])
                    regions.append(key.view(np.int64))
                yield pd.DataFrame({"id": part["id"].array, "cls": cls, "n_shingles": n, "sketch": sketches, "regions": regions})

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return bounded_batches(given).mapInPandas(tidy(run), "id long, cls binary, n_shingles long, sketch binary, regions array<bigint>")


def regions_of(reps: DataFrame, first_values: int) -> DataFrame:
    """(region, part, size, id, sketch, turned): the members of all regions with two texts or more, with the sketch
    turned to the tree's start. A crowded region is deepened by the next values of that order, the more of them the
    larger it is, and dealt into parts of about CROWDED texts, other ones in every tree."""
    each = reps.select("id", F.posexplode("regions").alias("tree", "region"))
    sizes = materialize(each.groupBy("region").agg(F.count("*").alias("size")).filter("size > 1"), "regions")
    members = each.join(sizes, "region")  # an inner join: one hot region is split by adaptive execution
    turned = F.expr(f"concat(substring(sketch, tree * {DEPTH} + 1), substring(sketch, 1, tree * {DEPTH}))")
    members = members.join(reps.select("id", "sketch"), "id").withColumn("turned", turned)
    more = f"cast(1 + floor(log(16, size / {CROWDED})) as int)"
    dealt = f"concat(hex(substring(turned, {first_values + 1}, {more})), '/', pmod(xxhash64(id, tree), cast(ceil(size / {CROWDED}) as bigint)))"
    part = F.when(F.col("size") > CROWDED, F.expr(dealt)).otherwise(F.lit(""))
    return members.select("region", part.alias("part"), "size", "id", "sketch", "turned")


@pandas_udf(DoubleType())
def estimated(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of equal signature bytes."""
    size = TREES * DEPTH
    one = np.frombuffer(b"".join(left), np.uint8).reshape(-1, size)
    two = np.frombuffer(b"".join(right), np.uint8).reshape(-1, size)
    return pd.Series((one == two).mean(axis=1))


def neighbours(members: DataFrame, least: float) -> DataFrame:
    """(a, b, est) with a < b: adjacent texts of each order, in small regions all pairs."""
    order = Window.partitionBy("region", "part").orderBy("turned", "id")
    after = [F.lead(F.struct("id", "sketch"), k).over(order) for k in range(1, SMALL)]
    near = F.array(after[0], *[F.when(F.col("size") <= SMALL, x) for x in after[1:]])
    pairs = members.select("id", "sketch", near.alias("near"))
    pairs = pairs.select("id", "sketch", F.explode(F.filter("near", lambda x: x.isNotNull())).alias("other"))
    pairs = pairs.select(
        F.least("id", "other.id").alias("a"), F.greatest("id", "other.id").alias("b"),
        F.when(F.col("id") < F.col("other.id"), F.struct(F.col("sketch").alias("s"), F.col("other.sketch").alias("t"))).otherwise(F.struct(F.col("other.sketch").alias("s"), F.col("sketch").alias("t"))).alias("p"),
    ).filter("a <> b")
    pairs = pairs.withColumn("est", estimated("p.s", "p.t")).filter(F.col("est") >= least)
    return pairs.groupBy("a", "b").agg(F.max("est").alias("est"))


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if len(one) > len(two):
        one, two = two, one
    if len(one) * 100 < percent * len(two) or not len(one):
        return False
    place = np.minimum(np.searchsorted(two, one), len(two) - 1)
    same = int((two[place] == one).sum())
    return 100 * same >= percent * (len(one) + len(two) - same)


def dealt_in_blocks(named: DataFrame, carried: list[str], block: int) -> DataFrame:
    """The members (region, id, comp, ...) of regions with several components, so dealt into pairs of blocks that every text outside its
    region's largest component (``minor``) meets every other text of the region that is at home in a block (``here``)."""
    shares = named.groupBy("region", "comp").agg(F.count("*").alias("n"))
    layout = shares.groupBy("region").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all_n"))
    layout = layout.filter("most < all_n").select(
        "region", "main", F.ceil(F.col("all_n") / block).cast("int").alias("blocks"), F.ceil((F.col("all_n") - F.col("most")) / block).cast("int").alias("minor_blocks")
    )
    rows = named.join(materialize(layout, "layout"), "region")
    rows = rows.withColumns({"own": F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), "own_minor": F.pmod(F.xxhash64("id"), F.col("minor_blocks")).cast("int")})
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    is_minor = F.col("comp") != F.col("main")
    whole = rows.select(*carried, F.col("own").alias("block"), every("minor_blocks").alias("minor_block"), F.lit(True).alias("here"), (is_minor & (F.col("own_minor") == F.col("minor_block"))).alias("minor"))
    guests = rows.filter(is_minor & (F.col("blocks") > 1)).select(*carried, "own", every("blocks").alias("block"), F.col("own_minor").alias("minor_block"), F.lit(False).alias("here"), F.lit(True).alias("minor"))
    return whole.unionByName(guests.filter("block <> own").drop("own"))


def _met(frame: pd.DataFrame, least: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each minor text of a pair of blocks: its place, those of the texts here whose signatures are close enough and whose first common
    region is this one, their estimates, and the components, which may be changed on the way."""
    ids, comp, region = frame["id"].to_numpy(), frame["comp"].to_numpy().copy(), int(frame["region"].iloc[0])
    sketch = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
    shared = np.stack(frame["regions"].tolist())
    here = np.flatnonzero(frame["here"].to_numpy())
    for i in np.flatnonzero(frame["minor"].to_numpy()):
        others = here[(comp[here] != comp[i]) & (ids[here] != ids[i])]
        estimate = (sketch[others] == sketch[i]).mean(axis=1)
        others, estimate = others[estimate >= least], estimate[estimate >= least]
        if len(others):
            first = shared[i][(shared[others] == shared[i]).argmax(axis=1)] == region
            others, estimate = others[first], estimate[first]
        yield i, others, estimate, comp


def between_components(members: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (u, v) between texts of one larger region that are in different components. Signatures are compared first, and only texts
    with a candidate are compared by their sets. Once two components are linked in a block, their other pairs add nothing and are skipped."""
    least = least_estimate(percent)
    wide = members.filter(F.col("size") > SMALL).select("region", "id", "sketch")
    named = wide.join(labels, wide["id"] == labels["node"], "left").select("region", "id", "sketch", F.coalesce("component", "id").alias("comp"))
    named = materialize(named.join(reps.select("id", "regions"), "id"), "wide")

    def touched(frame: pd.DataFrame) -> pd.DataFrame:
        ids, found = frame["id"].to_numpy(), set()
        for i, others, _, _ in _met(frame, least):
            if len(others):
                found.update(ids[others].tolist(), (int(ids[i]),))
        return pd.DataFrame({"region": frame["region"].iloc[0], "id": np.array(sorted(found), np.int64)})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ids, found = frame["id"].to_numpy(), []
        sets_ = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        for i, others, estimate, comp in _met(frame, least):
            for j in others[np.argsort(-estimate, kind="stable")]:
                if comp[j] != comp[i] and similar(sets_[i], sets_[j], percent):
                    found.append((ids[i], ids[j]))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame({"u": [int(u) for u, _ in found], "v": [int(v) for _, v in found]}, dtype="int64")

    light = ["region", "id", "sketch", "comp", "regions"]
    open_ = dealt_in_blocks(named, light, SKETCH_BLOCK).groupBy("region", "block", "minor_block").applyInPandas(touched, "region long, id long")
    still = materialize(named.join(open_.distinct(), ["region", "id"]).join(sets, "id"), "open")
    return dealt_in_blocks(still, [*light, "shingles"], BLOCK).groupBy("region", "block", "minor_block").applyInPandas(compare, "u long, v long")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, shingles) of the texts whose id is in ``wanted`` (id): sorted 64-bit hashes, as bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(width)
        for frame in frames:
            for start in range(0, len(frame), 512):
                part = frame.iloc[start : start + 512]
                yield pd.DataFrame({"id": part["id"].array, "shingles": [shingler.shingles(shingler.tokens(t)).tobytes() for t in part["text"]]})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    return bounded_batches(texts).join(wanted.hint("shuffle_hash"), "id", "left_semi").mapInPandas(tidy(run), "id long, shingles binary")


def linked(percent: int) -> Column:
    """Whether two sets (columns x, y) have 100 * intersection >= percent * union."""

    @pandas_udf(BooleanType())
    def confirm(left: pd.Series, right: pd.Series) -> pd.Series:
        out = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right, strict=True)]
        return pd.Series(out, dtype=bool)

    return confirm("x", "y")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").filter(linked(percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    first_values = first_depth(percent)
    rows = materialize(forest_rows(docs, id_col, text_col, width, first_values), "forest")
    named = rows.filter("cls is not null and id is not null")
    classes = materialize(named.groupBy("cls").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = named.select("id", "sketch", "regions").join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    members = materialize(regions_of(reps, first_values), "members")
    pairs = materialize(neighbours(members, least_estimate(percent)), "pairs")
    sets = materialize(shingle_sets(docs, id_col, text_col, members.select("id").distinct(), width), "sets")
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("est", "a")).alias("a"))
    first = materialize(confirmed(best, sets, percent), "links")
    labels = connected_components(first)
    ends = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    open_pairs = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    second = materialize(confirmed(open_pairs.join(best.select("a", "b"), ["a", "b"], "left_anti"), sets, percent), "links")
    labels = materialize(connected_components(first.unionByName(second)), "labels")
    third = materialize(between_components(members, labels, reps, sets, percent), "links")
    labels = materialize(connected_components(labels.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(third)), "labels")
    groups = classes.join(labels, classes["rep"] == labels["node"], "left")
    groups = materialize(groups.select("cls", "n", F.coalesce("component", "rep").alias("component_id")), "groups")
    found = join_skewed(rows.select("id", "cls", "n_shingles"), groups, ["cls"], "n", rows.count(), F.col("id"))
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, all columns kept: the smallest id stays, null ids rank last.
    Rows are judged by numbers that follow the ids and are written with the table, so rows that repeat an id or have none are judged one by one."""
    order = F.col(id_col).asc_nulls_last(), F.xxhash64(text_col).asc()
    ranked = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(ranked.withColumn("__row", F.monotonically_increasing_id()), "near-rows", compression="zstd")
    verdict = near_duplicates(rows, percent, id_col="__row", text_col=text_col)
    return without(rows, verdict.filter(~F.col("kept")), "__row").drop("__row")
