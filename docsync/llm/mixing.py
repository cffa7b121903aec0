"""Mixing sources to target weights, in DataFrame operations.

Sizes are added up per source; targets come from weights by filling: every source gets
``level * weight`` but no more than ``cap`` times its size, and the level is the one at which the
targets add up to ``budget`` times all sizes (the fixed point of resharing the excess by weight).
A document is then taken floor(rate) times, and once more with a probability of the rate's fraction f.

The further copies are drawn by hash: a document's draw is a number of DRAW_BITS bits that depends only on the seed and its id. Draws of few
or very unlike documents can miss a target by far, so each source draws class by class of about equal sizes (the number of binary digits and the three digits after the
first): of the n documents of a class those with the smallest draws get a copy, as many as make the count f * n, rounded up or down. The roundings of a source's classes follow
one another, in order of size, from one start that is drawn by hash from the seed and the source: the first k classes hold floor(f * N + start) copies for their N documents. So a source
of any number of documents comes near its target, and every document has a copy with probability f exactly over the seeds: the count of its class is f * n on average, and who of the class gets
one depends on the draws alone.

The smallest draws of a class are found without sorting it: draws are counted in BINS bins, and inside the bin that holds the last copy the bound is set by proportion, which keeps
probabilities; it misses the count by draws of this one bin only, so not at all where a bin holds one document.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; sources without words get target 0; a table without words takes nothing; rows that
repeat an id are drawn alike; a null id is drawn as the empty id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsync.llm.common import join_skewed, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
DRAW_BITS, BIN_BITS = 52, 12
BINS = 1 << BIN_BITS
#: Draws in one bin.
STEP = 1 << (DRAW_BITS - BIN_BITS)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number of DRAW_BITS bits: the first ones of md5(seed:key)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """A number for sizes that share their number of binary digits and the first four of them; it grows with the size."""
    digits = F.bin(size)
    return (F.length(digits) * 16 + F.conv(F.rpad(F.substring(digits, 1, 4), 4, "0"), 2, 10).cast("int")).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs), one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(int(w)) for w in weights])
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("weight", F.element_at(pick, place.cast("int")))
    room = F.lit(cap) * F.col("source_size")
    filling = Window.orderBy(room / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = F.lit(budget) * F.sum("source_size").over(everything)
    level = (words - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward)
    filled = weighed.withColumn("room", room).withColumn("level", level)
    # Sources fill up in order of room per weight: the level holds from the first one that it doesn't fill.
    final = F.max(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level"))).over(everything)
    target = F.least("room", F.coalesce(F.col("final") * F.col("weight"), F.col("room")))
    return filled.withColumn("final", final).select("source", "source_size", "n_docs", target.alias("target"))


def with_bounds(draws: DataFrame, targets: DataFrame, seed: str) -> tuple[DataFrame, int]:
    """``targets`` (source, source_size, n_docs, target) with ``rate`` and ``bounds``, by class of sizes the draw below which a document gets one more copy, from
    ``draws`` (source, size, draw); the number of rows. What is shuffled is a count per source, class and bin, at most one row per document."""
    rated = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    counts = draws.groupBy("source", size_class(F.col("size")).alias("class"), F.shiftright("draw", DRAW_BITS - BIN_BITS).alias("bin")).agg(F.count("*").alias("n"))
    counts = materialize(counts, "mix-bins")
    classes = counts.groupBy("source", "class").agg(F.sum("n").alias("n"))
    classes = classes.withColumnRenamed("source", "named").join(rated.select("source", (F.col("rate") - F.floor("rate")).alias("f")), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    start = draw(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")), f"{seed}:start") / F.lit(float(1 << DRAW_BITS))
    upto = Window.partitionBy("source").orderBy("class")
    copies = lambda n: F.floor(F.col("f") * n + start)
    total = F.sum("n").over(upto)
    wanted = classes.select("source", "class", (copies(total) - copies(total - F.col("n"))).alias("wanted"))
    within = Window.partitionBy("source", "class").orderBy("bin")
    before = F.sum("n").over(within) - F.col("n")
    placed = counts.withColumn("before", before).withColumnRenamed("source", "named").withColumnRenamed("class", "own")
    placed = placed.join(wanted, F.col("source").eqNullSafe(F.col("named")) & (F.col("class") == F.col("own")))
    last = placed.filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("n")))
    bound = (F.col("bin") * F.lit(STEP) + F.ceil((F.col("wanted") - F.col("before")) * F.lit(float(STEP)) / F.col("n"))).cast("long")
    bounds = last.select("source", F.struct("class", bound.alias("bound")).alias("b")).groupBy("source").agg(F.map_from_entries(F.collect_list("b")).alias("bounds"))
    found = rated.join(bounds.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
    found = materialize(found, "mix-bounds")
    return found, found.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]


def by_source(rows: DataFrame, table: DataFrame, n_rows: int, spread: Column) -> DataFrame:
    """``rows`` with the columns of ``table`` (source, n_docs, ...), null being a source too."""
    named = [F.coalesce(F.col("source"), F.lit("")).alias("__name"), F.col("source").isNull().alias("__unnamed")]
    rest = [c for c in table.columns if c != "source"]
    return join_skewed(rows.select("*", *named), table.select(*named, *rest), ["__name", "__unnamed"], "n_docs", n_rows, spread).drop("__name", "__unnamed")


def copies_of(size: Column, row_draw: Column) -> Column:
    """How often a row is taken, from its size and draw and its source's rate and bounds."""
    bound = F.coalesce(F.element_at("bounds", size_class(size)), F.lit(0).cast("long"))
    return F.floor("rate") + (row_draw < bound).cast("long")


def _sized(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, draw) of every row, written once: texts are read and counted in one pass."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), draw(F.col(id_col), seed).alias("draw"))
    return materialize(rows, "mix-sizes")


def _rates(sized: DataFrame, weights: Sequence[int], budget: float, cap: float, seed: str) -> tuple[DataFrame, int]:
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    return with_bounds(sized, source_targets(totals, weights, budget, cap), seed)


def mixing_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) per row."""
    sized = _sized(docs, seed, id_col, text_col, source_col)
    rates, n_rows = _rates(sized, weights, budget, cap, seed)
    out = by_source(sized, rates, n_rows, F.col("id")).withColumn("copies", copies_of(F.col("size"), F.col("draw")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as it is drawn, with its own columns."""
    rates, n_rows = _rates(_sized(docs, seed, id_col, text_col, source_col), weights, budget, cap, seed)
    rows = docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), draw(F.col(id_col), seed).alias("draw"), F.struct(*docs.columns).alias("row"))
    drawn = by_source(rows, rates, n_rows, F.col("draw")).select("row", copies_of(F.col("size"), F.col("draw")).alias("copies")).filter("copies > 0")
    copies = drawn.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])
