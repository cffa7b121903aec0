"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

A logged conversation is often a snapshot of a longer one: the same turns from the start, then more.
Each conversation gets a chain of rolling hashes, one per turn prefix (the hash of a prefix is the
SHA-256 of the previous hash, the role and the text, each with its length). Copies collapse to the
smallest id by their last hash; conversations whose last hash is a proper prefix hash of another
one go in an anti-join; the maximal ones that remain are rendered.

Both sides of the anti-join are distinct hashes, so a first turn that a third of the conversations
share meets in one row. A conversation is a unit: its turns are rendered into one text.

Defined results: a null role renders as ``user`` and a null text as empty (for the hash, null
differs from both); turns are ordered by turn number (null first), then role, then text; rows without
a conversation id are left out, since they belong to none; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import materialize

TURN = ("<|", "|>\n", "<|end|>\n")


def _sized(value: Column) -> Column:
    """Length and value, so that neighbouring fields can't run into each other; null is its own value."""
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def prefix_hashes(turns: Column) -> Column:
    """Rolling hashes of every turn prefix, shortest first."""
    step = lambda acc, t: F.concat(
        acc, F.array(F.sha2(F.concat(F.coalesce(F.element_at(acc, -1), F.lit("")), F.lit("/"), _sized(t["role"]), F.lit("/"), _sized(t["text"])), 256))
    )
    first = F.array(F.sha2(F.concat(F.lit("/"), _sized(turns[0]["role"]), F.lit("/"), _sized(turns[0]["text"])), 256))
    rest = F.slice(turns, F.lit(2), F.greatest(F.size(turns) - 1, F.lit(0)))
    return F.aggregate(rest, first, step)


def render(turns: Column, marks: tuple[str, str, str] = TURN) -> Column:
    """One text per conversation: each turn as open mark, role, mark, text, end mark."""
    opened, named, closed = marks
    one = lambda t: F.concat(F.lit(opened), F.coalesce(t["role"], F.lit("user")), F.lit(named), F.coalesce(t["text"], F.lit("")), F.lit(closed))
    return F.array_join(F.transform(turns, one), "")


def maximal_conversations(logs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, last_hash, rendered) of every conversation that no other one extends;
    n_copies counts the conversations with exactly these turns."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    named = logs.filter(F.col(conv_col).isNotNull())
    whole = named.groupBy(F.col(conv_col).alias("conv")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = materialize(whole.withColumn("hashes", prefix_hashes(F.col("turns"))), "chat-conversations")
    last = F.element_at("hashes", -1)
    copies = whole.groupBy(last.alias("last_hash")).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    proper = F.slice("hashes", F.lit(1), F.size("hashes") - 1)
    extended = whole.select(F.explode(proper).alias("last_hash")).distinct()
    maximal = copies.join(extended, "last_hash", "left_anti")
    kept = whole.select("conv", "turns").join(maximal, "conv")
    return kept.select(
        F.col("conv").alias(conv_col), F.size("turns").cast("long").alias("n_turns"), "n_copies", "last_hash", render(F.col("turns")).alias("rendered")
    )
