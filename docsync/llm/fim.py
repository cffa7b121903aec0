"""Fill-in-middle transformation: a text is cut in three at token ends and put together in another order.

Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, so a token ends where a character is no white space and the next one
is, and at the end of the text: two adjacent characters decide. The bytes of a batch of texts are therefore cut into chunks that overlap by
one byte, and the ends in each chunk are counted without knowing the chunks before it. Prefix sums of these counts give the number of tokens, and
tell which chunks own the two cuts; only those are scanned again for the places. A text lies in one row, so nothing is shuffled; a task holds
the counts of its batch and one block of bytes at a time, whatever the length of a text.

Forms (``<P>``, ``<S>`` and ``<M>`` being the marks): ``plain`` is the text; ``psm`` is ``<P>prefix<S>suffix<M>middle``; ``spm`` is
``<S>suffix<P>prefix<M>middle``. Draws are taken from the sha256 of seed and id, so reruns agree.

Defined results: a null text is an empty one; empty texts and texts that hold a mark stay plain, so ``restored`` is always exact; cuts may
coincide, and prefix, middle or suffix may be empty; a null id draws as the empty id, and rows that repeat an id draw alike (their
cuts still follow their own numbers of tokens); further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docsync.llm.common import bounded_batches

# The three marks.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a chunk, and of the chunks that are looked at in one go.
CHUNK, BLOCK = 4096, 1 << 20


def token_ends(data: np.ndarray, low: int, high: int, offsets: np.ndarray) -> np.ndarray:
    """Whether each byte of [low, high) is the last one of a token; one byte beyond is looked at. ``offsets`` are the ends of texts."""
    seen = data[low : high + 1]
    blank = (seen == 0x20) | ((seen - np.uint8(9)) < 5)
    found = ~blank[: high - low]
    found[: len(blank) - 1] &= blank[1:]
    ends = offsets[np.searchsorted(offsets, low, "right") : np.searchsorted(offsets, high, "right")]
    found[ends - 1 - low] = True
    return found


def characters(data: np.ndarray) -> np.ndarray:
    """Whether each byte is the first one of a code point."""
    return (data & 0xC0) != 0x80


def chunk_counts(data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges of the chunks, which also end with each text, and the sums of token ends and of code points before each edge."""
    edges = np.unique(np.concatenate([offsets, np.arange(offsets[0], offsets[-1], chunk)]))
    ends, chars = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    step = max(1, BLOCK // chunk)
    for i in range(0, len(edges) - 1, step):
        part = edges[i : i + step + 1]
        low, high = int(part[0]), int(part[-1])
        ends.append(np.add.reduceat(token_ends(data, low, high, offsets), part[:-1] - low, dtype=np.int64))
        chars.append(np.add.reduceat(characters(data[low:high]), part[:-1] - low, dtype=np.int64))
    return edges, np.cumsum(np.concatenate(ends)), np.cumsum(np.concatenate(chars))


def cut_places(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """The number of tokens of each text, and the code points before its cuts: with n tokens, cut c falls after ``draws[:, c] % (n + 1)`` of them."""
    edges, ends, chars = chunk_counts(data, offsets, chunk)
    at = np.searchsorted(edges, offsets)
    before = ends[at[:-1]]
    n = ends[at[1:]] - before
    ranks = draws % (n + 1)[:, None]
    owner = np.searchsorted(ends, before[:, None] + ranks) - 1  # the chunk that holds the last token end before the cut
    places = np.zeros(ranks.shape, np.int64)
    for i, c in zip(*np.nonzero(ranks), strict=True):
        k = owner[i, c]
        low, high = int(edges[k]), int(edges[k + 1])
        end = np.flatnonzero(token_ends(data, low, high, offsets))[before[i] + ranks[i, c] - ends[k] - 1] + 1
        places[i, c] = chars[k] - chars[at[i]] + np.count_nonzero(characters(data[low : low + end]))
    return n, places


@F.arrow_udf(StructType([StructField(name, LongType()) for name in ("n", "first", "second")]))
def cuts(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """(text, draw, draw): the number of tokens, and the code points before the first and the second cut."""
    for text, one, other in columns:
        text = text.cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        draws = np.stack([one.to_numpy(zero_copy_only=False), other.to_numpy(zero_copy_only=False)], axis=1)
        n, places = cut_places(data, offsets, draws)
        places.sort(axis=1)
        yield pa.StructArray.from_arrays([pa.array(n), pa.array(places[:, 0]), pa.array(places[:, 1])], ["n", "first", "second"])


def draws(id_col: Column, seed: str) -> list[Column]:
    """Four numbers of 32 bits: the first digits of sha256(seed:id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: str = "42", rate: int = 50, spm: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row: ``rate`` of 100 texts are cut, ``spm`` of 100 of those have the suffix first.
    The numbers of code points are null for plain texts."""
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), text.alias("body"), h1.alias("h1"), h2.alias("h2"), (h3 % 100).alias("cut"), (h4 % 100).alias("turn"))
    marked = F.contains("body", F.lit(PREFIX)) | F.contains("body", F.lit(SUFFIX)) | F.contains("body", F.lit(MIDDLE))
    form = F.when((F.length("body") == 0) | marked | (F.col("cut") >= rate), "plain").when(F.col("turn") < spm, "spm").otherwise("psm")
    rows = rows.select("id", "body", form.alias("form"), cuts("body", "h1", "h2").alias("at"))
    first, second = F.col("at.first"), F.col("at.second")
    prefix, middle = F.substr("body", F.lit(1), first), F.substr("body", first + 1, second - first)
    suffix = F.substr("body", second + 1)
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("body"))
    )
    is_cut = F.col("form") != "plain"
    return rows.select(
        F.col("id").alias(id_col), F.col("at.n").alias("n"), "form", F.when(is_cut, first).alias("prefix_chars"), F.when(is_cut, second - first).alias("middle_chars"), output.alias("output")
    )


def restored(form: Column, output: Column) -> Column:
    """The text from an output and its form. A mark begins with ``<`` and holds no other, so where the text has none the first of each kind is the one put in."""
    s, p, m = (F.instr(output, mark) for mark in (SUFFIX, PREFIX, MIDDLE))
    between = lambda a, b: F.substr(output, a + 3, b - a - 3)
    middle = F.substr(output, m + 3)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
