"""Periodic runs of words: stretches that repeat a group of words several times, found and collapsed.

A run is a stretch of words with smallest period q (words q apart are identical) and a length of at least ``least`` words and ``times`` periods,
that no neighbouring word extends with that period.

1. Masking. A run of length L and period q holds the same L - q words twice, q apart, and these two copies cover it; L - q is never below
   ``minimum_overlap``, which is taken as k. So a word outside all k-grams that occur twice in its text cannot be in a run, and a run with its
   neighbouring words of the same period lies in one surviving segment.
2. Main-Lorentz on the surviving segments: blocks of 8, 16, 32 ... words; a run belongs to the smallest block that holds it, so it crosses that block's
   centre and its period is at most 1 / ``times`` of the block. For every centre and period the stretch of equal words is extended to both sides from the centre and
   from one period before it. All centres of a level, of all texts of a batch, are extended at a time, by binary search over prefix hashes.
3. Every run is compared word by word before it counts, and a segment where hashes deceive is compared directly; equal hashes can only make
   extensions too long, never hide a run.

Texts are rows of their own, so nothing is shuffled. A task holds the words of about SLICE_CHARS characters, of a longer text one number per word.

Defined results: a null text has no words; a text without a run keeps all its words, joined by one space; rows that repeat an id are judged by
their own text; a null id stays null; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsync.llm.bpe import sliced
from docsync.llm.common import bounded_batches, tidy
from docsync.llm.minhash import mixed

WORD = r"[^\x20\x09-\x0D]+"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Characters of the texts that are worked on together, bytes of a text that are cut into words at a time, and pairs (centre, period) extended at a time.
SLICE_CHARS, PIECE_BYTES, PAIRS = 2_000_000, 4 << 20, 1 << 20
_BASE = 0x9E3779B97F4A7C15


def minimum_overlap(least: int, times: int) -> int:
    """The least L - q over all runs of length L >= max(least, times * q): L = max(least, times * q) at each period, and longer periods only add to it."""
    return min(max(least, times * q) - q for q in range(1, least + 2))


class Words:
    """Texts as numbers of words, with the words by number."""

    def __init__(self):
        self.names: list[bytes] = []
        self.numbers: dict[bytes, int] = {}

    def of(self, text: bytes) -> np.ndarray:
        """The numbers of a text's words; a long text is cut into words piece by piece."""
        parts, start, number = [], 0, self.numbers.setdefault
        while start < len(text):
            stop = start + PIECE_BYTES
            if stop < len(text):
                blank = _BLANK.search(text, stop)
                stop = blank.start() if blank else len(text)
            parts.append(np.array([number(w, len(self.numbers)) for w in text[start:stop].split()], np.int32))
            start = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def joined(self, numbers: np.ndarray) -> bytes:
        if len(self.names) < len(self.numbers):
            self.names = list(self.numbers)
        return b" ".join([self.names[i] for i in numbers.tolist()])


class Prefixes:
    """Prefix hashes of a sequence of numbers: whether stretches q apart are equal, many at a time."""

    def __init__(self, values: np.ndarray):
        with np.errstate(over="ignore"):
            spread = mixed(values.astype(np.uint64) * np.uint64(2) + np.uint64(1))
            self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(values), _BASE, np.uint64), dtype=np.uint64)])
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread * self.power[:-1], dtype=np.uint64)])

    def equal(self, at: np.ndarray, length: np.ndarray | int, q: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from ``at`` hash like those from ``at + q``."""
        with np.errstate(over="ignore"):
            return (self.sums[at + length] - self.sums[at]) * self.power[q] == self.sums[at + q + length] - self.sums[at + q]

    def longest(self, at: np.ndarray, q: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) equal those q later, ``most`` at most."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at if forward else at - middle, middle, q)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


def survivors(values: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Whether each word is inside a k-gram that occurs at least twice in its text. ``offsets`` are where texts begin and end."""
    covered = np.zeros(len(values) + 1, np.int64)
    n = len(values) - k + 1
    if n < 2:
        return covered[:-1] > 0
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)).astype(np.uint64)
    with np.errstate(over="ignore"):
        grams = mixed(text[:n] + np.uint64(1))
        for j in range(k):
            grams = mixed(grams * np.uint64(_BASE) + values[j : n + j].astype(np.uint64))
    inside = np.flatnonzero(text[:n] == text[k - 1 :])
    grams = grams[inside]
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    twice = np.zeros(len(ranked), bool)
    same = ranked[1:] == ranked[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    starts = inside[order[twice]]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + k, -1)
    return np.cumsum(covered[:-1]) > 0


def segments(kept: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of kept words inside texts, those of at least ``least`` words."""
    edge = np.zeros(len(kept) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= kept[1:] != kept[:-1]
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    chosen = kept[starts] & (ends - starts >= least) if len(starts) else np.zeros(0, bool)
    return starts[chosen], ends[chosen]


def crossing(hashes: Prefixes, starts: np.ndarray, ends: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of all stretches that hash like runs, by centres of growing blocks."""
    found, size = [np.zeros((0, 3), np.int64)], 1 << (least - 1).bit_length()
    touch = -(-minimum_overlap(least, times) // 2)  # of the equal words of a run, so many lie on one side of the centre
    longest = int((ends - starts).max(initial=0))
    while size // 2 < longest:
        half, periods = size // 2, size // times
        n = np.maximum(0, -((starts + half - ends) // size))
        of = np.repeat(np.arange(len(starts)), n)
        centres = starts[of] + half + size * (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
        for first in range(0, len(centres) * periods, PAIRS):
            pair = np.arange(first, min(first + PAIRS, len(centres) * periods))
            centre, q = centres[pair // periods], pair % periods + 1
            low, high = starts[of[pair // periods]], ends[of[pair // periods]]
            for at in (centre, centre - q):
                fits = (at >= low) & (at + q <= high)
                a, p, lo, hi = at[fits], q[fits], low[fits], high[fits]
                after, before = a + p + touch <= hi, a - touch >= lo
                near = np.zeros(len(a), bool)
                near[after] |= hashes.equal(a[after], touch, p[after])
                near[before] |= hashes.equal(a[before] - touch, touch, p[before])
                a, p, lo, hi = a[near], p[near], lo[near], hi[near]
                start = a - hashes.longest(a, p, a - lo, False)
                end = a + p + hashes.longest(a, p, hi - a - p, True)
                good = end - start >= np.maximum(least, times * p)
                found.append(np.stack([start[good], end[good], p[good]], axis=1))
        size *= 2
    rows = np.unique(np.concatenate(found), axis=0)
    # Of the periods of one stretch the smallest counts: with four and more repeats the others are its multiples.
    return rows[np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(axis=1))] if len(rows) else rows


def is_run(values: np.ndarray, start: int, end: int, q: int, low: int, high: int) -> bool:
    """Whether the words of [start, end) have period q and no neighbour inside [low, high) extends them."""
    return (
        np.array_equal(values[start : end - q], values[start + q : end])
        and (start == low or values[start - 1] != values[start - 1 + q])
        and (end == high or values[end] != values[end - q])
    )


def compared(values: np.ndarray, low: int, high: int, least: int, times: int) -> np.ndarray:
    """The runs of one segment by comparing the words of every period directly."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, (high - low) // times + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[False], values[low : high - q] == values[low + q : high], [False]]).astype(np.int8)))
        for a, b in zip(same[::2].tolist(), same[1::2].tolist(), strict=True):
            if b - a + q >= max(least, times * q):
                found.setdefault((low + a, low + b + q), q)
    return np.array(sorted((s, e, q) for (s, e), q in found.items()), np.int64).reshape(-1, 3)


def find_runs(values: np.ndarray, offsets: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of the runs of all texts, in order; ``values`` are the words of all texts one after the other."""
    starts, ends = segments(survivors(values, offsets, minimum_overlap(least, times)), offsets, least)
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    lengths = ends - starts
    edges = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(edges[-1]) + np.repeat(starts - edges[:-1], lengths)
    seen = values[place]
    rows = crossing(Prefixes(seen), edges[:-1], edges[1:], least, times)
    own = np.searchsorted(edges, rows[:, 0], "right") - 1
    deceived = {int(s) for (a, b, q), s in zip(rows.tolist(), own, strict=True) if not is_run(seen, a, b, q, int(edges[s]), int(edges[s + 1]))}
    if deceived:
        right = [compared(seen, int(edges[s]), int(edges[s + 1]), least, times) for s in sorted(deceived)]
        rows = np.concatenate([rows[~np.isin(own, list(deceived))], *right])
    rows = np.stack([place[rows[:, 0]], place[rows[:, 1] - 1] + 1, rows[:, 2]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def detect(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) per row: ``runs`` are (start, length, period) by start and period, ``collapsed`` the words, joined by one
    space, that no run holds after its first period. ``times`` is at least 2."""
    if times < 2 or least < 1:
        raise ValueError("times must be at least 2 and least at least 1")
    id_type = docs.schema[id_col].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def of_slice(texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray, list[bytes]]:
        words = Words()
        each = [words.of(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)])
        values = np.concatenate([*each, np.zeros(0, np.int32)])
        rows = find_runs(values, offsets, least, times)
        own = np.searchsorted(offsets, rows[:, 0], "right") - 1
        drop = np.zeros(len(values) + 1, np.int64)
        np.add.at(drop, rows[:, 0] + rows[:, 2], 1)
        np.add.at(drop, rows[:, 1], -1)
        kept, touched = np.cumsum(drop[:-1]) == 0, set(own.tolist())
        collapsed = [words.joined(each[i][kept[offsets[i] : offsets[i + 1]]]) if i in touched or len(t) > PIECE_BYTES else b" ".join(t.split()) for i, t in enumerate(texts)]
        rows = np.stack([rows[:, 0] - offsets[own], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
        return [len(x) for x in each], np.searchsorted(own, np.arange(len(texts) + 1)), rows, collapsed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            for part in sliced(texts, SLICE_CHARS):
                n, edges, rows, collapsed = of_slice(texts[part])
                runs = pa.StructArray.from_arrays([pa.array(rows[:, j]) for j in range(3)], fields=list(run_type))
                columns = [ids.slice(part.start, len(n)), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    given = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = given.mapInArrow(tidy(run), f"id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def longest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period, the first of several; null where there is none."""
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda old, new: old.isNull() | (new["length"] * old["period"] > old["length"] * new["period"])
    return F.aggregate(runs, nothing, lambda old, new: F.when(better(old, new), new).otherwise(old))


def listed(runs: Column) -> Column:
    """The runs as lines ``start,length,period``."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")


@F.arrow_udf(StringType())
def cycled(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """(text, start, period): the text's words, joined by one space, those from ``start`` on replaced by the ``period`` words that begin there, again and again."""
    for texts, starts, periods in columns:
        out = []
        for text, a, p in zip(texts.cast(pa.large_binary()).to_pylist(), starts.to_pylist(), periods.to_pylist(), strict=True):
            if text is None or a is None or p is None:
                out.append(None)
                continue
            words = text.split()
            group = words[a : a + p]
            rest = len(words) - a
            out.append(b" ".join(words[:a] + (group * -(-rest // p))[:rest]))
        yield pa.array(out, pa.binary()).cast(pa.string())
