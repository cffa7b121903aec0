"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` bytes, pretrained on the texts given for learning. In a
context x with N occurrences and D distinct followers, a follower seen n times has probability n / (N + D); the rest,
D / (N + D), escapes to the context one byte shorter, where the followers already offered by x are excluded
from all counts. Below the empty context every byte left has the same share. A text is framed by 0xFF, which UTF-8 never
holds, so that ends are predicted too and the probabilities of all texts add up to at most one.

The score of a byte depends on its (order + 1)-gram alone, and nothing is pruned or broadcast but the counts of STEM-grams (at most 256**STEM):

1. Texts are cut into parts of about PART_BYTES. A part lists its distinct grams and words once, with their counts in the texts learned from, dealt
   into cells: grams by the last STEM bytes of their context, so that a cell holds all contexts and shorter contexts of its grams, words by a hash.
2. The owner of a cell merges the parts' lists as they stream by, builds the cell's trie and scores its distinct grams. Lists of more than LOT_PARTS
   parts are added up in a tree, LOT_PARTS at a time, so that no task reads those of a common stem from all parts.
3. The cell's scores meet the lists of the parts, LOT_PARTS parts in a task, and each part gets back the scores and counts of what it holds.
4. Each part is scored with them.

A task holds the distinct grams or words of one cell, or one part; cells grow in number with the square root of the input, the lists in proportion to it.
The unigram base counts all words exactly in the same way.

Defined results: a null text counts as empty and is scored as an end alone; with nothing to learn from every byte has probability 1/256 and
every base token log10(1 / 1); a null in the choice of texts to learn from counts as no; rows repeating an id are scored apart; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import bounded_batches, materialize, tidy

ORDER, STEM = 5, 2
#: Bytes and texts of a part, and bytes handled at a time inside it.
PART_BYTES, PART_TEXTS, SLICE = 12 << 20, 60_000, 1 << 20
#: Parts whose lists of one cell meet in a task.
LOT_PARTS = 256


def packed(values: np.ndarray, delta: bool = False) -> bytes:
    """An array as compressed bytes; sorted ones as differences."""
    return zstandard.compress((np.diff(values, prepend=values.dtype.type(0)) if delta else values).tobytes(), 1)


def unpacked(raw: bytes, dtype: type, delta: bool = False) -> np.ndarray:
    values = np.frombuffer(zstandard.decompress(raw), dtype)
    return np.cumsum(values, dtype=dtype) if delta else values


def low(n_bytes: int) -> np.uint64:
    """The mask of the last ``n_bytes`` bytes."""
    return np.uint64((1 << (8 * n_bytes)) - 1)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted table, -1 where it is not there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Merger:
    """Adds up sorted lists of keys and counts, holding little more than the distinct keys."""

    def __init__(self) -> None:
        self.held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > len(self.held[0]) + 1_000_000:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        self.held = summed(np.concatenate([self.held[0], *[k for k, _ in self.waiting]]), np.concatenate([self.held[1], *[n for _, n in self.waiting]]))
        self.waiting, self.size = [], 0
        return self.held


def grams_of(texts: list[bytes], order: int, most: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The (order + 1)-gram of every byte and end of the texts, in slices: grams, the text of each counted from the slice's first, and that first one."""
    frame = b"\xff" * order
    whole = np.frombuffer(b"".join(part for t in texts for part in (frame, t, b"\xff")), np.uint8)
    ends = np.cumsum(np.array([len(t) + 1 + order for t in texts], np.int64))
    for a in range(0, len(whole) - order, most):
        b = min(a + most, len(whole) - order)
        grams = np.zeros(b - a, np.uint64)
        for j in range(order + 1):
            grams <<= np.uint64(8)
            grams |= whole[a + j : b + j]
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b - 1, side="right")
        edges = np.clip(np.concatenate(([a], ends[first : last + 1])), a, b)
        inside = np.ones(b - a, bool)
        gaps = (ends[first : last + 1, None] - 1 - np.arange(order)).ravel()  # grams that end in the frame of the next text
        inside[gaps[(gaps >= a) & (gaps < b)] - a] = False
        owner = np.repeat(np.arange(last - first + 1), np.diff(edges))
        yield grams[inside], owner[inside], int(first)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split()


@dataclass
class Level:
    """Contexts of one length: grams with their log counts and first probabilities, and for each
    context its escape, its shorter context, and that one's mass and escape once its own followers are excluded."""

    grams: np.ndarray
    log_n: np.ndarray
    top: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray
    shorter: np.ndarray
    mass: np.ndarray
    further: np.ndarray


class Trie:
    """The contexts of one cell (or of all texts): one Level per context length, the longest last."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts: for each context length from 0 the sorted grams and their counts, with every shorter form of a longer gram."""
        self.order, self.levels = len(counts) - 1, []
        totals: list[tuple[np.ndarray, np.ndarray]] = []
        for k, (grams, n) in enumerate(counts):
            contexts, owner = np.unique(grams >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(owner, weights=n, minlength=len(contexts)), np.bincount(owner, minlength=len(contexts))
            totals.append((total, kinds))
            shorter = np.zeros(len(contexts), np.int64)
            mass = further = np.zeros(len(contexts))
            if k:
                below, (low_total, low_kinds) = counts[k - 1], totals[k - 1]
                shorter = np.searchsorted(self.levels[k - 1].contexts, contexts & low(k - 1))
                same = np.searchsorted(below[0], grams & low(k))
                rest = low_total[shorter] - np.bincount(owner, weights=below[1][same], minlength=len(contexts))
                left = low_kinds[shorter] - kinds
                with np.errstate(divide="ignore", invalid="ignore"):
                    mass = np.where(left > 0, np.log10(rest + left), 0.0)
                    further = np.where(left > 0, np.log10(left) - mass, 0.0)
            whole = total + kinds
            level = Level(grams, np.log10(n), np.log10(n) - np.log10(whole)[owner], contexts, np.log10(kinds) - np.log10(whole), shorter, mass, further)
            self.levels.append(level)
        seen = len(self.levels[0].grams)
        self.last = -math.log10(256 - seen) if seen < 256 else 0.0

    def scores(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram after the bytes before it."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        above = np.full(len(grams), -1)  # the longer context that has escaped to this one
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            key = grams[todo] & low(k + 1)
            at = find(level.grams, key)
            hit, fresh = at >= 0, above < 0
            now = hit & fresh
            out[todo[now]] += level.top[at[now]]
            if k < self.order:
                longer = self.levels[k + 1]
                now = hit & ~fresh
                out[todo[now]] += level.log_n[at[now]] - longer.mass[above[now]]
                now = ~hit & ~fresh
                out[todo[now]] += longer.further[above[now]]
                above[~fresh] = longer.shorter[above[~fresh]]
            miss = ~hit
            todo, above, key, fresh = todo[miss], above[miss], key[miss], fresh[miss]
            found = find(level.contexts, key[fresh] >> np.uint64(8))
            above[fresh] = found
            new = found >= 0
            out[todo[fresh][new]] += level.escape[found[new]]
            if not len(todo):
                break
        out[todo] += self.last
        return out


def trie_of(grams: np.ndarray, counts: np.ndarray, order: int, stems: tuple[np.ndarray, np.ndarray]) -> Trie:
    """The trie of the longest grams of a cell; ``stems`` are the STEM-grams of all texts, which make the short contexts."""
    levels = [(grams, counts)]
    for k in range(order - 1, STEM - 1, -1):
        levels.append(summed(levels[-1][0] & low(k + 1), levels[-1][1]))
    levels.append(stems)
    for k in range(STEM - 2, -1, -1):
        levels.append(summed(levels[-1][0] & low(k + 1), levels[-1][1]))
    return Trie(levels[::-1])


@dataclass
class Part:
    """Some texts that are counted and scored together."""

    order: int
    cells: int
    most: int
    ids: list = field(default_factory=list)
    texts: list[bytes] = field(default_factory=list)
    learn: list[bool] = field(default_factory=list)
    words: Counter = field(default_factory=Counter)
    others: set[bytes] = field(default_factory=set)
    size: int = 0

    def add(self, name, text: bytes, learn: bool) -> None:
        self.ids.append(name), self.texts.append(text), self.learn.append(learn)
        self.size += len(text) + self.order + 1
        (self.words if learn else self.others).update(words_of(text))

    def full(self) -> bool:
        return self.size >= self.most or len(self.texts) >= PART_TEXTS

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct grams and their counts in the texts learned from."""
        learn, both = np.array(self.learn, np.uint64), Merger()
        for grams, owner, first in grams_of(self.texts, self.order):
            flagged = np.sort((grams << np.uint64(1)) | learn[first + owner])
            both.add(*_runs(flagged))
        flagged, counts = both.total()
        return summed(flagged >> np.uint64(1), counts * (flagged & np.uint64(1)).astype(np.int64))

    def rows(self, number: int) -> Iterator[dict]:
        """The part's texts as one row with cell -1, its lists of grams (cells from 0) and of words (from ``cells``)."""
        grams, counts = self.grams()
        stems, times = summed(grams & low(STEM), counts)
        stems, times = stems[times > 0].astype(np.int64).tolist(), times[times > 0].tolist()
        blank = {"part": number, "ids": None, "n_learned": None, "stems": None, "times": None}
        sizes = np.array([len(t) for t in self.texts], np.int64)
        yield blank | {"cell": -1, "keys": zstandard.compress(b"".join(self.texts), 3), "counts": packed(sizes), "ids": self.ids, "n_learned": sum(self.learn), "stems": stems, "times": times}
        stem = (grams >> np.uint64(8)) & low(STEM)
        cell = (stem * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(self.cells)
        order = np.argsort(cell, kind="stable")
        edges = np.searchsorted(cell[order], np.arange(self.cells + 1, dtype=np.uint64))
        for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                at = order[a:b]
                yield blank | {"cell": c, "keys": packed(grams[at], delta=True), "counts": packed(counts[at])}
        dealt: list[list[bytes]] = [[] for _ in range(self.cells)]
        for w in self.words.keys() | self.others:
            dealt[zlib.crc32(w) % self.cells].append(w)
        for c, words in enumerate(dealt):
            if words:
                times = np.array([self.words[w] for w in words], np.int64)
                yield blank | {"cell": self.cells + c, "keys": zstandard.compress(b"\n".join(words), 1), "counts": packed(times)}


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array and how often each occurs."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)
    return values[first], np.diff(np.append(first, len(values)))


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


LISTS = "part long, cell int, keys binary, counts binary"
_LISTED = pa.schema([("part", pa.int64()), ("cell", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def cut_into_parts(docs: DataFrame, order: int, cells: int, part_bytes: int) -> DataFrame:
    """One table of the parts' texts and lists, from ``docs`` (id, text, learn)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, schema = TaskContext.get().partitionId(), 0, None
        part = Part(order, cells, part_bytes)
        for batch in batches:
            schema = schema or pa.schema([*_LISTED, ("ids", pa.list_(batch.schema.field("id").type)), ("n_learned", pa.int64()), ("stems", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
            for name, text, learn in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "learn")), strict=True):
                part.add(name, (text or "").encode("utf-8", "surrogatepass"), learn)
                if part.full():
                    yield from (_batch([row], schema) for row in part.rows(task << 32 | made))
                    part, made = Part(order, cells, part_bytes), made + 1
        if part.texts:
            yield from (_batch([row], schema) for row in part.rows(task << 32 | made))

    id_type = docs.schema["id"].dataType.simpleString()
    return bounded_batches(docs).mapInArrow(tidy(run), f"{LISTS}, ids array<{id_type}>, n_learned long, stems array<long>, times array<long>")


def merged(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[int, int, Merger, dict[bytes, int]]]:
    """The lists, which come in order of (cell, lot), added up: cell, lot, and its grams, or its words that were learned from."""
    now, merger, words = None, Merger(), {}
    for batch in batches:
        for cell, lot, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("cell", "lot", "keys", "counts")), strict=True):
            if (cell, lot) != now:
                if now is not None:
                    yield *now, merger, words
                now, merger, words = (cell, lot), Merger(), {}
            times = unpacked(counts, np.int64)
            if cell < cells:
                merger.add(unpacked(keys, np.uint64, delta=True), times)
            else:
                for w, n in zip(zstandard.decompress(keys).split(b"\n"), times.tolist(), strict=True):
                    if n:
                        words[w] = words.get(w, 0) + n
    if now is not None:
        yield *now, merger, words


def in_lots(lists: DataFrame, lots: int) -> DataFrame:
    """The lists with the lot of their part, in tasks by (cell, lot) and in that order."""
    dealt = lists.withColumn("lot", F.pmod(F.xxhash64("part"), F.lit(lots)))
    return dealt.repartition("cell", "lot").sortWithinPartitions("cell", "lot", F.col("part").asc_nulls_first())


def add_up(lists: DataFrame, cells: int, lots: int) -> DataFrame:
    """One list for each cell and lot of parts, in the form of the parts' lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, lot, merger, words in merged(batches, cells):
            if cell < cells:
                grams, counts = merger.total()
                yield _batch([{"part": lot, "cell": cell, "keys": packed(grams, delta=True), "counts": packed(counts)}], _LISTED)
            elif words:
                yield _batch([{"part": lot, "cell": cell, "keys": zstandard.compress(b"\n".join(words), 1), "counts": packed(np.fromiter(words.values(), np.int64, len(words)))}], _LISTED)

    return in_lots(lists.select("part", "cell", "keys", "counts"), lots).mapInArrow(tidy(run), LISTS)


def learn_cells(lists: DataFrame, order: int, cells: int, stems: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(cell, keys, values, total, kinds) of every cell: its distinct grams and their scores, or its words and their counts."""
    schema = pa.schema([("cell", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("total", pa.int64()), ("kinds", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, _, merger, words in merged(batches, cells):
            if cell < cells:
                grams, counts = merger.total()
                seen = counts > 0
                scores = trie_of(grams[seen], counts[seen], order, stems).scores(grams)
                row = {"keys": packed(grams, delta=True), "values": packed(scores), "total": 0, "kinds": 0}
            else:
                counts = np.fromiter(words.values(), np.int64, len(words))
                row = {"keys": zstandard.compress(b"\n".join(words), 1), "values": packed(counts), "total": int(counts.sum()), "kinds": len(words)}
            yield _batch([{"cell": cell, **row}], schema)

    return in_lots(lists.select("part", "cell", "keys", "counts"), 1).mapInArrow(tidy(run), "cell int, keys binary, values binary, total long, kinds long")


def hand_back(lists: DataFrame, model: DataFrame, cells: int, lots: int) -> DataFrame:
    """The lists with the scores or counts of their grams and words: (part, cell, keys, counts). A cell's scores go to each of its lots of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = values = None
        words: dict[bytes, int] = {}
        for batch in batches:
            for part, cell, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "cell", "keys", "counts")), strict=True):
                if part is None and cell < cells:
                    grams, values = unpacked(keys, np.uint64, delta=True), unpacked(counts, np.float64)
                elif part is None:
                    words = dict(zip(zstandard.decompress(keys).split(b"\n"), unpacked(counts, np.int64).tolist(), strict=False))
                elif cell < cells:
                    yield _batch([{"part": part, "cell": cell, "keys": keys, "counts": packed(values[np.searchsorted(grams, unpacked(keys, np.uint64, delta=True))])}], _LISTED)
                else:
                    times = np.array([words.get(w, 0) for w in zstandard.decompress(keys).split(b"\n")], np.int64)
                    yield _batch([{"part": part, "cell": cell, "keys": keys, "counts": packed(times)}], _LISTED)

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long"))).alias("lot")
    known = model.select(F.lit(None).cast("long").alias("part"), "cell", "keys", F.col("values").alias("counts"), every)
    own = lists.select("part", "cell", "keys", "counts", F.pmod(F.xxhash64("part"), F.lit(lots)).alias("lot"))
    dealt = own.unionByName(known).repartition("cell", "lot").sortWithinPartitions("cell", "lot", F.col("part").asc_nulls_first())
    return dealt.mapInArrow(tidy(run), LISTS)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, part_bytes: int = PART_BYTES, lot_parts: int = LOT_PARTS) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``, both models learned from the rows where ``learn`` holds."""
    if not STEM <= order <= 5:
        raise ValueError(f"order must be from {STEM} to 5")
    if lot_parts < 2:
        raise ValueError("lot_parts must be at least 2")
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    n_bytes = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(8, math.ceil(4 * math.sqrt(n_bytes / part_bytes)))
    table = materialize(cut_into_parts(given, order, cells, part_bytes), "ppm-parts", compression="none")
    texts, lists = table.filter("cell < 0"), table.filter("cell >= 0")
    ends, n_parts = texts.agg(F.coalesce(F.sum("n_learned"), F.lit(0)), F.count("*")).first()
    each = texts.select(F.explode(F.arrays_zip("stems", "times")).alias("s")).groupBy(F.col("s.stems").alias("stem")).agg(F.sum("s.times").alias("n"))
    found = sorted(each.collect())  # at most 256**STEM rows
    stems = np.array([r[0] for r in found], np.uint64), np.array([r[1] for r in found], np.int64)
    lots = max(1, math.ceil(n_parts / lot_parts))
    learned, left = lists, lots
    while left > 1:  # so many lists of a cell are added up at a time
        learned, left = materialize(add_up(learned, cells, left), "ppm-lists", compression="none"), math.ceil(left / lot_parts)
    model = materialize(learn_cells(learned, order, cells, stems), "ppm-model", compression="none")
    words, kinds = model.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    tokens, kinds = words + ends, kinds + (ends > 0)
    whole = math.log10(tokens + kinds + 1)
    end = math.log10(ends + 1) - whole
    named = ("id", "n_tokens", "n_known", "base_score", "score")

    def finish(group: pa.Table) -> pa.Table:
        rows = group.select(["cell", "keys", "counts"]).to_pylist()
        grams = [(unpacked(r["keys"], np.uint64, delta=True), unpacked(r["counts"], np.float64)) for r in rows if 0 <= r["cell"] < cells]
        keys, values = np.concatenate([g for g, _ in grams]), np.concatenate([v for _, v in grams])
        by = np.argsort(keys)
        keys, values = keys[by], values[by]
        unknown, worth = -whole, {}
        for r in rows:
            if r["cell"] >= cells:
                times = unpacked(r["counts"], np.int64)
                logs = np.where(times > 0, np.log10(times + 1) - whole, unknown)
                worth.update(zip(zstandard.decompress(r["keys"]).split(b"\n"), logs.tolist(), strict=True))
        own = next(r for r in rows if r["cell"] < 0)
        grams = rows = None
        raw, edges = zstandard.decompress(own["keys"]), np.concatenate(([0], np.cumsum(unpacked(own["counts"], np.int64)))).tolist()
        coded = [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        total = np.zeros(len(coded))
        for slice_grams, owner, first in grams_of(coded, order):
            both = np.sort((slice_grams << np.uint64(16)) | owner.astype(np.uint64))
            distinct, times = _runs(both >> np.uint64(16))
            each = np.repeat(values[np.searchsorted(keys, distinct)], times)
            part = np.bincount((both & np.uint64(0xFFFF)).astype(np.int64), weights=each)
            total[first : first + len(part)] += part
        n_tokens, n_known, base = [], [], []
        for text in coded:
            logs = [worth[w] for w in words_of(text)]
            n_tokens.append(len(logs) + 1)
            n_known.append(len(logs) - logs.count(unknown) + (ends > 0))
            base.append(math.fsum(logs) + end)
        ids = group.column("ids").combine_chunks().flatten()
        return pa.table([ids, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(total)], list(named))

    back = hand_back(lists, model, cells, lots).withColumn("ids", F.lit(None).cast(f"array<{id_type}>"))
    parts = texts.select("part", "cell", "keys", "counts", "ids").unionByName(back).groupBy("part")
    scored = parts.applyInArrow(finish, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
