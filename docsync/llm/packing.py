"""Packing documents into token sequences of a fixed size, online and in bounded space.

1. Every partition keeps ``open_windows`` open windows. A document's tokens fill whole sequences as long as they can; the rest goes into the
   open window that it fits best. Where none fits and all windows are in use, the fullest one is topped up with the rest's first tokens and goes out, so windows that
   go out are full. Only these few windows and one batch of texts are in memory, however many documents a partition has.
2. The windows that are still open at a partition's end are written with their tokens, at most ``open_windows`` of each partition. They are merged by the same
   packing, those of MERGED partitions in one task, in rounds until one task is left.
3. The last windows are cut at powers of two: sequences of such a length need no padding.

Tokens are those of a public tokenizer file (see word_ids), whose path is a parameter and which is read on the driver and broadcast, and ``end_id`` after each document.

Every stage is written, so that a repeated task or a lost executor changes nothing. Which documents share a sequence follows from
the order of rows in the input's partitions.

Defined results: a null or empty text has ``end_id`` only; rows that repeat an id are packed each; a null id stays null; any length is packed whole; further columns are
not read; an empty table gives no sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.bpe import sliced
from docsync.llm.common import bounded_batches, materialize, tidy
from docsync.llm.word_ids import known_ids

SIZE, OPEN_WINDOWS, MERGED = 4096, 16, 64
#: Rows of an output batch.
ROWS = 20_000


class Packer:
    """Open windows of one task. A window is a list of (id, start, ids, doc_tokens); full ones are handed out by ``add``."""

    def __init__(self, size: int, open_windows: int):
        self.size, self.most, self.windows, self.used = size, open_windows, [], []

    def add(self, doc, start: int, ids: bytes, doc_tokens: int) -> Iterator[list[tuple]]:
        n, at = len(ids) // 4, 0
        cut = lambda a, b: (doc, start + a, ids[4 * a : 4 * b], doc_tokens)
        while n - at >= self.size:
            yield [cut(at, at + self.size)]
            at += self.size
        while at < n:
            rest = n - at
            fitting = [k for k, used in enumerate(self.used) if used + rest <= self.size]
            if fitting:
                k, part = max(fitting, key=self.used.__getitem__), rest
            elif len(self.windows) < self.most:
                self.windows.append([]), self.used.append(0)
                k, part = len(self.windows) - 1, rest
            else:
                k = max(range(len(self.used)), key=self.used.__getitem__)
                part = self.size - self.used[k]
            self.windows[k].append(cut(at, at + part))
            self.used[k] += part
            at += part
            if self.used[k] == self.size:
                self.used.pop(k)
                yield self.windows.pop(k)

    def last(self) -> Iterator[list[tuple]]:
        """What is left, in sequences of powers of two."""
        pieces = [p for w in self.windows for p in w]
        left, room, window = sum(self.used), 0, []
        for doc, start, ids, doc_tokens in pieces:
            at, n = 0, len(ids) // 4
            while at < n:
                if not room:
                    room = min(self.size, 1 << (left.bit_length() - 1))
                part = min(room, n - at)
                window.append((doc, start + at, ids[4 * at : 4 * (at + part)], doc_tokens))
                at, room, left = at + part, room - part, left - part
                if not room:
                    yield window
                    window = []


def _rows(windows: Iterator[tuple[list[tuple], bool]], level: int, keep_ids: bool) -> Iterator[pd.DataFrame]:
    """Batches of pieces: sequences are numbered by round, task and order; ids stay with pieces of open windows and, if wanted, with all."""
    part = TaskContext.get().partitionId()
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "open", "ids"]
    rows = []
    for number, (window, is_open) in enumerate(windows):
        offset, sequence = 0, level << 56 | part << 31 | number
        for doc, start, ids, doc_tokens in window:
            rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence, offset, part, is_open, ids if keep_ids or is_open else None))
            offset += len(ids) // 4
        if len(rows) >= ROWS:
            yield pd.DataFrame(rows, columns=columns)
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    size: int = SIZE,
    open_windows: int = OPEN_WINDOWS,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) per piece: ``length`` tokens of a document from ``start`` on, at ``offset`` in a
    sequence. ``ids`` are little-endian unsigned 32-bit numbers, left out without ``keep_ids``. ``size`` is a power of two: all sequences
    have its length or a smaller power of two."""
    if size < 1 or size & (size - 1) or open_windows < 1:
        raise ValueError("size must be a power of two and open_windows at least 1")
    with open(tokenizer_path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # of the size of a vocabulary
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int, open boolean, ids binary"

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        known = known_ids(file.value)
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            texts = [(t or "").encode() for t in frame["text"]]
            for part in sliced(texts):
                for doc, ids in zip(frame["id"].iloc[part], known.of(texts[part]), strict=True):
                    ids += end
                    yield doc, 0, ids, len(ids) // 4

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            yield from zip(frame["id"], frame["start"], frame["ids"], frame["doc_tokens"], strict=True)

    def packed(items, level: int, final: bool = False):
        def windows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list[tuple], bool]]:
            packer = Packer(size, open_windows)
            for item in items(frames):
                for window in packer.add(*item):
                    yield window, False
            for window in packer.last() if final else packer.windows:
                yield window, not final

        return tidy(lambda frames: _rows(windows(frames), level, keep_ids))

    given = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    done = materialize(given.mapInPandas(packed(encoded, 0), schema), "packed", "zstd")
    full, level = [done.filter("not open")], 0
    while True:
        left = done.filter("open").select("id", "start", "ids", "doc_tokens", "sequence_id", "offset", "part")
        parts = left.agg(F.max("part")).first()[0]
        tasks = 1 if parts is None else math.ceil((parts + 1) / MERGED)
        dealt = left.repartitionById(tasks, F.floor(F.col("part") / MERGED).cast("int")).sortWithinPartitions("sequence_id", "offset")
        level += 1
        done = materialize(dealt.mapInPandas(packed(pieces, level, tasks == 1), schema), "merged", "zstd")
        full.append(done.filter("not open"))
        if tasks == 1:
            break
    out = full[0]
    for more in full[1:]:
        out = out.unionByName(more)
    kept = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if keep_ids else [])
    return out.select(F.col("id").alias(id_col), *kept)
