"""Removal of long repeated byte strings with merged, anchored suffix orders.

Sorting every suffix of a corpus is not needed to find its repeats of LENGTH bytes. Each window of LENGTH bytes has an anchor, the
smallest fingerprint of its GRAM-byte pieces; equal windows have equal anchors at equal places. So a window can only
repeat if its anchor's fingerprint does, and only windows with one fingerprint have to be brought together.

1. Every text gives the fingerprints of its anchors (one in about 75 bytes); those that occur twice are kept.
2. A task turns its texts into a shard: for each kept anchor the bytes before and after it that its windows cover, one row
   for each distinct context and task, so that a passage in a third of all texts reaches its owner once per task.
3. The owner of a fingerprint merges the shards' suffix orders: all suffixes that start at the anchor begin in one block, and
   the interleave is refined block by block with the next bytes of those still together, settled ones being left alone;
   where a block splits, the common prefix of the neighbours is known. The same is done with the preceding bytes, read leftwards.
   A window that starts o bytes before the anchor repeats when it shares its block of common prefix LENGTH - o and its
   block of preceding o bytes with another: the repeated intervals come from the two orders, suffixes inside are never sorted.
4. The runs of repeated windows go back to the places of their contexts (hot ones by broadcast) and are merged to the spans that
   are removed.

Equal texts are one text with a count: when it is 2 or more, every byte of a text of LENGTH bytes or more is repeated. Windows are compared
on their bytes; two fingerprints that collide only share a block until the first byte that differs.

Defined results: null and empty texts are empty and lose nothing; a text below LENGTH bytes loses nothing; a null id is given
back as it is; rows that repeat id and text count as two occurrences; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import join_skewed, materialize

LENGTH, GRAM = 200, 48
#: Anchors for each part that an owner task takes at a time, and distinct contexts that a shard holds at a time.
PART, HELD = 30_000, 200_000
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def fingerprints(text: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit fingerprint of each piece of ``gram`` bytes."""
    up, down = _powers(1 << max(16, int(len(text)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], dtype=np.uint64)))
        x = (sums[gram:] - sums[:-gram]) * down[: len(text) - gram + 1]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def anchors(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and place of each anchor, and the first and last window that it is the anchor of. The
    anchor of a window is its leftmost piece with the smallest upper half of the fingerprint."""
    if len(text) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    x = fingerprints(text, gram)
    width, n = length - gram + 1, len(text) - length + 1
    key = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(x), dtype=np.uint64)
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(key)] = key
    padded = padded.reshape(blocks, width)
    onward = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], onward[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    places = least[first].astype(np.int64)
    return x[places], places, first, np.concatenate((first[1:], [n])) - 1


def refine(blocks: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted orders by refining their interleave: ``blocks`` names the block of each row, ``words`` (rows x k, big-endian) holds
    what follows. Returns the order of the rows and the common bytes of each with the one before it (-1 between blocks)."""
    n = len(blocks)
    order = np.argsort(blocks, kind="stable")
    shared = np.full(n, words.shape[1] * 8, np.int64)
    changed = blocks[order][1:] != blocks[order][:-1]
    shared[0:1] = -1
    shared[1:][changed] = -1
    active = np.arange(n)
    for j in range(words.shape[1]):
        start = shared[active] < 8 * j  # places where a block begins
        block = np.cumsum(start)
        size = np.bincount(block, minlength=block[-1] + 1 if len(block) else 1)
        open_ = size[block] > 1
        active, block = active[open_], block[open_]
        if not len(active):
            break
        value = words[order[active], j]
        inner = np.lexsort((value, block))
        order[active] = order[active][inner]
        value = value[inner]
        same = np.concatenate(([False], block[1:] == block[:-1]))
        with np.errstate(divide="ignore"):
            differ = np.concatenate(([np.uint64(0)], value[1:] ^ value[:-1]))
            common = np.where(differ == 0, 8, 7 - np.floor(np.log2(np.maximum(differ, 1).astype(np.float64))).astype(np.int64) // 8)
        split = same & (common < 8)
        shared[active[split]] = 8 * j + common[split]
    return order, shared


def _words(rows: list[bytes], size: int) -> np.ndarray:
    """Rows of bytes, cut or filled to ``size`` bytes, as big-endian 64-bit words."""
    size = -(-size // 8) * 8
    return np.frombuffer(b"".join(r[:size].ljust(size, b"\0") for r in rows), ">u8").reshape(len(rows), size // 8).astype(np.uint64)


def repeated_windows(fp: np.ndarray, left: np.ndarray, windows: np.ndarray, context: list[bytes], times: np.ndarray, length: int) -> np.ndarray:
    """For each context (bytes from its first window's start, the anchor ``left`` bytes in) and each of its windows
    whether it occurs again: a matrix, window w starting w bytes in. ``times`` counts the context's own occurrences."""
    widest = int(windows.max(initial=1))
    out = np.zeros((len(fp), widest), bool)
    out[times > 1] = True
    right_order, right_common = refine(fp, _words([c[a:] for c, a in zip(context, left, strict=True)], length))
    left_order, left_common = refine(fp, _words([c[:a][::-1] for c, a in zip(context, left, strict=True)], int(left.max(initial=1)) + 1))
    last = left - windows + 1
    right_block, left_block = np.empty(len(fp), np.int64), np.empty(len(fp), np.int64)
    for o in range(int(last.min(initial=0)), int(left.max(initial=0)) + 1):
        here = np.flatnonzero((o <= left) & (o >= last))
        if len(here) < 2:
            continue
        right_block[right_order] = np.cumsum(right_common < length - o)
        left_block[left_order] = np.cumsum(left_common < o)
        key = right_block[here] * (len(fp) + 1) + left_block[here]
        by = np.argsort(key)
        equal = key[by][1:] == key[by][:-1]
        again = here[by[np.concatenate((equal, [False])) | np.concatenate(([False], equal))]]
        out[again, left[again] - o] = True
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last place of each run of true values."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), body.alias("body"), F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts that share something (t1, t2, body), and their repeated intervals (t1, t2, first, last): ``last`` is the byte after."""
    texts = _texts(docs, id_col, text_col)

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 1000):
                part = frame.iloc[start : start + 1000]
                found = [anchors(np.frombuffer(b.encode("utf-8", "surrogatepass"), np.uint8), length, gram)[0] for b in part["body"]]
                sizes = [len(f) for f in found]
                yield pd.DataFrame({"fp": np.concatenate(found).view(np.int64), "t1": np.repeat(part["t1"].to_numpy(), sizes), "t2": np.repeat(part["t2"].to_numpy(), sizes)})

    long = texts.filter(F.octet_length("body") >= length)
    every = materialize(long.select("body", "t1", "t2").mapInPandas(find, "fp long, t1 long, t2 long"), "anchors")
    twice = materialize(every.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    total = every.count()
    kept = join_skewed(every, twice, ["fp"], "n", total, F.col("t1")).filter("n is not null")
    by_text = kept.groupBy("t1", "t2").agg(F.collect_set("fp").alias("fps"))
    # Of equal texts the row with the smallest id stands for all.
    named = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name")
    first = long.groupBy("t1", "t2").agg(F.min(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("name"))
    wanted = by_text.join(first, ["t1", "t2"])
    shared = long.select("body", "t1", "t2", named).join(wanted.hint("shuffle_hash"), ["t1", "t2", "name"]).select("t1", "t2", "body", "fps")
    shared = materialize(shared, "shared")

    def places(part: pd.DataFrame) -> Iterator[tuple[int, int, int, int, int, int, bytes, bytes]]:
        for t1, t2, body, fps in part[["t1", "t2", "body", "fps"]].itertuples(index=False):
            raw = body.encode("utf-8", "surrogatepass")
            fp, place, lo, hi = anchors(np.frombuffer(raw, np.uint8), length, gram)
            fp = fp.view(np.int64)
            for k in np.flatnonzero(np.isin(fp, fps)):
                left, context = int(place[k] - lo[k]), raw[lo[k] : hi[k] + length]
                digest = hashlib.blake2b(context, digest_size=16, salt=left.to_bytes(4, "little")).digest()
                yield int(fp[k]), t1, t2, int(lo[k]), left, int(hi[k] - lo[k] + 1), digest, context

    def shard(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The distinct contexts of a task, each with its number of occurrences."""
        held: dict[bytes, list] = {}
        columns = ["fp", "left", "windows", "digest", "context", "n"]
        for frame in frames:
            for start in range(0, len(frame), 500):
                for fp, _, _, _, left, windows, digest, context in places(frame.iloc[start : start + 500]):
                    if digest in held:
                        held[digest][-1] += 1
                    else:
                        held[digest] = [fp, left, windows, digest, context, 1]
                if len(held) > HELD:
                    yield pd.DataFrame(list(held.values()), columns=columns)
                    held.clear()
        yield pd.DataFrame(list(held.values()), columns=columns)

    def occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 500):
                rows = [(digest, t1, t2, lo) for _, t1, t2, lo, _, _, digest, _ in places(frame.iloc[start : start + 500])]
                yield pd.DataFrame(rows, columns=["digest", "t1", "t2", "lo"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        code, _ = pd.factorize(frame["digest"])
        one = frame.iloc[np.unique(code, return_index=True)[1]]
        times = np.bincount(code, weights=frame["n"]).astype(np.int64)
        windows = one["windows"].to_numpy(np.int64)
        flags = repeated_windows(one["fp"].to_numpy(), one["left"].to_numpy(np.int64), windows, one["context"].tolist(), times, length)
        flags &= np.arange(flags.shape[1]) < windows[:, None]
        row, start, end = _runs(flags)
        return pd.DataFrame({"digest": one["digest"].to_numpy()[row], "n": times[row], "first": start, "last": end + length})

    parts = max(1, total // PART)
    contexts = shared.mapInPandas(shard, "fp long, left int, windows int, digest binary, context binary, n long")
    contexts = contexts.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(parts)))
    runs = contexts.groupBy("part").applyInPandas(merge, "digest binary, n long, first int, last int")
    runs = runs.groupBy("digest").agg(F.max("n").alias("n"), F.collect_list(F.struct("first", "last")).alias("runs"))
    found = shared.mapInPandas(occurrences, "digest binary, t1 long, t2 long, lo long")
    found = join_skewed(found, materialize(runs, "runs"), ["digest"], "n", total, F.xxhash64("t1", "lo")).filter("n is not null")
    spans = found.select("t1", "t2", "lo", F.explode("runs").alias("r")).select("t1", "t2", (F.col("lo") + F.col("r.first")).alias("first"), (F.col("lo") + F.col("r.last")).alias("last"))
    return shared.select("t1", "t2", "body"), spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept`` is what is left, null where nothing was removed or
    all of it; it is left out without ``keep_text``."""
    shared, spans = repeated_spans(docs, length, gram, id_col, text_col)
    lists = spans.groupBy("t1", "t2").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))

    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for t1, t2, body, found in frame[["t1", "t2", "body", "spans"]].itertuples(index=False):
                raw, kept, at, runs, gone = body.encode("utf-8", "surrogatepass"), [], 0, 0, 0
                end = -1
                for s in found:
                    first, last = s["first"], s["last"]
                    if first > end:
                        runs += 1
                        kept.append(raw[at:first])
                    gone += max(0, last - max(first, end))
                    at = end = max(end, last)
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((t1, t2, gone, runs, hashlib.sha256(rest).hexdigest(), rest))
            yield pd.DataFrame(out, columns=["t1", "t2", "gone", "runs", "sha", "kept"])

    cut = shared.join(lists, ["t1", "t2"]).mapInPandas(strip, "t1 long, t2 long, gone long, runs long, sha string, kept binary")
    cut = materialize(cut if keep_text else cut.drop("kept"), "cut").withColumnsRenamed({"t1": "c1", "t2": "c2", "sha": "cut_sha"})
    light = _texts(docs, id_col, text_col).select("id", "t1", "t2", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2(F.col("body"), 256).alias("sha"))
    light = materialize(light, "light")
    copies = light.groupBy("t1", "t2").agg(F.count("*").alias("n"))
    alone = (F.col("t1") == F.col("c1")) & (F.col("t2") == F.col("c2")) & (F.col("n") == 1)
    found = copies.join(cut, alone, "left").drop("c1", "c2")
    rows = join_skewed(light, materialize(found, "found"), ["t1", "t2"], "n", light.count(), F.col("id"))
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    return rows.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        *([F.when(~whole, F.col("kept")).alias("kept")] if keep_text else []),
    )
