"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out as one linked list of symbols. An index maps every
neighbouring pair that has a rank to all positions where it occurs, over all words; the active
ranks are taken in ascending order from a heap, all positions of a pair are merged in one go, and
the lists of the pairs to their left and right are updated. Every word is thus merged once per
batch, and texts are assembled from the words' ids. Rows are independent, so nothing is shuffled.

The vocabulary is that of a public tokenizer file whose path is a parameter; it is read on the driver (its
size is fixed by the file) and broadcast.

Defined results: a null text counts as empty, an empty text has no ids; the strings of special tokens found in
a text give their own ids, as the tokenizers library does by default; any length is encoded whole.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import bounded_batches, tidy

#: Fixed pattern of byte-level BPE: contractions, letters, numbers, other marks, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words held (about) and text handled at a time by one task: these bound memory, not results.
MAX_WORDS, CHUNK_CHARS = 240_000, 1_500_000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others are numbered upwards from code point 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """ids of single bytes, rank of each pair (left id << 20 | right id), (left, right, merged id) by rank, bytes
    of each id, special tokens."""

    bytes_to_id: list[int]
    ranks: dict[int, int]
    made: list[tuple[int, int, int]]
    pieces: dict[int, bytes]
    special: dict[str, int] = field(default_factory=dict)

    def first_ranks(self) -> np.ndarray:
        """The rank of each pair of bytes, -1 where it has none."""
        ids = self.bytes_to_id
        return np.array([self.ranks.get(ids[a] << 20 | ids[b], -1) for a in range(256) for b in range(256)], np.int64)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        ids, letters = file["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        ranks, made, latest = {}, [], {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made.append((ids[left], ids[right], ids[left + right]))
            ranks[ids[left] << 20 | ids[right]] = rank
            latest[ids[left + right]] = rank
        # Taking ranks in ascending order over all words needs merges to follow those that make their parts.
        if any(latest.get(part, -1) >= rank for rank, m in enumerate(made) for part in m[:2]):
            raise ValueError("a merge comes before one that makes its parts")
        pieces = {i: bytes(back[c] for c in token) for token, i in ids.items() if token not in special}
        pieces |= {i: token.encode() for token, i in special.items()}
        return cls([ids[letters[b]] for b in range(256)], ranks, made, pieces, special)


def merge_words(words: list[bytes], vocab: Vocabulary, first_ranks: np.ndarray | None = None) -> list[list[int]]:
    """The ids of each word, all words merged together through one pair occurrence index."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    following, preceding = np.arange(1, len(raw) + 1), np.arange(-1, len(raw) - 1)
    following[ends[sizes > 0] - 1] = -1
    preceding[(ends - sizes)[sizes > 0]] = -1
    symbol, after, before = np.array(vocab.bytes_to_id, np.int64)[raw].tolist(), following.tolist(), preceding.tolist()
    table = vocab.first_ranks() if first_ranks is None else first_ranks
    rank_at = np.where(following[:-1] >= 0, table[(raw[:-1].astype(np.int64) << 8) | raw[1:]], -1) if len(raw) else np.zeros(0, np.int64)
    at = np.flatnonzero(rank_at >= 0)
    at = at[np.argsort(rank_at[at], kind="stable")]
    cuts = np.flatnonzero(np.diff(rank_at[at], prepend=-1))
    places = {int(rank_at[x[0]]): x.tolist() for x in np.split(at, cuts[1:]) if len(x)}
    ranks, made, active = vocab.ranks.get, vocab.made, list(places)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, merged = made[rank]
        todo = places.pop(rank)
        if left == right:
            todo.sort()  # of overlapping pairs the leftmost comes first
        for i in todo:
            j = after[i]
            if j < 0 or symbol[i] != left or symbol[j] != right:
                continue  # an earlier merge has used one of the two
            symbol[i], symbol[j], k, h = merged, -1, after[j], before[i]
            after[i] = k
            if k >= 0:
                before[k] = i
                new = ranks(merged << 20 | symbol[k])
                if new is not None:
                    if new in places:
                        places[new].append(i)
                    else:
                        places[new] = [i]
                        heapq.heappush(active, new)
            if h >= 0:
                new = ranks(symbol[h] << 20 | merged)
                if new is not None:
                    if new in places:
                        places[new].append(h)
                    else:
                        places[new] = [h]
                        heapq.heappush(active, new)
    final = np.array(symbol, np.int64)
    kept = np.flatnonzero(final >= 0)
    ids, edges = final[kept].tolist(), [0, *np.searchsorted(kept, ends).tolist()]
    return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Codec:
    """Encodes and decodes texts, keeping the ids of words already merged."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.known, self.old, self.pattern, self.first_ranks = vocab, {}, {}, regex.compile(PATTERN), vocab.first_ranks()
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(vocab.special, key=len, reverse=True)) + ")") if vocab.special else None

    def words(self, text: str) -> list[str]:
        if self.split is None or not self.split.search(text):
            return self.pattern.findall(text)
        parts = self.split.split(text)
        return [w for n, part in enumerate(parts) for w in ([part] if n % 2 else self.pattern.findall(part))]

    def encode(self, texts: Iterable[str]) -> list[list[tuple[str, int, bytes]]]:
        """For each text its words as (ids joined by commas, number of ids, bytes that the ids decode to)."""
        collects = gc.isenabled()
        gc.disable()  # the lists made here hold no cycles, and looking for some takes a fifth of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: Iterable[str]) -> list[list[tuple[str, int, bytes]]]:
        found = [self.words(t) for t in texts]
        if len(self.known) > MAX_WORDS // 2:  # words that come back before the next such turn are kept, the others forgotten
            self.old, self.known = self.known, {}
        known, old, new = self.known, self.old, []
        for w in {w for ws in found for w in ws}:
            if w not in known:
                if w in old:
                    known[w] = old[w]
                else:
                    new.append(w)
        plain = [w for w in new if w not in self.vocab.special]
        coded = dict(zip(plain, merge_words([w.encode() for w in plain], self.vocab, self.first_ranks), strict=True))
        for w in new:
            ids = coded[w] if w in coded else [self.vocab.special[w]]
            known[w] = (",".join(map(str, ids)), len(ids), b"".join(self.vocab.pieces[i] for i in ids))
        return [[known[w] for w in ws] for ws in found]


def sliced(values: list[str], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Slices of about ``most`` characters, a longer text alone."""
    start = size = 0
    for i, v in enumerate(values):
        if size and size + len(v) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(v)
    if values:
        yield slice(start, len(values))


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) per row: ids as an array, decoded from those ids."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(Vocabulary.load(tokenizer_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocab.value)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for part in sliced(texts):
                coded = codec.encode(texts[part])
                ids = [[int(i) for w in words if w[1] for i in w[0].split(",")] for words in coded]
                decoded = [b"".join(w[2] for w in words).decode("utf-8", "replace") for words in coded]
                yield pd.DataFrame({"id": frame["id"].iloc[part].array, "n_tokens": [len(x) for x in ids], "ids": ids, "decoded": decoded})

    got = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(tidy(run), f"id {id_type}, n_tokens long, ids array<int>, decoded string")
    return got.withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row, without moving the ids out of the task that made them."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(Vocabulary.load(tokenizer_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(vocab.value)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for part in sliced(texts):
                coded = codec.encode(texts[part])
                joined = [",".join([w[0] for w in words]) for words in coded]
                decoded = [b"".join([w[2] for w in words]).decode("utf-8", "replace") for words in coded]
                yield pd.DataFrame(
                    {
                        "id": frame["id"].iloc[part].array,
                        "n_tokens": [sum([w[1] for w in words]) for words in coded],
                        "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in joined],
                        "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded],
                    }
                )

    got = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(tidy(run), f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return got.withColumnRenamed("id", id_col)


def bpe_decode(coded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) from arrays of ids; null ids count as none, ids beyond the vocabulary add nothing."""
    spark = coded.sparkSession
    vocab = spark.sparkContext.broadcast(Vocabulary.load(tokenizer_path))
    id_type = coded.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = vocab.value.pieces
        for frame in frames:
            texts = [b"".join(pieces.get(i, b"") for i in ids if i is not None).decode("utf-8", "replace") if ids is not None else "" for ids in frame["ids"]]
            yield pd.DataFrame({"id": frame["id"].array, "decoded": texts})

    got = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInPandas(run, f"id {id_type}, decoded string")
    return got.withColumnRenamed("id", id_col)
