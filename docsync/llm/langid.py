"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, drawn from a generator seeded by its code
point. The vector of an n-gram binds its letters by element-wise product, each rotated by its place; a
text's profile bundles (adds) the vectors of all its n-grams, and a language's prototype bundles
the texts that are labelled with it. A text is given the language whose prototype has the largest
cosine with its profile. Bundles are integer sums, so they do not depend on order or partitioning.

Words are runs of letters, lower-cased; anything else separates them as one space.

A batch's n-grams are counted in slices of SLICE letters as (text, n-gram, count), and bound and bundled BLOCK n-grams at a time, so that
memory depends neither on the length of a text nor on how many letters or texts there are.

Learning reads every labelled row: each task adds up one vector per language, the tasks' vectors
are added in two levels. The prototypes (languages x dims, languages bounded by MAX_LANGS) go to all tasks.

Defined results: a null text and a text without letters give ``und`` with score 0, as does every
text when nothing was labelled; the score is the cosine, at least 0; ties go to the smaller language name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.bpe import sliced
from docsync.llm.common import bounded_batches, tidy

DIMS, ORDER, SEED = 1024, 3, 20
#: More labels than this are no language labels; the job stops instead of broadcasting them.
MAX_LANGS = 4096
#: Characters and texts of a batch, letters counted at a time, n-grams bound at a time.
CHUNK_CHARS, TEXTS, SLICE, BLOCK = 800_000, 256, 400_000, 2048
UNKNOWN = "und"
#: The filter rejects a text of at least ENOUGH letters whose best cosine is below CHANCE standard deviations of unrelated vectors.
ENOUGH, CHANCE = 50, 3.0


@cache
def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=32768)
def letter_vector(code: int, dims: int) -> np.ndarray:
    """The fixed random vector of a letter."""
    return np.random.default_rng([SEED, code]).integers(0, 2, dims, dtype=np.int8) * 2 - 1


def batches_of(texts: list[str]) -> Iterator[slice]:
    """Slices of at most TEXTS texts and about CHUNK_CHARS characters, a longer text alone."""
    for part in sliced(texts, CHUNK_CHARS):
        for start in range(part.start, part.stop, TEXTS):
            yield slice(start, min(start + TEXTS, part.stop))


def gram_counts(texts: list[str], most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams of the texts, in slices: the distinct ones (one row of ORDER code points each), and of each text that has
    one its number, the n-gram's row and the count, in order of rows."""
    whole = "".join("\0" + t.lower().replace("\0", " ") + " " for t in texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = codes == 0
    letters = np.where(letter_table()[codes], codes, np.uint32(32))
    gap = letters == 32
    kept = first | ~(gap & np.concatenate(([False], gap[:-1])))
    letters, owner = letters[kept], (np.cumsum(first, dtype=np.int32) - 1)[kept]
    most = most or SLICE
    for a in range(0, len(letters) - ORDER + 1, most):
        n = min(most, len(letters) - ORDER + 1 - a)
        packed = np.zeros(n, np.int64)
        for p in range(ORDER):
            packed = (packed << 21) | letters[a + p : a + p + n]
        same = owner[a : a + n] == owner[a + ORDER - 1 : a + ORDER - 1 + n]
        gram, distinct = pd.factorize(packed[same])
        pairs, times = np.unique(gram * len(texts) + owner[a : a + n][same], return_counts=True)
        yield np.stack([(distinct >> (21 * (ORDER - 1 - p))) & 0x1FFFFF for p in range(ORDER)], axis=1), pairs % len(texts), pairs // len(texts), times


def bind(grams: np.ndarray, dims: int) -> np.ndarray:
    """The vectors of n-grams: the product of their letters' vectors, each rotated by its place."""
    out = np.ones((len(grams), dims), np.int8)
    for p in range(ORDER):
        seen, which = np.unique(grams[:, p], return_inverse=True)
        if len(seen):
            out *= np.roll(np.stack([letter_vector(int(c), dims) for c in seen]), ORDER - 1 - p, axis=1)[which]
    return out


def bundles(texts: list[str], group: np.ndarray, n_groups: int, dims: int, kind: type = np.float32) -> np.ndarray:
    """The sums of the n-gram vectors of each group of texts; ``group`` has the group of each text."""
    out = np.zeros((n_groups, dims), kind)
    for grams, text, row, times in gram_counts(texts):
        edges = np.searchsorted(row, np.arange(0, len(grams) + BLOCK, BLOCK))
        for a, lo, hi in zip(range(0, len(grams), BLOCK), edges[:-1], edges[1:], strict=False):
            counts = np.zeros((n_groups, min(BLOCK, len(grams) - a)), kind)
            np.add.at(counts, (group[text[lo:hi]], row[lo:hi] - a), times[lo:hi])
            out += counts @ bind(grams[a : a + BLOCK], dims).astype(kind)
    return out


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dims: int = DIMS) -> DataFrame:
    """(lang, profile array<bigint>): the bundle of all texts labelled with each language."""

    def bundle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            texts = frame["text"].tolist()
            for part in batches_of(texts):
                which, langs = pd.factorize(frame["lang"].iloc[part])
                vectors = np.rint(bundles(texts[part], which, len(langs), dims, np.float64)).astype(np.int64)
                for lang, v in zip(langs, vectors, strict=True):
                    sums[lang] = sums[lang] + v if lang in sums else v
        yield pd.DataFrame({"lang": list(sums), "profile": [v.tolist() for v in sums.values()]}, dtype=object)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "profile": [np.sum(np.stack(frame["profile"].tolist()), axis=0).tolist()]})

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    partial = bounded_batches(labelled).mapInPandas(tidy(bundle), "lang string, profile array<bigint>").withColumn("part", F.spark_partition_id() % 64)
    level = partial.groupBy("lang", "part").applyInPandas(add, "lang string, profile array<bigint>")
    return level.groupBy("lang").applyInPandas(add, "lang string, profile array<bigint>")


class Predictor:
    """Languages and unit prototypes; predicts batches of texts."""

    def __init__(self, profiles: DataFrame, dims: int = DIMS):
        rows = profiles.orderBy("lang").limit(MAX_LANGS + 1).collect()
        if len(rows) > MAX_LANGS:
            raise ValueError(f"more than {MAX_LANGS} languages")
        self.dims, self.langs = dims, [r["lang"] for r in rows]
        prototypes = np.array([r["profile"] for r in rows], np.float64).reshape(len(rows), dims)
        norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
        self.prototypes = (prototypes / np.where(norms > 0, norms, 1)).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and number of letters of each text."""
        langs, scores, letters = [], [np.zeros(0)], [np.zeros(0, np.int64)]
        for part in batches_of(texts):
            letters.append(np.array([letter_table()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].sum() for t in texts[part]], np.int64))
            lettered = letters[-1] > 0
            if not self.langs:
                langs += [UNKNOWN] * len(lettered)
                scores.append(np.zeros(len(lettered)))
                continue
            found = bundles(texts[part], np.arange(len(lettered)), len(lettered), self.dims)
            norm = np.linalg.norm(found, axis=1)
            cosine = (found @ self.prototypes.T) / np.where(norm > 0, norm, 1)[:, None]
            best = cosine.argmax(axis=1)
            langs += [self.langs[b] if k else UNKNOWN for b, k in zip(best, lettered, strict=True)]
            scores.append(np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float) * lettered)
        return langs, np.concatenate(scores), np.concatenate(letters)

    def rejected(self, texts: list[str]) -> np.ndarray:
        """Which texts are in no language that was learned: those without any letter, and those with ENOUGH letters whose best cosine
        is within CHANCE standard deviations of what unrelated vectors have by chance (a deviation is 1 / sqrt(dims))."""
        _, scores, letters = self.judge(texts)
        return (letters == 0) | (letters >= ENOUGH) & (scores < CHANCE / self.dims**0.5)


def detect(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", dims: int = DIMS) -> DataFrame:
    """(id, lang_pred, score) per row."""
    model = docs.sparkSession.sparkContext.broadcast(Predictor(profiles, dims))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            langs, scores = model.value.predict([t or "" for t in frame["text"]])
            yield pd.DataFrame({"id": frame["id"].array, "lang_pred": langs, "score": scores})

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return bounded_batches(given).mapInPandas(tidy(run), f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, profiles: DataFrame, text_col: str = "text", dims: int = DIMS) -> DataFrame:
    """``docs`` without the rows that are in none of the languages learned (``Predictor.rejected``), all columns kept. Texts with few letters
    score low with every language and stay, being documents still. When nothing was labelled nothing can be told of any row, and all stay."""
    predictor = Predictor(profiles, dims)
    if not predictor.langs:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(predictor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = model.value.rejected([t or "" for t in batch.column(text_col).to_pylist()])
            yield batch.filter(pa.array(~gone, pa.bool_()))

    return bounded_batches(docs).mapInArrow(tidy(run), docs.schema)
