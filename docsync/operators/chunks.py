"""Chunking: overlapping token windows, and semantic breakpoints with repaired sentence ends.

Paragraphs come as (source_path, paragraph_num, page_num, text); chunks go out as
(source_path, chunk_index, text, paragraph_num, page_num).

Places that count over a whole file (of tokens, nodes, sentences) are found in two levels: inside splits of SPLIT paragraphs, then from the
sums of the splits, so that no task puts more than a split of a file in order, however long the file is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsync.functions import text as T
from docsync.functions.tables import few_rows, written

TOKEN = f"{T.WS}*+{T.NOT_WS}++|{T.WS}++"
SENTENCE_ENDS = (".", "!", "?")
SPLIT = 10_000

#: Models that this process has loaded, by the digest of the function that loads them and its settings.
_MODELS: dict[str, object] = {}


def overlap_size(chunk_size: int, overlap_ratio: float) -> int:
    """Tokens shared by neighbouring windows: at least one, less than a window."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    if not 0 <= overlap_ratio < 1:
        raise ValueError("overlap_ratio must be at least 0 and below 1")
    return min(max(1, math.ceil(chunk_size * overlap_ratio)), chunk_size - 1)


def _check(chunk_size: int, overlap: int) -> None:
    if chunk_size <= 0 or not 0 <= overlap < chunk_size:
        raise ValueError("chunk_size must be positive and overlap at least 0 and below it")


def regex_tokens(text: Column) -> Column:
    """Tokens that join back to the text: a word with the white space before it, or white space at the end."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


regex_tokens.count = lambda text: F.regexp_count(text, F.lit(TOKEN))


def sums_before(rows: DataFrame, value: Column, by: str, order: list[str], name: str, split: int = SPLIT) -> DataFrame:
    """(source_path, *order, name, <name>_total) for rows that are unique by these: the sum of ``value`` over the rows of the file that come
    before in ``order``, and over all its rows. ``by`` is the first number of the order; rows are summed in splits of ``split`` of these."""
    light = rows.select("source_path", *order, F.floor(F.col(by) / split).alias("__split"), value.cast("long").alias("__value"))
    within = Window.partitionBy("source_path", "__split").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("__inside", F.coalesce(F.sum("__value").over(within), F.lit(0)))
    sums = light.groupBy("source_path", "__split").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy("source_path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("__sum").over(Window.partitionBy("source_path"))
    offsets = sums.select("source_path", "__split", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"), total.alias(f"{name}_total"))
    found = placed.join(offsets, ["source_path", "__split"])
    return found.select("source_path", *order, (F.col("__inside") + F.col("__before")).alias(name), f"{name}_total")


#: Takes the (source_path, error) of files that a chunker could not take.
Failed = Callable[[DataFrame], None]


def token_windows(
    paragraphs: DataFrame, chunk_size: int = 500, overlap: int = 75, tokens: Callable[[Column], Column] = regex_tokens, failed: Failed | None = None, bound: int | None = None, tasks: int | None = None
) -> DataFrame:
    """Windows of ``chunk_size`` tokens, each starting ``chunk_size - overlap`` after the one before, over a file's whole
    token stream: each paragraph's tokens and those of one space. A window is put together from the slices that paragraphs have in it, so no row ever
    holds a file's stream. Only counts of tokens go into the paragraphs' places; a tokenizer with a ``count`` is counted by it. Files of which the tokenizer
    gave no tokens (null) for a text go to ``failed``; their chunks lack that text. ``bound`` is a number that no ``paragraph_num`` exceeds, where the caller knows
    one. ``tasks`` cut the texts; where none are given, Spark chooses them by bytes, which are few for the work where texts are few."""
    _check(chunk_size, overlap)
    step = chunk_size - overlap
    count = getattr(tokens, "count", None) or (lambda text: F.size(tokens(text)))
    split = F.floor(F.col("paragraph_num") / SPLIT).alias("__split")
    rows = paragraphs.select("source_path", split, "paragraph_num", "page_num", "text").filter("text is not null")
    counted = count(F.col("text"))
    n_tokens = counted + count(F.lit(" "))
    if hasattr(tokens, "spaced"):
        counted = n_tokens = F.size(tokens.spaced(F.col("text")))
    if not hasattr(tokens, "count"):
        n_tokens = F.when(counted.isNotNull() & (counted >= 0), n_tokens)
    longest = rows.agg(F.max("paragraph_num")).first()[0] if bound is None else bound
    short = longest is None or longest < SPLIT  # whether no file has a second split
    # where splits needn't be added up, nothing is counted beforehand but to find the files that fail, which a tokenizer with a count has none of
    if not short or not (hasattr(tokens, "count") or failed is None):
        counts = rows.select("source_path", "__split", "paragraph_num", n_tokens.alias("n"))
        sums = counts.groupBy("source_path", "__split").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sum"), F.min(F.when(F.col("n").isNull(), F.col("paragraph_num"))).alias("paragraph_num"))
        sums = written(sums, "counts")
        _report(failed, sums.filter("paragraph_num is not null"), "the tokenizer gave no tokens for paragraph ")
        earlier = Window.partitionBy("source_path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
        total = F.sum("sum").over(Window.partitionBy("source_path"))
        offsets = sums.select("source_path", "__split", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"), total.alias("start_total"))
    every = tokens.spaced(F.col("text")) if hasattr(tokens, "spaced") else F.concat(tokens(F.col("text")), tokens(F.lit(" ")))
    if hasattr(tokens, "count"):  # the texts are shuffled, not their tokens
        keys = ["source_path", "__split"]
        dealt = (rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)).withColumn("n", n_tokens)
    else:  # Python's tokens, made once: rows that come from Python are shuffled before a window anyhow, and a filter on the tokens would make them once more
        dealt = rows.withColumn("tokens", every).withColumn("n", F.greatest(F.coalesce(F.size("tokens"), F.lit(0)), F.lit(0))).drop("text")
    group = Window.partitionBy("source_path", "__split")
    within = group.orderBy("paragraph_num").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("n").over(within), F.lit(0)).cast("long"))
    if short:
        placed = placed.withColumn("start_total", F.sum("n").over(group))
    else:
        placed = placed.join(offsets, ["source_path", "__split"]).withColumn("start", F.col("start") + F.col("before"))
    if hasattr(tokens, "count"):
        placed = placed.withColumn("tokens", every)
    last = F.greatest(F.lit(0), F.ceil((F.col("start_total") - chunk_size) / step)).cast("long")
    first_k = F.greatest(F.lit(0), F.floor((F.col("start") - chunk_size) / step) + 1)
    last_k = F.least(last, F.floor((F.col("start") + F.col("n") - 1) / step))
    spread = placed.filter((F.col("n") > 0) & (first_k <= last_k)).select("source_path", "__split", "paragraph_num", "page_num", "tokens", "start", "n", F.explode(F.sequence(first_k, last_k)).alias("k"))
    begin = F.greatest(F.col("k") * step - F.col("start"), F.lit(0))
    end = F.least(F.col("k") * step + chunk_size - F.col("start"), F.col("n").cast("long"))
    piece = F.array_join(F.slice("tokens", (begin + 1).cast("int"), (end - begin).cast("int")), "")
    parts = spread.filter(begin < end).select("source_path", "__split", "k", F.struct("paragraph_num", "page_num", piece.alias("text")).alias("part"))
    # a window's slices are in one task already where no file has a second split
    keys = ["source_path", "__split", "k"] if short else ["source_path", "k"]
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    made = whole.select(
        "source_path",
        F.col("k").cast("int").alias("chunk_index"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        F.col("parts")[0]["paragraph_num"].alias("paragraph_num"),
        F.col("parts")[0]["page_num"].alias("page_num"),
    )
    decode = getattr(tokens, "decode", None)
    return decode(made) if decode else made


def _report(failed: Failed | None, rows: DataFrame, message: str) -> None:
    """Hand the files of ``rows`` (source_path, paragraph_num) to ``failed``."""
    if failed is not None:
        failed(rows.groupBy("source_path").agg(F.concat(F.lit(message), F.min("paragraph_num").cast("string")).alias("error")))


def cached_model(key: str, load: Callable[[], object]) -> object:
    """What ``load()`` gives, loaded once in each process for each key."""
    if key not in _MODELS:
        _MODELS[key] = load()
    return _MODELS[key]


def _key(load: Callable) -> str:
    from pyspark import cloudpickle

    return hashlib.sha256(cloudpickle.dumps(load)).hexdigest()


def each_alone(texts: list[str], run: Callable[[list[str]], list]) -> list:
    """``run(texts)``; where a batch fails its texts are run one by one, and those that fail give None."""
    try:
        return list(run(texts))
    except Exception:  # noqa: BLE001  whatever a plug-in raises for a text concerns this text's file
        if len(texts) < 2:
            return [None] * len(texts)
        return [x for t in texts for x in each_alone([t], run)]


def coder_tokens(load: Callable[[], object]) -> Callable[[Column], Column]:
    """A tokenizer for the windows from a byte-level coder (``encode_ordinary_batch``, ``decode_single_token_bytes``) that ``load()`` makes in
    each worker process: every token as its bytes in Latin letters, so that tokens join; finished windows are decoded. A text that can't be encoded gives null."""
    from pyspark.sql.functions import pandas_udf

    key = _key(load)

    def cut(batches: Iterator[pd.Series], end: str) -> Iterator[pd.Series]:
        from docsync.operators.chunks import cached_model, each_alone

        coder = cached_model(key, load)
        letters = lambda ids: ids if ids is None else [coder.decode_single_token_bytes(i).decode("latin-1") for i in ids]
        last = letters(each_alone([end], coder.encode_ordinary_batch)[0]) if end else []
        for texts in batches:
            coded = map(letters, each_alone([t or "" for t in texts], coder.encode_ordinary_batch))
            yield pd.Series([None if found is None or last is None else found + last for found in coded], dtype=object)

    @pandas_udf("array<string>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return cut(batches, "")

    @pandas_udf("array<string>")
    def encode_spaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return cut(batches, " ")

    tokens = lambda text: encode(text)
    tokens.spaced = lambda text: encode_spaced(text)  # with the tokens of one space, which no row has to bring to the worker
    tokens.decode = decode_bpe
    return tokens


def bpe_tokens(ranks: dict[bytes, int], pattern: str) -> Callable[[Column], Column]:
    """A tokenizer for the windows from a rank file's vocabulary."""

    def load() -> object:
        import tiktoken

        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return coder_tokens(load)


def encoding_tokens(name: str = "cl100k_base") -> Callable[[Column], Column]:
    """A tokenizer for the windows by the name of a public encoding, whose ranks must be at hand on all machines."""

    def load() -> object:
        import tiktoken

        return tiktoken.get_encoding(name)

    return coder_tokens(load)


def decode_bpe(chunks: DataFrame) -> DataFrame:
    """Chunks made of tokens in Latin letters as text; a character that a window cuts becomes U+FFFD."""
    return chunks.withColumn("text", F.make_valid_utf8(F.encode("text", "ISO-8859-1").cast("string")))


# Sentences and semantic breakpoints


def sentence_list(text: Column) -> Column:
    """The sentences of a text: split after ``.``, ``!`` or ``?`` and white space."""
    return F.filter(F.split(T.collapse(text), r"(?<=[.!?]) +"), lambda s: F.length(s) > 0)


def sentences(paragraphs: DataFrame) -> DataFrame:
    """(source_path, paragraph_num, page_num, sent_idx, sentence)."""
    return paragraphs.select("source_path", "paragraph_num", "page_num", F.posexplode(sentence_list(F.col("text"))).alias("sent_idx", "sentence"))


def bag_of_words(dims: int = 32) -> Callable[[Column], Column]:
    """The default embedding, in column functions: words counted in ``dims`` slots by the first 4 hex digits of their md5. Its ``code``
    writes a letter for each word's slot, and codes of texts joined are the code of the joined texts; ``vector`` counts the letters."""
    one_byte = dims <= 63
    letters = [chr((0x40 if one_byte else 0x100) + d) for d in range(dims)]

    def slot(word: Column) -> Column:
        return F.pmod(F.conv(F.substring(F.md5(word.cast("binary")), 1, 4), 16, 10).cast("int"), F.lit(dims))

    def code(text: Column) -> Column:
        words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: F.length(w) > 0)
        return F.array_join(F.transform(words, lambda w: F.substr(F.lit("".join(letters)), slot(w) + 1, F.lit(1))), "")

    def vector(coded: Column) -> Column:
        size = F.octet_length if one_byte else F.length  # the number of bytes is known without counting
        return F.array(*[(size(coded) - size(F.replace(coded, F.lit(x), F.lit("")))).cast("double") for x in letters])

    def embed(text: Column) -> Column:
        return vector(code(text))

    embed.code, embed.vector = code, vector
    return embed


def model_embedding(load: Callable[[], Callable[[list[str]], np.ndarray]]) -> Callable[[Column], Column]:
    """An embedding by a model that each Python worker process loads once: ``load()`` gives a function from texts to vectors. Functions that
    load with other settings are other models. A text that the model fails on gives null."""
    from pyspark.sql.functions import pandas_udf

    key = _key(load)

    @pandas_udf("array<double>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from docsync.operators.chunks import cached_model, each_alone

        model = cached_model(key, load)
        for texts in batches:
            vectors = each_alone(texts.fillna("").tolist(), model)
            yield pd.Series([v if v is None else np.asarray(v, float).tolist() for v in vectors], dtype=object)

    return embed


class StoredVectors:
    """An embedding whose vectors are kept below ``folder`` by the content of their contexts, so that only contexts not met before are embedded, each once, in batches
    of like lengths. Vectors are appended, whole tables at a time; two jobs that embed the same context at once store it twice, and one of the two counts.
    ``folder`` belongs to one model: another one needs a folder of its own."""

    def __init__(self, embed: Callable[[Column], Column], folder: str):
        self.embed, self.folder = embed, folder.rstrip("/")

    def _there(self, spark: SparkSession) -> bool:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def stored(self, spark: SparkSession) -> DataFrame:
        """(key, vector) of the contexts embedded so far; those that the model failed on are stored without a vector, and count as not met."""
        schema = "key binary, vector array<double>"
        return spark.read.schema(schema).parquet(self.folder).filter("vector is not null") if self._there(spark) else few_rows(spark, schema)

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` (context, ...) with ``vector`` in the place of ``context``; null where the model fails. Contexts, three times the text, are shuffled only where they are
        embedded; what is known of a context is told by its key, half of its SHA-256."""
        spark = rows.sparkSession
        keyed = rows.withColumn("key", F.unhex(F.substring(F.sha2("context", 256), 1, 32)))
        contexts, found = keyed.select("key", "context"), keyed.drop("context")
        if self._there(spark):
            found = written(found, "keyed", "zstd")
            missing = written(found.select("key").distinct().join(self.stored(spark).select("key"), "key", "left_anti"), "missing", "zstd")
            contexts = None if missing.isEmpty() else contexts.join(missing, "key", "left_semi")
        if contexts is not None:
            alike = contexts.dropDuplicates(["key"]).sortWithinPartitions(F.length("context"))
            alike.select("key", self.embed(F.col("context")).alias("vector")).write.mode("append").option("compression", "zstd").parquet(self.folder)
        return found.join(self.stored(spark).dropDuplicates(["key"]), "key", "left").drop("key")


def inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(product: Column, norms: Column) -> Column:
    """1 - cosine from an inner product and the product of the norms; 1 where either is zero; rounded to 9 digits so that equal contexts compare equal."""
    return F.round(1 - F.when(norms > 0, product / norms).otherwise(F.lit(0.0)), 9) + F.lit(0.0)


def semantic_breaks(paragraphs: DataFrame, percentile: float = 70, embed: Callable[[Column], Column] | StoredVectors | None = None, with_failed: bool = False) -> DataFrame:
    """Sentences with the distance of their context (one neighbour each side) to the next one's, and whether a chunk ends
    after them: where the distance exceeds the percentile of the paragraph's distances. A paragraph is the unit; files meet in no task.
    ``with_failed`` adds whether there is no vector for the context."""
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be from 0 to 100")
    return _breaks(paragraphs.repartition("source_path", "paragraph_num"), ["source_path", "paragraph_num"], percentile, embed, with_failed)


def _breaks(paragraphs: DataFrame, keys: list[str], percentile: float, embed: Callable[[Column], Column] | StoredVectors | None, with_failed: bool) -> DataFrame:
    """``semantic_breaks`` of paragraphs known by ``keys`` and dealt by some of them: texts are shuffled, and their sentences stay where they are."""
    embed = embed or bag_of_words()
    group = Window.partitionBy(*keys)
    order = group.orderBy("sent_idx")
    rows = paragraphs.select(*keys, "page_num", F.posexplode(sentence_list(F.col("text"))).alias("sent_idx", "sentence"))
    around = lambda c: F.concat_ws(" ", F.lag(c).over(order), F.col(c), F.lead(c).over(order))
    if hasattr(embed, "code"):
        rows = rows.withColumn("code", embed.code(F.col("sentence"))).withColumn("context", around("code"))
        rows = rows.withColumn("vector", embed.vector(F.col("context")))
    elif isinstance(embed, StoredVectors):
        rows = embed.attach(rows.withColumn("context", around("sentence")))
    else:
        rows = rows.withColumn("context", around("sentence")).withColumn("vector", embed(F.col("context")))
    rows = rows.withColumn("norm", F.sqrt(inner(F.col("vector"), F.col("vector"))))
    rows = rows.withColumns({"next_vector": F.lead("vector").over(order), "next_norm": F.lead("norm").over(order)})
    distance = cosine_distance(inner(F.col("vector"), F.col("next_vector")), F.col("norm") * F.col("next_norm"))
    rows = rows.withColumn("distance", F.when(F.col("next_vector").isNotNull(), distance))
    rows = rows.withColumn("threshold", F.round(F.percentile("distance", F.lit(percentile / 100)).over(group), 9))
    cut = F.coalesce(F.col("distance") > F.col("threshold"), F.lit(False))
    columns = [*keys, "page_num", "sent_idx", "sentence", "distance", cut.alias("cut")]
    return rows.select(*columns) if not with_failed else rows.select(*columns, F.col("vector").isNull().alias("failed"))


def semantic_nodes(breaks: DataFrame, failed: Failed | None = None) -> DataFrame:
    """(source_path, node, text, paragraph_num, page_num): the sentences between cuts, joined by spaces; ``node`` counts over the file. The
    texts are written once, so that embeddings are not computed again for the numbers. Files with a sentence marked ``failed`` go to ``failed``."""
    before = Window.partitionBy("source_path", "paragraph_num").orderBy("sent_idx").rowsBetween(Window.unboundedPreceding, -1)
    part = breaks.withColumn("part", F.coalesce(F.sum(F.col("cut").cast("int")).over(before), F.lit(0)))
    bad = F.max("failed") if "failed" in breaks.columns else F.lit(False)
    joined = part.groupBy("source_path", "paragraph_num", "part").agg(
        F.first("page_num").alias("page_num"), F.array_sort(F.collect_list(F.struct("sent_idx", "sentence"))).alias("s"), bad.alias("failed")
    )
    texts = written(joined.select("source_path", "paragraph_num", "part", "page_num", F.array_join(F.transform("s", lambda x: x["sentence"]), " ").alias("text"), "failed"), "nodes")
    _report(failed, texts.filter("failed"), "the embedding failed in paragraph ")
    counts = texts.groupBy("source_path", "paragraph_num").agg(F.count("*").alias("n"))
    placed = texts.join(sums_before(counts, F.col("n"), "paragraph_num", ["paragraph_num"], "first_node"), ["source_path", "paragraph_num"])
    return placed.select("source_path", (F.col("first_node") + F.col("part")).cast("int").alias("node"), "text", "paragraph_num", "page_num")


def repair_sentences(nodes: DataFrame) -> DataFrame:
    """Nodes (source_path, node, text, paragraph_num, page_num) with every sentence whole: what a node leaves unended goes to
    the front of the next; a rest at the end of the file goes to the last node that keeps a sentence, or to the first
    node when there is none. Nodes left empty vanish. No fold is needed: only a node's last piece can be unended, and it goes to the next node
    that ends a sentence, which a running count of such nodes tells."""
    pieces = F.col("pieces")
    ended = F.coalesce(F.substring(F.element_at(pieces, -1), -1, 1).isin(*SENTENCE_ENDS), F.lit(False))
    listed = nodes.select("source_path", "node", "paragraph_num", "page_num", sentence_list(F.col("text")).alias("pieces")).filter(F.size("pieces") > 0)
    n_whole = F.size("pieces") - F.when(ended, 0).otherwise(1)
    cut = listed.select("source_path", "node", "paragraph_num", "page_num", F.array_join(F.slice(pieces, F.lit(1), n_whole), " ").alias("whole"), F.when(~ended, F.element_at(pieces, -1)).alias("tail"))
    cut = written(cut.withColumn("ends", F.length("whole") > 0), "cut")
    places = sums_before(cut.select("source_path", "node", "ends"), F.col("ends").cast("int"), "node", ["node"], "place")
    placed = cut.join(places, ["source_path", "node"])
    tails = placed.filter("tail is not null").select("source_path", (F.col("place") + F.col("ends").cast("long")).alias("place"), F.struct("node", "tail").alias("t"), "place_total")
    carried = tails.groupBy("source_path", "place").agg(F.array_sort(F.collect_list("t")).alias("t"), F.max("place_total").alias("total"))
    carried = carried.select("source_path", "place", "total", F.array_join(F.transform("t", lambda x: x["tail"]), " ").alias("carried"))
    rest = carried.filter("place = total").select("source_path", F.greatest(F.col("total") - 1, F.lit(0)).alias("place"), "total", F.col("carried").alias("rest"))
    homes = placed.filter("ends").join(carried.drop("total"), ["source_path", "place"], "left").join(rest.filter("total > 0").drop("total"), ["source_path", "place"], "left")
    columns = ["source_path", "node", "text", "paragraph_num", "page_num"]
    homes = homes.withColumn("text", F.concat_ws(" ", "carried", "whole", "rest")).select(columns)
    alone = rest.filter("total = 0").select("source_path", F.col("rest").alias("text"))  # files in which no sentence ends
    first = nodes.groupBy("source_path").agg(F.min(F.struct("node", "paragraph_num", "page_num")).alias("f"))
    return homes.unionByName(alone.join(first, "source_path").select("source_path", "f.*", "text").select(columns))


def _chunks_in_place(paragraphs: DataFrame, percentile: float, repair: bool, embed: Callable[[Column], Column] | None) -> DataFrame:
    """``semantic_chunks`` of files without a second split: texts are shuffled once, by file, and everything that counts over a file is a window there. Nodes with the same
    number of sentence-ending nodes before them form a group, of which only the last ends a sentence; what its other nodes and the last one of the group before leave unended goes to its front."""
    paragraph = ["source_path", "paragraph_num"]
    rows = paragraphs.select(*paragraph, "page_num", "text").repartition("source_path")
    before = Window.partitionBy(*paragraph).orderBy("sent_idx").rowsBetween(Window.unboundedPreceding, -1)
    part = _breaks(rows, paragraph, percentile, embed, False).withColumn("part", F.coalesce(F.sum(F.col("cut").cast("int")).over(before), F.lit(0)))
    joined = part.groupBy(*paragraph, "part").agg(F.first("page_num").alias("page_num"), F.array_sort(F.collect_list(F.struct("sent_idx", "sentence"))).alias("s"))
    text = F.array_join(F.transform("s", lambda x: x["sentence"]), " ").alias("text")
    numbered = F.row_number().over(Window.partitionBy("source_path").orderBy("paragraph_num", "part")).alias("node")
    nodes = joined.select("source_path", numbered, "paragraph_num", "page_num", text)
    if repair:
        pieces = F.col("pieces")
        ended = F.coalesce(F.substring(F.element_at(pieces, -1), -1, 1).isin(*SENTENCE_ENDS), F.lit(False))
        n_whole = F.greatest(F.size(pieces) - F.when(ended, 0).otherwise(1), F.lit(0))
        listed = nodes.select("source_path", "node", "paragraph_num", "page_num", sentence_list(F.col("text")).alias("pieces"))
        cut = listed.select("source_path", "node", "paragraph_num", "page_num", T.non_empty(F.array_join(F.slice(pieces, F.lit(1), n_whole), " ")).alias("whole"), F.when(~ended, F.try_element_at(pieces, F.lit(-1))).alias("tail"))
        ends = F.col("whole").isNotNull()
        earlier = Window.partitionBy("source_path").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        placed = cut.withColumn("place", F.coalesce(F.sum(ends.cast("int")).over(earlier), F.lit(0)))
        groups = placed.groupBy("source_path", "place").agg(
            F.array_sort(F.collect_list(F.when(~ends & F.col("tail").isNotNull(), F.struct("node", "tail")))).alias("left"),
            F.max(F.when(ends, F.struct("node", "paragraph_num", "page_num", "whole", "tail"))).alias("home"),
            F.min(F.struct("node", "paragraph_num", "page_num")).alias("first"),
        )
        left = T.non_empty(F.array_join(F.transform("left", lambda x: x["tail"]), " "))
        order = Window.partitionBy("source_path").orderBy("place")
        groups = groups.withColumn("left", left).withColumns({"tail_before": F.lag("home.tail").over(order), "is_last": F.lead("place").over(order).isNull(), "next": F.lead(F.struct("left", "home")).over(order)})
        own_rest = F.when(F.col("is_last") | F.col("next.home").isNull(), F.col("home.tail"))  # no node after this one ends a sentence
        rest = T.non_empty(F.concat_ws(" ", own_rest, F.when(F.col("next.home").isNull(), F.col("next.left"))))
        home = F.when(F.col("home").isNotNull(), F.struct("home.node", "home.paragraph_num", "home.page_num", F.concat_ws(" ", "tail_before", "left", "home.whole", rest).alias("text")))
        alone = F.when(F.col("place") == 0, F.struct("first.node", "first.paragraph_num", "first.page_num", F.coalesce("left", F.lit("")).alias("text")))  # no sentence of the file ends
        nodes = groups.select("source_path", F.coalesce(home, alone).alias("n")).filter("n is not null").select("source_path", "n.*")
    kept = nodes.withColumn("text", T.strip(F.col("text"))).filter(F.length("text") > 0)
    index = F.row_number().over(Window.partitionBy("source_path").orderBy("node")) - 1
    return kept.select("source_path", index.cast("int").alias("chunk_index"), "text", "paragraph_num", "page_num")


def semantic_chunks(paragraphs: DataFrame, percentile: float = 70, repair: bool = True, embed: Callable[[Column], Column] | StoredVectors | None = None, failed: Failed | None = None) -> DataFrame:
    """Semantic chunks, by default with repaired sentence ends; stripped, empty ones dropped, numbered over the file."""
    if not 0 <= percentile <= 100:
        raise ValueError("percentile must be from 0 to 100")
    embed = embed or bag_of_words()
    if hasattr(embed, "code"):  # such an embedding takes every text
        longest = paragraphs.agg(F.max("paragraph_num")).first()[0]
        if longest is None or longest < SPLIT:
            return _chunks_in_place(paragraphs, percentile, repair, embed)
    nodes = semantic_nodes(semantic_breaks(paragraphs, percentile, embed, failed is not None), failed)
    nodes = repair_sentences(nodes) if repair else nodes
    kept = written(nodes.withColumn("text", T.strip(F.col("text"))).filter(F.length("text") > 0), "chunks")
    places = sums_before(kept, F.lit(1), "node", ["node"], "chunk_index").drop("chunk_index_total")
    return kept.join(places, ["source_path", "node"]).select("source_path", F.col("chunk_index").cast("int").alias("chunk_index"), "text", "paragraph_num", "page_num")


def chunk(paragraphs: DataFrame, chunker: str = "semantic", chunk_size: int = 500, overlap_ratio: float = 0.15, percentile: float = 70, repair: bool = True, bound: int | None = None, tasks: int | None = None, **plugins) -> DataFrame:
    """Chunks by the named chunker; ``failed``, if given, takes the files that its plug-in fails on. ``bound`` and ``tasks`` as in ``token_windows``."""
    name = chunker.strip().lower()
    if name == "simple":
        return token_windows(paragraphs, chunk_size, overlap_size(chunk_size, overlap_ratio), bound=bound, tasks=tasks, **plugins)
    if name == "semantic":
        return semantic_chunks(paragraphs, percentile, repair, **plugins)
    raise ValueError("chunker must be 'semantic' or 'simple'")
