"""Keeping a collection of chunks in step with a listing of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 200
COLLECTION = (
    "chunk_id string, source_path string, file_signature string, chunk_index int, text string, paragraph_num int, page_num int, source_name string, attrs map<string,string>"
)


def signature(size: Column, mtime_ns: Column) -> Column:
    return F.concat_ws(":", size.cast("string"), mtime_ns.cast("string"))


def usable(c: str) -> Column:
    """Whether a string column holds something."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def normalised(collection: DataFrame) -> DataFrame:
    """Rows with a usable id; a missing metadata map is an empty one."""
    rows = collection.filter(usable("chunk_id"))
    if "attrs" in rows.columns:
        rows = rows.withColumn("attrs", F.coalesce("attrs", F.create_map().cast("map<string,string>")))
    return rows


def stored_files(collection: DataFrame) -> DataFrame:
    """(source_path, old_chunks, lowest, highest): chunks per file and the least and greatest signature, a missing one taken as a
    value of its own; three columns of the collection are read and partial aggregates are shuffled."""
    rows = collection.select("chunk_id", "source_path", "file_signature").filter(usable("chunk_id") & usable("source_path"))
    sig = F.coalesce("file_signature", F.lit("\0"))
    return rows.groupBy("source_path").agg(F.count("*").alias("old_chunks"), F.min(sig).alias("lowest"), F.max(sig).alias("highest"))


def distinct_files(files: DataFrame) -> DataFrame:
    """One row per path of a listing (source_path, file_signature); of several the greatest signature counts."""
    return files.groupBy("source_path").agg(F.max("file_signature").alias("file_signature"))


def plan(files: DataFrame, collection: DataFrame) -> DataFrame:
    """(source_path, action, old_chunks, file_signature) for every path on either side: removed, new, changed or unchanged."""
    return plan_stored(files, stored_files(collection))


def compared(local: DataFrame, stored: DataFrame) -> DataFrame:
    """``local`` (source_path, file_signature, ...; one row per path) beside what ``stored_files`` gives, with ``action`` and ``old_chunks``, for every path on either side."""
    both = local.join(stored, "source_path", "full_outer")
    same = F.col("lowest").eqNullSafe(F.col("highest")) & F.col("lowest").eqNullSafe(F.col("file_signature"))
    action = (
        F.when(F.col("file_signature").isNull(), "removed").when(F.col("old_chunks").isNull(), "new").when(same, "unchanged").otherwise("changed")
    )
    rest = [c for c in local.columns if c != "source_path"]
    return both.select("source_path", action.alias("action"), F.coalesce("old_chunks", F.lit(0)).cast("long").alias("old_chunks"), *rest)


def plan_stored(files: DataFrame, stored: DataFrame) -> DataFrame:
    """The plan from what ``stored_files`` gives, as a collection keeps it beside its chunks."""
    return compared(distinct_files(files), stored)


def in_order(sync_plan: DataFrame) -> DataFrame:
    """The plan as it is shown: removed paths first, then the others, by path."""
    return sync_plan.orderBy(F.col("action") != "removed", "source_path")


def removed(files: DataFrame, collection: DataFrame) -> DataFrame:
    """(source_path, old_chunks) of stored paths that are no longer listed."""
    return stored_files(collection).join(files, "source_path", "left_anti").select("source_path", "old_chunks")


def added(files: DataFrame, collection: DataFrame) -> DataFrame:
    """(source_path, file_signature) of listed paths without chunks."""
    return distinct_files(files).join(stored_files(collection), "source_path", "left_anti")


def changed(files: DataFrame, collection: DataFrame) -> DataFrame:
    """(source_path, old_chunks, file_signature) of paths on both sides whose stored signatures are not just the current one."""
    both = distinct_files(files).join(stored_files(collection), "source_path")
    same = (F.col("lowest") == F.col("highest")) & (F.col("lowest") == F.col("file_signature"))
    return both.filter(~same).select("source_path", "old_chunks", "file_signature")


def kept(collection: DataFrame, sync_plan: DataFrame) -> DataFrame:
    """The collection without the chunks of removed and changed files. Rows without a usable path or id are out of the sync's
    reach and stay."""
    gone = sync_plan.filter(F.col("action").isin("removed", "changed")).select(F.col("source_path").alias("gone"))
    reach = usable("chunk_id") & usable("source_path")
    return collection.join(gone, reach & (F.col("source_path") == F.col("gone")), "left_anti")


def with_metadata(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Chunks as collection rows: the file's name, signature and attributes, and an id made from path, signature and index."""
    columns = ["source_path", "source_name", "file_signature"] + (["attrs"] if "attrs" in files.columns else [])
    rows = chunks.join(files.select(*columns), "source_path")
    if "attrs" not in files.columns:
        rows = rows.withColumn("attrs", F.create_map().cast("map<string,string>"))
    chunk_id = F.sha2(F.concat_ws("\x01", "source_path", "file_signature", F.col("chunk_index").cast("string")), 256)
    return rows.select(
        chunk_id.alias("chunk_id"), "source_path", "file_signature", F.col("chunk_index").cast("int").alias("chunk_index"), "text",
        F.col("paragraph_num").cast("int").alias("paragraph_num"), F.col("page_num").cast("int").alias("page_num"), "source_name", "attrs",
    )


def apply(collection: DataFrame, sync_plan: DataFrame, fresh: DataFrame) -> DataFrame:
    """The next state: what is kept, and the fresh chunks of new and changed files."""
    todo = sync_plan.filter(F.col("action").isin("new", "changed")).select("source_path")
    return kept(collection, sync_plan).unionByName(fresh.join(todo, "source_path", "left_semi"))


def plan_counts() -> list[Column]:
    """What a plan will do, as aggregates: removed paths, new or changed files, chunks to delete."""
    return [
        F.count_if(F.col("action") == "removed").alias("removed_paths"),
        F.count_if(F.col("action").isin("new", "changed")).alias("added_or_updated_files"),
        F.coalesce(F.sum(F.when(F.col("action").isin("removed", "changed"), F.col("old_chunks"))), F.lit(0)).alias("deleted_chunks"),
    ]


def summary(files: DataFrame, collection: DataFrame, sync_plan: DataFrame) -> DataFrame:
    """One row: files listed, usable chunks before the pass, removed paths, new or changed files, chunks to delete."""
    counts = sync_plan.agg(*plan_counts())
    local = files.agg(F.count("*").alias("local_files"))
    remote = collection.filter(usable("chunk_id")).agg(F.count("*").alias("remote_docs"))
    return local.join(remote).join(counts).select("local_files", "remote_docs", "removed_paths", "added_or_updated_files", "deleted_chunks")


def batch_numbers(chunks: DataFrame, size: int = BATCH) -> DataFrame:
    """Chunks with ``batch``, the number of their write batch inside the file; ``chunk_index`` counts a file's chunks from 0."""
    return chunks.withColumn("batch", (F.floor(F.col("chunk_index") / size) + 1).cast("long"))


def ingest_batches(chunks: DataFrame, size: int = BATCH) -> DataFrame:
    """(source_path, n_chunks, n_batches) per file."""
    return chunks.groupBy("source_path").agg(F.count("*").alias("n_chunks")).withColumn("n_batches", F.ceil(F.col("n_chunks") / size).cast("long"))
