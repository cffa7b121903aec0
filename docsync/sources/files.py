"""Listing folder trees and reading their files, both inside tasks.

A folder is walked level by level: the directories found at one level are listed by the tasks of the next one, so neither paths nor listings pass
the driver. Reading is planned as ranges of bytes, packed by size into tasks; each task opens its own files, and whatever goes wrong with
a file is a row of its own and not an error of the job.

Paths without a scheme and ``file:`` ones are opened by the system, others by ``pyarrow.fs``; an ``opener`` stands in for both.
"""

from __future__ import annotations

import io
import math
import os
import shutil
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsync.functions import text as T
from docsync.functions.tables import Counts, few_rows
from docsync.operators.sync import signature
from docsync.sources import docx

# The suffixes that are kept in step.
SUFFIXES = (".docx", ".doc", ".pdf", ".md", ".html", ".htm", ".msg", ".log")
TEXT_SUFFIXES = (".md", ".html", ".htm", ".log")
SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ENTRIES = "kind string, path string, source_path string, size long, mtime_ns long, error string"
CONTENTS = "source_path string, suffix string, first_byte long, line_no long, content binary, break_before boolean, breaks_inside long, outcome string, error string"
#: Files that are read as rows of text, which may be of any size.
BY_ROW = (".log", ".docx")
#: Most tasks that list one level, and directories of a task; bytes that a task reads; bytes of a log read at a time by one task; bytes that count for opening a file.
LIST_TASKS, LISTED, TASK_BYTES, RANGE_BYTES, OPEN_BYTES = 2_000, 500, 128 << 20, 32 << 20, 64 << 10
#: Bytes of the largest file that is held as a whole, and of a log's longest line; rows and bytes of an output batch.
LARGEST, ROWS, BATCH_BYTES = 256 << 20, 10_000, 4 << 20


def name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix_of(path: Column) -> Column:
    """The lower-case suffix; a name that only starts with a dot has none."""
    return F.lower(F.regexp_extract(name_of(path), r"^.+(\.[^./]+)$", 1))


def key_of(path: Column) -> Column:
    """The path by which a file is known: without the scheme for local files."""
    return F.regexp_replace(path, "^file:/+", "/")


def signed(files: DataFrame) -> DataFrame:
    """``files`` (source_path, size, mtime_ns, ...) with a supported suffix, with name, suffix and signature."""
    rows = files.withColumns({"source_name": name_of(F.col("source_path")), "suffix": suffix_of(F.col("source_path"))})
    return rows.withColumn("file_signature", signature(F.col("size"), F.col("mtime_ns"))).filter(F.col("suffix").isin(*SUFFIXES))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Rows of a schema; whole numbers stay whole beside nulls."""
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pd.DataFrame({name: pd.array(list(x), {"long": "Int64", "boolean": "boolean"}.get(kind, object)) for (name, kind), x in zip(fields, columns, strict=True)})


# Listing


def _local(path: str) -> str | None:
    """The path as the system knows it, or none where it is in another store."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def list_directory(path: str) -> Iterator[tuple]:
    """(kind, path, source_path, size, mtime_ns, error) of what a directory holds, hidden and empty files too. Links to files are followed and known by their target,
    links to directories are not; entries that vanish meanwhile are left out."""
    local = _local(path)
    if local is None:
        from pyarrow import fs

        store, inside = fs.FileSystem.from_uri(path)
        prefix = path[: len(path.rstrip("/")) - len(inside.rstrip("/"))] if path.rstrip("/").endswith(inside.rstrip("/")) else path.split("://")[0] + "://"
        for info in store.get_file_info(fs.FileSelector(inside, allow_not_found=False)):
            place = prefix + info.path
            if info.type == fs.FileType.Directory:
                yield "directory", place, None, None, None, None
            elif info.type == fs.FileType.File:
                yield "file", place, place, info.size, info.mtime_ns, None
        return
    with os.scandir(local) as entries:
        for entry in entries:
            try:
                entry.path.encode()
            except UnicodeEncodeError:
                yield "error", ascii(entry.path), None, None, None, "the name is no UTF-8"
                continue
            try:
                if entry.is_dir(follow_symlinks=False):
                    yield "directory", entry.path, None, None, None, None
                elif entry.is_file():
                    stat = entry.stat()
                    yield "file", entry.path, os.path.realpath(entry.path) if entry.is_symlink() else entry.path, stat.st_size, stat.st_mtime_ns, None
            except FileNotFoundError:
                continue


def _list_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    for frame in frames:
        for path in frame["directory"]:
            try:
                for row in list_directory(path):
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield _frame(rows, ENTRIES)
                        rows = []
            except FileNotFoundError:
                rows.append(("gone", path, None, None, None, None))
            except OSError as e:
                rows.append(("error", path, None, None, None, f"{type(e).__name__}: {e}"))
    yield _frame(rows, ENTRIES)


def list_tasks(n: int, cores: int) -> int:
    """Tasks that list ``n`` directories: all cores, and so many that none has more than some hundreds of them, since starting a task takes longer than listing a directory."""
    return max(1, min(n, LIST_TASKS, max(2 * cores, math.ceil(n / LISTED))))


def walk(spark: SparkSession, folder: str, place: str) -> tuple[DataFrame, DataFrame]:
    """The files below ``folder`` as (path, source_path, source_name, suffix, size, mtime_ns, file_signature), and (path, error) of
    directories that can't be listed. Levels are written below ``place``. A folder that isn't there is an error, since all its files would seem removed."""
    root = os.path.realpath(local) if (local := _local(folder)) else folder.rstrip("/")
    frontier, n, level = few_rows(spark, "directory string", (root,)), 1, 0
    while n:
        counts = Counts()
        found = frontier.repartition(list_tasks(n, spark.sparkContext.defaultParallelism), "directory").mapInPandas(_list_all, ENTRIES)
        counts.on(found, F.count_if(F.col("kind") == "directory").alias("n")).write.parquet(f"{place}/level={level}")
        entries = spark.read.schema(ENTRIES).parquet(f"{place}/level={level}")
        if level == 0 and (bad := entries.filter(F.col("kind").isin("gone", "error") & (F.col("path") == root)).first()):
            raise FileNotFoundError(f"{folder} can't be listed: {bad.error or 'it is not there'}")
        frontier, n, level = entries.filter("kind = 'directory'").select(F.col("path").alias("directory")), counts.get()["n"], level + 1
    entries = spark.read.schema(ENTRIES).parquet(*[f"{place}/level={k}" for k in range(level)])
    files = signed(entries.filter("kind = 'file'").select("path", "source_path", "size", "mtime_ns"))
    columns = ["path", "source_path", "source_name", "suffix", "size", "mtime_ns", "file_signature"]
    return files.select(*columns), entries.filter("kind = 'error'").select("path", "error")


def described_now(found: DataFrame) -> DataFrame:
    """A listing as ``walk`` gives it, of files named by ``path``: each is looked up in a task; those that are gone are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["path"]:
                local = _local(path)
                try:
                    if local is not None:
                        stat = os.stat(local)
                        rows.append(("file", local, os.path.realpath(local), stat.st_size, stat.st_mtime_ns, None))
                    else:
                        from pyarrow import fs

                        store, inside = fs.FileSystem.from_uri(path)
                        info = store.get_file_info(inside)
                        if info.type == fs.FileType.File:
                            rows.append(("file", path, path, info.size, info.mtime_ns, None))
                except FileNotFoundError:
                    continue
            yield _frame(rows, ENTRIES)

    files = signed(found.select("path").mapInPandas(run, ENTRIES).select("path", "source_path", "size", "mtime_ns"))
    return files.select("path", "source_path", "source_name", "suffix", "size", "mtime_ns", "file_signature")


def under(paths: DataFrame, directories: DataFrame) -> DataFrame:
    """The rows of ``paths`` (source_path, ...) that lie below one of ``directories`` (path)."""
    parts = F.split("source_path", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    each = paths.select("source_path", F.explode(above).alias("path")).join(directories.select("path").distinct(), "path", "left_semi")
    return paths.join(each.select("source_path").distinct(), "source_path", "left_semi")


# Reading


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, source_path, suffix, size, first_byte, n_bytes): logs in ranges, other files whole."""
    split = F.col("suffix") == ".log"
    firsts = F.when(split, F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    each = files.select("path", "source_path", "suffix", "size", F.explode(firsts).alias("first_byte"))
    return each.withColumn("n_bytes", F.when(split, F.least(F.lit(range_bytes).cast("long"), F.col("size") - F.col("first_byte"))).otherwise(F.col("size")))


def packed(planned: DataFrame, total: int, n: int, parts: int, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """``planned`` ranges (a written table with ``part`` and ``at``, their place in it) with ``bin``, the task that reads each, and the number of tasks. Their sizes are
    summed inside parts and then over the parts, so tasks get equal shares of ``total`` bytes, openings included."""
    cost = F.least(F.col("n_bytes"), F.lit(LARGEST)) + OPEN_BYTES
    total += n * OPEN_BYTES
    bins = max(1, min(n, max(math.ceil(total / task_bytes), parts)))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = planned.groupBy("part").agg(F.sum(cost).alias("sum"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row of each task that planned
    offsets = sums.select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    placed = planned.withColumn("inside", F.coalesce(F.sum(cost).over(within), F.lit(0))).join(offsets, "part")
    # a range is placed by its middle
    share = (F.col("before") + F.col("inside") + cost / 2) * bins / F.lit(max(1, total))
    return placed.withColumn("bin", F.least(F.floor(share), F.lit(bins - 1)).cast("int")).drop("inside", "before", "part", "at"), bins


def open_path(path: str) -> BinaryIO:
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path)
    return io.BufferedReader(store.open_input_file(inside))


class Store:
    """Writes and deletes below a folder, as ``open_path`` reads."""

    def __init__(self, folder: str):
        self.local = _local(folder)
        if self.local is None:
            from pyarrow import fs

            self.store, self.inside = fs.FileSystem.from_uri(folder)

    def create(self, name: str) -> BinaryIO:
        """A new file, in folders that are made where they are not; one that an earlier attempt of the task has left is overwritten."""
        if self.local is not None:
            path = f"{self.local}/{name}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            return open(path, "wb")
        path = f"{self.inside}/{name}"
        self.store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return self.store.open_output_stream(path)

    def delete(self, name: str) -> None:
        """Delete a folder with all that it holds, if it is there."""
        if self.local is not None:
            shutil.rmtree(f"{self.local}/{name}", ignore_errors=True)
        else:
            from pyarrow import fs

            if self.store.get_file_info(f"{self.inside}/{name}").type != fs.FileType.NotFound:
                self.store.delete_dir(f"{self.inside}/{name}")


class TooLarge(Exception):
    pass


def log_range(file: BinaryIO, first: int, n_bytes: int, size: int, longest: int) -> Iterator[bytes]:
    """The lines that begin in a range, without what has been added to the file since it was listed. Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; one that holds a
    ``\\r`` belongs where its ``\\n`` line begins."""
    at = max(first - 1, 0)
    file.seek(at)
    skipping = first > 0
    while at < min(first + n_bytes, size):
        record = file.readline(longest + 1)
        if not record:
            return
        if len(record) > longest:
            raise TooLarge(f"a line of more than {longest} bytes")
        begun, at = at, at + len(record)
        if skipping:  # the rest of a line that began before
            skipping = False
            continue
        record = record[: size - begun].removesuffix(b"\n").removesuffix(b"\r")
        yield from record.removeprefix(b"\xef\xbb\xbf" if begun == 0 else b"").split(b"\r")


def reader(opener: Callable[[str], BinaryIO] = open_path, largest: int = LARGEST) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task's work on planned ranges: rows of contents and one row with the outcome of each range (ok, missing, too large, unreadable)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for frame in frames:
            for path, key, suffix, size, first, n_bytes in zip(*[frame[c] for c in ("path", "source_path", "suffix", "size", "first_byte", "n_bytes")], strict=True):
                outcome, error, content = "ok", None, None
                try:
                    if suffix not in BY_ROW and size > largest:
                        raise TooLarge(f"{size} bytes, more than {largest}")
                    with opener(path) as file:
                        if suffix == ".log":
                            found = ((n, line, None, None) for n, line in enumerate(log_range(file, first, n_bytes, size, largest)))
                        elif suffix == ".docx":
                            found = ((n, text.encode("utf-8", "replace"), before, inside) for n, text, before, inside in docx.paragraphs(file))
                        else:
                            found = ()
                            content = file.read(size)
                        for row in found:
                            rows.append((key, suffix, first, *row, None, None))
                            held += len(row[1])
                            if len(rows) >= ROWS or held >= BATCH_BYTES:
                                yield _frame(rows, CONTENTS)
                                rows, held = [], 0
                except FileNotFoundError as e:
                    outcome, error = "missing", str(e)
                except TooLarge as e:
                    outcome, error = "too large", str(e)
                except Exception as e:  # noqa: BLE001  whatever a store raises for a file concerns this file
                    outcome, error = "unreadable", f"{type(e).__name__}: {e}"
                rows.append((key, suffix, first, None, content, None, None, outcome, error))
                held += len(content or b"")
                if len(rows) >= ROWS or held >= BATCH_BYTES:
                    yield _frame(rows, CONTENTS)
                    rows, held = [], 0
        yield _frame(rows, CONTENTS)

    return run


def read_files(
    todo: DataFrame, place: str, opener: Callable[[str], BinaryIO] = open_path, range_bytes: int = RANGE_BYTES, task_bytes: int = TASK_BYTES, largest: int = LARGEST, outcomes: Counts | None = None, tasks: int | None = None
) -> DataFrame:
    """Read the files ``todo`` (path, source_path, suffix, size; one row per source_path), each once, in one job whose tasks get equal shares of bytes, and return
    CONTENTS rows written below ``place``: a whole file in the row with its outcome, lines of logs and paragraphs of .docx files in rows of their own without one.
    ``outcomes``, if given, gets ``n_failed``, the ranges that could not be read. With ``tasks`` the files, which should be few and small, are dealt in turn
    to that many, and their sizes are not looked at."""
    spark = todo.sparkSession
    if tasks:
        found = ranges(todo, range_bytes).repartition(tasks).mapInPandas(reader(opener, largest), CONTENTS)
    else:
        counts = Counts()
        planned = ranges(todo, range_bytes).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
        counts.on(planned, F.count("*").alias("n"), F.coalesce(F.sum(F.least(F.col("n_bytes"), F.lit(LARGEST))), F.lit(0)).alias("total")).write.parquet(f"{place}/ranges")
        planned = spark.read.schema(planned.schema).parquet(f"{place}/ranges")
        seen = counts.get()
        dealt, bins = packed(planned, seen["total"], seen["n"], spark.sparkContext.defaultParallelism, task_bytes)
        found = dealt.repartitionById(bins, F.col("bin")).mapInPandas(reader(opener, largest), CONTENTS)
    if outcomes is not None:
        found = outcomes.on(found, F.count_if(F.col("outcome") != "ok").alias("n_failed"))
    found.write.option("compression", "zstd").parquet(f"{place}/contents")
    return spark.read.schema(CONTENTS).parquet(f"{place}/contents")


def failed_files(contents: DataFrame) -> DataFrame:
    """(source_path, error) of files of which some range couldn't be read."""
    bad = contents.filter("outcome <> 'ok'")
    return bad.groupBy("source_path").agg(F.min(F.concat_ws(": ", "outcome", "error")).alias("error"))


def texts(contents: DataFrame) -> DataFrame:
    """(source_path, suffix, raw) of files read whole: invalid bytes become U+FFFD, line ends ``\\n``."""
    return contents.filter(F.col("outcome").eqNullSafe("ok") & ~F.col("suffix").isin(*BY_ROW)).select("source_path", "suffix", T.utf8(F.col("content")).alias("raw"))


def log_lines(contents: DataFrame) -> DataFrame:
    """(source_path, split_no, line_no, line) of logs."""
    line = F.make_valid_utf8(F.col("content").cast("string"))
    return contents.filter("line_no is not null and suffix = '.log'").select("source_path", F.col("first_byte").alias("split_no"), "line_no", line.alias("line"))


def word_paragraphs(contents: DataFrame) -> DataFrame:
    """(source_path, para_idx, text, break_before, breaks_inside) of .docx files."""
    rows = contents.filter("line_no is not null and suffix = '.docx'")
    return rows.select("source_path", F.col("line_no").cast("int").alias("para_idx"), F.col("content").cast("string").alias("text"), "break_before", F.col("breaks_inside").cast("int").alias("breaks_inside"))
