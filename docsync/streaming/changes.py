"""A stream of what changes in a folder: added, changed and removed files, as differences of numbered listings.

Every trigger lists the folder anew, in tasks, and compares the listing with the one before it. Listings and differences are written under the number of the
micro-batch before they are handed on, and a batch that is repeated after a failure takes up what it has written, so a restarted query loses and repeats
no change. What a handler does with a batch should depend on its number only once, as publishing in the collection does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsync.functions.tables import delete, few_rows
from docsync.jobs.sync_folder import sync_folder
from docsync.sources import files

LISTING = "path string, source_path string, source_name string, suffix string, size long, mtime_ns long, file_signature string"
CHANGES = f"change string, old_signature string, {LISTING}"


class Snapshots:
    """Numbered listings of a folder and their differences, below ``place``."""

    def __init__(self, spark: SparkSession, folder: str, place: str):
        self.spark, self.folder, self.place = spark, folder, place.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.place).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        """The numbers of tables of a kind that are whole."""
        top = self._path(f"{self.place}/{kind}")
        names = [s.getPath().getName() for s in self._fs.listStatus(top)] if self._fs.exists(top) else []
        return sorted(int(n) for n in names if n.isdigit() and self._fs.exists(self._path(f"{self.place}/{kind}/{n}/_SUCCESS")))

    def _table(self, kind: str, number: int | None, schema: str) -> DataFrame:
        if number is None:
            return few_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(f"{self.place}/{kind}/{number:012d}")

    def take(self, number: int) -> DataFrame:
        """CHANGES rows between listing ``number`` and the one before; made once for each number. The first listing adds every file. What lies below a directory that can't
        be listed stays as it was."""
        if number not in self._numbers("changes"):
            before = self._table("listings", max((n for n in self._numbers("listings") if n < number), default=None), LISTING)
            walked = f"{self.place}/walk"
            delete(self.spark, walked)
            found, unlisted = files.walk(self.spark, self.folder, walked)
            entry = F.max_by(F.struct(*[c for c in found.columns if c != "source_path"]), "file_signature").alias("entry")
            found = found.groupBy("source_path").agg(entry).select("source_path", "entry.*")
            unseen = files.under(before, unlisted).join(found, "source_path", "left_anti")
            columns = [c.split()[0] for c in LISTING.split(", ")]
            found.select(*columns).unionByName(unseen.select(*columns)).write.mode("overwrite").parquet(f"{self.place}/listings/{number:012d}")
            delete(self.spark, walked)
            now = self._table("listings", number, LISTING)
            old = before.select("source_path", F.col("file_signature").alias("old_signature"))
            both = now.join(old, "source_path", "full_outer")
            change = F.when(F.col("old_signature").isNull(), "added").when(F.col("file_signature").isNull(), "removed").when(F.col("file_signature") != F.col("old_signature"), "changed")
            both.withColumn("change", change).filter("change is not null").select("change", "old_signature", *columns).write.mode("overwrite").parquet(f"{self.place}/changes/{number:012d}")
            for kind in ("listings", "changes"):  # a batch that is repeated needs its own and the listing before it
                for n in self._numbers(kind)[:-2]:
                    delete(self.spark, f"{self.place}/{kind}/{n:012d}")
        return self._table("changes", number, CHANGES)


def stream_changes(spark: SparkSession, folder: str, place: str, checkpoint: str, handle: Callable[[DataFrame, int], None], interval: str = "300 seconds") -> StreamingQuery:
    """Call ``handle(changes, number)`` at the start and at every interval. An error ends the query; started again, it repeats the batch with the same changes."""
    snapshots = Snapshots(spark, folder, place)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    run = lambda _, number: handle(snapshots.take(number), number)
    return ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def publish(spark: SparkSession, collection_root: str, work: str, texts: dict[str, DataFrame] | None = None, **chunking) -> Callable[[DataFrame, int], None]:
    """A handler that publishes changes in the collection: added and changed files are taken, removed ones go. The work follows the changes, not the folder."""

    def handle(changes: DataFrame, _: int) -> None:
        come = changes.filter("change <> 'removed'").drop("change", "old_signature")
        gone = changes.filter("change = 'removed'").select("source_path")
        if not changes.isEmpty():
            sync_folder(spark, come, collection_root, work, texts, gone=gone, **chunking)

    return handle
