"""Keeping an outside store of chunks in step with the collection.

Two versions of the collection differ in the buckets and layers whose folders differ; only these are read, and give the chunks to delete and to add. Tasks
send them in batches to the store, and every chunk gets a row with its outcome, so that one failing chunk stops neither its batch nor the job, and a later run can take up
what is left. Chunks are put by their id: a repeated task, or a repeated run, puts the same again and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.functions.tables import Counts
from docsync.operators.sync import BATCH, usable
from docsync.sources.collection import Collection, layers_of

OUTCOMES = "chunk_id string, action string, error string"
#: Chunks that a task has in hand when a store answers slowly: tasks are of this size at most.
TASK_ROWS = 20_000


class Store(Protocol):
    """An outside store, as ``connect()`` gives it to each task."""

    def put(self, chunks: list[dict]) -> None:
        """Add or replace chunks by ``chunk_id``."""

    def delete(self, chunk_id: str) -> None:
        """Remove a chunk; none of that id is no error."""


def changes(collection: Collection, old: dict, new: dict) -> tuple[DataFrame, DataFrame]:
    """(chunk_id, deleted) ids that only the version of manifest ``old`` has, and the rows that only that of ``new`` has. Ids name path, signature and place, so equal ids are equal
    chunks. Rows without a usable id are out of reach."""
    if old["n_buckets"] == new["n_buckets"]:
        touched = [int(b) for b in {*old["buckets"], *new["buckets"]} if old["buckets"].get(b) != new["buckets"].get(b)]
    else:
        touched = None
    alone = lambda m, other: [where for where in layers_of(m) if where not in layers_of(other)]
    before, after = (collection.read(touched, m, alone(m, other)).filter(usable("chunk_id")) for m, other in ((old, new), (new, old)))
    gone = before.select("chunk_id").join(after.select("chunk_id"), "chunk_id", "left_anti").distinct()
    return gone, after.join(before.select("chunk_id"), "chunk_id", "left_anti")


def _attempt(run: Callable[[], None], times: int) -> str | None:
    """None when one of ``times`` attempts succeeds, else the last one's error."""
    error = None
    for _ in range(times):
        try:
            run()
            return None
        except Exception as e:  # noqa: BLE001  whatever a store raises is the outcome
            error = f"{type(e).__name__}: {e}"
    return error


def put_all(chunks: DataFrame, connect: Callable[[], Store], size: int = BATCH, attempts: int = 2) -> DataFrame:
    """OUTCOMES rows of putting ``chunks`` in batches of ``size``; a batch that fails is put chunk by chunk. Nothing is sent until the rows are written."""
    columns = chunks.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()

        def sent(batch: list[dict]) -> pd.DataFrame:
            errors = dict.fromkeys(range(len(batch)))
            if _attempt(lambda: store.put(batch), attempts) is not None:
                errors = {i: _attempt(lambda c=c: store.put([c]), attempts) for i, c in enumerate(batch)}
            return pd.DataFrame([(c["chunk_id"], "put", errors[i]) for i, c in enumerate(batch)], columns=["chunk_id", "action", "error"])

        batch: list[dict] = []
        for frame in frames:
            for row in frame.to_dict("records"):
                batch.append(row)
                if len(batch) == size:
                    yield sent(batch)
                    batch = []
        if batch:
            yield sent(batch)

    return chunks.select(*columns).mapInPandas(run, OUTCOMES)


def delete_all(ids: DataFrame, connect: Callable[[], Store], attempts: int = 2) -> DataFrame:
    """OUTCOMES rows of deleting chunks (chunk_id); an id that can't be deleted does not stop the others."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = connect()
        for frame in frames:
            yield pd.DataFrame([(i, "delete", _attempt(lambda i=i: store.delete(i), attempts)) for i in frame["chunk_id"]], columns=["chunk_id", "action", "error"])

    return ids.select("chunk_id").mapInPandas(run, OUTCOMES)


def mirror(collection: Collection, old: dict, new: dict, connect: Callable[[], Store], outcomes: str) -> dict:
    """Bring a store that holds version ``old`` to version ``new``: deletions first, as a changed file's old chunks must not stay beside its new ones. Outcomes are written
    below ``outcomes``, and what failed can be read there; returns the numbers of deleted, put and failed chunks."""
    gone, added = changes(collection, old, new)
    found: dict = {"failed": 0}
    for action, rows, send in (("delete", gone, delete_all), ("put", added, put_all)):
        spread = rows.repartition(max(1, -(-rows.count() // TASK_ROWS)), "chunk_id")
        counts = Counts()
        sent = counts.on(send(spread, connect), F.count_if(F.col("error").isNull()).alias("done"), F.count_if(F.col("error").isNotNull()).alias("failed"))
        sent.write.mode("overwrite").parquet(f"{outcomes}/{action}")
        seen = counts.get(collection.spark.read.schema(OUTCOMES).parquet(f"{outcomes}/{action}"))
        found |= {f"{action}s": seen["done"], "failed": found["failed"] + seen["failed"]}
    return found


def failed(collection: Collection, outcomes: str) -> DataFrame:
    """The OUTCOMES rows of chunks that a ``mirror`` could not delete or put."""
    return collection.spark.read.schema(OUTCOMES).parquet(f"{outcomes}/delete", f"{outcomes}/put").filter("error is not null")
