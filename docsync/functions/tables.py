"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors. One is made only where the session names none and all tasks run in the
    driver's own process, as in tests; a cluster without one is an error, since its machines do not see each other's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="docsync-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


#: The paths that ``written`` has made inside ``temporary``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside go at its end, not only with the application, as a long-running one needs."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete(spark, path)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: it is computed once, and lineage ends in
    files that survive a lost executor. The files go when the application ends, or with the ``temporary`` part of it."""
    spark, made = df.sparkSession, _MADE.get()
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if made is not None:
        made.append(path)
    df.write.option("compression", compression).parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` over all cores of the session where its files have fewer splits than that, as small tables do; larger ones are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.toJavaRDD().getNumPartitions() < cores else df


def few_rows(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    """A few rows that the driver knows, or none, as literals. ``createDataFrame`` passes even an empty list through Python workers of another kind than
    those of the functions on columns and batches, and every executor would keep both kinds."""
    fields = StructType.fromDDL(schema).fields
    values = [F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for f, x in zip(fields, row, strict=True)]) for row in rows]
    if not values:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*values)))


class Counts:
    """Aggregates taken while rows are written."""

    def __init__(self):
        self.seen: list[tuple[Observation, DataFrame, list[Column]]] = []

    def on(self, df: DataFrame, *aggregates: Column) -> DataFrame:
        self.seen.append((Observation(), df, list(aggregates)))
        return df.observe(self.seen[-1][0], *aggregates)

    def get(self, rows: DataFrame | None = None) -> dict:
        """All of them; where the optimizer has left out an observed part, as it does with empty ones, its rows are counted, or ``rows``, what was written of them."""
        found: dict = {}
        for seen, df, aggregates in self.seen:
            try:
                found |= seen.get
            except Py4JJavaError:
                found |= (df if rows is None else rows).agg(*aggregates).first().asDict()
        return found
