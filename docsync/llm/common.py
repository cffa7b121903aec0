"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds at least 1/HOT of all rows is "hot"; at most HOT keys can, so a table of
#: hot keys has a proven bound and may be broadcast at any input size.
HOT = 1024
#: Bytes of an Arrow batch that goes to a Python worker, where the session leaves Spark's own default.
BATCH_BYTES = 8 << 20


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


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends in
    files that survive a lost executor. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose batches for Python workers are from now on cut at BATCH_BYTES, so that long texts do not add up to
    large batches. A size that the session has set itself is left as it is."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key).rstrip("bB") == str(64 << 20):
        conf.set(key, str(BATCH_BYTES))
    return df


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a Python worker, which gives freed memory back to the system when a task ends: workers are kept for the next stages."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole


def bucket_of(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id gives -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(-1))


def join_skewed(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, spread: Column) -> DataFrame:
    """Left join ``rows`` with ``table`` (one row per key, ``weight`` = how many of ``total`` rows
    hold the key). Hot keys, of which there are at most HOT, are broadcast; the other keys are
    shuffled, and rows already served are dealt out by ``spread`` so that none of them meet."""
    rest = [c for c in table.columns if c not in keys]
    is_hot = F.col(weight) * F.lit(HOT) >= F.lit(total)
    hot = table.filter(is_hot).select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.struct(*rest).alias("__hot"))
    cold = table.filter(~is_hot).select(
        *[F.col(k).alias(f"__c_{k}") for k in keys], F.lit(0).cast("long").alias("__c_spread"), F.struct(*rest).alias("__cold")
    )
    out = rows.join(F.broadcast(hot), [F.col(k) == F.col(f"__h_{k}") for k in keys], "left")
    served = F.col("__hot").isNotNull()
    out = out.withColumn("__spread", F.when(served, F.xxhash64(spread).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long")))
    out = out.join(cold, [F.col(k) == F.col(f"__c_{k}") for k in keys] + [F.col("__spread") == F.col("__c_spread")], "left")
    picked = F.coalesce(F.col("__hot"), F.col("__cold"))
    return out.select(*rows.columns, *[picked[c].alias(c) for c in rest])


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` less the rows whose id is in ``dropped`` (rows with a null id stay)."""
    gone = dropped.select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
