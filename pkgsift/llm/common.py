"""Helpers the operators share: table reads, scratch tables, deterministic shards."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.session import ensure_checkpoint_dir

#: Records in one Arrow batch: a batch of whole texts must fit a worker's memory.
BATCH_RECORDS = 1024
#: Most shards of one output, whatever its size (bounds the shard table).
MAX_SHARDS = 65_536
#: Cells of the key histogram that shards are cut from.
MAX_BINS = 65_536


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small unless the session already asks for its own size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_RECORDS))


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    survives lost executors and gives the planner real sizes."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let go of what finished work held on the driver.

    Spark drops broadcasts and shuffles that nothing refers to only after a
    collection in the JVM, and Python's allocator keeps freed memory until it is trimmed."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system behind a folder URI (local path, file:, hdfs:, s3:, …)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def commit(fs: pyarrow.fs.FileSystem, made: str, name: str) -> None:
    """Rename a finished file; if another attempt did so first, its bytes are the same."""
    try:
        fs.move(made, name)
    except OSError:
        if fs.get_file_info(name).type != pyarrow.fs.FileType.File:
            raise
        fs.delete_file(made)


def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``, so that lambdas inside don't recompute it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shard_column(df: DataFrame, key: str, weight: Column, target: int) -> tuple[Column, int]:
    """A column that numbers ascending key ranges of about ``target`` weight each.

    The ranges come from exact weights per histogram cell, so they depend on the
    rows alone, not on partitions or samples.  Cells split [min, max] evenly, at
    most ``MAX_BINS``; a null key goes to shard 0.  At most ``MAX_SHARDS`` shards.
    """
    lo, hi, total = df.agg(F.min(key), F.max(key), F.sum(weight)).first()
    if lo is None:
        return F.lit(0), 1
    width = max(1, -(-(hi - lo + 1) // MAX_BINS))
    cell = F.coalesce(F.expr(f"cast((cast(`{key}` as decimal(20,0)) - ({lo})) div {width} as int)"), F.lit(0))
    target = max(target, -(-int(total or 0) // MAX_SHARDS))
    if (total or 0) <= target:
        return F.lit(0), 1
    weights = dict(df.groupBy(cell.alias("c")).agg(F.sum(weight)).collect())
    numbers, shard, held = [], 0, 0
    for c in range(max(weights) + 1):
        here = weights.get(c) or 0
        if held and held + here > target:
            shard, held = shard + 1, 0
        held += here
        numbers.append(str(shard))
    # the cells' shards as one constant array of at most MAX_BINS entries
    return F.get(F.split(F.lit(",".join(numbers)), ","), cell).cast("int"), shard + 1
