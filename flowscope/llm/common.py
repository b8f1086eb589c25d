"""Shared helpers: reading tables, staging, row identity and Arrow slices."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscope.session import fresh_path

# numpy work inside a task runs over slices of about this many text bytes, so
# its temporary arrays stay at some tens of MB whatever the Arrow batch holds
SLICE_BYTES = 1 << 20
# bytes of one Arrow batch, about: Spark's own bound (64 MB) is held several times
# per task, in the JVM's direct memory and in the Python worker
BATCH_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, kind: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage;
    a lost executor costs a re-read of committed files)."""
    path = fresh_path(df.sparkSession, kind)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def fold_of(doc_id: str | Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the text ''."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (length rows + 1) of a string column without nulls."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    n = len(column)
    _, off, data = column.buffers()
    if n == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, width)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes, one row at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def binary_list(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def running_offset(df: DataFrame, keys: list[str], bucket: str, value: Column, out: str) -> DataFrame:
    """Per (keys, bucket): the sum of ``value`` over earlier buckets of the same keys.

    Sums per bucket are combined map-side, so the ordered window only sees one
    row per bucket; used to number rows without sorting a whole key in one task.
    """
    from pyspark.sql import Window

    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias(out))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique long ``_flowscope_key`` per row: its doc_id where ids are unique, else a
    number stored once with the rows (so that every scan sees the same one)."""
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if twice.isEmpty():
        return docs.withColumn("_flowscope_key", F.col("doc_id").cast("long"))
    return stage(docs.withColumn("_flowscope_key", F.monotonically_increasing_id()), "keyed")


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``_flowscope_key`` is not among ``keys``. The keys are stored
    first, so Spark chooses the join by their real size."""
    gone = stage(keys.select(F.col("key").alias("_gone")), "gone")
    return docs.join(gone, docs["_flowscope_key"] == gone["_gone"], "left_anti").drop("_flowscope_key")


def map_arrow(df: DataFrame, task, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of about ``BATCH_BYTES`` (a longer row is a batch of its
    own), in workers that hand freed memory back. Sets Spark's batch bound for the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(tidy(task), schema)


def tidy(task):
    """``task`` (a mapInArrow function) that returns freed memory to the system when it
    ends: Python workers are reused, and would otherwise keep the peak of every
    operator that ran in them before."""
    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)
    return run
