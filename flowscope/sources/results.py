"""Result sinks and the result store.

The store is a table of monitoring results in long form ``time, func, key,
value`` (one row per reported key), a folder per inserted batch and a log of
commits (``commits.CommittedTable``): a replayed micro-batch replaces its own
rows, readers see whole batches only, and streams and inserts share one store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from flowscope.sources.commits import CommittedTable

STORE_SCHEMA = StructType([
    StructField("time", TimestampNTZType(), True),
    StructField("func", StringType(), True),
    StructField("key", StringType(), True),
    StructField("value", DoubleType(), True),
])
DOC_COLUMNS = ["time", "func", "key", "value"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless CSV written by the executors (no driver collect)."""
    df.write.mode(mode).option("header", "false").csv(path)


def peek(df: DataFrame, n: int = 20, show: bool = False) -> DataFrame:
    """The first ``n`` rows (printed untruncated when ``show``)."""
    head = df.limit(n)
    if show:
        head.show(n, truncate=False)
    return head


def snapshot_to_results(snapshot: DataFrame) -> DataFrame:
    """Monitor snapshot rows -> store rows (``time`` = window end)."""
    return snapshot.select(F.col("window_end").alias("time"), "func", "key", "value")


def documents_as_text(docs: DataFrame) -> DataFrame:
    """Result documents with each function's keys as one comma-separated text, best first, and the
    number of deviants: ``time, func1, .. func6, n_func3, n_func6``."""
    def keys(entries, key):
        return F.array_join(F.transform(entries, lambda e: e[key]), ",")
    names = {f: [x.name for x in docs.schema[f].dataType.elementType][1] for f in ("func1", "func2", "func4", "func5")}
    names |= {f: [x.name for x in docs.schema[f].dataType["largest"].dataType.elementType][1] for f in ("func3", "func6")}
    return docs.select(
        F.col("window_end").alias("time"),
        *[keys(F.col(f if f not in ("func3", "func6") else f"{f}.largest"), names[f]).alias(f) for f in sorted(names)],
        F.col("func3.n").alias("n_func3"), F.col("func6.n").alias("n_func6"))


def store_table(spark: SparkSession, store: str) -> CommittedTable:
    return CommittedTable(spark, store, STORE_SCHEMA, "time")


def insert(df: DataFrame, store: str, batch_id: int = 0, source: str = "batch") -> None:
    """Add result rows; re-inserting the same ``batch_id`` of a ``source``
    replaces it (streams write under the name of their key)."""
    store_table(df.sparkSession, store).put(df, source, batch_id)


def read_all(spark: SparkSession, store: str) -> DataFrame:
    """Every stored result row, as of now."""
    return store_table(spark, store).read()


def read_latest(spark: SparkSession, store: str) -> DataFrame:
    """The rows of the most recent ``time``, from the folders that hold it."""
    return store_table(spark, store).read_latest()


def delete_all(spark: SparkSession, store: str) -> None:
    """An empty table from now on; frames read before keep their rows."""
    store_table(spark, store).replace()


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row (``value`` column), as the store receives it."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def from_json_lines(lines: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Decode JSON rows back into typed columns."""
    schema = schema or STORE_SCHEMA
    return lines.select(F.from_json("value", schema).alias("d")).select("d.*")


def write_json(df: DataFrame, path: str) -> None:
    """Results as JSON lines written by the executors."""
    df.write.mode("overwrite").json(path)
