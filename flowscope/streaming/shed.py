"""Load shedding inside a stream (L1, L2): a rate per micro-batch that follows the backlog, with counters.

A micro-batch holds what arrived while the one before was worked on, so its size
is the backlog. ``run_shedding`` keeps a batch whole while it has at most
``capacity`` rows and sheds the rest of a larger one by a hash of the row's key,
at the rate ``capacity / rows``. Kept rows and one counter row per batch go to
committed tables, under the batch's number: a replay sheds the same rows again and
replaces them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowscope.functions.hashing import hash_keep
from flowscope.session import fresh_path
from flowscope.sources.commits import CommittedTable

COUNTERS = "batch_id long, n_in long, n_kept long, rate double"


def run_shedding(feed: DataFrame, key: str, capacity: int, kept: CommittedTable, counters: CommittedTable,
                 checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Shed ``feed`` into ``kept``; ``key`` tells the rows of a batch apart."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            n = batch.count()
            if not n:
                return
            rate = min(1.0, capacity / n)
            rows = batch.where(hash_keep(key, rate))
            kept.put(rows, "shed", batch_id)
            line = rows.agg(F.count(F.lit(1)).alias("n_kept")).select(
                F.lit(batch_id).cast("long").alias("batch_id"), F.lit(n).cast("long").alias("n_in"), "n_kept", F.lit(rate).alias("rate"))
            counters.put(line, "shed", batch_id)
        finally:
            batch.unpersist()

    w = feed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).foreachBatch(per_batch).start()


def shed_drops(spark: SparkSession, drops: Iterable[DataFrame], key: str, capacity: int) -> tuple[DataFrame, DataFrame]:
    """A feed that arrives in drops, each shed as one micro-batch: (kept rows, counters)."""
    feed, ck, base = (fresh_path(spark, f"shed-{x}") for x in ("in", "ck", "out"))
    kept = counters = None
    for drop in drops:
        drop.write.mode("append").parquet(feed)
        kept = kept or CommittedTable(spark, f"{base}/kept", drop.schema)
        counters = counters or CommittedTable(spark, f"{base}/counters", StructType.fromDDL(COUNTERS))
        stream = spark.readStream.schema(drop.schema).parquet(feed)
        run_shedding(stream, key, capacity, kept, counters, ck).awaitTermination()
    if kept is None:
        raise ValueError("a feed has one drop at least")
    return kept.read(), counters.read()
