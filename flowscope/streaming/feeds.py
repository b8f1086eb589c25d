"""Finite feeds on streams (T3, T5): end-of-input punctuation, feeds that arrive in drops, late rows.

A watermark only moves when rows arrive, so the last windows of a feed that
ends stay open for ever. ``EndOfInput`` is a second input of the stream: a folder
without rows until ``announce`` puts one row there whose time lies in the far
future. It moves the watermark past every window of the feed and, in append
mode, shows up nowhere: its own window is never closed, its other columns are
null. Rows that reach a stream after the end are late.

Late rows are counted by accounting, not by watching the watermark: every
(row, window) that arrives is observed before the aggregation, every one that was
counted is in the ``n`` of an emitted window, and after the end all windows have
been emitted. Spark's own ``numRowsDroppedByWatermark`` counts the groups that
partial aggregation leaves of late rows, not the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from flowscope.session import fresh_path
from flowscope.streaming.runner import read_run, start_run

# far behind every event; a year of four digits, so that any delay and window width can be taken off or put on
END = "9990-01-01 00:00:00"


class EndOfInput:
    """The punctuation input of one stream. ``folder`` lies on shared storage; a stream that is
    restarted on its checkpoint takes the same folder again."""

    def __init__(self, spark: SparkSession, time_col: str = "datetime", folder: str | None = None):
        self.spark, self.time_col = spark, time_col
        self.folder = folder or fresh_path(spark, "end-of-input")
        self.schema = StructType([StructField(time_col, TimestampType())])
        if folder is None:  # a file stream needs the folder to exist
            spark.createDataFrame([], self.schema).write.mode("append").parquet(self.folder)

    def follow(self, stream: DataFrame) -> DataFrame:
        """``stream`` with the punctuation behind it; call it before ``withWatermark``."""
        marks = self.spark.readStream.schema(self.schema).parquet(self.folder)
        columns = [F.col(f.name) if f.name == self.time_col else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in stream.schema.fields]
        return stream.unionByName(marks.select(*columns))

    def announce(self) -> None:
        """The feed is complete: once, after its last row is in."""
        row = self.spark.range(1).select(F.lit(END).cast("timestamp").alias(self.time_col))
        row.write.mode("append").parquet(self.folder)


def run_feed(spark: SparkSession, feed: DataFrame, build: Callable[[DataFrame], DataFrame],
             fn: Callable[[DataFrame], DataFrame] | None = None, kind: str = "feed",
             time_col: str = "datetime") -> DataFrame:
    """Run ``build(feed)`` (append mode; ``fn`` per micro-batch, if given) until the feed's files are
    read, announce the end, wait for the windows that this closes and return the sink as a table.

    The end is announced only after all rows are in, so it makes no row late, however many
    micro-batches the feed takes."""
    end = EndOfInput(spark, time_col)
    df = build(end.follow(feed))
    sink, ck = fresh_path(spark, f"{kind}-out"), fresh_path(spark, f"{kind}-ck")
    q = start_run(df, fn, sink, ck, {"processingTime": "0 seconds"})
    try:
        q.processAllAvailable()
        end.announce()
        q.processAllAvailable()
    finally:
        q.stop()
    return read_run(spark, df, fn, sink)


OBSERVED = "arrived"


def observed_windows(stream: DataFrame, width: str, slide: str | None = None, watermark: str = "1 minute",
                     time_col: str = "datetime") -> DataFrame:
    """``stream`` with a column ``w``, the windows of each row, watermarked, and the number of
    (row, window) pairs of the feed observed as ``arrived`` (the punctuation is none)."""
    w = F.window(time_col, width, slide or width)
    laid = stream.withWatermark(time_col, watermark).withColumn("w", w)
    return laid.observe(OBSERVED, F.count_if(F.col(time_col) < F.lit(END).cast("timestamp")).alias("rows"))


def arrived_rows(query: StreamingQuery) -> int:
    """Pairs observed by one run of ``observed_windows``, over the progress it still remembers
    (``spark.sql.streaming.numRecentProgressUpdates`` micro-batches)."""
    rows = (p.observedMetrics.get(OBSERVED) for p in query.recentProgress)
    return sum(r["rows"] or 0 for r in rows if r is not None)


def run_drops(spark: SparkSession, drops: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame],
              kind: str = "drops", time_col: str = "datetime", sink: str | None = None) -> tuple[DataFrame, int]:
    """A feed that arrives in drops, each processed by a run of its own on one checkpoint, as a
    scheduled job does: rows of a drop see the watermark that the drops before it left.
    A drop is taken from ``drops`` when the one before it has been processed; after the last one
    the end is announced. Returns the sink (a fresh folder by default) as a table and the number of pairs
    that arrived. All files of a drop are read in one micro-batch, whatever their number."""
    feed, ck = fresh_path(spark, f"{kind}-in"), fresh_path(spark, f"{kind}-ck")
    sink = sink or fresh_path(spark, f"{kind}-out")
    end, arrived, df = EndOfInput(spark, time_col), 0, None

    def run() -> int:
        q = start_run(df, None, sink, ck, {"availableNow": True})
        q.awaitTermination()
        return arrived_rows(q)

    for drop in drops:
        drop.write.mode("append").parquet(feed)
        df = build(end.follow(spark.readStream.schema(drop.schema).parquet(feed)))
        arrived += run()
    if df is None:
        raise ValueError("a feed has one drop at least")
    end.announce()
    run()
    return read_run(spark, df, None, sink), arrived


def windows_with_late_rows(spark: SparkSession, drops: Iterable[DataFrame], key: str, width: str,
                           slide: str | None = None, watermark: str = "1 minute", value: str = "packet_size",
                           time_col: str = "datetime") -> DataFrame:
    """T5: ``window_start, window_end, key, bytes, n, late_rows`` of a feed that arrives in drops.

    A row is late for a window that ended at or before the cut-off: the largest time of all drops
    before the row's own, less the watermark's delay. Late rows are in no window; ``late_rows``
    (the same in every row) says how many (row, window) pairs of the feed that were."""
    def build(feed: DataFrame) -> DataFrame:
        agg = (observed_windows(feed, width, slide, watermark, time_col).groupBy("w", key)
               .agg(F.sum(value).alias("bytes"), F.count(F.lit(1)).alias("n")))
        return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"), key, "bytes", "n")

    windows, arrived = run_drops(spark, drops, build, "late", time_col)
    counted = windows.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return windows.withColumn("late_rows", F.lit(arrived).cast("bigint") - counted)
