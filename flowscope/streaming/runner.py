"""Structured Streaming: sources, watermarked window aggregation and sinks
(S3, S4, S6, S8, S9, T2-T9).

How the monitoring functions run on a stream::

    source -> parse -> withWatermark -> groupBy(window, key).agg  (append mode)
           -> foreachBatch(batch function of flowscope.operators.traffic)
           -> parquet sink partitioned by batch_id

In append mode every window is emitted once, complete, when the watermark
passes its end; all keys of a window share that end and therefore arrive in
the same micro-batch. Per-window functions that need all keys (totals,
spread, row_number) are thus exact inside ``foreachBatch``, and the same
code serves tables and streams. ``foreachBatch`` is at-least-once; each
batch overwrites its own ``batch_id=`` partition, so a replay after a
failure is idempotent. State and offsets live in the checkpoint folder,
which must be on shared storage (see ``flowscope.session.shared_dir``).

Complete mode (the original's choice) re-emits every window on every
trigger and never drops late rows or state; it is offered for the global
``orderBy().limit(k)`` form only.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from flowscope.session import ensure_dir, fresh_path
from flowscope.sources.commits import CommittedTable
from flowscope.sources.flows import flow_view
from flowscope.sources.logs import EVENTS_YEAR_MONTH, log_lines_path, parse_log_lines
from flowscope.sources.tables import table


def _stream_path(path: str) -> str:
    """A file stream needs a folder or a glob; a single local file becomes a glob."""
    if os.path.isfile(path):
        return path[:-1] + f"[{path[-1]}]"
    return path


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table read as a file stream (schema from the table)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(_stream_path(path))


def as_event_time(df: DataFrame, col: str = "datetime") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ) event time."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def flows_stream(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return as_event_time(flow_view(table_stream(spark, sf_dir, "events", **kw)))


def log_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The stored access log of a folder, tailed as a file stream and parsed."""
    path = log_lines_path(spark, sf_dir)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return as_event_time(parse_log_lines(reader.parquet(path), EVENTS_YEAR_MONTH))


def keyed_window_stream(stream: DataFrame, key: str | None, width: str, slide: str | None = None,
                        watermark: str = "1 minute", value: str = "packet_size",
                        time_col: str = "datetime", panes: bool | str = "auto") -> DataFrame:
    """T2 + T3: watermarked window aggregate; output like ``keyed_window_agg``
    (bounds back as TIMESTAMP_NTZ).

    With a slide shorter than the width, rows are first aggregated into panes
    of ``gcd(width, slide)`` and the panes into windows by a second, chained
    stateful aggregation on ``window_time(pane)`` (the pane's last instant),
    which lies in exactly the windows that contain the whole pane. Each row
    then updates one state entry instead of ``width/slide``; results equal
    the direct form (tested). The second stateful operator costs a shuffle
    and a state store per micro-batch, while map-side partial aggregation
    already absorbs a small expansion, so ``panes='auto'`` chains only when
    ``width/slide >= PANE_MIN_FANOUT``. Complete mode supports a single
    stateful operator only, so pass ``panes=False`` there.
    """
    from flowscope.operators.windows import PANE_MIN_FANOUT, seconds

    keys = [key] if key else []
    wm = stream.withWatermark(time_col, watermark)
    t = seconds(width)
    sl = seconds(slide) if slide else t
    if panes == "auto":
        panes = t // sl >= PANE_MIN_FANOUT
    if panes and sl != t:
        g = math.gcd(t, sl)
        p = (wm.groupBy(F.window(time_col, f"{g} seconds").alias("pw"), *keys)
             .agg(F.sum(value).alias("_b"), F.count(value).alias("_n")))
        agg = (p.groupBy(F.window(F.window_time("pw"), f"{t} seconds", f"{sl} seconds").alias("w"), *keys)
               .agg(F.sum("_b").alias("bytes"), F.sum("_n").alias("n")))
    else:
        w = F.window(time_col, f"{t} seconds", f"{sl} seconds")
        agg = wm.groupBy(w.alias("w"), *keys).agg(F.sum(value).alias("bytes"), F.count(value).alias("n"))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "bytes", "n")


def monitor_to_store(spark: SparkSession, flows: DataFrame, key: str, store: str, width: str,
                     slide: str | None, h: float, k: int, x: float,
                     funcs: tuple[str, str, str] = ("func1", "func2", "func3"),
                     watermark: str = "1 minute", trigger: dict | None = None,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Monitor one key of a flow stream and push every micro-batch's
    results (heavy hitters, top-k, deviants) to the result store, as batch
    ``<id>`` of the source ``<key>`` (replays replace their batch)."""
    from flowscope.operators.traffic import monitor_rows
    from flowscope.sources.results import insert, snapshot_to_results

    agg = keyed_window_stream(flows, key, width, slide, watermark)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            insert(snapshot_to_results(monitor_rows(batch, key, h, k, x, funcs)), store, batch_id, key)

    return _writer(agg, checkpoint or fresh_path(spark, "monitor-ck"), trigger, "append").foreachBatch(per_batch).start()


def running_total_stream(stream: DataFrame, key: str, value: str = "packet_size") -> DataFrame:
    """Total bytes and rows per key since the start (no window, no
    watermark); run it in ``update`` mode so each trigger emits changed keys."""
    return stream.groupBy(key).agg(F.sum(value).alias("bytes"), F.count(F.lit(1)).alias("n"))


def latest_top_k_stream(window_agg: DataFrame, key: str, k: int) -> DataFrame:
    """O5 as originally run: global sort (window_start desc, bytes desc) + limit
    over a windowed aggregate, valid in ``complete`` mode only. Complete mode
    keeps every window in the state (the watermark has no effect there)."""
    return (window_agg.select("window_start", "window_end", key, "bytes")
            .orderBy(F.desc("window_start"), F.desc("bytes"), F.asc(key)).limit(k))


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True}))


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                      trigger: dict | None = None, mode: str = "append") -> StreamingQuery:
    """Apply a batch function to every micro-batch and write the result to
    ``sink/batch_id=<id>`` (overwritten on replay). Empty micro-batches (no
    window closed yet) are skipped."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():  # append mode: no window closed in this trigger
                return
            out = fn(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(sink))
        finally:
            batch.unpersist()

    return _writer(df, checkpoint, trigger, mode).foreachBatch(per_batch).start()


def run_totals(df: DataFrame, keys: list[str], sink: str, checkpoint: str, trigger: dict | None = None,
               fold_every: int = 16) -> StreamingQuery:
    """Update mode into a committed table. A micro-batch adds the keys it changed; every
    ``fold_every`` batches the table is replaced by the newest row of each key, so it holds at most
    so many batches besides one row per key. ``read_totals`` returns the newest rows."""
    table = _batch_table(df, sink)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if batch_id % fold_every == fold_every - 1:
            # a replay folds the same rows again
            table.replace(latest_rows(table.read().unionByName(rows), keys).withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                          "totals", batch_id)
        else:
            table.put(rows, "totals", batch_id)

    return _writer(df, checkpoint, trigger, "update").foreachBatch(per_batch).start()


def read_totals(df: DataFrame, keys: list[str], sink: str) -> DataFrame:
    """The newest row of each key that ``run_totals(df, ...)`` wrote to ``sink``."""
    return latest_rows(_batch_table(df, sink).read(), keys)


def run_latest(df: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Complete mode into a committed table that every micro-batch replaces: it holds the newest result alone."""
    table = _batch_table(df, sink)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        table.replace(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "latest", batch_id)

    return _writer(df, checkpoint, trigger, "complete").foreachBatch(per_batch).start()


def read_newest(df: DataFrame, sink: str) -> DataFrame:
    return _batch_table(df, sink).read().drop("batch_id")


def _batch_table(df: DataFrame, sink: str) -> CommittedTable:
    return CommittedTable(df.sparkSession, sink, StructType([*df.schema.fields, StructField("batch_id", LongType())]))


def latest_rows(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of each key among stored update batches (``max_by`` on
    ``batch_id``: a partial aggregate, no per-key sort)."""
    vals = [c for c in stored.columns if c not in keys and c != "batch_id"]
    latest = stored.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("_v"))
    return latest.select(*keys, *[F.col("_v").getField(c).alias(c) for c in vals])


def run_append(df: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
               fmt: str = "parquet") -> StreamingQuery:
    """Append rows to a file sink (exactly-once through its commit log)."""
    return _writer(df, checkpoint, trigger, "append").format(fmt).option("path", sink).start()


def run_console(df: DataFrame, mode: str = "complete", trigger: dict | None = None,
                checkpoint: str | None = None) -> StreamingQuery:
    """Console sink (for watching a live feed)."""
    w = df.writeStream.outputMode(mode).format("console").option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def read_sink(spark: SparkSession, sink: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(sink).drop("batch_id")


def start_run(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None, sink: str, checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """Append mode into ``sink``: through ``fn`` per micro-batch, or rows as they are."""
    return run_foreach_batch(df, fn, sink, checkpoint, trigger) if fn else run_append(df, sink, checkpoint, trigger)


def run_to_end(spark: SparkSession, df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None = None,
               kind: str = "stream") -> DataFrame:
    """Run a stream over everything available (``availableNow``), wait for it
    and return the sink as a table. Sink and checkpoint are fresh folders
    under the shared checkpoint directory; a query restarted on the same
    folders resumes from its checkpoint. Windows that the watermark has not
    passed stay open; ``feeds.run_feed`` closes them."""
    sink, ck = fresh_path(spark, f"{kind}-out"), fresh_path(spark, f"{kind}-ck")
    q = start_run(df, fn, sink, ck)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_run(spark, df, fn, sink)


def read_run(spark: SparkSession, df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None, sink: str) -> DataFrame:
    """The sink of a run of ``df`` (through ``fn``) as a table; empty if no window ever closed."""
    ensure_dir(sink)
    schema = _batch_schema(spark, df, fn)
    try:
        return read_sink(spark, sink, schema)
    except AnalysisException as e:  # nothing was ever written (no window closed)
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _batch_schema(spark: SparkSession, df: DataFrame, fn) -> StructType:
    """Schema of the sink rows, derived without running anything."""
    empty = spark.createDataFrame([], df.schema)
    return (fn(empty) if fn else empty).schema


def change_parameters(spark: SparkSession, running: StreamingQuery | None, build: Callable[[], DataFrame],
                      fn: Callable[[DataFrame], DataFrame] | None, sink: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """New H, T, k or X -> stop the running query, start the new plan.

    The window width is part of the aggregation state, so the new query gets
    a fresh checkpoint folder, and its output goes to its own
    ``sink/run=<id>`` folder (its batch ids restart at 0 and must not
    replace the previous run's partitions). ``read_sink(sink)`` returns all
    runs with a ``run`` column.
    """
    if running is not None:
        running.stop()
    ck = fresh_path(spark, "stream-ck")
    out = f"{sink.rstrip('/')}/run={ck.rsplit('-', 1)[-1]}"
    df = build()
    return run_foreach_batch(df, fn, out, ck, trigger) if fn else run_append(df, out, ck, trigger)
