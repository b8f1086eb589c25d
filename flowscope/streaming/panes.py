"""Changing H, T, k and X on a live feed without reading it again.

The stream does one thing that no parameter touches: it aggregates the feed into
panes (key, bytes and rows per small interval) in append mode and writes them to
a log. Every row enters one pane, every file is read once, and the query is never
stopped. Windows and monitoring functions are computed from the log, under the
settings in force: ``change`` adds a line (settings, first pane) to a history,
and each pane belongs to the settings whose span it starts in. Windows that were
open at a change hold the panes up to it, those of the new settings the panes
from it on, so the windows of both together hold every row as often as their own
slide says, whatever the old and the new widths are.

Widths and slides must be whole numbers of panes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowscope.operators.traffic import WIN
from flowscope.operators.windows import seconds
from flowscope.session import stage
from flowscope.streaming.runner import keyed_window_stream

HISTORY = "since timestamp_ntz, width long, slide long, h double, k int, x double"
BEGINNING = "1900-01-01 00:00:00"  # before any feed
SPAN = ["since", *WIN]


@dataclass(frozen=True)
class Settings:
    """T (``width``, sliding by ``slide``), H, k and X."""

    width: str
    slide: str | None
    h: float
    k: int
    x: float


def pane_stream(feed: DataFrame, key: str, pane: str, watermark: str = "1 minute", value: str = "packet_size") -> DataFrame:
    """``window_start, window_end, key, bytes, n`` per pane: what the log holds."""
    return keyed_window_stream(feed, key, pane, None, watermark, value)


def logged_upto(spark: SparkSession, log: str) -> Column:
    """End of the last pane in the log. Panes come in the order of their ends, so all rows before
    it are in. A scalar subquery: nothing runs until it is used."""
    try:
        panes = spark.read.parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" and e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return F.lit(BEGINNING).cast("timestamp_ntz")  # no pane has closed yet
    return F.coalesce(panes.agg(F.max("window_end")).scalar(), F.lit(BEGINNING).cast("timestamp_ntz"))


def change(spark: SparkSession, history: str, settings: Settings, pane: str, log: str | None = None) -> None:
    """New settings for all panes that the log does not hold yet (without ``log``: from the
    beginning). One line is added to the history; the stream goes on."""
    width, slide = seconds(settings.width), seconds(settings.slide or settings.width)
    if width % seconds(pane) or slide % seconds(pane):
        raise ValueError(f"{settings} is not made of panes of {pane}")
    since = F.lit(BEGINNING).cast("timestamp_ntz") if log is None else logged_upto(spark, log)
    line = spark.range(1).select(since.alias("since"), F.lit(width).cast("long").alias("width"), F.lit(slide).cast("long").alias("slide"),
                                 F.lit(settings.h).cast("double").alias("h"), F.lit(settings.k).alias("k"),
                                 F.lit(settings.x).cast("double").alias("x"))
    line.coalesce(1).write.mode("append").parquet(history)


def settings_spans(spark: SparkSession, history: str) -> DataFrame:
    """The history with ``until``, the next line's ``since``; the later of two lines that start
    at the same pane holds. One row per change."""
    lines = spark.read.schema(HISTORY).parquet(history).select("*", F.col("_metadata.file_modification_time").alias("written"))
    last = lines.groupBy("since").agg(F.max_by(F.struct("width", "slide", "h", "k", "x"), "written").alias("s"))
    ends = last.agg(F.array_sort(F.collect_list("since")).alias("all"))
    spans = last.crossJoin(F.broadcast(ends))  # with one row
    after = F.array_min(F.filter("all", lambda t: t > F.col("since")))
    return spans.select("since", after.alias("until"), "s.*")


def _laid(panes: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """``since, at, key, bytes, n``: the sums of every window (start ``at``, in seconds) of every span
    over its own panes."""
    inside = (F.col("window_start") >= F.col("since")) & (F.col("until").isNull() | (F.col("window_start") < F.col("until")))
    # the history is one row per change of the settings by hand
    rows = panes.select("window_start", key, "bytes", "n").join(F.broadcast(spans), inside)
    at = F.unix_seconds(F.col("window_start").cast("timestamp"))
    past = at % F.col("slide")
    # the last window that holds the pane starts at ``at - past``, the first one so many slides earlier
    slides = F.least(F.floor((F.col("width") - past - 1) / F.col("slide")), F.floor((F.col("width") - 1) / F.col("slide")))
    rows = rows.select("since", "slide", key, "bytes", "n", (at - past).alias("last"), slides.alias("slides")).where("slides >= 0")
    rows = rows.select("since", "slide", key, "bytes", "n", "last", F.explode(F.sequence(F.lit(0).cast("long"), "slides")).alias("i"))
    # what a span fixes (width, settings) does not travel with its rows
    return (rows.select("since", (F.col("last") - F.col("i") * F.col("slide")).alias("at"), key, "bytes", "n")
            .groupBy("since", "at", key).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")))


def _under_settings(laid: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with ``since`` and ``at``: instead of ``at`` the bounds of the window, and the settings of the span."""
    rest = [c for c in laid.columns if c not in ("since", "at")]
    return laid.join(F.broadcast(spans.select("since", "width", "h", "k", "x")), "since").select(
        "since", F.timestamp_seconds("at").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_seconds(F.col("at") + F.col("width")).cast("timestamp_ntz").alias("window_end"), *rest, "h", "k", "x")


def windows_by_history(panes: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """``since, window_start, window_end, key, bytes, n`` and the settings of the span: the windows
    of every span over its own panes."""
    return _under_settings(_laid(panes, spans, key), spans)


def monitor_by_history(panes: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """F1 to F3 of every window under the settings of its span: ``since, window_start, window_end,
    func, key, value`` as ``traffic.monitor_rows`` gives them. The windows are laid out once and
    stored; the statistics, the k best and the rows themselves are read from there."""
    laid = stage(_laid(panes, spans, key), "windows").withColumn("mean", F.try_divide("bytes", "n"))
    # stored first, so Spark chooses the join by their real size
    stats = stage(laid.groupBy("since", "at").agg(F.sum("bytes").alias("total"), F.stddev_pop("mean").alias("sd")), "window-stats")
    joined = _under_settings(laid.join(stats, ["since", "at"]), spans)
    heavy = F.when(F.col("bytes") > F.col("h") * F.col("total"),
                   F.struct(F.lit("func1").alias("func"), F.try_divide("bytes", "total").alias("value")))
    deviant = F.when(F.col("mean") > F.col("x") * F.col("sd"), F.struct(F.lit("func3").alias("func"), F.col("mean").alias("value")))
    found = joined.select(*SPAN, F.col(key).alias("key"), F.explode(F.array(heavy, deviant)).alias("r")).where("r IS NOT NULL")
    # ``at`` first: it tells most rows of a sort apart
    rank = F.row_number().over(Window.partitionBy("at", "since").orderBy(F.desc("bytes"), F.asc(key)))
    # the largest k of the history (one row per change) as a number: Spark then drops rows beyond it before the shuffle
    most = spans.agg(F.max("k")).first()[0] or 0
    top = laid.withColumn("_rank", rank).where(F.col("_rank") <= most)
    top = _under_settings(top, spans).where(F.col("_rank") <= F.col("k")).select(
        *SPAN, F.lit("func2").alias("func"), F.col(key).alias("key"), F.col("bytes").cast("double").alias("value"))
    return found.select(*SPAN, "r.func", "key", "r.value").unionByName(top)
