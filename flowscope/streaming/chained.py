"""Monitoring functions on streams without ``foreachBatch``: chained stateful operators in append mode.

All state is bounded by the watermark: aggregates drop a window when it ends,
the stream-stream join drops both sides of it, and the k-best aggregate holds
at most k keys per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.functions.kbest import k_best


def _windowed(stream: DataFrame, width: str, slide: str | None, watermark: str, time_col: str):
    return stream.withWatermark(time_col, watermark), F.window(time_col, width, slide or width).alias("w")


def _bounds() -> list:
    return [F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end")]


def joined_heavy_stream(stream: DataFrame, key: str, h: float, width: str, slide: str | None = None,
                        watermark: str = "1 minute", value: str = "packet_size", time_col: str = "datetime") -> DataFrame:
    """J1 + F1/F4: the keyed sums of each window joined, as streams, with the window's total;
    keys above ``h`` times the total. Rows as ``traffic.heavy_hitters`` gives them.

    Both sides are windowed aggregates of the same stream and are joined on the window, so each
    window meets its total once, when it closes, and both leave the join's state with it."""
    wm, w = _windowed(stream, width, slide, watermark, time_col)
    sums = wm.groupBy(w, key).agg(F.sum(value).alias("bytes"))
    totals = wm.groupBy(w).agg(F.sum(value).alias("total_bytes"))
    heavy = sums.join(totals, "w").where(F.col("bytes") > F.lit(float(h)) * F.col("total_bytes"))
    return heavy.select(*_bounds(), key, "bytes", "total_bytes", (F.col("bytes") / F.col("total_bytes")).alias("share"))


def top_k_stream(stream: DataFrame, key: str, k: int, width: str, slide: str | None = None,
                 watermark: str = "1 minute", value: str = "packet_size", time_col: str = "datetime") -> DataFrame:
    """F2/F5 (O6): the ``k`` biggest keys of every window. A second aggregate, chained to the keyed
    sums, keeps a queue of ``k`` keys per window (``k_best``). Rows as ``traffic.top_k`` gives them."""
    wm, w = _windowed(stream, width, slide, watermark, time_col)
    sums = wm.groupBy(w, key).agg(F.sum(value).alias("bytes"))
    best = sums.groupBy("w").agg(k_best(key, "bytes", k).alias("best"))
    return best.select("w", F.posexplode("best").alias("at", "b")).select(
        *_bounds(), (F.col("at") + 1).alias("rank"), F.col(f"b.{key}").alias(key), F.col("b.bytes").alias("bytes"))
