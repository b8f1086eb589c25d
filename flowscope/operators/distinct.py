"""Distinct keys per window (A5), exact and by mergeable sketches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscope.operators.traffic import WIN
from flowscope.operators.windows import seconds

LG_K = 14


def relative_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Bound on the relative error of a sketch with 2^lg_k registers, in standard errors (1.04 / sqrt(registers))."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def _windows(time_col: Column | str, width, slide) -> Column:
    t = seconds(width)
    return F.window(time_col, f"{t} seconds", f"{seconds(slide) if slide is not None else t} seconds")


def pane_sketches(fl: DataFrame, key: str, width, slide=None, time_col: str = "datetime", lg_k: int = LG_K) -> DataFrame:
    """``pane, sketch``: one HyperLogLog sketch of the keys of every pane (``gcd(width, slide)``).
    A row is hashed once; sketches of a fixed size are all that is shuffled, stored and merged."""
    t = seconds(width)
    pane = F.window(time_col, f"{math.gcd(t, seconds(slide) if slide is not None else t)} seconds").getField("start")
    rows = fl.where(F.col(time_col).isNotNull() & F.col(key).isNotNull())
    return rows.groupBy(pane.alias("pane")).agg(F.hll_sketch_agg(F.col(key).cast("string"), F.lit(lg_k)).alias("sketch"))


def sketched_distinct(panes: DataFrame, width, slide=None) -> DataFrame:
    """``window_start, window_end, estimate``: pane sketches merged into sliding windows."""
    merged = panes.groupBy(_windows("pane", width, slide).alias("w")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return merged.select(F.col("w.start").alias(WIN[0]), F.col("w.end").alias(WIN[1]), "estimate")


def exact_distinct(fl: DataFrame, key: str, width, slide=None, time_col: str = "datetime") -> DataFrame:
    """``window_start, window_end, n_keys``: keys counted per window through (window, key) groups."""
    rows = fl.where(F.col(time_col).isNotNull() & F.col(key).isNotNull())
    keys = rows.groupBy(_windows(time_col, width, slide).alias("w"), key).agg(F.lit(1).alias("one"))
    counts = keys.groupBy("w").agg(F.count(F.lit(1)).alias("n_keys"))
    return counts.select(F.col("w.start").alias(WIN[0]), F.col("w.end").alias(WIN[1]), "n_keys")


def distinct_per_window(fl: DataFrame, key: str, width, slide=None, time_col: str = "datetime",
                        lg_k: int = LG_K) -> DataFrame:
    """Both counts side by side: ``window_start, window_end, n_keys, estimate, within_bound``, the last
    telling whether the estimate is off by at most ``relative_error`` of the count, or one key."""
    both = exact_distinct(fl, key, width, slide, time_col).join(
        sketched_distinct(pane_sketches(fl, key, width, slide, time_col, lg_k), width, slide), WIN, "full")
    off = F.abs(F.col("n_keys") - F.col("estimate"))
    bound = F.greatest(F.lit(1.0), F.lit(relative_error(lg_k)) * F.col("n_keys"))
    return both.withColumn("within_bound", F.coalesce(off <= bound, F.lit(False)))
