"""The six monitoring functions over a keyed window aggregate (F1-F6, J1,
O4-O7, P8, P9, A12, J3).

Inputs are the output of ``keyed_window_agg``: ``window_start, window_end,
<key>, bytes, n``. The key is a parameter, so the same code serves
protocols, source and destination addresses.

Scale notes
* Per-window statistics (total, spread) are aggregated separately (partial
  aggregation, one row per window) and joined back on the window. Both sides
  of that join carry the same filters and columns (``_shared``), so they read
  one shuffle of the input (``ReusedExchange``): one scan, nothing stored or
  counted while the plan is built. The join strategy is left to Spark, which
  broadcasts by the measured size of the shuffled statistics. No operator
  gathers all keys of a window into one task.
* Adaptive execution, and with it skew splitting, is off inside
  ``foreachBatch``; there a batch holds the windows one trigger closed.
* Top-k per window filters ``row_number() <= k``; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so each task ships at most k rows
  per window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowscope.functions.kbest import k_best

WIN = ["window_start", "window_end"]

def _shared(agg: DataFrame) -> DataFrame:
    """``agg`` with the null filters that the window join would put on one side
    only, so that both sides keep one plan and share its shuffle. Drops nothing:
    a window has bounds."""
    return agg.where(F.col(WIN[0]).isNotNull() & F.col(WIN[1]).isNotNull())


def window_totals(agg: DataFrame) -> DataFrame:
    """A9 from the keyed aggregate: total bytes per window."""
    return agg.groupBy(*WIN).agg(F.sum("bytes").alias("total_bytes"))


def heavy_hitters(agg: DataFrame, key: str, h: float, totals: DataFrame | None = None) -> DataFrame:
    """keys whose bytes exceed ``h`` (a fraction) of the window total.

    ``totals`` defaults to ``window_totals(agg)``. Output: ``window_start, window_end, key, bytes,
    total_bytes, share``. At most ``floor(1/h)`` keys per window can pass.
    """
    agg = _shared(agg)
    totals = window_totals(agg) if totals is None else totals.select(*WIN, "total_bytes")
    j = agg.select(*WIN, key, "bytes").join(totals, WIN)
    return (j.where(F.col("bytes") > F.lit(float(h)) * F.col("total_bytes"))
            .select(*WIN, key, "bytes", "total_bytes",
                    (F.col("bytes") / F.col("total_bytes")).alias("share")))


def top_k(agg: DataFrame, key: str, k: int) -> DataFrame:
    """F2/F5 (intended form, O6): the ``k`` biggest keys of every window.

    Ties are broken by the key ascending. Output: ``window_start, window_end,
    rank, key, bytes``.
    """
    w = Window.partitionBy(*WIN).orderBy(F.desc("bytes"), F.asc(key))
    return (agg.select(*WIN, key, "bytes").withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).select(*WIN, "rank", key, "bytes"))


def latest_top_k(agg: DataFrame, key: str, k: int) -> DataFrame:
    """F2/F5 as coded (O5): one global sort on (window_start desc, bytes desc)
    and the first ``k`` rows, i.e. the biggest keys of the latest window,
    spilling into the previous window when it has fewer than ``k`` keys."""
    return (agg.select(*WIN, key, "bytes")
            .orderBy(F.desc("window_start"), F.desc("bytes"), F.asc(key)).limit(k))


def key_means(agg: DataFrame, key: str) -> DataFrame:
    return agg.select(*WIN, key, F.try_divide("bytes", "n").alias("avg_size"))


def window_spread(agg: DataFrame, key: str) -> DataFrame:
    """Per window, population standard deviation (``_sd``) and mean
    (``_mu``) of the per-key mean packet sizes."""
    return (key_means(agg, key).groupBy(*WIN)
            .agg(F.stddev_pop("avg_size").alias("_sd"), F.avg("avg_size").alias("_mu")))


def window_stats(agg: DataFrame) -> DataFrame:
    """A9 + A12 in one aggregate: per window the byte total and the spread
    (``_sd``) and mean (``_mu``) of the per-key mean packet sizes; serves
    both ``heavy_hitters`` (as ``totals``) and ``deviants`` (as ``stats``)."""
    m = F.try_divide("bytes", "n")
    return agg.groupBy(*WIN).agg(F.sum("bytes").alias("total_bytes"), F.stddev_pop(m).alias("_sd"),
                                 F.avg(m).alias("_mu"))


def deviants(agg: DataFrame, key: str, x: float, center: str = "zero", stats: DataFrame | None = None) -> DataFrame:
    """keys whose mean packet size exceeds ``x`` times the population
    standard deviation of the per-key means of the same window
    (``center='mean'`` adds the mean of those means to the bound).

    ``stats`` defaults to ``window_spread(agg, key)``.
    Output: ``window_start, window_end, key, avg_size``.
    """
    agg = _shared(agg)
    means = key_means(agg, key)
    stats = window_spread(agg, key) if stats is None else stats.select(*WIN, "_sd", "_mu")
    bound = F.lit(float(x)) * F.col("_sd")
    if center == "mean":
        bound = F.col("_mu") + bound
    return means.join(stats, WIN).where(F.col("avg_size") > bound).select(*WIN, key, "avg_size")


def monitor_rows(agg: DataFrame, key: str, h: float, k: int, x: float,
                 funcs: tuple[str, str, str] = ("func1", "func2", "func3")) -> DataFrame:
    """Heavy hitters, top-k and deviants of one keyed aggregate as long rows
    ``window_start, window_end, func, key, value`` (share, bytes, mean size).

    Heavy hitters and deviants come from one join with ``window_stats``; it
    and the top-k read the same shuffle of the input, so the input is
    scanned once.
    """
    # n is a count: the test holds for every row and keeps the column, so that
    # the top-k, which does not need it, has the same aggregate as the others
    agg = _shared(agg).where(F.col("n") >= 0)
    joined = agg.withColumn("_m", F.try_divide("bytes", "n")).join(window_stats(agg), WIN)
    heavy = F.when(F.col("bytes") > F.lit(float(h)) * F.col("total_bytes"),
                   F.struct(F.lit(funcs[0]).alias("func"), F.try_divide("bytes", "total_bytes").alias("value")))
    deviant = F.when(F.col("_m") > F.lit(float(x)) * F.col("_sd"),
                     F.struct(F.lit(funcs[2]).alias("func"), F.col("_m").alias("value")))
    found = (joined.select(*WIN, F.col(key).alias("key"), F.explode(F.array(heavy, deviant)).alias("_r"))
             .where("_r IS NOT NULL").select(*WIN, "_r.func", "key", "_r.value"))
    top = top_k(agg, key, k).select(*WIN, F.lit(funcs[1]).alias("func"), F.col(key).alias("key"),
                                    F.col("bytes").cast("double").alias("value"))
    return found.unionByName(top)


def snapshot(protocol_agg: DataFrame, ip_agg: DataFrame, h: float, k: int, x: float,
             protocol_key: str = "protocol", ip_key: str = "source_ip") -> DataFrame:
    """The six results of every window as one long table
    ``window_start, window_end, func, key, value`` (``func1`` .. ``func6``).

    ``value`` is the share (func1/4), the bytes (func2/5) or the mean size
    (func3/6). A union of the six results replaces the per-window document
    of six lists: the rows stay distributed instead of being gathered per
    window.
    """
    return monitor_rows(protocol_agg, protocol_key, h, k, x, ("func1", "func2", "func3")).unionByName(
        monitor_rows(ip_agg, ip_key, h, k, x, ("func4", "func5", "func6")))


def window_documents(agg: DataFrame, key: str, h: float, k: int, x: float, funcs: tuple[str, str, str]) -> DataFrame:
    """One row per window: ``window_start, window_end`` and a column per function.

    * heavy hitters: array of (bytes, key), largest first; at most ``ceil(1/h)`` keys can pass
    * top-k: array of (bytes, key), largest first
    * deviants: struct of their number and the ``k`` with the largest mean size, as (avg_size, key)

    Each list is a bounded k-best aggregate, so what a window holds does not grow with its keys.
    """
    agg = _shared(agg).where(F.col("n") >= 0)
    joined = agg.withColumn("avg_size", F.try_divide("bytes", "n")).join(window_stats(agg), WIN)
    heavy = F.col("bytes") > F.lit(float(h)) * F.col("total_bytes")
    deviant = F.col("avg_size") > F.lit(float(x)) * F.col("_sd")
    return joined.groupBy(*WIN).agg(
        k_best(key, "bytes", math.ceil(1 / h), heavy).alias(funcs[0]),
        k_best(key, "bytes", k).alias(funcs[1]),
        F.struct(F.count_if(deviant).alias("n"), k_best(key, "avg_size", k, deviant).alias("largest")).alias(funcs[2]))


def documents(protocol_agg: DataFrame, ip_agg: DataFrame, h: float, k: int, x: float,
              protocol_key: str = "protocol", ip_key: str = "source_ip") -> DataFrame:
    """J3 as documents: ``window_start, window_end, func1 .. func6``, one row per window."""
    a = window_documents(protocol_agg, protocol_key, h, k, x, ("func1", "func2", "func3"))
    b = window_documents(ip_agg, ip_key, h, k, x, ("func4", "func5", "func6"))
    return a.join(b, WIN, "full")
