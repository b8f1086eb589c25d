"""Batch analytics over parsed access logs ``(ip, datetime, bytes)``.

Every aggregation is a plain ``groupBy().agg()``: Spark runs it as a partial
(map-side) hash aggregate, a shuffle of one row per key and task, and a final
aggregate, so a hot address costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.functions.parse import subnet16, subnet24


def bytes_by_ip(log: DataFrame, ordered: bool = True) -> DataFrame:
    """A1: total bytes per address, by address as a string (``100.x`` < ``99.x``)."""
    out = log.groupBy("ip").agg(F.sum("bytes").alias("bytes"))
    return out.orderBy("ip") if ordered else out


def top_ips(log: DataFrame, k: int = 10) -> DataFrame:
    """O2/O3: the ``k`` addresses with most bytes (ties by address).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps a
    k-heap over its partial sums, so only k rows per task reach the final merge.
    """
    return bytes_by_ip(log, ordered=False).orderBy(F.desc("bytes"), F.asc("ip")).limit(k)


def summary(log: DataFrame, approx: bool = False) -> DataFrame:
    """A4 + A5: valid lines, distinct addresses, total bytes (one row)."""
    distinct = F.approx_count_distinct("ip") if approx else F.count_distinct("ip")
    return log.agg(F.count(F.lit(1)).alias("n_lines"), distinct.alias("n_ips"),
                   F.sum("bytes").alias("total_bytes"))


def hourly_bytes(log: DataFrame, width: str = "60 minutes", ordered: bool = True) -> DataFrame:
    """Bytes per address per tumbling window (epoch aligned, ``[start, end)``).

    T4: a watermark on a batch frame has no effect, so none is applied here;
    the streaming form (``stream_hourly_bytes``) uses one.
    """
    out = (log.groupBy(F.window("datetime", width).alias("w"), "ip")
           .agg(F.sum("bytes").alias("bytes"))
           .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                   "ip", "bytes"))
    return out.orderBy(F.asc("window_start"), F.desc("bytes"), F.asc("ip")) if ordered else out


def hourly_slice(log: DataFrame, year: int, month: int, day: int, hour: int,
                 ordered: bool = True) -> DataFrame:
    """Bytes per address in the one-hour window starting at the given hour.

    The calendar test on the window bounds is kept, and the equivalent
    range ``start <= datetime < start + 1 hour`` is added, so rows outside the
    hour are dropped before the aggregation (and in the scan when ``datetime``
    is a stored column: a range is pushed down).
    """
    start = F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(day), F.lit(hour), F.lit(0), F.lit(0))
    rows = log.where((F.col("datetime") >= start) & (F.col("datetime") < start + F.expr("INTERVAL 1 HOUR")))
    w = hourly_bytes(rows, ordered=False)
    w = w.where((F.year("window_start") == year) & (F.month("window_start") == month)
                & (F.dayofmonth("window_start") == day) & (F.hour("window_start") == hour)
                & (F.hour("window_end") == (hour + 1) % 24))
    out = w.drop("window_start", "window_end")
    return out.orderBy("ip") if ordered else out


def bytes_by_subnet(log: DataFrame, prefix_len: int = 16, ordered: bool = True) -> DataFrame:
    """A2/A3: bytes per ``a.b.*.*`` (16) or ``a.b.c.*`` (24) prefix."""
    sub = subnet16("ip") if prefix_len == 16 else subnet24("ip")
    out = log.groupBy(sub.alias("subnet")).agg(F.sum("bytes").alias("bytes"))
    return out.orderBy("subnet") if ordered else out
