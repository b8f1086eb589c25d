"""Heavy hitters by a frequent-items summary (F4, O3): candidates first, exact counts for those only.

Pass 1 keeps, in every task and pane, at most ``ceil(1/h)`` weighted counters
(Misra-Gries). A key with more than the share ``h`` of a window has more than
that share of at least one of its (task, pane) parts, because shares of parts
average to the share of the whole, and a summary of c counters never loses a key
with more than 1/(c+1) of its part. So the kept keys of all parts together hold
every heavy key; no summary has to be merged with another, and what leaves the
tasks is at most ``tasks * panes * ceil(1/h)`` rows however many keys there are.

Pass 2 counts the candidates' rows exactly and compares them with the totals
per window. The result is that of ``traffic.heavy_hitters``, without a shuffle
of all (window, key) groups. Sizes must not be negative; rows without a key or a
size count towards the total of their window only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.operators.traffic import WIN
from flowscope.operators.windows import keyed_window_agg, seconds
from flowscope.session import stage

# rows gathered before the counters of a task are cut back
GATHER = 1 << 16


def _cut_back(table: pa.Table, c: int) -> pa.Table:
    """Counters of each pane lowered by its (c+1)-th largest, the positive ones kept: at most ``c``.
    Every cut takes its amount from c+1 counters, so a key loses at most 1/(c+1) of the pane."""
    table = table.group_by(["pane", "key"]).aggregate([("weight", "sum")]).rename_columns(["pane", "key", "weight"])
    table = table.sort_by([("pane", "ascending"), ("weight", "descending")])
    pane = table["pane"].to_numpy()
    weight = table["weight"].to_numpy().copy()
    first = np.flatnonzero(np.r_[True, pane[1:] != pane[:-1]]) if len(pane) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(pane)])
    full = size > c
    cut = np.zeros(len(first), weight.dtype)
    cut[full] = weight[first[full] + c]
    weight -= np.repeat(cut, size)
    table = table.set_column(2, "weight", pa.array(weight))
    return table.filter(pc.greater(table["weight"], 0))


def _summary(c: int):
    schema = pa.schema([("pane", pa.int64()), ("key", pa.string()), ("weight", pa.int64())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        kept, waiting, rows = schema.empty_table(), [], 0
        for b in batches:
            waiting.append(b.cast(schema))
            rows += b.num_rows
            if rows >= GATHER:
                kept, waiting, rows = _cut_back(pa.concat_tables([kept, pa.Table.from_batches(waiting)]), c), [], 0
        kept = _cut_back(pa.concat_tables([kept, pa.Table.from_batches(waiting, schema)]), c)
        yield from kept.select(["pane", "key"]).to_batches()
    return run


def heavy_candidates(fl: DataFrame, key: str, h: float, width, slide=None, value: str = "packet_size",
                     time_col: str = "datetime") -> DataFrame:
    """``window_start, window_end, key``: a superset of the keys above the share ``h`` of a window."""
    t = seconds(width)
    s = seconds(slide) if slide is not None else t
    pane = F.window(time_col, f"{math.gcd(t, s)} seconds").getField("start")
    rows = fl.where(F.col(time_col).isNotNull() & F.col(key).isNotNull() & F.col(value).isNotNull())
    rows = rows.select(F.unix_micros(pane.cast("timestamp")).alias("pane"), F.col(key).cast("string").alias("key"),
                       F.col(value).cast("long").alias("weight"))
    kept = rows.mapInArrow(_summary(math.ceil(1 / h)), "pane long, key string").distinct()
    time_type = fl.schema[time_col].dataType
    w = F.window(F.timestamp_micros("pane").cast(time_type), f"{t} seconds", f"{s} seconds")
    return kept.select(w.alias("w"), F.col("key").alias(key)).select(
        F.col("w.start").alias(WIN[0]), F.col("w.end").alias(WIN[1]), key).distinct()


def frequent_heavy_hitters(fl: DataFrame, key: str, h: float, width, slide=None, value: str = "packet_size",
                           time_col: str = "datetime") -> DataFrame:
    """F1/F4 as ``traffic.heavy_hitters`` over ``keyed_window_agg``, by two passes over the input.

    The candidates are stored first: Spark then chooses the join with the rows by their real
    size. Where they are too many to broadcast, the join shuffles the rows; the result is the same."""
    found = stage(heavy_candidates(fl, key, h, width, slide, value, time_col), "heavy-candidates")
    t = seconds(width)
    s = seconds(slide) if slide is not None else t
    w = F.window(time_col, f"{t} seconds", f"{s} seconds")
    laid = fl.where(F.col(time_col).isNotNull()).select(w.alias("w"), key, value)
    laid = laid.select(F.col("w.start").alias(WIN[0]), F.col("w.end").alias(WIN[1]), key, value)
    counts = laid.join(found, [*WIN, key], "left_semi").groupBy(*WIN, key).agg(F.sum(value).alias("bytes"))
    totals = keyed_window_agg(fl, None, width, slide, value, time_col).select(*WIN, F.col("bytes").alias("total_bytes"))
    heavy = counts.join(totals, WIN).where(F.col("bytes") > F.lit(float(h)) * F.col("total_bytes"))
    return heavy.select(*WIN, key, "bytes", "total_bytes", (F.col("bytes") / F.col("total_bytes")).alias("share"))
