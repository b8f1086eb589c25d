"""Finite feeds: the end closes every window, drops make late rows, chained operators equal the batch functions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from flowscope.functions.kbest import k_best
from flowscope.operators import traffic
from flowscope.operators.windows import keyed_window_agg
from flowscope.sources.flows import flow_drops, flows
from flowscope.streaming.chained import joined_heavy_stream, top_k_stream
from flowscope.streaming.feeds import EndOfInput, run_drops, run_feed, windows_with_late_rows
from flowscope.streaming.runner import flows_stream, keyed_window_stream, run_append
from tests.conftest import SF_SMALL

W = ("1 hour", "15 minutes")
SCHEMA = "datetime timestamp, protocol string, source_ip string, packet_size int"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


def frame(spark, rows):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(at + dt.timedelta(seconds=s), p, f"10.0.0.{i}", n) for s, p, i, n in rows], SCHEMA)


@pytest.mark.parametrize("panes", [False, True])
def test_end_closes_every_window(spark, panes):
    out = run_feed(spark, flows_stream(spark, SF_SMALL),
                   lambda feed: keyed_window_stream(feed, "source_ip", *W, panes=panes))
    assert same(out, keyed_window_agg(flows(spark, SF_SMALL), "source_ip", *W))


def test_end_after_many_micro_batches(spark, tmp_dir):
    """One file per trigger, out of order within the delay: no row is late, the end comes last."""
    rows = [(60 * ((7 * i) % 5 + i), "tcp" if i % 3 else "udp", i % 4, 10 + i) for i in range(12)]
    schema, path = frame(spark, rows[:1]).schema, os.path.join(tmp_dir, "in")
    for i in range(0, 12, 4):
        frame(spark, rows[i:i + 4]).coalesce(1).write.mode("append").parquet(path)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = run_feed(spark, feed, lambda f: keyed_window_stream(f, "protocol", "5 minutes", None, "30 minutes"))
    assert same(out, keyed_window_agg(frame(spark, rows), "protocol", "5 minutes").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))


def test_rows_after_the_end_are_late(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    end = EndOfInput(spark)

    def run():
        feed = spark.readStream.schema(frame(spark, [(0, "a", 1, 1)]).schema).parquet(src)
        run_append(keyed_window_stream(end.follow(feed), "protocol", "1 minute"), sink, ck).awaitTermination()
        return spark.read.parquet(sink).count()

    frame(spark, [(0, "a", 1, 5), (200, "b", 1, 6)]).write.parquet(src)
    assert run() == 1
    end.announce()
    assert run() == 2
    frame(spark, [(10_000, "c", 1, 7)]).write.mode("append").parquet(src)
    assert run() == 2


def test_empty_feed(spark, tmp_dir):
    empty = frame(spark, [(0, "a", 1, 1)]).limit(0)
    empty.write.parquet(os.path.join(tmp_dir, "in"))
    feed = spark.readStream.schema(empty.schema).parquet(os.path.join(tmp_dir, "in"))
    out = run_feed(spark, feed, lambda f: top_k_stream(f, "source_ip", 2, "1 minute"))
    assert out.count() == 0 and "rank" in out.columns


def test_joined_heavy_hitters_and_state(spark):
    out = run_feed(spark, flows_stream(spark, SF_SMALL), lambda f: joined_heavy_stream(f, "protocol", 0.2, *W))
    assert same(out, traffic.heavy_hitters(keyed_window_agg(flows(spark, SF_SMALL), "protocol", *W), "protocol", 0.2))


def test_joined_plan_is_a_stream_join(spark, tmp_dir):
    df = joined_heavy_stream(flows_stream(spark, SF_SMALL), "protocol", 0.2, *W)
    q = run_append(df, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    ops = [o["operatorName"] for o in q.recentProgress[0]["stateOperators"]]
    assert ops.count("symmetricHashJoin") == 1 and ops.count("stateStoreSave") == 2
    last = [o for o in q.lastProgress["stateOperators"] if o["operatorName"] == "symmetricHashJoin"][0]
    assert last["numRowsTotal"] < 50  # windows that closed have left the join


def test_append_top_k(spark):
    agg = keyed_window_agg(flows(spark, SF_SMALL), "source_ip", *W)
    for k in (1, 3):
        out = run_feed(spark, flows_stream(spark, SF_SMALL), lambda f: top_k_stream(f, "source_ip", k, *W))
        assert same(out, traffic.top_k(agg, "source_ip", k))


def test_k_best_ties_and_filter(spark):
    rows = spark.createDataFrame([("w", "b", 5), ("w", "a", 5), ("w", "c", 9), ("w", "d", 1), ("v", "z", 2)], "w string, key string, x long")
    got = {r.w: [(e.key, e.x) for e in r.best] for r in rows.groupBy("w").agg(k_best("key", "x", 2).alias("best")).collect()}
    assert got == {"w": [("c", 9), ("a", 5)], "v": [("z", 2)]}
    some = rows.groupBy("w").agg(k_best("key", "x", 2, F.col("x") < 5).alias("best")).collect()
    assert {r.w: [e.key for e in r.best] for r in some} == {"w": ["d"], "v": ["z"]}


def test_late_rows_are_counted(spark):
    """Minute windows, a delay of one minute: the cut-off of a drop is the largest time of the drops
    before, less a minute; a row is late for windows that ended by then."""
    drops = [[(0, "a", 1, 1), (30, "a", 1, 2), (300, "b", 1, 3)],  # cut-off of the next drop: 240
             [(10, "a", 1, 100), (179, "a", 1, 100), (180, "a", 1, 4), (239, "b", 1, 5), (600, "a", 1, 6)],  # then 540
             [(299, "b", 1, 100), (540, "a", 1, 7), (479, "c", 1, 100), (480, "c", 1, 100)]]
    out = windows_with_late_rows(spark, [frame(spark, d) for d in drops], "protocol", "1 minute").collect()
    got = sorted(((r.window_start - dt.datetime(2024, 1, 1)).seconds, r.protocol, r.bytes, r.n) for r in out)
    # 180..239 ends at 240 and is late, too: its end is not behind the cut-off
    assert got == [(0, "a", 3, 2), (300, "b", 3, 1), (540, "a", 7, 1), (600, "a", 6, 1)]
    assert {r.late_rows for r in out} == {7}


def test_late_rows_of_sliding_windows(spark):
    """A straggler can be late for its older windows and in time for its newer ones."""
    drops = [[(0, "a", 1, 1), (400, "a", 1, 1)], [(290, "a", 1, 10)]]
    out = windows_with_late_rows(spark, [frame(spark, d) for d in drops], "protocol", "2 minutes", "1 minute")
    rows = {(r.window_start - dt.datetime(2024, 1, 1)).total_seconds(): r.bytes for r in out.collect()}
    # cut-off 340: of 290's windows, [180, 300) has ended and [240, 360) has not
    assert rows == {-60.0: 1, 0.0: 1, 240.0: 10, 300.0: 1, 360.0: 1}
    assert {r.late_rows for r in out.collect()} == {1}


def test_drops_hold_every_flow_once(spark):
    drops = flow_drops(spark, SF_SMALL)
    assert len(drops) == 4 and sum(d.count() for d in drops) == flows(spark, SF_SMALL).count()
    agg = lambda f: keyed_window_stream(f, "protocol", "1 hour", None, "30 days")
    out, arrived = run_drops(spark, drops, agg)
    assert same(out, keyed_window_agg(flows(spark, SF_SMALL), "protocol", "1 hour"))  # a long delay: nothing is late
    with pytest.raises(ValueError):
        run_drops(spark, [], agg)


def test_change_loses_and_repeats_no_row(spark, tmp_dir):
    """Tumbling windows of 4 minutes, then of 6: a change between two drops, in the middle of a
    window of either width. Every pane is in one window, every file is read once."""
    from flowscope.streaming.panes import Settings, change, monitor_by_history, pane_stream, settings_spans, windows_by_history
    log, history = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "history")
    drops = [[(60 * m + 1, f"p{m % 3}", 1, 2 ** m) for m in range(9)], [(60 * m + 1, f"p{m % 3}", 1, 2 ** m) for m in range(9, 20)]]
    change(spark, history, Settings("4 minutes", None, 0.5, 1, 2.0), "1 minute")

    def feed():
        yield frame(spark, drops[0])
        change(spark, history, Settings("5 minutes", None, 0.5, 1, 2.0), "1 minute", log)
        change(spark, history, Settings("6 minutes", None, 0.1, 2, 2.0), "1 minute", log)  # replaces it: no pane in between
        yield frame(spark, drops[1])

    panes, read = run_drops(spark, feed(), lambda f: pane_stream(f, "protocol", "1 minute"), sink=log)
    spans = settings_spans(spark, history)
    assert spans.count() == 2
    rows = windows_by_history(panes, spans, "protocol").collect()
    start = dt.datetime(2024, 1, 1)
    got = {}
    for r in rows:
        w = (int((r.window_start - start).total_seconds() // 60), int((r.window_end - start).total_seconds() // 60))
        got[w] = got.get(w, 0) + r.bytes
    # the cut-off after the first drop lies in minute 7: panes 0 to 6 are logged
    want = {(0, 4): range(0, 4), (4, 8): range(4, 7), (6, 12): range(7, 12), (12, 18): range(12, 18), (18, 24): range(18, 20)}
    assert got == {w: sum(2 ** m for m in v) for w, v in want.items()}
    assert sum(got.values()) == 2 ** 20 - 1 and sum(r.n for r in rows) == 20
    found = monitor_by_history(panes, spans, "protocol").where("func = 'func2'").groupBy("since").agg(F.max("value")).count()
    assert found == 2
    with pytest.raises(ValueError):
        change(spark, history, Settings("90 seconds", None, 0.5, 1, 2.0), "1 minute", log)


def test_change_before_any_pane(spark, tmp_dir):
    from flowscope.streaming.panes import Settings, change, settings_spans
    history = os.path.join(tmp_dir, "history")
    for k in (1, 2):
        change(spark, history, Settings("4 minutes", None, 0.5, k, 2.0), "1 minute", os.path.join(tmp_dir, "no-log"))
    assert [(r.k, r.until) for r in settings_spans(spark, history).collect()] == [(2, None)]


def test_shedding_follows_the_backlog(spark):
    """Small batches pass whole, large ones are cut to about the capacity; kept rows are a subset."""
    from flowscope.streaming.shed import shed_drops

    def rows(lo, n):
        return spark.range(lo, lo + n).select(F.col("id").alias("event_id"), (F.col("id") * 2).alias("x"))

    kept, counters = shed_drops(spark, [rows(0, 300), rows(1000, 4000), rows(9000, 8000), rows(20000, 0)], "event_id", 1000)
    got = {r.batch_id: r for r in counters.collect()}
    assert (got[0].n_in, got[0].n_kept, got[0].rate) == (300, 300, 1.0)
    sizes = [got[b].n_in for b in sorted(got)]
    assert sizes == [300, 4000, 8000] and all(abs(got[b].n_kept - 1000) < 150 for b in sorted(got)[1:])
    ids = [r.event_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == sum(r.n_kept for r in got.values())
    assert set(ids) <= {*range(300), *range(1000, 5000), *range(9000, 17000)}


@pytest.mark.parametrize("width,slide,k", [("6 minutes", "4 minutes", 2), ("2 minutes", "5 minutes", 1), ("3 minutes", None, 1200)])
def test_windows_are_laid_out_once(spark, tmp_dir, width, slide, k):
    """The pane log is read once, rows beyond the largest k go before the shuffle, and windows that
    overlap, leave gaps or hold fewer keys than k are those of plain Python."""
    from flowscope.operators.windows import seconds
    from flowscope.streaming.panes import Settings, change, monitor_by_history, settings_spans
    log, history = os.path.join(tmp_dir, "panes"), os.path.join(tmp_dir, "history")
    start, minute = dt.datetime(2024, 1, 1), dt.timedelta(minutes=1)
    panes = [(start + m * minute, start + (m + 1) * minute, f"p{i}" if i else None, None if (m + i) % 7 == 6 else (m * i) % 5 * 10 + i, 1 + i % 2)
             for m in range(20) for i in range(4)]
    spark.createDataFrame(panes[: 4 * 7], "window_start timestamp_ntz, window_end timestamp_ntz, protocol string, bytes long, n long").write.parquet(log)
    change(spark, history, Settings("2 minutes", "1 minute", 0.3, 3, 1.5), "1 minute")
    change(spark, history, Settings(width, slide, 0.3, k, 1.5), "1 minute", log)
    spark.createDataFrame(panes[4 * 7:], spark.read.parquet(log).schema).write.mode("append").parquet(log)
    out = monitor_by_history(spark.read.parquet(log), settings_spans(spark, history), "protocol")

    sums = {}
    for at, _, key, size, n in panes:
        m, later = int((at - start) / minute), at >= start + 7 * minute
        w, s = (seconds(width) // 60, seconds(slide or width) // 60) if later else (2, 1)
        base = int((start - dt.datetime(1970, 1, 1)) / minute)  # windows are aligned to the epoch
        for first in range((base + m) // s * s, base + m - w, -s):
            b, c = sums.setdefault((later, first - base, w), {}).get(key, (None, 0))
            sums[later, first - base, w][key] = (b if size is None else (b or 0) + size, c + n)
    want = set()
    for (later, first, w), keys in sums.items():
        total = sum(b for b, _ in keys.values() if b is not None)
        means = {key: b / n for key, (b, n) in keys.items() if b is not None}
        centre = sum(means.values()) / max(1, len(means))
        sd = (sum((x - centre) ** 2 for x in means.values()) / max(1, len(means))) ** 0.5
        best = sorted(keys, key=lambda key: (keys[key][0] is None, -(keys[key][0] or 0), key is not None, key or ""))
        got = [("func1", key, b / total) for key, (b, _) in keys.items() if b is not None and b > 0.3 * total]
        got += [("func3", key, x) for key, x in means.items() if x > 1.5 * sd]
        got += [("func2", key, keys[key][0]) for key in best[: k if later else 3]]
        want |= {(later, first, first + w, f, key, None if v is None else round(v, 9)) for f, key, v in got}
    rows = [(r.since.year > 1900, int((r.window_start - start) / minute), int((r.window_end - start) / minute), r.func, r.key,
             None if r.value is None else round(r.value, 9)) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert not [f for f in out.inputFiles() if "/panes/" in f] and len([f for f in out.inputFiles() if "/windows-" in f]) > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("WindowGroupLimit" in plan) == (max(k, 3) < 1000)
