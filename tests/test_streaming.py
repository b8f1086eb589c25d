import datetime as dt
import os
import time

from pyspark.sql import functions as F

from flowscope.sources.flows import parse_flow_lines, read_flow_text
from flowscope.streaming.runner import as_event_time, keyed_window_stream, run_append, run_to_end

LATE = [  # file, line (read one file per micro-batch, in this order)
    ("a", "2020-05-07_13:15:40.000 DNS 1.1.1.1 2.2.2.2 100"),
    ("b", "2020-05-07_13:25:40.000 DNS 1.1.1.1 2.2.2.2 50"),
    ("c", "2020-05-07_13:25:41.000 DNS 1.1.1.1 2.2.2.2 60"),
    ("d", "2020-05-07_13:15:40.000 SSH 1.1.1.1 2.2.2.2 7"),
    ("e", "2020-05-07_13:45:40.000 NTP 1.1.1.1 2.2.2.2 1"),
]


def _write_files(folder):
    os.makedirs(folder)
    t0 = time.time() - 100
    for i, (name, line) in enumerate(LATE):
        p = os.path.join(folder, f"{name}.txt")
        with open(p, "w") as f:
            f.write(line + "\n")
        os.utime(p, (t0 + i * 10, t0 + i * 10))


def _agg(spark, folder):
    s = as_event_time(parse_flow_lines(read_flow_text(spark, folder, streaming=True, max_files_per_trigger=1)))
    return keyed_window_stream(s, "protocol", "5 seconds", None, watermark="1 minute")


def test_late_rows_append_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write_files(src)
    q = run_append(_agg(spark, src), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 5
    rows = spark.read.parquet(os.path.join(tmp_dir, "out")).collect()
    got = sorted((r.window_start, r.protocol, r.bytes) for r in rows)
    assert got == [(dt.datetime(2020, 5, 7, 13, 15, 40), "DNS", 100),
                   (dt.datetime(2020, 5, 7, 13, 25, 40), "DNS", 110)]


def test_late_rows_complete_mode_keeps_everything(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write_files(src)
    q = (_agg(spark, src).writeStream.outputMode("complete").format("memory").queryName("late_complete")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.protocol, r.bytes) for r in spark.sql("select * from late_complete").collect())
    assert got == [("DNS", 100), ("DNS", 110), ("NTP", 1), ("SSH", 7)]


def test_foreach_batch_stream_equals_batch(spark):
    from flowscope.operators import traffic
    from flowscope.operators.windows import keyed_window_agg
    from flowscope.sources.flows import flows
    from flowscope.streaming.runner import flows_stream
    sf = "/root/testdata/sf0.001"
    agg = keyed_window_stream(flows_stream(spark, sf), "protocol", "1 hour", "15 minutes")
    out = run_to_end(spark, agg, lambda b: traffic.top_k(b, "protocol", 2), kind="t-topk")
    batch = traffic.top_k(keyed_window_agg(flows(spark, sf), "protocol", "1 hour", "15 minutes"), "protocol", 2)
    max_ts = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts")).collect()[0][0]
    closed = batch.where(F.col("window_end") <= F.lit(max_ts - dt.timedelta(minutes=1)))
    assert out.count() > 0
    assert out.exceptAll(closed).count() == 0 and closed.exceptAll(out).count() == 0


def test_stream_panes_equal_direct(spark):
    from flowscope.streaming.runner import flows_stream
    sf = "/root/testdata/sf0.001"
    a = run_to_end(spark, keyed_window_stream(flows_stream(spark, sf), "source_ip", "1 hour", "15 minutes",
                                              panes=True), None, kind="t-panes")
    b = run_to_end(spark, keyed_window_stream(flows_stream(spark, sf), "source_ip", "1 hour", "15 minutes",
                                              panes=False), None, kind="t-direct")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_change_parameters_restarts_on_new_checkpoint(spark, tmp_dir):
    from flowscope.operators import traffic
    from flowscope.streaming.runner import change_parameters, flows_stream, read_sink
    sf = "/root/testdata/sf0.001"
    sink = os.path.join(tmp_dir, "sink")
    q1 = change_parameters(spark, None, lambda: keyed_window_stream(flows_stream(spark, sf), "protocol", "1 hour"),
                           lambda b: traffic.top_k(b, "protocol", 1), sink)
    q1.awaitTermination()
    n1 = read_sink(spark, sink).count()
    q2 = change_parameters(spark, q1, lambda: keyed_window_stream(flows_stream(spark, sf), "protocol", "2 hours"),
                           lambda b: traffic.top_k(b, "protocol", 1), sink)
    q2.awaitTermination()
    runs = read_sink(spark, sink).groupBy("run").count().collect()
    assert n1 > 0 and q2.id != q1.id and len(runs) == 2


def test_console_sink_complete_mode(spark, tmp_dir):
    from flowscope.streaming.runner import flows_stream, latest_top_k_stream, run_console
    agg = keyed_window_stream(flows_stream(spark, "/root/testdata/sf0.001"), "protocol", "1 hour", panes=False)
    q = run_console(latest_top_k_stream(agg, "protocol", 3), mode="complete", trigger={"availableNow": True},
                    checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    assert q.exception() is None and q.lastProgress["numInputRows"] >= 0
