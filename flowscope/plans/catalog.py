"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each one reads the folder's tables (all rows) and composes operators from
``flowscope.operators``; parameters are the documented defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscope import sources as src
from flowscope import streaming as st
from flowscope.operators import distinct, frequent, logs, profile, shedding, traffic
from flowscope.operators.windows import (
    grand_total, keyed_window_agg, running_total, window_avg, window_bytes,
)
from flowscope.session import ensure_dir, fresh_path, stage
from flowscope.sources import results as store
from flowscope.sources.synth import synth_flows as _synth
from flowscope.streaming.chained import joined_heavy_stream, top_k_stream
from flowscope.streaming.feeds import run_drops, run_feed, windows_with_late_rows
from flowscope.streaming.shed import shed_drops
from flowscope.streaming.panes import Settings, change, monitor_by_history, pane_stream, settings_spans
from flowscope.streaming.runner import (
    latest_top_k_stream, read_newest, read_totals, run_latest, run_totals, running_total_stream,
)

# Monitoring parameters for the tables: 30 days of events, so T is an hour
# sliding by 15 minutes; H is a fraction, k a count, X a multiplier.
MONITOR = {"width": "1 hour", "slide": "15 minutes", "h": 0.2, "k": 3, "x": 2.0}
# Shedding rate, selection rates of A and B, repetitions of the experiments.
SHED_RATE = 0.3
RATE_A, RATE_B = 0.5, 0.3
RUNS = 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- logs
@query("log_parse")
def log_parse(spark, sf):
    return src.parsed_log(spark, sf)


@query("log_valid_lines")
def log_valid_lines(spark, sf):
    return src.valid_log_lines(src.log_lines(spark, sf)).select("value")


@query("log_summary")
def log_summary(spark, sf):
    return logs.summary(src.parsed_log(spark, sf))


@query("log_bytes_by_ip")
def log_bytes_by_ip(spark, sf):
    return logs.bytes_by_ip(src.parsed_log(spark, sf))


@query("log_parse_rejects")
def log_parse_rejects(spark, sf):
    return src.log_parse_rejects(src.log_lines(spark, sf), src.EVENTS_YEAR_MONTH)


@query("log_top_ips")
def log_top_ips(spark, sf):
    return logs.top_ips(src.parsed_log(spark, sf), k=10)


@query("log_hourly_bytes")
def log_hourly_bytes(spark, sf):
    return logs.hourly_bytes(src.parsed_log(spark, sf))


@query("log_hourly_slice")
def log_hourly_slice(spark, sf):
    return logs.hourly_slice(src.parsed_log(spark, sf), 2024, 1, 30, 0)


@query("log_bytes_by_subnet16")
def log_bytes_by_subnet16(spark, sf):
    return logs.bytes_by_subnet(src.parsed_log(spark, sf), 16)


@query("log_bytes_by_subnet24")
def log_bytes_by_subnet24(spark, sf):
    return logs.bytes_by_subnet(src.parsed_log(spark, sf), 24)


# ---------------------------------------------------------------- flows
def _fl(spark, sf):
    return src.flows(spark, sf)


def _agg(spark, sf, key, slide=True):
    m = MONITOR
    return keyed_window_agg(_fl(spark, sf), key, m["width"], m["slide"] if slide else None)


@query("flow_parse")
def flow_parse(spark, sf):
    return src.parse_flow_lines(src.flow_lines(spark, sf))


@query("flow_parse_zoned")
def flow_parse_zoned(spark, sf):
    return src.parse_flow_lines(src.flow_lines(spark, sf), zone="America/New_York")


@query("flow_parse_rejects")
def flow_parse_rejects(spark, sf):
    return src.flow_parse_rejects(src.flow_lines(spark, sf))


@query("format_flow_line")
def format_flow_line(spark, sf):
    return src.format_flow_lines(_fl(spark, sf))


@query("flow_grand_total")
def flow_grand_total(spark, sf):
    return grand_total(_fl(spark, sf))


@query("running_total_by_protocol")
def running_total_by_protocol(spark, sf):
    return running_total(_fl(spark, sf), "protocol")


@query("protocol_bytes_tumbling")
def protocol_bytes_tumbling(spark, sf):
    return window_bytes(_fl(spark, sf), "protocol", MONITOR["width"])


@query("topk_protocols_tumbling")
def topk_protocols_tumbling(spark, sf):
    return traffic.top_k(_agg(spark, sf, "protocol", slide=False), "protocol", MONITOR["k"])


@query("protocol_bytes_sliding")
def protocol_bytes_sliding(spark, sf):
    return window_bytes(_fl(spark, sf), "protocol", MONITOR["width"], MONITOR["slide"])


@query("ip_bytes_sliding")
def ip_bytes_sliding(spark, sf):
    return window_bytes(_fl(spark, sf), "source_ip", MONITOR["width"], MONITOR["slide"])


@query("total_bytes_sliding")
def total_bytes_sliding(spark, sf):
    return window_bytes(_fl(spark, sf), None, MONITOR["width"], MONITOR["slide"])


@query("protocol_avg_sliding")
def protocol_avg_sliding(spark, sf):
    return window_avg(_fl(spark, sf), "protocol", MONITOR["width"], MONITOR["slide"])


@query("ip_avg_sliding")
def ip_avg_sliding(spark, sf):
    return window_avg(_fl(spark, sf), "source_ip", MONITOR["width"], MONITOR["slide"])


# ---------------------------------------------------------------- flagship
@query("heavy_protocols")
def heavy_protocols(spark, sf):
    return traffic.heavy_hitters(_agg(spark, sf, "protocol"), "protocol", MONITOR["h"])


@query("topk_protocols")
def topk_protocols(spark, sf):
    return traffic.top_k(_agg(spark, sf, "protocol"), "protocol", MONITOR["k"])


@query("deviant_protocols")
def deviant_protocols(spark, sf):
    return traffic.deviants(_agg(spark, sf, "protocol"), "protocol", MONITOR["x"])


@query("heavy_ips")
def heavy_ips(spark, sf):
    return traffic.heavy_hitters(_agg(spark, sf, "source_ip"), "source_ip", MONITOR["h"])


@query("topk_ips")
def topk_ips(spark, sf):
    return traffic.top_k(_agg(spark, sf, "source_ip"), "source_ip", MONITOR["k"])


@query("frequent_heavy_ips")
def frequent_heavy_ips(spark, sf):
    return frequent.frequent_heavy_hitters(_fl(spark, sf), "source_ip", MONITOR["h"], MONITOR["width"], MONITOR["slide"])


@query("distinct_ips_sliding")
def distinct_ips_sliding(spark, sf):
    counts = distinct.distinct_per_window(_fl(spark, sf), "source_ip", MONITOR["width"], MONITOR["slide"])
    return counts.select("window_start", "window_end", F.col("n_keys").alias("n_ips"), "within_bound")


@query("deviant_ips")
def deviant_ips(spark, sf):
    return traffic.deviants(_agg(spark, sf, "source_ip"), "source_ip", MONITOR["x"])


@query("latest_topk_protocols")
def latest_topk_protocols(spark, sf):
    return traffic.latest_top_k(_agg(spark, sf, "protocol"), "protocol", MONITOR["k"])


@query("latest_topk_ips")
def latest_topk_ips(spark, sf):
    return traffic.latest_top_k(_agg(spark, sf, "source_ip"), "source_ip", MONITOR["k"])


@query("monitor_snapshot")
def monitor_snapshot(spark, sf):
    m = MONITOR
    return traffic.snapshot(_agg(spark, sf, "protocol"), _agg(spark, sf, "source_ip"),
                            m["h"], m["k"], m["x"])


# ---------------------------------------------------------------- shedding
def _shed_in(spark, sf):
    return shedding.shed_input(src.log_lines(spark, sf), "event_id")


@query("shed_hash")
def shed_hash(spark, sf):
    return shedding.hash_shed(_shed_in(spark, sf), "event_id", SHED_RATE)


@query("shed_bernoulli")
def shed_bernoulli(spark, sf):
    return shedding.bernoulli_shed(_shed_in(spark, sf), SHED_RATE, seed=7)


@query("shed_bernoulli_report")
def shed_bernoulli_report(spark, sf):
    rows = _shed_in(spark, sf)
    # the draw is made once and stored: a seeded draw depends on how the rows are split
    return shedding.shed_report(rows, stage(shedding.bernoulli_shed(rows, SHED_RATE, seed=7), "shed"), "event_id", SHED_RATE)


@query("histogram_aligned")
def histogram_aligned(spark, sf):
    lines = _shed_in(spark, sf)
    return shedding.align(shedding.histogram(lines), shedding.histogram(shedding.hash_shed(lines, "event_id", SHED_RATE)))


@query("bytes_histogram")
def bytes_histogram(spark, sf):
    return shedding.histogram(_shed_in(spark, sf))


@query("histogram_wasserstein")
def histogram_wasserstein(spark, sf):
    return shedding.shed_distance(_shed_in(spark, sf), "event_id", SHED_RATE)


@query("shed_sweep")
def shed_sweep(spark, sf):
    return shedding.shed_sweep(_shed_in(spark, sf), "event_id")


@query("shed_accuracy")
def shed_accuracy(spark, sf):
    return shedding.shed_accuracy(_shed_in(spark, sf), "event_id")


# ---------------------------------------------------------------- profiling
@query("filter_chain_ab")
def filter_chain_ab(spark, sf):
    return profile.filter_chain(src.log_lines(spark, sf), "event_id", RATE_A, RATE_B, "ab")


@query("filter_chain_ba")
def filter_chain_ba(spark, sf):
    return profile.filter_chain(src.log_lines(spark, sf), "event_id", RATE_A, RATE_B, "ba")


@query("filter_chain_profile")
def filter_chain_profile(spark, sf):
    return profile.chain_profile(src.log_lines(spark, sf), "event_id", RATE_A, RATE_B)


@query("chain_cost_model")
def chain_cost_model(spark, sf):
    sel = profile.measured_selectivities(src.log_lines(spark, sf), "event_id", runs=1)
    table = sel.select("rate_b", F.lit(1.0).alias("cost_a"), F.lit(1.0).alias("cost_b"), "sel_a", "sel_b",
                       F.lit(1.0).alias("cost_ratio"))
    return profile.cost_model(table)


@query("chain_throughput")
def chain_throughput(spark, sf):
    return profile.experiment_series(src.log_lines(spark, sf), "event_id", runs=1)


def _means(spark, sf):
    return profile.mean_over_runs(profile.experiment_series(src.log_lines(spark, sf), "event_id", runs=RUNS))


@query("mean_over_runs")
def mean_over_runs(spark, sf):
    return _means(spark, sf)


@query("ratio_to_max")
def ratio_to_max(spark, sf):
    return profile.ratio_to_max(_means(spark, sf))


@query("minmax_scale")
def minmax_scale(spark, sf):
    # one row per shed rate: bounded by the rate grid
    return profile.minmax_scale(shed_accuracy(spark, sf), "n_kept", out="load", bounded=True)


@query("weights_to_cdf")
def weights_to_cdf(spark, sf):
    return profile.weights_to_cdf(_fl(spark, sf), "protocol")


@query("synth_flows")
def synth_flows(spark, sf):
    return _synth(src.table(spark, sf, "events"))


# ---------------------------------------------------------------- result store
def _results(spark, sf):
    return store.snapshot_to_results(monitor_snapshot(spark, sf))


def _stored(spark, sf):
    path = fresh_path(spark, "results")
    store.insert(_results(spark, sf), path, batch_id=0)
    return path


@query("results_all")
def results_all(spark, sf):
    return store.read_all(spark, _stored(spark, sf))


@query("results_latest")
def results_latest(spark, sf):
    return store.read_latest(spark, _stored(spark, sf))


@query("results_documents")
def results_documents(spark, sf):
    m = MONITOR
    return store.documents_as_text(traffic.documents(_agg(spark, sf, "protocol"), _agg(spark, sf, "source_ip"),
                                                     m["h"], m["k"], m["x"]))


@query("results_json_roundtrip")
def results_json_roundtrip(spark, sf):
    return store.from_json_lines(store.to_json_lines(_results(spark, sf)))


# ---------------------------------------------------------------- streaming twins
# File stream over the events table, append mode, run until the table is read and
# its end announced (``feeds.run_feed``), so that every window is closed; per-batch
# functions in foreachBatch.
STREAM_WATERMARK = "1 minute"
LOG_WATERMARK = "10 minutes"


def _stream_agg(spark, sf, key, panes="auto"):
    m = MONITOR
    return st.keyed_window_stream(st.flows_stream(spark, sf), key, m["width"], m["slide"], STREAM_WATERMARK,
                                  panes=panes)


def _windowed(feed, key):
    return st.keyed_window_stream(feed, key, MONITOR["width"], MONITOR["slide"], STREAM_WATERMARK)


def _twin(name, key, fn):
    def run(spark, sf):
        return run_feed(spark, st.flows_stream(spark, sf), lambda feed: _windowed(feed, key), fn, kind=name)
    QUERIES[name] = run
    return run


def _heavy_batch(key):
    return lambda b: traffic.heavy_hitters(b, key, MONITOR["h"])


def _deviant_batch(key):
    return lambda b: traffic.deviants(b, key, MONITOR["x"])


_twin("stream_heavy_protocols", "protocol", _heavy_batch("protocol"))
_twin("stream_topk_protocols", "protocol", lambda b: traffic.top_k(b, "protocol", MONITOR["k"]))
_twin("stream_deviant_protocols", "protocol", _deviant_batch("protocol"))
_twin("stream_heavy_ips", "source_ip", _heavy_batch("source_ip"))
_twin("stream_topk_ips", "source_ip", lambda b: traffic.top_k(b, "source_ip", MONITOR["k"]))
_twin("stream_deviant_ips", "source_ip", _deviant_batch("source_ip"))


@query("stream_hourly_bytes")
def stream_hourly_bytes(spark, sf):
    def hourly(feed):
        agg = (feed.withWatermark("datetime", LOG_WATERMARK).groupBy(F.window("datetime", "60 minutes").alias("w"), "ip")
               .agg(F.sum("bytes").alias("bytes")))
        return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"), "ip", "bytes")
    return run_feed(spark, st.log_stream(spark, sf), hourly, kind="stream_hourly_bytes")


@query("stream_late_rows")
def stream_late_rows(spark, sf):
    return windows_with_late_rows(spark, src.flow_drops(spark, sf), "protocol", MONITOR["width"], None, STREAM_WATERMARK)


# settings after the change in the middle of the feed, and the panes that both are made of
CHANGED = Settings("2 hours", "30 minutes", 0.3, 2, 1.5)
PANE = "15 minutes"


@query("stream_changed_parameters")
def stream_changed_parameters(spark, sf):
    """The monitor over a feed of four drops, H, T, k and X changed after the second."""
    m = MONITOR
    log, history = fresh_path(spark, "pane-log"), fresh_path(spark, "settings")
    change(spark, history, Settings(m["width"], m["slide"], m["h"], m["k"], m["x"]), PANE)

    def feed():
        for i, drop in enumerate(src.flow_drops(spark, sf, stragglers=False)):
            if i == 2:
                change(spark, history, CHANGED, PANE, log)
            yield drop

    panes, _ = run_drops(spark, feed(), lambda f: pane_stream(f, "source_ip", PANE, STREAM_WATERMARK), "panes", sink=log)
    return monitor_by_history(panes, settings_spans(spark, history), "source_ip")


# rows that a micro-batch of the shedding stream may keep
CAPACITY = 1500


@query("stream_shed_backlog")
def stream_shed_backlog(spark, sf):
    """Counters per micro-batch of a shedding stream, and what its kept rows hold."""
    kept, counters = shed_drops(spark, src.flow_drops(spark, sf, keep=("event_id",)), "event_id", CAPACITY)
    total = kept.agg(F.sum("packet_size")).scalar()
    return counters.withColumn("kept_bytes", total)


@query("stream_joined_heavy_protocols")
def stream_joined_heavy_protocols(spark, sf):
    m = MONITOR
    return run_feed(spark, st.flows_stream(spark, sf), lambda feed: joined_heavy_stream(
        feed, "protocol", m["h"], m["width"], m["slide"], STREAM_WATERMARK), kind="stream_joined")


@query("stream_append_topk_ips")
def stream_append_topk_ips(spark, sf):
    m = MONITOR
    return run_feed(spark, st.flows_stream(spark, sf), lambda feed: top_k_stream(
        feed, "source_ip", m["k"], m["width"], m["slide"], STREAM_WATERMARK), kind="stream_append_topk")


@query("stream_running_total_by_protocol")
def stream_running_total_by_protocol(spark, sf):
    sink, totals = fresh_path(spark, "running-out"), running_total_stream(st.flows_stream(spark, sf), "protocol")
    run_totals(totals, ["protocol"], sink, fresh_path(spark, "running-ck")).awaitTermination()
    return read_totals(totals, ["protocol"], sink)


def _latest(spark, sf, key):
    # complete mode allows one stateful operator only: direct windows, no panes
    sink, top = fresh_path(spark, "latest-out"), latest_top_k_stream(_stream_agg(spark, sf, key, panes=False), key, MONITOR["k"])
    run_latest(top, sink, fresh_path(spark, "latest-ck")).awaitTermination()
    return read_newest(top, sink)


@query("stream_latest_topk_protocols")
def stream_latest_topk_protocols(spark, sf):
    return _latest(spark, sf, "protocol")


@query("stream_latest_topk_ips")
def stream_latest_topk_ips(spark, sf):
    return _latest(spark, sf, "source_ip")


# ---------------------------------------------------------------- store operations
@query("results_replaced_after_delete")
def results_replaced_after_delete(spark, sf):
    """Insert, delete all, insert the top-k rows only, insert them again (a replay)."""
    path = _stored(spark, sf)
    rows = stage(store.read_all(spark, path).where("func IN ('func2', 'func5')"), "replay")
    store.delete_all(spark, path)
    for _ in range(2):
        store.insert(rows, path, batch_id=1)
    return store.read_all(spark, path)


# ---------------------------------------------------------------- text scans
@query("log_text_bytes_by_ip")
def log_text_bytes_by_ip(spark, sf):
    lines = src.read_log_text(spark, src.log_text_path(spark, sf))
    return logs.bytes_by_ip(src.parse_log_lines(lines, src.EVENTS_YEAR_MONTH))


@query("flow_text_parse")
def flow_text_parse(spark, sf):
    return src.parse_flow_lines(src.read_flow_text(spark, src.flow_text_path(spark, sf)))
