"""Physical-plan checks of the registered queries (scale properties).

* no cartesian / nested-loop joins and no Python evaluation in any plan;
* scans of ``events`` read only the columns they need (never ``props``);
* top-k per window places a partial ``WindowGroupLimit`` below its shuffle;
* each query scans each input a bounded number of times.
"""
import re

import pytest

from __spark_entry__ import queries
from flowscope.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

STREAMING = {q for q in QUERIES if q.startswith("stream_")}
BATCH = sorted(set(QUERIES) - STREAMING)


def _plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(spark, name) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_python(plans, name):
    p = plans[name]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


@pytest.mark.parametrize("name", BATCH)
def test_events_scans_are_pruned(plans, name):
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]):
        assert "props" not in schema, (name, schema)


@pytest.mark.parametrize("name", ["topk_protocols", "topk_ips", "topk_protocols_tumbling"])
def test_topk_partial_limit_before_shuffle(plans, name):
    p = plans[name]
    assert "WindowGroupLimit" in p
    lines = p.splitlines()
    partial = [i for i, s in enumerate(lines) if "WindowGroupLimit" in s]
    exchange = [i for i, s in enumerate(lines) if "Exchange hashpartitioning(window_start" in s]
    assert exchange and max(partial) > min(exchange), "a WindowGroupLimit must sit below the window shuffle"


# Scans named in the initial plan, before exchanges are reused: the snapshot names
# each key's input three times (rows, statistics, top-k), see
# test_monitor_scans_input_once. The latest results read the small store twice
# (rows and the max-time subquery).
# Frequent items read the small candidate table besides rows and totals; documents
# read each key's rows and statistics.
SCAN_LIMIT = {"frequent_heavy_ips": 3, "results_documents": 8, "monitor_snapshot": 10, "results_json_roundtrip": 10, "results_latest": 3}


@pytest.mark.parametrize("name", BATCH)
def test_bounded_input_scans(plans, name):
    initial = plans[name].split("== Initial Plan ==")[-1]
    n = len(re.findall(r"FileScan|(?<!File)Scan parquet", initial))
    assert n <= SCAN_LIMIT.get(name, 2), (name, n)


@pytest.mark.parametrize("name", BATCH)
def test_aggregations_combine_map_side(plans, name):
    """Every shuffled aggregation is split into a map-side partial aggregate
    and a final one, so a key holding a large share of the rows leaves each
    task as a single partial row."""
    p = plans[name]
    if "HashAggregate" in p and "Exchange hashpartitioning" in p:
        assert "partial_" in p, name


@pytest.mark.parametrize("name,keys", [("heavy_protocols", 1), ("heavy_ips", 1), ("deviant_protocols", 1),
                                       ("deviant_ips", 1), ("monitor_snapshot", 2)])
def test_monitor_scans_input_once(spark, name, keys):
    """Rows and per-window statistics of a key share one scan and shuffle, and
    nothing is stored or counted while the plan is built."""
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        df = queries()[name](spark, SF_SMALL)
        # a job that reads the parquet footer for the schema is no work on rows
        built = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(built) <= keys
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) == keys
    assert final.count("ReusedExchange") >= keys


def test_rows_without_time_have_no_window(spark):
    from flowscope.operators.windows import keyed_window_agg
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 00:00:05', 'a', 3), (NULL, 'a', 4), "
                     "(TIMESTAMP_NTZ'2024-01-01 00:00:06', NULL, NULL) AS t(datetime, protocol, packet_size)")
    for slide in ("10 seconds", "5 seconds", "1 second"):
        got = keyed_window_agg(rows, "protocol", "10 seconds", slide).groupBy("protocol").sum("bytes", "n").collect()
        f = {"10 seconds": 1, "5 seconds": 2, "1 second": 10}[slide]
        assert {(r[0], r[1], r[2]) for r in got} == {("a", 3 * f, f), (None, None, 0)}
