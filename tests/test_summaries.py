"""Frequent items, sketched distinct counts, running sums, documents and the shed report."""

import collections
import datetime as dt
import math
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowscope.operators import distinct, frequent, shedding, traffic
from flowscope.operators.running import running_sums
from flowscope.operators.windows import keyed_window_agg
from flowscope.sources.flows import flows
from flowscope.sources.results import documents_as_text
from tests.conftest import SF_SMALL

W = ("1 hour", "15 minutes")


def skewed(spark, n=20_000):
    """One address with a third of the rows, many with one row; null times, keys and sizes."""
    at = dt.datetime(2024, 1, 1)
    rng = random.Random(4)
    rows = [(at + dt.timedelta(seconds=rng.randrange(6 * 3600)), "10.9.9.9" if i % 3 == 0 else f"10.0.{i % 211}.{i % 97}",
             rng.randrange(2000)) for i in range(n)]
    rows += [(None, "10.9.9.9", 5), (at, None, 50), (at, "10.8.8.8", None)]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, source_ip string, packet_size int")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from("abcdefg"), st.integers(0, 9)), max_size=60),
       st.integers(1, 4), st.integers(1, 5))
def test_summary_never_loses_a_heavy_key(rows, c, batch):
    old, frequent.GATHER = frequent.GATHER, 3
    try:
        schema = pa.schema([("pane", pa.int64()), ("key", pa.string()), ("weight", pa.int64())])
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i:i + batch]], schema)
                   for i in range(0, len(rows), batch)]
        kept = {(r["pane"], r["key"]) for b in frequent._summary(c)(batches) for r in b.to_pylist()}
    finally:
        frequent.GATHER = old
    total, own = collections.Counter(), collections.Counter()
    for p, k, w in rows:
        total[p] += w
        own[p, k] += w
    assert {x for x, w in own.items() if w * (c + 1) > total[x[0]]} <= kept
    assert all(sum(p == q for p, _ in kept) <= c for q in range(3))


@pytest.mark.parametrize("h", [0.05, 0.2, 0.3])
@pytest.mark.parametrize("slide", [None, "15 minutes"])
def test_frequent_equals_exact_heavy_hitters(spark, h, slide):
    fl = skewed(spark).repartition(7)
    a = frequent.frequent_heavy_hitters(fl, "source_ip", h, "1 hour", slide)
    b = traffic.heavy_hitters(keyed_window_agg(fl, "source_ip", "1 hour", slide), "source_ip", h).where("source_ip IS NOT NULL")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert frequent.frequent_heavy_hitters(fl.limit(0), "source_ip", h, "1 hour", slide).count() == 0


def test_candidates_are_few(spark):
    """What pass 1 ships does not grow with the number of keys."""
    at = dt.datetime(2024, 1, 1)
    many = spark.range(50_000).select(F.lit(at).cast("timestamp_ntz").alias("datetime"), F.lit(3).alias("packet_size"),
                                      F.col("id").cast("string").alias("source_ip")).repartition(4)
    assert frequent.heavy_candidates(many, "source_ip", 0.2, "1 hour").count() <= 4 * 5


def test_distinct_counts(spark):
    fl = skewed(spark)
    rows = distinct.distinct_per_window(fl, "source_ip", *W).collect()
    want = {(r.window_start, r.window_end): r.n for r in keyed_window_agg(fl.where("source_ip IS NOT NULL"), "source_ip", *W)
            .groupBy("window_start", "window_end").agg(F.count("*").alias("n")).collect()}
    assert {(r.window_start, r.window_end): r.n_keys for r in rows} == want
    assert all(r.within_bound for r in rows) and max(r.n_keys for r in rows) > 1000
    panes = distinct.pane_sketches(fl, "source_ip", *W, lg_k=10)
    assert max(len(r.sketch) for r in panes.collect()) < 4096  # a sketch has a fixed size
    coarse = distinct.sketched_distinct(panes, *W).collect()
    assert all(abs(r.estimate - want[r.window_start, r.window_end]) <= 1 + distinct.relative_error(10) * want[r.window_start, r.window_end]
               for r in coarse)
    assert distinct.distinct_per_window(fl.limit(0), "source_ip", *W).count() == 0


def test_running_sums(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 13).alias("n"), F.when(F.col("id") % 5 != 0, F.col("id")).alias("m"))
    out = running_sums(df.repartition(9), "k", ["n", "m"], partitions=7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and not [x for x in plan.split("\n") if "Window" in x and "[_range#" not in x]
    got = {r.k: (r.n_upto, r.m_upto, r.n_all, r.m_all) for r in out.collect()}
    a = b = 0
    tot = (sum(i % 13 for i in range(n)), sum(i for i in range(n) if i % 5))
    for i in range(n):
        a, b = a + i % 13, b + (i if i % 5 else 0)
        assert got[i] == (a, b, *tot)
    assert running_sums(df.limit(0), "k", ["n"]).count() == 0


def test_documents(spark):
    fl = flows(spark, SF_SMALL)
    p, i = keyed_window_agg(fl, "protocol", *W), keyed_window_agg(fl, "source_ip", *W)
    docs = traffic.documents(p, i, 0.2, 3, 2.0)
    told = {r.time: r for r in documents_as_text(docs).collect()}
    rows = traffic.snapshot(p, i, 0.2, 3, 2.0).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.window_end, r.func].append((-r.value, r.key))
    assert {r.window_end for r in rows} <= set(told) and len(told) == docs.count()
    for (t, f), found in by.items():
        found = sorted(found)
        if f in ("func3", "func6"):
            assert told[t][f"n_{f}"] == len(found)
            found = found[:3]
        if f in ("func1", "func4"):  # listed by bytes, which order as the shares do
            assert sorted(told[t][f].split(",")) == sorted(k for _, k in found)
        else:
            assert told[t][f] == ",".join(k for _, k in found)
    most = docs.agg(F.max(F.size("func4")), F.max(F.size("func5")), F.max(F.size("func6.largest"))).first()
    assert most[0] <= math.ceil(1 / 0.2) and most[1] <= 3 and most[2] <= 3


def test_shed_report(spark):
    rows = spark.range(4000).select(F.col("id").alias("event_id"))
    report = lambda kept: tuple(shedding.shed_report(rows, kept, "event_id", 0.3).first())
    assert report(rows.where("event_id % 10 < 3")) == (4000, True, True, True)
    assert report(rows.where("event_id % 10 < 4")) == (4000, True, True, False)
    assert report(rows.where("event_id % 10 < 3").unionByName(rows.where("event_id = 1")))[2] is False
    assert report(rows.where("event_id % 10 < 3").unionByName(spark.range(5000, 5001).toDF("event_id")))[1] is False
    assert report(rows.limit(0))[3] is False
