from pyspark.sql import functions as F

from flowscope.operators import profile
from flowscope.sources.logs import log_lines
from flowscope.sources.synth import PROTOCOLS, cdf_of, normalise_weights, synth_flows
from flowscope.sources.tables import table
from tests.conftest import SF_SMALL


def test_cost_model_hand_case(spark):
    t = spark.createDataFrame([(2.0, 4.0, 0.5, 0.25, 1.0)], "cost_a double, cost_b double, sel_a double, sel_b double, cost_ratio double")
    r = profile.cost_model(t).collect()[0]
    assert (r.cost_ab, r.cost_ba, r.cost_fused) == (4.0, 4.5, 3.0)


def test_chain_orders_equal(spark):
    lines = log_lines(spark, SF_SMALL)
    ab = profile.filter_chain(lines, "event_id", 0.5, 0.3, "ab")
    ba = profile.filter_chain(lines, "event_id", 0.5, 0.3, "ba")
    assert ab.exceptAll(ba).count() == 0 and ba.exceptAll(ab).count() == 0
    p = profile.chain_profile(lines, "event_id", 0.5, 0.3).collect()[0]
    assert p.n_ab == ab.count() and p.n_in == lines.count()
    assert p.best_order == ("A,B" if p.sel_a <= p.sel_b else "B,A")


def test_series_shape_and_means(spark):
    lines = log_lines(spark, SF_SMALL)
    s = profile.experiment_series(lines, "event_id", runs=3)
    counts = {(r.experiment, r.variant): r["count"] for r in s.groupBy("experiment", "variant").count().collect()}
    assert counts == {("reorder", "A_B"): 297, ("reorder", "B_A"): 297, ("fusion", "A_B"): 147, ("fusion", "AB"): 147}
    m = profile.mean_over_runs(s)
    r = profile.ratio_to_max(m)
    assert r.where((F.col("variant") == "A_B")).agg(F.max("ratio")).collect()[0][0] == 1.0


def test_minmax_scale(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 9.0)], "k int, x double")
    for kw in ({}, {"bounded": True}):
        got = [r.scaled for r in profile.minmax_scale(df, "x", **kw).orderBy("k").collect()]
        assert got == [0.0, 0.5, 1.0]


def test_weights_to_cdf_ends_at_one(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "p string")
    rows = profile.weights_to_cdf(df, "p").orderBy("idx").collect()
    assert [r.cdf for r in rows] == [0.25, 0.75, 1.0]


def test_normalise_weights():
    w = [0.1, 0.2, 0.7]
    assert normalise_weights(w, 3) == w and normalise_weights(w, 4) == [0.25] * 4
    cdf_of(w)
    assert w == [0.1, 0.2, 0.7]  # not mutated


def test_synth_flows_distribution(spark):
    ev = table(spark, "/root/testdata/sf0.01", "events")
    out = synth_flows(ev, protocol_num=4, protocol_weights=[0.7, 0.1, 0.1, 0.1]).cache()
    n = out.count()
    assert n == ev.count()
    share = {r.protocol: r["count"] / n for r in out.groupBy("protocol").count().collect()}
    assert set(share) <= set(PROTOCOLS[:4]) and abs(share["SOAP"] - 0.7) < 0.03
    sizes = out.agg(F.min("packet_size"), F.max("packet_size")).collect()[0]
    assert 16 <= sizes[0] and sizes[1] <= 12288
