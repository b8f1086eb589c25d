from pyspark.sql import functions as F

from flowscope.operators import traffic
from flowscope.operators.windows import keyed_window_agg, window_bytes
from flowscope.sources.flows import flows, parse_flow_lines
from tests.conftest import SF_SMALL
from tests.test_parse import FLOW_LINES


def _ten(spark):
    return parse_flow_lines(spark.createDataFrame([(x,) for x in FLOW_LINES], "value string"))


def test_ten_flow_totals(spark):
    agg = keyed_window_agg(_ten(spark), "protocol", "5 seconds", "1 second")
    w = agg.where(F.col("window_start") == F.lit("2020-05-07 13:15:38").cast("timestamp_ntz"))
    got = {r.protocol: r.bytes for r in w.collect()}
    assert got == {"SSDP": 15698, "UPnP": 15945, "DNS": 10235, "SOAP": 6460}
    assert sum(got.values()) == 48338


def test_ten_flow_heavy_and_topk(spark):
    agg = keyed_window_agg(_ten(spark), "protocol", "5 seconds", "1 second")
    starts = ["2020-05-07 13:15:38", "2020-05-07 13:15:39", "2020-05-07 13:15:40"]
    for s in starts:
        one = agg.where(F.col("window_start") == F.lit(s).cast("timestamp_ntz"))
        heavy = {r.protocol for r in traffic.heavy_hitters(one, "protocol", 0.2).collect()}
        assert heavy == {"UPnP", "SSDP", "DNS"}
        top = [r.protocol for r in traffic.top_k(one, "protocol", 3).orderBy("rank").collect()]
        assert top == ["UPnP", "SSDP", "DNS"]


def test_latest_topk_spills_into_previous_window(spark):
    agg = keyed_window_agg(_ten(spark), "protocol", "5 seconds", "1 second")
    rows = traffic.latest_top_k(agg, "protocol", 3).collect()
    assert len(rows) == 3
    last = agg.agg(F.max("window_start")).collect()[0][0]
    n_last = agg.where(F.col("window_start") == last).count()
    assert sum(r.window_start == last for r in rows) == min(3, n_last)


def test_panes_equal_direct(spark):
    fl = flows(spark, SF_SMALL)
    for key in ("protocol", "source_ip", None):
        a = keyed_window_agg(fl, key, "1 hour", "15 minutes", panes=True)
        b = keyed_window_agg(fl, key, "1 hour", "15 minutes", panes=False)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = window_bytes(fl, "protocol", "40 minutes", "15 minutes")  # pane = gcd = 5 minutes
    b = window_bytes(fl, "protocol", "40 minutes", "15 minutes", panes=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_properties(spark):
    fl = flows(spark, SF_SMALL)
    agg = keyed_window_agg(fl, "source_ip", "1 hour", "15 minutes")
    heavy = traffic.heavy_hitters(agg, "source_ip", 0.2)
    assert heavy.where(F.col("share") > 1).count() == 0
    per_window = heavy.groupBy("window_start").count().agg(F.max("count")).collect()[0][0]
    assert per_window <= 5  # at most floor(1/H) keys pass
    top = traffic.top_k(agg, "source_ip", 3)
    assert top.select("window_start", "source_ip").exceptAll(agg.select("window_start", "source_ip")).count() == 0
    assert top.groupBy("window_start").count().where("count > 3").count() == 0
    dev = traffic.deviants(agg, "source_ip", 2.0)
    assert dev.select("window_start", "source_ip").exceptAll(agg.select("window_start", "source_ip")).count() == 0


def test_single_group_always_deviant(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00", "2020-01-01 00:05:00", "a", 10, 2)],
                               "window_start string, window_end string, protocol string, bytes long, n long")
    out = traffic.deviants(df, "protocol", 2.0).collect()
    assert [r.protocol for r in out] == ["a"]


def test_snapshot_funcs(spark):
    fl = flows(spark, SF_SMALL)
    p = keyed_window_agg(fl, "protocol", "1 hour", "15 minutes")
    i = keyed_window_agg(fl, "source_ip", "1 hour", "15 minutes")
    snap = traffic.snapshot(p, i, 0.2, 3, 2.0)
    funcs = {r.func for r in snap.select("func").distinct().collect()}
    assert funcs <= {f"func{j}" for j in range(1, 7)} and "func2" in funcs and "func5" in funcs
