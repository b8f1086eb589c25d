"""A hot key holding a third of all rows: results equal a brute force, with
the statistics broadcast and with a forced shuffle join."""
import pandas as pd
from pyspark.sql import functions as F

from flowscope.operators import traffic
from flowscope.operators.windows import keyed_window_agg
from flowscope.sources.flows import flows

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    fl = flows(spark, SF, keep=("event_id",))
    hot = F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("10.9.9.9")).otherwise(F.col("source_ip"))
    return fl.withColumn("source_ip", hot).drop("event_id")


def _brute(pdf: pd.DataFrame):
    """Sliding 1 h / 15 min windows by explicit expansion in pandas."""
    rows = []
    for off in range(4):
        start = pdf["datetime"].dt.floor("15min") - pd.Timedelta(minutes=15 * off)
        rows.append(pdf.assign(window_start=start))
    e = pd.concat(rows)
    g = e.groupby(["window_start", "source_ip"]).packet_size.agg(["sum", "count"]).reset_index()
    g["total"] = g.groupby("window_start")["sum"].transform("sum")
    return g


def test_hot_key_heavy_topk_deviant(spark):
    fl = _skewed(spark)
    agg = keyed_window_agg(fl, "source_ip", "1 hour", "15 minutes")
    g = _brute(fl.toPandas())
    assert (fl.where(F.col("source_ip") == "10.9.9.9").count() * 3) >= fl.count() - 3

    want_heavy = {(r.window_start, r.source_ip) for r in g[g["sum"] > 0.2 * g["total"]].itertuples()}
    for hint in ("broadcast", "shuffle_merge"):  # both joins
        heavy = traffic.heavy_hitters(agg, "source_ip", 0.2, traffic.window_totals(agg).hint(hint))
        got = {(pd.Timestamp(r.window_start), r.source_ip) for r in heavy.collect()}
        assert got == want_heavy

    g = g.sort_values(["window_start", "sum", "source_ip"], ascending=[True, False, True])
    want_top = {(r.window_start, r.source_ip) for r in g.groupby("window_start").head(3).itertuples()}
    got_top = {(pd.Timestamp(r.window_start), r.source_ip) for r in traffic.top_k(agg, "source_ip", 3).collect()}
    assert got_top == want_top

    g["avg"] = g["sum"] / g["count"]
    sd = g.groupby("window_start")["avg"].transform(lambda s: s.std(ddof=0))
    want_dev = {(r.window_start, r.source_ip) for r in g[g["avg"] > 2.0 * sd].itertuples()}
    got_dev = {(pd.Timestamp(r.window_start), r.source_ip) for r in traffic.deviants(agg, "source_ip", 2.0).collect()}
    assert got_dev == want_dev
