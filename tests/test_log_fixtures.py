"""Log operators on the fixture rows of FIXTURES.md §3 (values stated there)."""
from pyspark.sql import functions as F

from flowscope.operators import logs

# fixed values: the one-hour slice (address, bytes), by address as a string
HOUR_SLICE = [("131.170.154.29", 5075), ("137.132.52.66", 2235), ("138.25.148.25", 28591),
              ("141.243.1.172", 177370), ("141.243.1.174", 10739), ("149.159.22.10", 67951),
              ("157.22.192.30", 7513), ("161.122.12.78", 45957), ("202.32.50.6", 16682),
              ("203.1.203.222", 3717), ("204.188.47.212", 21118), ("204.62.245.32", 21181)]
# fixed values: the ten addresses with most bytes, in order
TOP10 = [("139.121.98.45", 5041738), ("203.251.228.110", 3785626), ("155.84.92.3", 3353172),
         ("198.102.67.27", 3182052), ("161.122.12.78", 3008684), ("156.98.205.46", 1938034),
         ("141.243.1.172", 1634402), ("204.7.162.158", 1463223), ("129.237.24.71", 1274796),
         ("137.219.55.101", 1162480)]


def _df(spark, rows):
    # split every total over two log rows so that the aggregation has work to do
    data = [(ip, b // 2) for ip, b in rows] + [(ip, b - b // 2) for ip, b in rows]
    return spark.createDataFrame(data, "ip string, bytes long")


def test_string_order_of_addresses(spark):
    got = [(r.ip, r.bytes) for r in logs.bytes_by_ip(_df(spark, HOUR_SLICE)).collect()]
    assert got == HOUR_SLICE  # 204.188... sorts before 204.62...


def test_top_k(spark):
    df = _df(spark, TOP10 + HOUR_SLICE)
    totals: dict[str, int] = {}
    for ip, b in TOP10 + HOUR_SLICE:  # two addresses are in both lists
        totals[ip] = totals.get(ip, 0) + b
    want = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [(r.ip, r.bytes) for r in logs.top_ips(df, 10).collect()] == want
    assert sum(b for _, b in TOP10) == 25844207


def test_subnet_rollup_preserves_total(spark):
    df = _df(spark, HOUR_SLICE)
    sub = logs.bytes_by_subnet(df, 16)
    assert sub.agg(F.sum("bytes")).collect()[0][0] == sum(b for _, b in HOUR_SLICE)
    got = {r.subnet: r.bytes for r in sub.collect()}
    assert got["141.243.*.*"] == 177370 + 10739 and got["204.188.*.*"] == 21118
