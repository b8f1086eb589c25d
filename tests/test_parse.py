import datetime as dt

from flowscope.functions.parse import FLOW_LINE_PATTERN  # noqa: F401
from flowscope.sources.flows import format_flow_lines, parse_flow_lines
from flowscope.sources.logs import log_parse_rejects, parse_log_lines

LOG_LINES = [
    '141.243.1.172 [29:23:53:25] "GET /Software.html HTTP/1.0" 200 1497',
    'wpbfl2-45.gate.net [29:23:54:15] "GET /docs/ HTTP/1.0" 200 4464',       # host name: dropped
    '140.112.68.165 [29:23:54:16] "GET /logos/us-flag.gif HTTP/1.0" 302 -',   # no bytes: dropped
    '128.159.122.20 [29:23:54:17] "GET /icons/x.gif HTTP/1.0" 304 0',         # zero bytes: kept
    'gw1-204.62.245.32.example.com [30:00:10:00] "GET / HTTP/1.0" 200 10',    # quad inside: kept
    '',                                                                       # empty line
    'garbage',                                                                # junk
    '10.0.0.1 [31:25:00:00] "GET / HTTP/1.0" 200 5',                          # hour 25: unparsable
]

FLOW_LINES = """2020-05-07_13:15:40.179 SOAP 53.215.218.189 45.43.227.63 4626
2020-05-07_13:15:40.381 UPnP 45.43.227.63 133.98.231.165 2818
2020-05-07_13:15:40.585 SSDP 53.215.218.189 222.186.237.75 3243
2020-05-07_13:15:40.788 DNS 45.43.227.63 45.43.227.63 9320
2020-05-07_13:15:40.992 SSDP 11.71.50.83 11.71.50.83 9013
2020-05-07_13:15:41.194 DNS 222.186.237.75 45.43.227.63 915
2020-05-07_13:15:41.395 UPnP 53.215.218.189 133.98.231.165 6200
2020-05-07_13:15:41.599 UPnP 222.186.237.75 45.43.227.63 6927
2020-05-07_13:15:41.803 SOAP 45.43.227.63 133.98.231.165 1834
2020-05-07_13:15:42.007 SSDP 45.43.227.63 45.43.227.63 3442""".splitlines()


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_log_parse_fixture(spark):
    rows = parse_log_lines(_lines(spark, LOG_LINES), "2020-01").orderBy("ip").collect()
    got = [(r.ip, r.datetime, r.bytes) for r in rows]
    assert got == [
        ("128.159.122.20", dt.datetime(2020, 1, 29, 23, 54, 17), 0),
        ("141.243.1.172", dt.datetime(2020, 1, 29, 23, 53, 25), 1497),
        ("gw1-204.62.245.32.example.com", dt.datetime(2020, 1, 30, 0, 10, 0), 10),
    ]
    assert str(parse_log_lines(_lines(spark, LOG_LINES)).schema["datetime"].dataType) == "TimestampNTZType()"


def test_log_parse_strict_anchors_host(spark):
    rows = parse_log_lines(_lines(spark, LOG_LINES), "2020-01", strict=True).collect()
    assert sorted(r.ip for r in rows) == ["128.159.122.20", "141.243.1.172"]


def test_log_rejects_counted(spark):
    r = log_parse_rejects(_lines(spark, LOG_LINES), "2020-01").collect()[0]
    assert (r.n_lines, r.n_filtered, r.n_unparsed) == (8, 4, 1)


def test_flow_parse_fixture(spark):
    df = parse_flow_lines(_lines(spark, FLOW_LINES + ["junk line", ""]))
    rows = df.collect()
    assert len(rows) == 10
    assert rows[0].datetime == dt.datetime(2020, 5, 7, 13, 15, 40, 179000)
    assert (rows[0].protocol, rows[0].source_ip, rows[0].destination_ip, rows[0].packet_size) == \
        ("SOAP", "53.215.218.189", "45.43.227.63", 4626)
    kept = parse_flow_lines(_lines(spark, ["junk line"]), drop_bad=False).collect()[0]
    assert kept.datetime is None and kept.protocol == "" and kept.packet_size is None


def test_flow_format_roundtrip(spark):
    df = parse_flow_lines(_lines(spark, FLOW_LINES))
    back = [r.value for r in format_flow_lines(df).collect()]
    assert back == FLOW_LINES


def test_output_schemas(spark):
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.001"
    log = queries()["log_parse"](spark, sf).schema
    assert [(f.name, f.dataType.simpleString()) for f in log] == \
        [("ip", "string"), ("datetime", "timestamp_ntz"), ("bytes", "bigint")]
    fl = queries()["flow_parse"](spark, sf).schema
    assert [(f.name, f.dataType.simpleString()) for f in fl] == \
        [("datetime", "timestamp_ntz"), ("protocol", "string"), ("source_ip", "string"),
         ("destination_ip", "string"), ("packet_size", "int")]


def test_flow_and_log_timestamp_functions(spark):
    from flowscope.functions.parse import flow_timestamp, log_timestamp
    df = spark.createDataFrame([("2020-05-07_13:15:40.179", "[29:23:53:25]"), ("2020-05-07 13:15:40", "[32:00:00:00]"),
                                ("junk", "29:23:53:25")], "f string, l string")
    rows = df.select(flow_timestamp("f").alias("f"), log_timestamp("l", "2020-01").alias("l")).collect()
    assert rows[0].f == dt.datetime(2020, 5, 7, 13, 15, 40, 179000) and rows[0].l == dt.datetime(2020, 1, 29, 23, 53, 25)
    assert [rows[1].f, rows[1].l, rows[2].f, rows[2].l] == [None] * 4


def test_ids_of_any_size_get_their_own_address_and_are_kept(spark):
    from pyspark.sql import functions as F
    from flowscope.functions.parse import ip_of_user, is_ipv4_host
    ids = [1, 255, 256, 65_531, 65_536, 65_541, 70_001, 2**24 - 1, 2**24, 2**24 + 1, 3 * 2**24 + 5]
    rows = spark.createDataFrame([(i,) for i in ids], "user_id long").select(ip_of_user("user_id").alias("ip"))
    got = [r.ip for r in rows.collect()]
    assert len(set(got)) == len(ids)
    assert all(0 <= int(o) < 256 for ip in got for o in ip.split("."))
    assert rows.where(is_ipv4_host("ip")).count() == len(ids)
    assert got[:5] == ["10.0.0.1", "10.0.0.255", "10.0.1.0", "10.0.255.251", "10.1.0.0"]


def test_flow_times_must_have_the_exact_format(spark):
    from flowscope.sources.flows import flow_parse_rejects
    good = "2020-05-07_13:15:40.179 SOAP 1.2.3.4 5.6.7.8 10"
    bad = ["2020-5-7_1:2:3.5 SOAP 1.2.3.4 5.6.7.8 10", "2020-05-07_13:15:40 SOAP 1.2.3.4 5.6.7.8 10",
           "2020-05-07_13:15:40.179123 SOAP 1.2.3.4 5.6.7.8 10"]
    lines = spark.createDataFrame([(x,) for x in [good, *bad, good.replace(" 10", " 99999999999")]], "value string")
    assert parse_flow_lines(lines).count() == 2
    assert flow_parse_rejects(lines).first().asDict() == {"n_lines": 5, "n_bad_time": 3, "n_bad_size": 1}


def test_durations():
    import pytest
    from flowscope.operators.windows import seconds
    for text, want in [("1 hour", 3600), ("15 minutes", 900), ("5s", 5), ("5 seconds", 5), ("2000 ms", 2), ("1 m", 60),
                       (5, 5), (2.0, 2), ("1 week", 604800)]:
        assert seconds(text) == want, text
    for text in ("500 ms", "1500 ms", "250 milliseconds", 2.5, "5 parsecs", "ms", 0):
        with pytest.raises(ValueError):
            seconds(text)


def test_a_rewritten_input_is_rendered_anew(spark, tmp_dir):
    from flowscope.sources.flows import flow_lines
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = f"file://{tmp_dir}/in"
    events.limit(7).write.parquet(f"{folder}/events.parquet")
    assert flow_lines(spark, folder).count() == 7
    events.limit(14).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    assert flow_lines(spark, folder).count() == 14


def test_flow_time_in_a_zone(spark):
    """Wall clocks of a zone, in winter and in summer, become UTC; junk stays null."""
    import datetime as dt

    from flowscope.sources.flows import parse_flow_lines
    lines = spark.createDataFrame([("2024-01-15_22:30:00.250 DNS 1.1.1.1 2.2.2.2 7",), ("2024-07-15_22:30:00.000 DNS 1.1.1.1 2.2.2.2 8",),
                                   ("junk",)], "value string")
    got = {r.packet_size: r.datetime for r in parse_flow_lines(lines, drop_bad=False, zone="America/New_York").collect()}
    assert got == {7: dt.datetime(2024, 1, 16, 3, 30, 0, 250000), 8: dt.datetime(2024, 7, 16, 2, 30), None: None}
