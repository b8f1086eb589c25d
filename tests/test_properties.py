"""Property tests: parsers never fail on junk (ANSI mode on) and every row
they keep satisfies the format's invariants."""
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowscope.functions.parse import IPV4_PATTERN
from flowscope.sources.flows import parse_flow_lines
from flowscope.sources.logs import parse_log_lines

ALPHABET = "0123456789 .-_:[]\"/abcGETHTP#\t"
piece = st.sampled_from(["141.243.1.172", "[29:23:53:25]", "[31:25:61:61]", '"GET / HTTP/1.0"', "200", "-",
                         "2020-05-07_13:15:40.179", "DNS", "12288", "99999999999999999999", "", "1.2.3"])
junk = st.text(alphabet=ALPHABET, max_size=40)
line = st.one_of(junk, st.lists(st.one_of(piece, junk), min_size=1, max_size=6).map(" ".join))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(line, min_size=1, max_size=30))
def test_log_parser_total_on_junk(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = parse_log_lines(df, "2020-01").collect()
    for r in rows:
        assert r.datetime is not None and r.bytes is not None
        assert re.search(IPV4_PATTERN, r.ip)
    assert len(rows) <= len(lines)


@SETTINGS
@given(st.lists(line, min_size=1, max_size=30))
def test_flow_parser_total_on_junk(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    kept = parse_flow_lines(df).collect()
    every = parse_flow_lines(df, drop_bad=False).collect()
    assert len(every) == len(lines) and len(kept) <= len(lines)
    for r in kept:
        assert r.datetime is not None
