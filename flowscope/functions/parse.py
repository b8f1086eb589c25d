"""Column expressions for log and flow lines (no UDFs).

All functions return ``Column`` objects so that Catalyst can fuse them into
the scan stage (whole-stage codegen) and push predicates down.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the original analyses) -----------------------
# Dotted-quad test used to keep access-log lines; it is applied unanchored, so
# a host that merely contains a quad passes.
IPV4_PATTERN = (r"(([01]{0,1}\d{0,1}\d|2[0-4]\d|25[0-5])\.){3}"
                r"([01]{0,1}\d{0,1}\d|2[0-4]\d|25[0-5])")
# Flow line "yyyy-MM-dd_HH:mm:ss.SSS PROTO SRC DST SIZE", five groups, as in
# the original (its unescaped '.' matches any character).
FLOW_LINE_PATTERN = r'^([0-9]*-[0-9]*-[0-9]*_[0-9]*:[0-9]*:[0-9]*.[0-9]*)\s*(\w*)\s*([0-9]*.[0-9]*.[0-9]*.[0-9]*)\s*([0-9]*.[0-9]*.[0-9]*.[0-9]*)\s*([0-9]*)$'
FLOW_TIME_FORMAT = "yyyy-MM-dd_HH:mm:ss.SSS"
LOG_TIME_FORMAT = "dd:HH:mm:ss"  # written inside square brackets
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(line, i: int) -> Column:
    """Field ``i`` (0-based, negative from the end) of a space-split line;
    null when the line is shorter (never an ANSI index error)."""
    parts = F.split(_col(line), " ")
    return F.try_element_at(parts, F.lit(i + 1 if i >= 0 else i))


def last_field(line) -> Column:
    return field(line, -1)


def is_ipv4_host(host, strict: bool = False) -> Column:
    """True when the host contains (``strict``: is) a dotted quad."""
    pattern = f"^{IPV4_PATTERN}$" if strict else IPV4_PATTERN
    return _col(host).rlike(pattern)


def bytes_present(line, by_last_char: bool = False) -> Column:
    """The log line served bytes: last field is not ``-``.

    ``by_last_char`` tests only the last character, as the shedding job did.
    """
    if by_last_char:
        return ~_col(line).endswith("-")
    return last_field(line) != F.lit("-")


def log_timestamp(stamp, year_month: str = "2020-01") -> Column:
    """``[DD:HH:MM:SS]`` plus a constant year-month -> TIMESTAMP_NTZ (null on junk).

    One anchored ``regexp_replace`` lays the parts out as an ISO string; text
    that does not match keeps a ``#`` prefix and fails the cast. The cast to
    ``timestamp_ntz`` does not depend on the session time zone and
    ``try_cast`` gives null for impossible values (day 32, hour 25). The input
    is referenced once, so the expression stays small when Catalyst inlines it.
    """
    iso = F.regexp_replace(F.concat(F.lit("#"), _col(stamp)),
                           r"^#\[(\d\d):(\d\d):(\d\d):(\d\d)\]$", year_month + "-$1 $2:$3:$4")
    return iso.try_cast("timestamp_ntz")


def flow_timestamp(text) -> Column:
    """``yyyy-MM-dd_HH:mm:ss.SSS`` -> TIMESTAMP_NTZ, null for anything that is not in
    exactly this format (no short fields, three digits of milliseconds)."""
    iso = F.regexp_replace(F.concat(F.lit("#"), _col(text)),
                           r"^#(\d{4}-\d\d-\d\d)_(\d\d:\d\d:\d\d\.\d{3})$", "$1 $2")
    return iso.try_cast("timestamp_ntz")


def subnet16(ip) -> Column:
    """Text up to the second dot plus ``.*.*`` (``a.b.*.*``)."""
    return F.concat(F.substring_index(_col(ip), ".", 2), F.lit(".*.*"))


def subnet24(ip) -> Column:
    """Text up to the third dot plus ``.*`` (``a.b.c.*``)."""
    return F.concat(F.substring_index(_col(ip), ".", 3), F.lit(".*"))


def ip_of_user(user_id) -> Column:
    """Dotted quad of a non-negative integer id, one address per id:
    ``10.a.b.c`` with the id's three low bytes; ids from 2**24 on carry into the
    first octet (room for about 4.1 billion ids)."""
    u = _col(user_id)
    octets = [F.shiftright(u, 24) + 10] + [F.shiftright(u, n).bitwiseAND(255) for n in (16, 8, 0)]
    return F.concat_ws(".", *(o.cast("string") for o in octets))
