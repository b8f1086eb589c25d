"""Weighted flow synthesis (S14, S15), re-aimed as a distributed job.

Every input row (e.g. an ``events`` row) yields one flow whose protocol,
source and destination are drawn from weighted lists and whose size is
uniform in 16..12288. Draws come from the multiplicative row hash with a
different multiplier per draw, ``r = unit_hash / 65536`` in [0, 1), so the
output is repeatable and independent of partitioning. The weighted pick is
"first index with ``r < cdf[i]``, else the last index", evaluated as
``size(filter(cdf, c -> c <= r))`` against a literal array: no join, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscope.functions.hashing import HASH_RANGE, unit_hash

# ---- fixed values: the generator's protocol and address lists, in order ----
PROTOCOLS = ["SOAP", "SSDP", "TCAP", "UPnP", "DHCP", "DNS", "HTTP", "HTTPS", "NFS", "POP3", "SMTP", "SNMP",
             "FTP", "NTP", "IRC", "Telnet", "SSH", "TFTP", "AMQP"]
ADDRESSES = ["53.215.218.189", "133.98.231.165", "222.186.237.75", "11.71.50.83", "45.43.227.63",
             "116.168.68.91", "20.232.17.27", "158.223.93.237", "84.191.253.211", "153.17.103.198",
             "224.80.117.250", "97.211.109.139", "21.50.108.54", "109.126.189.56", "90.227.18.21"]
SIZE_MIN, SIZE_MAX = 16, 12288
# ------------------------------------------------------------------------------

# odd 32-bit multipliers, one per independent draw
DRAW_MULTS = {"protocol": 2654435761, "source": 2246822519, "destination": 3266489917, "size": 668265263}


def normalise_weights(weights: list[float] | None, n: int) -> list[float]:
    """A list of the wrong length becomes uniform ``1/n``; otherwise as given.
    (Unlike the original, the caller's list is never modified.)"""
    if not weights or len(weights) != n:
        return [1.0 / n] * n
    return list(weights)


def cdf_of(pdf: list[float]) -> list[float]:
    """Running sum of the weights."""
    out, acc = [], 0.0
    for w in pdf:
        acc += w
        out.append(acc)
    return out


def pick(r: Column, values: list[str], cdf: list[float]) -> Column:
    """First ``values[i]`` with ``r < cdf[i]``, else the last value."""
    below = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cdf]), lambda c: c <= r))
    idx = F.least(below, F.lit(len(values) - 1))
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def draw(key: str, name: str) -> Column:
    return unit_hash(key, DRAW_MULTS[name]) / F.lit(float(HASH_RANGE))


def synth_flows(rows: DataFrame, key: str = "event_id", time_col: str = "ts", ip_num: int = 5,
                protocol_num: int = 8, ip_weights: list[float] | None = None,
                protocol_weights: list[float] | None = None) -> DataFrame:
    """One weighted random flow per input row, timestamped by ``time_col``.

    Output: ``datetime, protocol, source_ip, destination_ip, packet_size``.
    """
    protocols, ips = PROTOCOLS[:protocol_num], ADDRESSES[:ip_num]
    p_cdf = cdf_of(normalise_weights(protocol_weights, protocol_num))
    i_cdf = cdf_of(normalise_weights(ip_weights, ip_num))
    size = F.lit(SIZE_MIN) + (unit_hash(key, DRAW_MULTS["size"]) * F.lit(SIZE_MAX - SIZE_MIN + 1)
                              / F.lit(HASH_RANGE)).cast("int")
    return rows.select(F.col(time_col).alias("datetime"),
                       pick(draw(key, "protocol"), protocols, p_cdf).alias("protocol"),
                       pick(draw(key, "source"), ips, i_cdf).alias("source_ip"),
                       pick(draw(key, "destination"), ips, i_cdf).alias("destination_ip"),
                       size.alias("packet_size"))
