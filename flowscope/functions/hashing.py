"""Repeatable row hashing for shedding and selection experiments.

``unit_hash(key, mult)`` is a multiplicative hash of a non-negative integer
key: ``((key mod 2^32) * mult mod 2^32) >> 16``, a value in ``[0, 65536)``.
The product is split into 16-bit halves so that no intermediate exceeds 2^48;
the expression is therefore exact in any engine with 64-bit integers and
valid for every bigint key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------
HASH_A = 2654435761  # Knuth's golden-ratio multiplier (filter A / shedding)
HASH_B = 2246822519  # a second odd 32-bit multiplier (filter B)
HASH_RANGE = 65536   # hash values lie in [0, HASH_RANGE)
# --------------------------------------------------------------------------------

_P32 = 4294967296
_P16 = 65536


def unit_hash(key, mult: int = HASH_A) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    x = F.pmod(k.try_cast("bigint"), F.lit(_P32))
    lo = F.pmod(x, F.lit(_P16))
    hi = F.shiftright(x, 16)
    prod = F.pmod(lo * F.lit(mult) + F.pmod(hi * F.lit(mult), F.lit(_P16)) * F.lit(_P16), F.lit(_P32))
    return F.shiftright(prod, 16)


def hash_keep(key, rate: float, mult: int = HASH_A) -> Column:
    """Keep a row with probability ``rate`` (repeatable, partitioning-independent)."""
    return unit_hash(key, mult) < F.lit(float(rate) * HASH_RANGE)


def unit_hash_sql(key_sql: str, mult: int = HASH_A) -> str:
    """The same hash as ANSI SQL text (used by the DuckDB oracle)."""
    x = f"(({key_sql}) % {_P32} + {_P32}) % {_P32}"
    return (f"(((({x}) % {_P16}) * {mult} + ((({x}) // {_P16}) * {mult}) % {_P16} * {_P16})"
            f" % {_P32}) // {_P16}")
