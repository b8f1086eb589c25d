"""Golomb-coded exchange of sorted 64-bit fingerprints between blocks and owners.

A block (the rows one scan task holds) sorts its distinct fingerprints, cuts
them by owner (equal ranges of the hash space) and sends each owner one
message: the gaps of the sorted values, Rice-coded with the parameter that
suits the mean gap. An owner decodes the messages of all blocks, works on the
union and answers each message with one value per fingerprint, in the
message's order. Both sides hold numpy arrays of bounded size: a block's
fingerprints, or an owner's range.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def owner_of(h: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each hash: the hash space cut into equal ranges (keeps sort order)."""
    return ((h >> U(32)) * U(owners) >> U(32)).astype(np.int64)


def encode(values: np.ndarray) -> bytes:
    """Rice code of a strictly increasing uint64 array: 1 byte parameter, 4 bytes count,
    8 bytes first value, remainders (fixed width), then the unary quotients."""
    n = len(values)
    if n == 0:
        return b""
    head = np.uint32(n).tobytes() + values[:1].tobytes()
    if n == 1:
        return b"\x00" + head
    gaps = np.diff(values) - U(1)
    mean = float(values[-1] - values[0]) / (n - 1)
    k = min(63, max(0, int(np.floor(np.log2(max(1.0, mean * 0.69))))))
    quotients = (gaps >> U(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n - 1, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    low = gaps & ((U(1) << U(k)) - U(1))
    if k:
        bits = np.unpackbits(low.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k:]
        packed = np.packbits(bits.reshape(-1)).tobytes()
    else:
        packed = b""
    return bytes([k]) + head + packed + np.packbits(unary).tobytes()


def decode(message: bytes) -> np.ndarray:
    if not message:
        return np.empty(0, np.uint64)
    k = message[0]
    n = int(np.frombuffer(message, np.uint32, 1, 1)[0])
    first = np.frombuffer(message, np.uint64, 1, 5)
    if n == 1:
        return first.copy()
    size = ((n - 1) * k + 7) // 8
    raw = np.frombuffer(message, np.uint8, offset=13)
    low = np.zeros((n - 1, 64), np.uint8)
    if k:
        low[:, 64 - k:] = np.unpackbits(raw[:size])[: (n - 1) * k].reshape(n - 1, k)
    rest = np.packbits(low, axis=1).reshape(-1).view(">u8").astype(np.uint64)
    ones = np.flatnonzero(np.unpackbits(raw[size:]))[: n - 1]
    quotients = np.diff(ones, prepend=-1) - 1
    out = np.empty(n, np.uint64)
    out[0] = first[0]
    out[1:] = (quotients.astype(np.uint64) << U(k)) + rest + U(1)
    return np.cumsum(out, dtype=np.uint64)


def cut_by_owner(distinct: np.ndarray, owners: int) -> list[tuple[int, int, int]]:
    """(owner, start, end) runs of a sorted array."""
    if not len(distinct):
        return []
    own = owner_of(distinct, owners)
    at = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
    ends = np.append(at[1:], len(own))
    return [(int(own[a]), int(a), int(b)) for a, b in zip(at, ends)]
