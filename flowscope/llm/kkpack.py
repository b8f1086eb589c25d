"""Packing by Karmarkar-Karp multiway differencing.

Every task tokenises its documents and cuts full windows off long ones. The
remainders are collected into batches; a batch of total S is partitioned into
ceil(S / capacity) windows: each piece starts as a partial partition (itself in
one window, nothing in the others), and the two partial partitions with the
largest spread are merged with opposing imbalances, the heaviest window of
one with the lightest of the other, until one partition of near-equal windows
is left. If a window then exceeds the capacity, either the window count rises
by one and the batch is partitioned again (``cut=False``), or, when pieces may
be cut, the few excess tokens move to windows with room (``cut=True``); in that
mode batches are filled to a multiple of the capacity, so no window is padded.
What is left at the end of a task beyond its full windows becomes sequences
whose lengths are powers of two, which need no padding.

No shuffle: windows hold documents of one scan task, and memory is bounded by
one batch. Sequence ids are unique across tasks and the same for a rerun task.

Defined results: a null text is empty (only the end id); repeated rows are
packed separately; a null doc_id is carried as null; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, slices, string_bytes
from flowscope.llm.tokens import default_tokenizer, tokenizer, with_end

CAPACITY = 2048
WINDOWS = 64  # windows of one batch
SCHEMA = ("doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def karmarkar_karp(sizes: list[int], windows: int) -> list[list[int]]:
    """Item indexes per window, window sums as equal as differencing makes them."""
    if windows == 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, s in enumerate(sizes):
        loads = np.zeros(windows, np.int64)
        loads[0] = s  # loads are kept in descending order
        heap.append((-s, i, loads, [[i]] + [[] for _ in range(windows - 1)]))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, members_a = heapq.heappop(heap)
        _, _, b, members_b = heapq.heappop(heap)
        loads = a + b[::-1]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        members = [members_a[j] + members_b[windows - 1 - j] for j in order.tolist()]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), count, loads, members))
        count += 1
    return heap[0][3] if heap else [[] for _ in range(windows)]


class Piece:
    """A run of one document's ids."""
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start, ids, total):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def split(self, n: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.doc, self.start, self.ids[:n], self.total),
                Piece(self.doc, self.start + n, self.ids[n:], self.total))


def _take(pool: list[Piece], tokens: int) -> list[Piece]:
    """Move pieces of ``tokens`` ids in all from the end of the pool, cutting the last one."""
    out = []
    while tokens:
        p = pool.pop()
        if len(p.ids) > tokens:
            head, tail = p.split(tokens)
            pool.append(tail)
            p = head
        out.append(p)
        tokens -= len(p.ids)
    return out


def windows_of(pieces: list[Piece], capacity: int, cut: bool) -> list[list[Piece]]:
    """Windows of at most ``capacity`` ids that hold the pieces."""
    sizes = [len(p.ids) for p in pieces]
    total = sum(sizes)
    if not total:
        return []
    count = -(-total // capacity)
    while True:
        groups = [[pieces[i] for i in g] for g in karmarkar_karp(sizes, count)]
        loads = [sum(len(p.ids) for p in g) for g in groups]
        if max(loads) <= capacity:
            return [g for g in groups if g]
        if cut:
            break
        count += 1
    spare = []
    for g, load in zip(groups, loads):
        if load > capacity:
            g.sort(key=lambda p: len(p.ids))
            spare.extend(_take(g, load - capacity))
    for g in groups:
        room = capacity - sum(len(p.ids) for p in g)
        left = sum(len(p.ids) for p in spare)
        if room and left:
            g.extend(_take(spare, min(room, left)))
    return groups


class Packer:
    """Streaming state of one task: the pool of remainders and the rows made so far."""

    def __init__(self, part: int, capacity: int, cut: bool):
        self.next, self.capacity, self.cut = part << 40, capacity, cut
        self.pool, self.size = [], 0
        self.rows = [[] for _ in range(8)]

    def _emit(self, sequence: list[Piece]):
        at = 0
        for p in sequence:
            ids = p.ids.astype("<u4").tobytes()
            for column, v in zip(self.rows, (p.doc, p.start, len(p.ids), ids, zlib.crc32(ids), p.total, self.next, at)):
                column.append(v)
            at += len(p.ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray):
        total, c = len(ids), self.capacity
        full = total // c * c
        for a in range(0, full, c):
            self._emit([Piece(doc, a, ids[a: a + c], total)])
        if total > full:
            self.pool.append(Piece(doc, full, ids[full:].copy(), total))
            self.size += total - full
        if self.size >= WINDOWS * c:
            if self.cut:
                batch = _take(self.pool, WINDOWS * c)
            else:
                batch, self.pool = self.pool, []
            self._pack(batch)

    def _pack(self, batch: list[Piece]):
        self.size -= sum(len(p.ids) for p in batch)
        for w in windows_of(batch, self.capacity, self.cut):
            self._emit(w)

    def finish(self):
        rest = self.size % self.capacity
        if self.cut and rest:
            n = 1
            while n <= rest:
                if rest & n:
                    self._emit(_take(self.pool, n))
                    self.size -= n
                n *= 2
        self._pack(self.pool)
        self.pool = []

    def drain(self) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.rows, types)], names)
        self.rows = [[] for _ in range(8)]
        return out


def pack(docs: DataFrame, capacity: int = CAPACITY, cut: bool = True, tokenizer_path: str | None = None,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32, null
    unless ``with_ids``), ids_crc32, doc_tokens, sequence_id, offset."""
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), capacity, cut)
        words = tokenizer(path)

        def drained():
            out = packer.drain()
            return out if with_ids else out.set_column(3, "ids", pa.nulls(out.num_rows, pa.binary()))

        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for a, b in slices(offsets):
                ids, first = with_end(*words.encode(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]))
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    packer.add(doc_ids[a + i], ids[lo:hi])
                yield drained()
        packer.finish()
        yield drained()

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.coalesce(F.col("text"), F.lit("")).alias("text")), run, SCHEMA)
