"""Packed token-id matrices by best-fit decreasing.

Documents longer than the row length are split losslessly into pieces. Every
task sorts the pieces of a bounded batch by decreasing length and puts each
into the row with the least remaining room that still fits it; the row is
found in a segment tree over remaining capacities. The output is one row per
packed sequence: the id matrix row (little-endian uint16, padded), cumulative
segment lengths (``cu_seqlens``, 0 first) and the offsets at which positions
reset to 0.

Defined results: a null text is empty and has only the end id; repeated rows
are packed separately; null doc_ids are carried as null; empty input gives
no rows. Tasks are independent: no shuffle, and memory is one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, slices, stage, string_bytes
from flowscope.llm.tokens import default_tokenizer, tokenizer, with_end

LENGTH = 2048
BATCH_TOKENS = 1 << 20
PAD_ID = 0
SCHEMA = ("sequence_id long, n_tokens long, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, "
          "starts array<long>, ids binary")
TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()),
         pa.list_(pa.int64()), pa.binary()]


class CapacityTree:
    """How many open rows have each remaining capacity; finds the least one that fits."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size < capacity + 1:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, by: int):
        i = capacity + self.size
        while i:
            self.count[i] += by
            i //= 2

    def least_at_least(self, need: int) -> int:
        """The least remaining capacity >= need of an open row, -1 if there is none."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item indexes per row."""
    tree, rows, open_rows = CapacityTree(capacity), [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = tree.least_at_least(sizes[i])
        if room < 0:
            rows.append([])
            row, room = len(rows) - 1, capacity
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        left = room - sizes[i]
        if left:
            open_rows.setdefault(left, []).append(row)
            tree.add(left, 1)
    return rows


def packed_rows(docs: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None) -> DataFrame:
    path = tokenizer_path or default_tokenizer()

    def pack(pieces, number) -> pa.RecordBatch:
        columns = [[] for _ in TYPES]
        for row in best_fit_decreasing([len(p[2]) for p in pieces], length):
            parts = [pieces[i] for i in row]
            ends = np.cumsum([0] + [len(p[2]) for p in parts]).tolist()
            ids = np.full(length, PAD_ID, "<u2")
            ids[: ends[-1]] = np.concatenate([p[2] for p in parts])
            for c, v in zip(columns, (number, ends[-1], ends, ends[:-1], [p[0] for p in parts],
                                      [p[1] for p in parts], ids.tobytes())):
                c.append(v)
            number += 1
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)],
                                          [f.split()[0] for f in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pieces, held = TaskContext.get().partitionId() << 40, [], 0
        words = tokenizer(path)
        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for a, b in slices(offsets):
                ids, first = with_end(*words.encode(raw[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]))
                ids = ids.astype(np.uint16)
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for at in range(lo, hi, length):
                        pieces.append((doc_ids[a + i], at - lo, ids[at: min(hi, at + length)]))
                    held += hi - lo
                if held >= BATCH_TOKENS:
                    out = pack(pieces, number)
                    number, pieces, held = number + out.num_rows, [], 0
                    yield out
        if pieces:
            yield pack(pieces, number)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.coalesce(F.col("text"), F.lit("")).alias("text")), run, SCHEMA)


def write_packed(docs: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None) -> DataFrame:
    """Write the packed rows once to the shared folder and return the stored table."""
    return stage(packed_rows(docs, length, tokenizer_path), "packed-ids")


def packed_digest(packed: DataFrame) -> DataFrame:
    """Per stored row: its documents, starts, segment bounds and the crc32 of its ids without padding."""
    return packed.select("sequence_id", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "starts",
                         F.crc32(F.expr("substring(ids, 1, cast(2 * n_tokens as int))")).alias("ids_crc32"),
                         (F.octet_length("ids") / 2 - F.col("n_tokens")).cast("long").alias("n_padding"))
