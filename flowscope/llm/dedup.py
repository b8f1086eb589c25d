"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. Every scan task hashes its rows' normalised texts, sorts the distinct
   64-bit fingerprints of each block of rows and emits, next to one digest row
   per document, one Rice-coded message per owner with a bitmap of the
   fingerprints that repeat inside the block.
2. Each owner decodes its messages and answers each with a bitmap: bit i is set
   when fingerprint i occurs in more than one row of the corpus.
3. Digest rows whose bit is set are suspects. Only their texts are shuffled:
   rows are grouped by the normalised text itself (byte equality, combined
   map-side, so a text that a third of all rows carry is one row per task),
   which also settles fingerprint collisions.

Defined results: a null text counts as empty and all empty texts are equal; a
null doc_id is an ordinary id that sorts last; repeated rows (same doc_id and
text) are separate rows of one group, and exactly one of them stays; further
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, shuffle_partitions, stage, string_bytes
from flowscope.llm.exchange import cut_by_owner, decode, encode

U = np.uint64
DELETED = b" \t\n\x0b\x0c\r"
BLOCK_ROWS = 1 << 18  # rows of one sender block; a task with more rows sends several
OWNERS_PER_PARTITION = 4

_ROWS = pa.schema([
    ("kind", pa.string()), ("row", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("points", pa.int64()), ("sha", pa.binary()),
    ("block", pa.int64()), ("owner", pa.int32()), ("rank", pa.int32()), ("message", pa.binary()), ("repeated", pa.binary())])
_ROWS_SQL = ("kind string, row long, key long, doc_id long, points long, sha binary, block long, owner int, rank int, "
             "message binary, repeated binary")


def _send(owners: int):
    def fill(n, **given):
        return pa.RecordBatch.from_arrays(
            [given[f.name] if f.name in given else pa.nulls(n, f.type) for f in _ROWS], schema=_ROWS)

    def flush(block, hashes):
        """Messages of one block and, per row, its (owner, rank in the message)."""
        h = np.concatenate(hashes)
        distinct, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        parts = cut_by_owner(distinct, owners)
        first = np.zeros(len(distinct), np.int64)
        own = np.zeros(len(distinct), np.int32)
        for o, a, b in parts:
            first[a:b], own[a:b] = a, o
        n = len(parts)
        messages = fill(
            n, kind=pa.array(["message"] * n), block=pa.array([block] * n, pa.int64()),
            owner=pa.array([p[0] for p in parts], pa.int32()),
            message=pa.array([encode(distinct[a:b]) for _, a, b in parts], pa.binary()),
            repeated=pa.array([np.packbits(counts[a:b] > 1).tobytes() for _, a, b in parts], pa.binary()))
        return messages, own[inverse], (inverse - first[inverse]).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, block, held, hashes, kept = part << 36, part << 20, 0, [], []

        def emit():
            messages, own, rank = flush(block, hashes)
            at = 0
            for ids, points, keys, shas, first in kept:
                n = len(ids)
                yield fill(n, kind=pa.array(["row"] * n), row=pa.array(np.arange(first, first + n)), key=keys, doc_id=ids,
                           points=points, sha=shas, block=pa.array(np.full(n, block)),
                           owner=pa.array(own[at: at + n]), rank=pa.array(rank[at: at + n]))
                at += n
            yield messages

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(lo, BLOCK_ROWS)
                raw, offsets = string_bytes(piece.column(1))
                view = memoryview(raw)
                digests = [hashlib.sha256(bytes(view[a:b]).translate(None, DELETED)).digest()
                           for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                h = np.frombuffer(b"".join(digests), ">u8")[::4].astype(np.uint64)
                if held and held + len(h) > BLOCK_ROWS:
                    yield from emit()
                    block, held, hashes, kept = block + 1, 0, [], []
                hashes.append(h)
                kept.append((piece.column(0), piece.column(2), piece.column(3), pa.array(digests, pa.binary()), row))
                held += len(h)
                row += len(h)
        if held:
            yield from emit()

    return run


def _answer(table: pa.Table) -> pa.Table:
    """An owner's work: bitmap per message of the fingerprints that more than one row has."""
    sets = [decode(m) for m in table["message"].to_pylist()]
    again = [np.unpackbits(np.frombuffer(r, np.uint8))[: len(s)].astype(bool)
             for r, s in zip(table["repeated"].to_pylist(), sets)]
    ordered = np.sort(np.concatenate(sets))
    same = ordered[1:] == ordered[:-1]
    hot = np.unique(np.concatenate([ordered[1:][same], *(s[a] for s, a in zip(sets, again))]))
    bitmaps = [np.packbits(np.isin(s, hot, assume_unique=True)).tobytes() for s in sets]
    return pa.table({"block": table["block"], "owner": table["owner"], "bitmap": pa.array(bitmaps, pa.binary())})


def _suspect_texts(words: np.ndarray):
    """Scan task of the second pass: normalised texts whose filter bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_bytes(batch.column(0))
            view = memoryview(raw)
            for at in range(0, batch.num_rows, 1024):
                end = min(at + 1024, batch.num_rows)
                norms = [bytes(view[a:b]).translate(None, DELETED)
                         for a, b in zip(offsets[at:end].tolist(), offsets[at + 1:end + 1].tolist())]
                shas = [hashlib.sha256(x).digest() for x in norms]
                slot = np.frombuffer(b"".join(shas), ">u8")[1::4].astype(np.uint64) % U(64 * len(words))
                hit = np.flatnonzero(words[(slot >> U(6)).astype(np.int64)] >> (slot & U(63)) & U(1))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array([shas[i] for i in hit], pa.binary()),
                                                      pa.array([norms[i] for i in hit], pa.binary())], ["sha", "norm"])
    return run


def _filter_words(suspects: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size over the suspects' hashes: at most bits / 64 rows reach the driver.

    It only spares the second pass the texts that are certainly unique; at
    any fill the grouping that follows is exact."""
    low = F.conv(F.hex(F.expr("substring(sha, 9, 8)")), 16, 10).cast("decimal(20,0)") % F.lit(bits)
    slots = suspects.select(low.cast("long").alias("slot")).distinct()
    rows = (slots.groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).toPandas())
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def exact_dedup(docs: DataFrame, key_col: str = "doc_id", filter_bits: int = 1 << 24) -> DataFrame:
    """One row per input row: key, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text,
    then the smallest doc_id (then the first such row) stays. ``key_col`` is
    carried through as ``key``.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                         F.col(key_col).cast("long").alias("key"))
    owners = OWNERS_PER_PARTITION * shuffle_partitions(spark)
    sent = stage(map_arrow(source.select("doc_id", "text", F.char_length("text").cast("long").alias("points"), "key"),
                           _send(owners), _ROWS_SQL), "dedup-sent")
    rows = sent.where("kind = 'row'").select("row", "key", "doc_id", "points", "sha", "block", "owner", "rank")
    answers = (sent.where("kind = 'message'").select("block", "owner", "message", "repeated")
               .groupBy("owner").applyInArrow(_answer, "block long, owner int, bitmap binary"))
    flagged = stage(rows.join(answers, ["block", "owner"]).select("row", "key", "doc_id", "points", "sha", F.expr(
        "shiftright(cast(conv(hex(substring(bitmap, cast(rank div 8 as int) + 1, 1)), 16, 10) as int),"
        " cast(7 - rank % 8 as int)) % 2 = 1").alias("suspect")), "dedup-flagged")
    suspects = flagged.where("suspect")
    words = spark.sparkContext.broadcast(_filter_words(suspects, filter_bits))
    verified = (map_arrow(source.select("text"), lambda it: _suspect_texts(words.value)(it), "sha binary, norm binary")
                .groupBy("sha", "norm").agg(F.count(F.lit(1)).alias("n")).select("sha", "n"))
    best = suspects.groupBy("sha").agg(F.min(F.struct(
        -F.col("points"), F.coalesce("doc_id", F.lit(2**63 - 1)), "row", "doc_id")).alias("best"))
    # stored, so that the join below reads plain exchanges whose hot partitions Spark can split
    groups = stage(best.join(verified, "sha").select("sha", F.col("best.row").alias("keep_row"),
                                                     F.col("best.doc_id").alias("keep_id"), "n"), "dedup-groups")
    alone = F.col("keep_row").isNull()
    return flagged.join(groups, "sha", "left").select(
        "key", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
