"""Benchmark decontamination by winnowing.

Fingerprints are hashes of k consecutive words; of every ``window - k + 1``
consecutive fingerprints the smallest is kept, on both sides. Any span of
``window`` words that a document shares with an item therefore holds a kept
fingerprint of both. Kept fingerprints are joined by value, each match is
extended word by word in both directions to the longest common run, the run's
bytes are compared, and runs of ``window`` words or more are hits: every
word of the run lies in an occurrence of an item window, and no other does.
Items of fewer words than ``window`` are one window each and are looked up
whole, by a gram of their own length, without winnowing.

The item side is a stated query set. It is taken in blocks of at most
``block_words`` words; each block is broadcast (its size is proven by that
bound) and all documents are scanned against it.

Defined results: a null text has no words; a null item_id reads as the id
'null'; items with equal ids count once; repeated documents are separate rows;
empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, slices, stage, string_bytes
from flowscope.llm.textnum import ALNUM, LOWER, grams, span_hashes, word_spans


def winnow(h: np.ndarray, row_of: np.ndarray, span: int) -> np.ndarray:
    """Positions whose hash is the smallest of some ``span`` consecutive hashes of one row."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least = h[:n].copy()
    for j in range(1, span):
        np.minimum(least, h[j: j + n], out=least)
    whole = row_of[:n] == row_of[span - 1:]
    kept = np.zeros(len(h), bool)
    for j in range(span):
        kept[j: j + n] |= whole & (h[j: j + n] == least)
    return np.flatnonzero(kept)


def _scan(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = word_spans(data, offsets, ALNUM)
    h = span_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return starts, ends, first, h, row


def _inside(row: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a gram of k words lies inside one row."""
    n = len(row) - k + 1
    return np.flatnonzero(row[:n] == row[k - 1:]) if n > 0 else np.empty(0, np.int64)


class ItemBlock:
    """Words, kept fingerprints and short-item grams of one block of items."""

    def __init__(self, ids: list[str], texts: list[str], window: int, k: int):
        self.ids, self.window, self.k = ids, window, k
        raw = [t.encode() for t in texts]
        data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        offsets = np.cumsum([0, *map(len, raw)])
        starts, ends, self.first, self.h, self.row = _scan(data, offsets)
        text = data.tobytes()
        self.words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        counts = np.diff(self.first)
        long_rows = counts[self.row] >= window if len(self.row) else np.empty(0, bool)
        at = _inside(self.row, k)
        at = at[long_rows[at]]
        g = grams(self.h, k)
        pos = at[winnow(g[at], self.row[at], window - k + 1)]
        order = np.argsort(g[pos], kind="stable")
        self.prints, self.places = g[pos][order], pos[order]
        self.short = {}
        for n in range(1, window):
            heads = self.first[:-1][counts == n]
            if len(heads):
                keys = grams(self.h, n)[heads]
                order = np.argsort(keys, kind="stable")
                self.short[n] = keys[order], heads[order]


def _matches(keys: np.ndarray, places: np.ndarray, g: np.ndarray, pos: np.ndarray):
    """(document position, item position) pairs with equal hashes."""
    left = np.searchsorted(keys, g, side="left")
    count = np.searchsorted(keys, g, side="right") - left
    hit = np.flatnonzero(count)
    for i in hit.tolist():
        for j in range(left[i], left[i] + count[i]):
            yield int(pos[i]), int(places[j])


def _hits(block: ItemBlock, data: np.ndarray, offsets: np.ndarray):
    """(words per row, covered word mask, first word per row, [(row, item)])."""
    starts, ends, first, h, row = _scan(data, offsets)
    covered = np.zeros(len(h), bool)
    found: set[tuple[int, int]] = set()
    text = data.tobytes()

    def same(i, j, n):
        return all(text[starts[i + d]:ends[i + d]] == block.words[j + d] for d in range(n))

    def take(i, j, n):
        covered[i: i + n] = True
        found.add((int(row[i]), int(block.row[j])))

    done: dict[tuple[int, int], int] = {}
    g = grams(h, block.k)
    at = _inside(row, block.k)
    kept = at[winnow(g[at], row[at], block.window - block.k + 1)]
    for i, j in _matches(block.prints, block.places, g[kept], kept):
        item = int(block.row[j])
        line = item, i - j  # a run of equal words keeps this difference
        if done.get(line, -1) > i:
            continue
        lo, hi = block.first[item], block.first[item + 1]
        a, b = first[row[i]], first[row[i] + 1]
        back = min(i - a, j - lo)
        differ = np.flatnonzero(h[i - back: i][::-1] != block.h[j - back: j][::-1])
        left = int(differ[0]) if len(differ) else int(back)
        ahead = min(b - i, hi - j)
        differ = np.flatnonzero(h[i: i + ahead] != block.h[j: j + ahead])
        right = int(differ[0]) if len(differ) else int(ahead)
        done[line] = i + right
        if left + right >= block.window and same(i - left, j - left, left + right):
            take(i - left, j - left, left + right)
    for n, (keys, places) in block.short.items():
        at = _inside(row, n)
        for i, j in _matches(keys, places, grams(h, n)[at], at):
            if same(i, j, n):
                take(i, j, n)
    return covered, first, found


def _task(block: ItemBlock):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_bytes(batch.column(2))
            for a, b in slices(offsets):
                data = LOWER[raw[offsets[a]: offsets[b]]]
                covered, first, found = _hits(block, data, offsets[a: b + 1] - offsets[a])
                n = b - a
                sums = np.concatenate([[0], np.cumsum(covered)])
                n_hit = sums[first[1:]] - sums[first[:-1]]
                items: list[set] = [set() for _ in range(n)]
                for r, item in found:
                    items[r].add(block.ids[item])
                runs: list[list[int]] = [[] for _ in range(n)]
                for r in np.flatnonzero(n_hit).tolist():
                    inside = np.concatenate([[0], covered[first[r]: first[r + 1]].astype(np.int8), [0]])
                    runs[r] = np.flatnonzero(np.diff(inside)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(np.diff(first)),
                     pa.array(n_hit), pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                     pa.array(runs, pa.list_(pa.int64()))], ["row", "doc_id", "n_words", "n_hit", "items", "runs"])
    return run


def item_blocks(benchmark: DataFrame, window: int, k: int, block_words: int,
                id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemBlock]:
    """Blocks of items of at most ``block_words`` words each (one item at least),
    streamed through the driver one partition at a time."""
    ids, texts, size = [], [], 0
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for r in items.toLocalIterator():
        n = len(r["text"]) // 2 + 1  # words of a text, at most
        if ids and size + n > block_words:
            yield ItemBlock(ids, texts, window, k)
            ids, texts, size = [], [], 0
        ids.append(r["id"])
        texts.append(r["text"])
        size += n
    yield ItemBlock(ids, texts, window, k)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """One row per document row from its results against several item blocks:
    the union of the runs, their words counted once, and of the items."""
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    pairs = ("array_sort(flatten(collect_list(transform(sequence(1, cast(size(runs) / 2 as int)),"
             " i -> named_struct('a', runs[2 * i - 2], 'b', runs[2 * i - 1])))))")
    df = df.withColumn("runs", F.expr("if(size(runs) = 0, array(0L, 0L), runs)"))
    df = df.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                               F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"),
                               F.expr(pairs).alias("pairs"))
    joined = ("filter(aggregate(pairs, array(named_struct('a', -1L, 'b', -1L)), (acc, p) -> "
              "if(p.a <= acc[size(acc) - 1].b, concat(slice(acc, 1, size(acc) - 1), array(named_struct("
              "'a', acc[size(acc) - 1].a, 'b', greatest(p.b, acc[size(acc) - 1].b)))), concat(acc, array(p)))),"
              " p -> p.b > p.a)")
    df = df.withColumn("pairs", F.expr(joined))
    return df.select("row", "doc_id", "n_words",
                     F.expr("aggregate(pairs, 0L, (acc, p) -> acc + p.b - p.a)").alias("n_hit"), "items",
                     F.expr("flatten(transform(pairs, p -> array(p.a, p.b)))").alias("runs"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5,
                  block_words: int = 4_000_000) -> DataFrame:
    """Per document row: row, doc_id, n_words, n_hit, items (sorted ids), runs (word
    positions start, end, start, end ... of the hit words)."""
    spark = docs.sparkSession
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = "row long, doc_id long, n_words long, n_hit long, items array<string>, runs array<long>"
    blocks = item_blocks(benchmark, window, k, block_words)
    block, parts = next(blocks), []
    while block is not None:
        follows = next(blocks, None)
        if follows is not None and not parts:
            source = stage(source, "decontam-docs")  # row numbers must be the same in every pass
        held = spark.sparkContext.broadcast(block)
        parts.append(map_arrow(source, lambda it, held=held: _task(held.value)(it), schema))
        block = follows
    return parts[0] if len(parts) == 1 else _merged(parts)


def contamination_digest(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document row."""
    return contamination(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
