"""Spelling variants by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by a
vector of squared length 1 (insert, delete) or 2 (replace). Words are therefore
compared through their count vectors: for a block of words with count rows A and
one with rows B, ``|a|^2 + |b|^2 - 2 A B^T`` gives all squared distances in one
matrix product; pairs at most 2 apart, in the same or in adjacent lengths, are
verified letter by letter.

Blocks are not whole lengths: a block is one vector of counts over
``LETTER_GROUPS`` (with it, one length). An edit moves that vector by one step in
one group, or one up and one down, so every partner of a word lies in one of a
fixed number of blocks; each word visits those that exist and lie ahead of its
own, which meets every pair exactly once. A block of more than ``TILE`` words (or
``TILE_BYTES`` letters) is dealt to several tiles by hash, and visitors go to
every tile of it, so no task ever holds a whole block: the rows are sorted by
tile and streamed.

Words are counted over all whole texts. Nothing passes the driver.

Defined results: null and empty texts hold no words; a null doc_id reads as the
text ''; repeated rows count as often as they stand there; a word without a near
word has n_near 0, no form, and is its own root; equal counts go to the smaller
word in code point order; other columns are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, shuffle_partitions, stage, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]"  # fixed value: the letters of a word
MIN_LENGTH, MIN_COUNT, RATIO, DELETES = 6, 5, 5, 199  # fixed values
# letters whose counts are summed to name a block, and one more group of all others; frequent
# letters are spread over the groups
LETTER_GROUPS = ("ezkév", "thqwç", "asxjá", "onfyí", "ircbó")
TILE, TILE_BYTES = 2048, 4 << 20
VISITORS = 2048  # visitors per product
SMALL_TILES = 256  # homes that small tiles are gathered to, for one product
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the words of all texts, typing slips put in by the fixed rule, with their counts."""
    # a run that is too short stays too short: runs below the least length are not taken apart
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("w"))
    rows = rows.select("id", F.translate("w", _UPPER, _LOWER).alias("w"))
    rows = rows.select("w", F.crc32(F.concat_ws(":", "id", "w").cast("binary")).alias("h"), F.length("w").alias("len"))
    at = (F.col("h") % F.col("len")).cast("int")
    word = F.when(F.col("h") % DELETES == 0, F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.col("len")))
                  ).otherwise(F.col("w"))
    words = rows.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _group_counts() -> list[Column]:
    length = F.length("word")
    named = [length - F.length(F.translate("word", g, "")) for g in LETTER_GROUPS]
    rest = length
    for c in named:
        rest = rest - c
    return [*named, rest]


def _block(counts: list[Column]) -> Column:
    return F.concat_ws(",", *counts)


def _reach(counts: list[Column]) -> Column:
    """The blocks a word of these group counts visits: its own, those with one letter more, and those
    with one letter more in one group and one less in a later one."""
    def step(*changes):
        return _block([c + dict(changes)[i] if i in dict(changes) else c for i, c in enumerate(counts)])
    n = len(counts)
    return F.array(_block(counts), *[step((g, 1)) for g in range(n)],
                   *[step((g, 1), (h, -1)) for g in range(n) for h in range(g + 1, n)])


def _tiles(words: DataFrame) -> DataFrame:
    """Rows ``tile, role, word, n``: role 0 words live in the tile, 1 visit it, 2 visit their own block."""
    names = [f"c{i}" for i in range(len(LETTER_GROUPS) + 1)]
    counts = [F.col(c) for c in names]
    words = words.select("word", "n", *[c.alias(x) for c, x in zip(_group_counts(), names)])
    words = words.withColumn("block", _block(counts))
    size = F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum(F.length("word")) / TILE_BYTES), F.lit(1))
    blocks = stage(words.groupBy("block", *names).agg(size.cast("int").alias("parts")), "variant-blocks")
    # a block's words are laid out once for every part of the blocks that visit it
    fan = (blocks.select(F.explode(_reach(counts)).alias("block"), "parts")
           .groupBy("block").agg(F.max("parts").alias("fan")))
    sized = blocks.select("block", "parts").join(fan, "block", "left")
    words = words.join(sized, "block").withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    homes = words.select("word", "n", "block", "part", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("of"))
    homes = homes.select(F.concat_ws("/", "block", "part", "of").alias("tile"), F.lit(0).cast("byte").alias("role"), "word", "n")
    visits = words.select("word", "n", "block", "part", F.explode(_reach(counts)).alias("to"))
    there = blocks.select(F.col("block").alias("to"), F.col("parts").alias("to_parts"))
    visits = visits.join(there, "to").select("*", F.explode(F.sequence(F.lit(0), F.col("to_parts") - 1)).alias("of"))
    visits = visits.select(F.concat_ws("/", "to", "of", "part").alias("tile"),
                           F.when(F.col("to") == F.col("block"), 2).otherwise(1).cast("byte").alias("role"), "word", "n")
    return homes.unionByName(visits)


class _Words:
    """Words of one or several tiles as byte rows (every letter is below U+0100) and letter counts."""

    def __init__(self, words: list[str], wide: int):
        raw = [w.encode("latin-1") for w in words]
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.chars = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in raw), np.uint8).reshape(len(raw), wide)
        # sums of squares stay exact: below 2^24 in single, below 2^53 in double precision
        self.counts = np.zeros((len(raw), _LETTERS), np.float32 if wide < 4096 else np.float64)
        at = np.repeat(np.arange(len(raw)), self.length)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        np.add.at(self.counts, (at, _COLUMN[flat]), 1)
        self.square = (self.counts * self.counts).sum(axis=1)


_COLUMN = np.zeros(256, np.int64)
_COLUMN[ord("a"): ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:] = np.arange(26, 90)
_LETTERS = 90


def one_edit(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[j] differ by exactly one replaced or, where lengths differ by one,
    inserted letter."""
    x, y, lx, ly = a.chars[i], b.chars[j], a.length[i], b.length[j]
    same = (lx == ly) & ((x != y).sum(axis=1) == 1)
    for longer, shorter, n, test in ((x, y, ly, lx == ly + 1), (y, x, lx, ly == lx + 1)):
        k = np.flatnonzero(test)
        if len(k):
            p, q, m = longer[k], shorter[k], n[k]
            within = np.arange(p.shape[1] - 1) < m[:, None]
            head = (p[:, :-1] == q[:, :-1]) & within  # letters equal before the insert
            tail = (p[:, 1:] == q[:, :-1]) | ~within  # letters equal behind it
            lead = np.where(head.all(axis=1), head.shape[1], head.argmin(axis=1))
            behind = np.where(tail.all(axis=1), 0, tail.shape[1] - tail[:, ::-1].argmin(axis=1))
            same[k] = lead >= behind
    return same


def near_pairs(homes: list[str], home_tile: np.ndarray, visitors: list[str], tile: np.ndarray,
               own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (home, visitor) of one tile that are one edit apart. Visitors of their ``own``
    block meet each word once: those behind them in code point order."""
    wide = max(map(len, homes), default=0) + 1
    h = _Words(homes, wide)
    left, right = [], []
    for at in range(0, len(visitors), VISITORS):
        part = visitors[at: at + VISITORS]
        v = _Words(part, wide)
        distance = h.square[:, None] + v.square[None, :] - 2 * (h.counts @ v.counts.T)
        i, j = np.nonzero((distance <= 2) & (home_tile[:, None] == tile[None, at: at + VISITORS])
                          & (np.abs(h.length[:, None] - v.length[None, :]) <= 1))
        mine = np.flatnonzero(own[at + j])
        keep = np.ones(len(i), bool)
        keep[mine] = [part[b] < homes[a] for a, b in zip(i[mine].tolist(), j[mine].tolist())]
        i, j = i[keep], j[keep]
        ok = np.concatenate([one_edit(h, i[s: s + VISITORS], v, j[s: s + VISITORS])
                             for s in range(0, len(i), VISITORS)] or [np.zeros(0, bool)])
        left.append(i[ok])
        right.append(at + j[ok])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


class _Slab:
    """Whole tiles in the order they arrive, until there is enough for one product."""

    def __init__(self):
        self.homes, self.visitors, self.n_tiles = [], [], 0  # rows (tile, word, n, own)

    def drain(self) -> pa.RecordBatch:
        homes, visitors = self.homes, self.visitors
        i, j = near_pairs([r[1] for r in homes], np.array([r[0] for r in homes]), [r[1] for r in visitors],
                          np.array([r[0] for r in visitors]), np.array([r[3] for r in visitors], bool))
        found: dict[str, list] = {}
        for a, b in zip(i.tolist(), j.tolist()):
            (_, x, nx, _), (_, y, ny, _) = homes[a], visitors[b]
            for w, n, o in ((x, ny, y), (y, nx, x)):
                e = found.get(w)
                if e is None:
                    found[w] = [1, n, o]
                else:
                    e[0] += 1
                    if n > e[1] or n == e[1] and o < e[2]:
                        e[1], e[2] = n, o
        self.homes, self.visitors = [], []
        return pa.record_batch([pa.array(list(found), pa.string())] +
                               [pa.array([e[k] for e in found.values()], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                               names=["word", "n_near", "form_n", "form"])


def _compare(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tile, role): homes of a tile come first, then its visitors. Homes of one tile
    are bounded; visitors beyond a slab's room are compared and let go while the homes stay."""
    slab, tile, number = _Slab(), None, 0
    for batch in batches:
        for t, role, word, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if t != tile:
                if len(slab.homes) >= SMALL_TILES or len(slab.visitors) >= VISITORS:
                    if slab.visitors:
                        yield slab.drain()
                    slab = _Slab()
                tile, number = t, number + 1
            if role == 0:
                slab.homes.append((number, word, n, False))
                continue
            slab.visitors.append((number, word, n, role == 2))
            if len(slab.visitors) >= 2 * VISITORS:
                homes = [r for r in slab.homes if r[0] == number]
                yield slab.drain()
                slab.homes = homes
    if slab.visitors:
        yield slab.drain()


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: for every word with a near word their number and ``best`` (less, form),
    less being the form's count below zero."""
    tiles = _tiles(words).repartition(shuffle_partitions(words.sparkSession), "tile").sortWithinPartitions("tile", "role")
    found = map_arrow(tiles, _compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: pointers are doubled until none moves. Counts grow by
    ``RATIO`` at every step, so chains are short and there are no cycles."""
    at = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(at.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def spelling_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = stage(word_counts(docs, text_col, id_col), "variant-words")
    near = words.join(near_words(words), "word", "left")
    rises = -F.col("best.less") >= RATIO * F.col("n")
    near = stage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(rises, F.col("best.form")).alias("form"),
        F.when(rises, -F.col("best.less")).alias("form_n")), "variant-near")
    roots = _roots(near.where("form IS NOT NULL"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
