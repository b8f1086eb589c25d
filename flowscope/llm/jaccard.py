"""Exact n-gram Jaccard self-join (components) with set-relation skipping.

A document's set holds the 64-bit hashes of its distinct runs of ``words``
words. Sets that are equal are one class from the start. The join then skips
work at three levels.

* **Corpus.** In hash order, linked sets share several of their smallest
  hashes: a prefix of |x| - ceil(t|x|) + ceil(|x|/4) hashes holds at least
  ceil(t|x|/4) that some linked set has in its own prefix. Scan tasks send these
  prefixes, Golomb-coded at a width that follows the row count, to owners
  that count the shared ones per row (hashes that repeat inside a block are
  counted there and sent once). Rows with too few cannot link with anything.
* **Index.** For the rest, an inverted index over the prefixes in rarest-first
  order. Tasks send the keys of their sets (short prefixes of the hashes),
  Golomb-coded, to owners that answer with a rank of each key's frequency;
  keys that one set alone has need no posting. A list is cut into blocks by
  set size; a set skips every block but its own and the two beside it, and
  every entry whose position in either set leaves too few hashes for the
  required overlap.
* **Answers.** In each round a list block compares only its pivots with its
  members. The answers of a pivot settle the other members: a set highly
  similar to the pivot inherits its links (same component, no comparison), and
  its overlap with a set y of known overlap with the pivot is at most
  min(|x & p|, |y & p|) + min(|x - p|, |y - p|), which rules out sets that only share a
  passage. Parity signatures (512 bits in the first round, 2048 after it) bound the
  symmetric difference from below and rule out most near misses. Pivots leave their blocks, blocks whose neighbourhood is one
  component leave the index, pivots multiply, until the index is empty; so every
  pair of the index is compared, connected or ruled out by a bound, and large
  groups of copies are never expanded into pairs.

Defined results: a null text or one without words has an empty set and links
with nothing; fewer than ``words`` words are one shingle; repeated rows and
null doc_ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import map_arrow, shuffle_partitions, slices, stage, string_bytes
from flowscope.llm.components import components
from flowscope.llm.exchange import cut_by_owner, decode, encode
from flowscope.llm.textnum import LOWER, NOT_SPACE, grams, mix, span_hashes, word_spans

U = np.uint64
WORDS = 5
# links: 100 * intersection >= 75 * union; with |x| <= |union| the overlap is at least 3/4 of either set
NUM, DEN = 3, 4
BLOCK_ROWS = 1 << 16
BLOCK_HASHES = 1 << 20
OWNERS_PER_PARTITION = 4

_SENT = pa.schema([("kind", pa.string()), ("row", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                   ("shared", pa.int64()), ("cls", pa.binary()), ("owner", pa.int32()), ("block", pa.int64()),
                   ("message", pa.binary()), ("members", pa.binary())])
_SENT_SQL = ("kind string, row long, key long, doc_id long, n long, shared long, cls binary, owner int, block long, "
             "message binary, members binary")

_POSTED = pa.schema([("block", pa.int64()), ("owner", pa.int32()), *((c, pa.binary()) for c in (
    "message", "counts", "members", "nodes", "sizes", "signs"))])
_POSTED_SQL = "block long, owner int, message binary, counts binary, members binary, nodes binary, sizes binary, signs binary"


def document_sets(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for a, b in slices(offsets):
        data = LOWER[raw[offsets[a]: offsets[b]]]
        starts, ends, first = word_spans(data, offsets[a: b + 1] - offsets[a], NOT_SPACE)
        h = span_hashes(data, starts, ends)
        g = grams(h, words)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= words:
                yield np.unique(g[lo: hi - words + 1])
            else:
                yield grams(h[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64)


def set_class(s: np.ndarray) -> bytes:
    """128-bit identity of a set."""
    if not len(s):
        return b""
    return b"".join(np.uint64(v).tobytes() for v in (np.add.reduce(mix(s ^ U(0x51ED270B))),
                                                     np.bitwise_xor.reduce(mix(s + U(len(s))))))


def overlap_least(n):
    """ceil(3n / 4): the least overlap of a linked set of n shingles."""
    return -(-NUM * n // DEN)


def _send(owners: int, width: int):
    """Scan task: one digest row per document and the block messages."""
    shift = U(64 - width)

    def fill(count, **given):
        return pa.RecordBatch.from_arrays(
            [given[f.name] if f.name in given else pa.nulls(count, f.type) for f in _SENT], schema=_SENT)

    def flush(block, keys, ids, sizes, classes, row, prefixes):
        n = len(sizes)
        h = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint64)
        member = np.repeat(np.arange(n), [len(p) for p in prefixes]).astype(np.uint16)
        order = np.argsort(h, kind="stable")
        h, member = h[order], member[order]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(head)
        count = np.diff(np.append(at, len(h)))
        repeated = np.repeat(count > 1, count)
        shared = np.bincount(member[repeated], minlength=n)
        yield fill(n, kind=pa.array(["row"] * n), row=pa.array(np.arange(row, row + n)), key=pa.array(keys, pa.int64()),
                   doc_id=pa.array(ids, pa.int64()), n=pa.array(sizes, pa.int64()), shared=pa.array(shared), cls=pa.array(classes, pa.binary()))
        distinct, single, who = h[at], count == 1, member[at]
        parts = cut_by_owner(distinct << shift, owners)
        if parts:
            yield fill(len(parts), kind=pa.array(["message"] * len(parts)), row=pa.array([row] * len(parts), pa.int64()),
                       owner=pa.array([p[0] for p in parts], pa.int32()), block=pa.array([block] * len(parts), pa.int64()),
                       message=pa.array([encode(distinct[a:b]) for _, a, b in parts], pa.binary()),
                       # the row of each hash inside the block; repeated ones need none
                       members=pa.array([np.packbits(single[a:b]).tobytes() + who[a:b][single[a:b]].tobytes()
                                         for _, a, b in parts], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, block = part << 36, part << 20
        keys, ids, sizes, classes, prefixes, held = [], [], [], [], [], 0
        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            for doc_id, key, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), document_sets(raw, offsets)):
                n = len(s)
                p = n - overlap_least(n) + -(-n // 4)
                ids.append(doc_id)
                keys.append(key)
                sizes.append(n)
                classes.append(set_class(s))
                prefixes.append(np.unique(s[: min(n, p)] >> shift))
                held += len(prefixes[-1])
                if len(ids) == BLOCK_ROWS or held >= BLOCK_HASHES:
                    yield from flush(block, keys, ids, sizes, classes, row, prefixes)
                    row, block = row + len(ids), block + 1
                    keys, ids, sizes, classes, prefixes, held = [], [], [], [], [], 0
        if ids:
            yield from flush(block, keys, ids, sizes, classes, row, prefixes)

    return run


def _count_shared(table: pa.Table) -> pa.Table:
    """An owner's work: per message, how many of each row's hashes some other row has too
    (positions of rows inside the block, and counts)."""
    hashes, who = [], []
    for message, members in zip(table["message"].to_pylist(), table["members"].to_pylist()):
        h = decode(message)
        size = (len(h) + 7) // 8
        single = np.unpackbits(np.frombuffer(members, np.uint8, size))[: len(h)].astype(bool)
        row = np.full(len(h), -1, np.int64)
        row[single] = np.frombuffer(members, np.uint16, offset=size)
        hashes.append(h)
        who.append(row)
    every = np.sort(np.concatenate(hashes))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    rows, counts = [], []
    for h, row in zip(hashes, who):
        row, n = np.unique(row[np.isin(h, again, assume_unique=True) & (row >= 0)], return_counts=True)
        rows.append(row.astype(np.uint16).tobytes())
        counts.append(n.astype(np.uint32).tobytes())  # a long text may share more than 65,535 with one owner
    return pa.table({"block": table["block"], "first": table["row"], "rows": pa.array(rows, pa.binary()),
                     "counts": pa.array(counts, pa.binary())})


def _sum_shared(table: pa.Table) -> pa.Table:
    """All owners' answers to one block, added up per row."""
    total = np.zeros(BLOCK_ROWS, np.int64)
    for rows, counts in zip(table["rows"].to_pylist(), table["counts"].to_pylist()):
        total[np.frombuffer(rows, np.uint16)] += np.frombuffer(counts, np.uint32)
    at = np.flatnonzero(total)
    return pa.table({"row": pa.array(at + table["first"][0].as_py()), "shared": pa.array(total[at])})


def _sets_task(words_map: np.ndarray):
    """Second scan: (class, set) of rows whose class is in the filter, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            raw, offsets = string_bytes(batch.column(0))
            classes, sets = [], []
            for s in document_sets(raw, offsets):
                c = set_class(s)
                if c and c not in seen and filter_hit(words_map, c):
                    seen.add(c)
                    classes.append(c)
                    sets.append(s.view(np.int64))
                if len(sets) == 512:
                    yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "items"])
                    classes, sets = [], []
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "items"])
    return run


def filter_hit(words: np.ndarray, cls: bytes) -> bool:
    slot = int.from_bytes(cls[:8], "big") % (64 * len(words))
    return bool(int(words[slot >> 6]) >> (slot & 63) & 1)


def filter_words(slots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size over the column ``slot``: at most bits / 64 rows reach the driver.
    It only spares work on sets that are not asked for; a join follows."""
    rows = (slots.select("slot").distinct().groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).toPandas())
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def _class_slots(classes: DataFrame, bits: int) -> DataFrame:
    low = F.conv(F.hex(F.expr("substring(cls, 1, 8)")), 16, 10).cast("decimal(20,0)") % F.lit(bits)
    return classes.select(low.cast("long").alias("slot"))


def _sets_of(sets: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """(node, n, items) of the sets whose node is in ``nodes`` and of a few others (a bitmap of fixed size
    decides), so that a join with ``nodes`` does not shuffle every set first."""
    def slot(node: str):
        return F.pmod(F.xxhash64(node), F.lit(bits)).alias("slot")
    words = sets.sparkSession.sparkContext.broadcast(filter_words(nodes.select(slot("node")), bits))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            hit = words.value[at >> 6] >> (at & 63).astype(np.uint64) & U(1)
            yield pa.RecordBatch.from_arrays(batch.columns[1:], ["node", "n", "items"]).filter(pa.array(hit.astype(bool)))

    return map_arrow(sets.select(slot("node"), "node", "n", "items"), named, "node long, n long, items array<long>")


# 64-bit words of the signatures: in the first round, and for the few sets that are left after it
FIRST_WORDS, LATER_WORDS = 8, 32


def _signature(words: int) -> list[str]:
    return [f"s{i}" for i in range(words)]


def _signatures(sets: DataFrame, words: int) -> DataFrame:
    """(node, n, items, s0, s1, ..): bit h of the 64 * ``words`` is the parity of the set's hashes with residue
    h; the signatures of two sets differ in at most as many bits as the sets differ in items."""
    def word(i: int):
        return F.expr(f"aggregate(items, 0L, (acc, x) -> if(pmod(shiftright(x, 6), {words}) = {i}, "
                      "acc ^ shiftleft(1L, cast(x & 63 as int)), acc))")
    return sets.select("node", "n", "items", *(word(i).alias(s) for i, s in enumerate(_signature(words))))


def _post(owners: int, width: int):
    """Scan task over stored sets: per block its nodes, sizes and signatures, and to each owner of a range of
    keys (the first ``width`` bits of the hashes) the block's keys there, how many of its items have each, and
    the sets these belong to."""
    shift = U(64 - width)

    def fill(count, **given):
        return pa.RecordBatch.from_arrays(
            [given[f.name] if f.name in given else pa.nulls(count, f.type) for f in _POSTED], schema=_POSTED)

    def flush(block, nodes, sizes, signs, items):
        key = np.concatenate(items) >> shift
        member = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint16)
        order = np.argsort(key, kind="stable")
        key, member = key[order], member[order]
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        start = np.append(np.flatnonzero(head), len(key))
        count = np.diff(start).astype(np.uint32)
        distinct = key[head]
        yield fill(1, block=pa.array([block]), nodes=pa.array([np.array(nodes, np.int64).tobytes()], pa.binary()),
                   sizes=pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                   signs=pa.array([b"".join(signs)], pa.binary()))
        parts = cut_by_owner(distinct << shift, owners)
        yield fill(len(parts), block=pa.array([block] * len(parts), pa.int64()), owner=pa.array([p[0] for p in parts], pa.int32()),
                   message=pa.array([encode(distinct[a:b]) for _, a, b in parts], pa.binary()),
                   counts=pa.array([count[a:b].tobytes() for _, a, b in parts], pa.binary()),
                   members=pa.array([member[start[a]: start[b]].tobytes() for _, a, b in parts], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 20
        nodes, sizes, signs, items, held = [], [], [], [], 0
        for batch in batches:
            for node, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = row.values.to_numpy(zero_copy_only=False).view(np.uint64)
                nodes.append(node)
                sizes.append(len(own))
                signs.append(parity(own, FIRST_WORDS))
                items.append(own)
                held += len(own)
                if len(nodes) == BLOCK_ROWS or held >= BLOCK_HASHES:
                    yield from flush(block, nodes, sizes, signs, items)
                    block += 1
                    nodes, sizes, signs, items, held = [], [], [], [], 0
        if nodes:
            yield from flush(block, nodes, sizes, signs, items)

    return run


def parity(items: np.ndarray, words: int) -> bytes:
    """The signature of one set (see ``_signatures``)."""
    odd = np.bincount((items & U(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _rank(df: np.ndarray) -> np.ndarray:
    """A byte that never falls with the frequency: up to 128 itself, then eight steps per doubling."""
    return np.where(df <= 128, df, np.minimum(255, 128 + 8 * np.log2(np.maximum(df, 128) / 128))).astype(np.uint8)


def _frequencies(table: pa.Table) -> pa.Table:
    """An owner's work: per message, the keys that more than one item has, with their ranks."""
    keys = [decode(m) for m in table["message"].to_pylist()]
    counts = [np.frombuffer(c, np.uint32) for c in table["counts"].to_pylist()]
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    df = np.bincount(at, np.concatenate(counts)).astype(np.int64)[at]
    out, start = [], 0
    for key, count, members in zip(keys, counts, table["members"].to_pylist()):
        mine = df[start: start + len(key)]
        start += len(key)
        again = mine > 1
        out.append((encode(key[again]), count[again].tobytes(), _rank(mine[again]).tobytes(),
                    np.frombuffer(members, np.uint16)[np.repeat(again, count)].tobytes()))
    return pa.table({"block": table["block"], **{c: pa.array(v, pa.binary()) for c, v in zip(
        ("message", "counts", "ranks", "members"), zip(*out))}})


def _postings(table: pa.Table) -> pa.Table:
    """All owners' answers to one block: the postings of its sets' prefixes. Keys that one item alone has come
    first and need no posting."""
    head = table.filter(table["nodes"].is_valid()).to_pylist()[0]
    nodes, sizes = np.frombuffer(head["nodes"], np.int64), np.frombuffer(head["sizes"], np.int64)
    answers = table.filter(table["message"].is_valid())
    counts = [np.frombuffer(c, np.uint32) for c in answers["counts"].to_pylist()]
    key, rank, member = (np.concatenate([np.empty(0, kind), *parts]) for kind, parts in (
        (np.uint64, [np.repeat(decode(m), c) for m, c in zip(answers["message"].to_pylist(), counts)]),
        (np.uint8, [np.repeat(np.frombuffer(r, np.uint8), c) for r, c in zip(answers["ranks"].to_pylist(), counts)]),
        (np.uint16, [np.frombuffer(m, np.uint16) for m in answers["members"].to_pylist()])))
    order = np.lexsort((key, rank, member))
    key, member = key[order], member[order].astype(np.int64)
    own = np.bincount(member, minlength=len(nodes))
    k = np.arange(len(key)) - (np.cumsum(own) - own)[member]
    kept = k <= (own - overlap_least(sizes))[member]
    key, member, k = key[kept], member[kept], k[kept]
    return pa.table({"item": pa.array(key.astype(np.int64)), "node": pa.array(nodes[member]), "n": pa.array(sizes[member]),
                     "pos": pa.array((sizes - own)[member] + k)})


def _block_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for nodes, signs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            signs = np.frombuffer(signs, np.int64).reshape(-1, FIRST_WORDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(nodes, np.int64)), *map(pa.array, signs.T.copy())],
                                             ["node", *_signature(FIRST_WORDS)])


def _prefix_index(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings (item, node, n, pos, size_block) of the rarest-first prefixes, and (node, signature) of all sets.
    Items go by keys of so many bits that about one in a thousand meets another item's key by chance; such a
    meeting is a posting too many, never one too few."""
    items = sets.agg(F.sum("n")).head()[0] or 0
    width = min(64, 10 + max(1, int(items).bit_length()))
    posted = stage(map_arrow(sets.select("node", "items"), _post(OWNERS_PER_PARTITION * shuffle_partitions(sets.sparkSession), width),
                             _POSTED_SQL), "jaccard-posted")
    answers = (posted.where("owner is not null").select("block", "owner", "message", "counts", "members")
               .groupBy("owner").applyInArrow(_frequencies, "block long, message binary, counts binary, ranks binary, members binary"))
    heads = posted.where("owner is null").select("block", "nodes", "sizes")
    found = (answers.unionByName(heads, allowMissingColumns=True).groupBy("block")
             .applyInArrow(_postings, "item long, node long, n long, pos long"))
    found = found.withColumn("size_block", F.floor(F.log(F.col("n")) / F.log(F.lit(DEN / NUM))))
    signs = map_arrow(posted.where("owner is null").select("nodes", "signs"), _block_signatures,
                      ", ".join(f"{c} long" for c in ("node", *_signature(FIRST_WORDS))))
    return stage(found, "jaccard-index"), signs


LINKED = "100 * both >= 75 * (a_n + b_n - both)"
# a link of sets of n and p_n items needs this overlap, and so at most this many differing items
NEED = "ceil(3 * (n + p_n) / 7)"


def _worth(words: int) -> str:
    differ = " + ".join(f"bit_count({s} ^ p_{s})" for s in _signature(words))
    return (f"node <> p_node and comp <> p_comp and least(pos, p_pos) + least(n - pos, p_n - p_pos) >= {NEED}"
            " and not coalesce(leader = p_leader and least(with_leader, p_with_leader)"
            f" + least(n - with_leader, p_n - p_with_leader) < {NEED}, false) and {differ} <= n + p_n - 2 * {NEED}")


def _with_pivots(live: DataFrame, pivots: int, seed: int) -> DataFrame:
    """``live`` with is_pivot: the least node of each of ``pivots`` random groups of a list block."""
    group = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(pivots))
    first = (live.groupBy("item", "size_block", group.alias("g")).agg(F.min("node").alias("node"))
             .select("item", "size_block", "node", F.lit(True).alias("first")))
    return live.join(first, ["item", "size_block", "node"], "left").withColumn("is_pivot", F.col("first").isNotNull()).drop("first")


def _candidates(live: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(pairs a < b of pivots and members worth comparing, postings without the pivots)."""
    near = F.explode(F.array(*(F.col("size_block") + d for d in (-1, 0, 1))))
    p = live.where("is_pivot").select("item", near.alias("size_block"), *(
        F.col(c).alias("p_" + c) for c in ("node", "comp", "n", "pos", "leader", "with_leader", *_signature(words))))
    pairs = live.join(p, ["item", "size_block"]).where(_worth(words))
    pairs = pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()
    return pairs, live.where("not is_pivot").select("item", "node", "n", "pos", "size_block")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("items").alias("a_items"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("items").alias("b_items"))
    return pairs.join(a, "a").join(b, "b").select(
        "a", "b", "a_n", "b_n", F.size(F.array_intersect("a_items", "b_items")).cast("long").alias("both"))


def similar_components(docs: DataFrame, key_col: str = "doc_id", filter_bits: int = 1 << 24) -> DataFrame:
    """Per input row: key, doc_id, n_shingles, component_id (smallest doc_id reachable by
    links) and first_row (True for one row of each component that carries that id).
    ``key_col`` is carried through as ``key``."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                         F.col(key_col).cast("long").alias("key"))
    # width of the exchanged hashes: 18 bits beyond the row count, so chance hits stay rare at any size
    # (a row that they keep costs a comparison later)
    width = min(64, 18 + max(1, int(source.count()).bit_length()))
    owners = OWNERS_PER_PARTITION * shuffle_partitions(spark)
    sent = stage(map_arrow(source, _send(owners, width), _SENT_SQL), "jaccard-sent")
    rows = sent.where("kind = 'row'").select("row", "key", "doc_id", "n", "shared", "cls")
    counted = (sent.where("kind = 'message'").select("block", "row", "owner", "message", "members")
               .groupBy("owner").applyInArrow(_count_shared, "block long, first long, rows binary, counts binary")
               .groupBy("block").applyInArrow(_sum_shared, "row long, shared long"))
    shared = (counted.unionByName(rows.where("shared > 0").select("row", "shared"))
              .groupBy("row").agg(F.sum("shared").alias("total")).select(F.col("row").alias("_row"), "total"))
    alive = rows.join(shared, rows["row"] == shared["_row"]).where(
        "total >= ceil(3 * n / 16)").select("row", "doc_id", "n", "cls")
    alive = stage(alive, "jaccard-alive")
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "row", "doc_id"))
    classes = stage(alive.groupBy("cls", "n").agg(F.min("row").alias("node"), least.alias("least")), "jaccard-classes")
    words = spark.sparkContext.broadcast(filter_words(_class_slots(classes, filter_bits), filter_bits))
    sets = (map_arrow(source.select("text"), lambda it: _sets_task(words.value)(it), "cls binary, items array<long>")
            .groupBy("cls").agg(F.first("items").alias("items")))
    sets = stage(classes.join(sets, "cls").select("node", "n", "items"), "jaccard-sets")
    nodes = _connected(sets, filter_bits)
    labels = classes.join(nodes, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    least = labels.groupBy("comp").agg(F.min("least").alias("first"))
    labels = labels.join(least, "comp").select(F.col("cls").alias("_cls"), "first")
    alone = F.col("_cls").isNull()
    return rows.join(labels, rows["cls"] == labels["_cls"], "left").select(
        "key", "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("first.row"))).alias("first_row"))


def _connected(sets: DataFrame, filter_bits: int) -> DataFrame:
    """(node, component) of the nodes that have links, by rounds of pivots. A round after the first
    stores the sets that its index still names and moves no other: what the rounds shuffle shrinks
    with the index, however many there are."""
    spark = sets.sparkSession
    index, signs = _prefix_index(sets)
    words = FIRST_WORDS
    nodes = spark.createDataFrame([], "node long, component long")
    checked, pivots, rounds = None, 1, 0
    while True:
        if not rounds:
            unknown = F.lit(None).cast("long")
            live = index.withColumns({"comp": F.col("node"), "leader": unknown, "with_leader": unknown})
        else:
            live = index.join(nodes, "node", "left").withColumn("comp", F.coalesce("component", "node"))
            # keep what has another component in reach
            near = F.explode(F.array(*(F.col("size_block") + d for d in (-1, 0, 1))))
            mixed = (live.select("item", near.alias("size_block"), "comp").groupBy("item", "size_block")
                     .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("item", "size_block"))
            live = live.join(mixed, ["item", "size_block"], "left_semi")
            known = checked.select(F.col("a").alias("node"), F.struct(F.col("b").alias("leader"), "both").alias("x")).unionByName(
                checked.select(F.col("b").alias("node"), F.struct(F.col("a").alias("leader"), "both").alias("x")))
            known = known.groupBy("node").agg(F.min("x").alias("x")).select("node", "x.leader", F.col("x.both").alias("with_leader"))
            live = live.join(known, "node", "left").select("item", "node", "n", "pos", "size_block", "comp", "leader", "with_leader")
            live = stage(live, "jaccard-left")
            if live.isEmpty():
                return nodes
            left = live.select("node").distinct()
            if rounds == 1:
                words = LATER_WORDS
                sets = _signatures(_sets_of(sets, left, filter_bits).join(left, "node", "left_semi"), words)
            else:
                sets = sets.join(left, "node", "left_semi")
            sets = stage(sets, "jaccard-sets")
            signs = sets.select("node", *_signature(words))
        live = stage(_with_pivots(live, pivots, rounds).join(signs, "node"), "jaccard-live")
        pairs, index = _candidates(live, words)
        if checked is not None:
            # an outer join: Spark would test an anti-join before the pairs are made distinct, once
            # for every item that a pair shares
            pairs = pairs.join(checked.select("a", "b", F.lit(True).alias("known")), ["a", "b"], "left").where("known IS NULL").select("a", "b")
        pairs = stage(pairs, "jaccard-pairs")
        if rounds:
            found = _overlaps(pairs, sets)
        else:
            ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
            found = _overlaps(pairs, _sets_of(sets, ends, filter_bits))
        found = stage(found, "jaccard-answers")
        links = found.where(LINKED).select("a", "b")
        checked = found if checked is None else checked.unionByName(found)
        if links.isEmpty():
            pivots *= 16
        else:
            nodes = components(links.unionByName(nodes.where("node <> component").select(
                F.col("component").alias("a"), F.col("node").alias("b"))))
            pivots *= 8
        rounds += 1
