"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked; a link whose ends lie in different
shards is cut. Groups of more than 1/``HEAVY`` of a quota are placed first, the
largest first: each goes to the shard it fits best, or fills the shards with
most room one after the other, so one larger than a quota ends in about
members / quota shards. All other documents start with a label hashed from their
row, over the room that is left. The links of a group of equal texts are complete, so
a document's neighbours are counted per (group, label) cell instead of per link:
each round proposes that the cells of a group join the one most of its members are
in (ties drawn anew each round; every other round labels with room first). Proposals
are accepted in order while the target's room lasts, and beyond it as exchanges: as
many cells of n rows from one shard to another as of n rows the other way, which needs
no room. A cell moves whole and joins another of its group, so every move leaves one
cell less, and rounds go on until a round of either rule moves nothing. The few groups
still split then (their shards are full and nobody comes the other way) are laid out
whole, one behind the other, in the room of the shards, which cuts one group at
most per border of two shards. No shard then holds more linked rows than its quota,
and unlinked rows even the shards out exactly.

Law ``rows``: row counts of any two shards differ by one at most. Numbering is
two-level (running counts of buckets, then inside a bucket), so neither a shard
nor a group is ever sorted in one task. Only tables of one row per shard, and fewer
than ``HEAVY`` rows per shard of placed groups, reach the driver.

Defined results: a null text has size 16, crc32 0 and is equal to the empty
text; repeated rows are linked rows of their own; null doc_ids are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowscope.llm.common import running_offset, stage

SHARDS = 40
GROUP = ["text_hash", "text_crc32", "size"]
BUCKET_ROWS = 1024
HEAVY = 8


def _of_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), shard + 1)


def _per_shard(df: DataFrame, label: str, value: Column, shards: int) -> list[int]:
    """One total per shard (at most ``shards`` rows reach the driver)."""
    out = [0] * shards
    for r in df.groupBy(F.col(label).alias("s")).agg(F.sum(value).alias("v")).collect():
        out[r["s"]] = int(r["v"])
    return out


def _numbered(df: DataFrame, keys: list[str], bucket: str, out: str) -> DataFrame:
    """``out``: gapless numbers from 0 per ``keys``, ordered by (bucket, row)."""
    before = running_offset(df, keys, bucket, F.lit(1), "_before")
    inside = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy("row")) - 1
    return (df.withColumn("_inside", inside).join(before, [*keys, bucket])
            .withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside"))


def _starts(sizes: list[int]) -> list[int]:
    return [sum(sizes[:s]) for s in range(len(sizes))]


def _shard_at(starts: list[int], number: Column) -> Column:
    """The last shard whose room begins at or before the number (shards without room share their successor's start)."""
    return F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in starts)), lambda x: x <= number)) - 1


def place_heavy(sizes: list[int], quotas: list[int]) -> tuple[list[list[tuple[int, int]]], list[int]]:
    """Per group (largest first) its (shard, rows), and the room left per shard."""
    room, out = list(quotas), []
    for left in sizes:
        cells = []
        while left:
            fits = [s for s, x in enumerate(room) if x >= left]
            s = min(fits, key=lambda s: room[s]) if fits else max(range(len(room)), key=lambda s: room[s])
            n = min(left, room[s])
            cells.append((s, n))
            room[s] -= n
            left -= n
        out.append(cells)
    return out, room


def _exchanges(stuck: DataFrame) -> DataFrame:
    """Of the cells (GROUP, label, goal, n, bucket) that wish to move, those that change places: as
    many of n rows that go from one shard to another as of n rows that go the other way, in the
    order of the buckets. Both shards keep their loads."""
    way = ["label", "goal", "n"]
    back = stuck.groupBy(*way).agg(F.count(F.lit(1)).alias("offers")).select(
        F.col("label").alias("goal"), F.col("goal").alias("label"), "n", "offers")
    before = running_offset(stuck, way, "bucket", F.lit(1), "_before")
    inside = F.row_number().over(Window.partitionBy(*way, "bucket").orderBy(*GROUP)) - 1
    return (stuck.withColumn("_inside", inside).join(before, [*way, "bucket"]).join(back, way)
            .where(F.col("_before") + F.col("_inside") < F.col("offers")).select(*GROUP, "label", F.lit(True).alias("swap")))


def propagate(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Cells (group, label, n) after balanced label propagation."""
    shards, rounds, still = len(quotas), 0, 0
    while still < 2:  # a round of either rule that moves nothing
        loads = _per_shard(cells, "label", F.col("n"), shards)
        room = [max(0, q - x) for q, x in zip(quotas, loads)]
        open_first = _of_shard(room, F.col("label")) > 0 if rounds % 2 else F.lit(True)
        goal = cells.groupBy(*GROUP).agg(F.max(F.struct(
            open_first.alias("open"), "n", F.xxhash64(*GROUP, "label", F.lit(rounds // 2)).alias("tie"), "label")).alias("best"))
        moves = (cells.join(goal.select(*GROUP, F.col("best.label").alias("goal")), GROUP)
                 .withColumn("wish", F.when(F.col("goal") != F.col("label"), F.col("n")).otherwise(F.lit(0)))
                 .withColumn("bucket", F.pmod(F.xxhash64(*GROUP, F.lit(rounds)), F.lit(4096))))
        before = running_offset(moves.where("wish > 0"), ["goal"], "bucket", F.col("wish"), "_before")
        order = Window.partitionBy("goal", "bucket").orderBy(*GROUP, "label")
        inside = F.sum("wish").over(order.rowsBetween(Window.unboundedPreceding, -1))
        moves = moves.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(before, ["goal", "bucket"], "left")
        free = _of_shard(room, F.col("goal")) - F.coalesce("_before", F.lit(0)) - F.col("_inside")
        moves = stage(moves.select(*GROUP, "label", "goal", "n", "wish", "bucket", ((F.col("wish") > 0) & (F.col("wish") <= free)).alias("go")),
                      "shard-moves")
        swaps = _exchanges(moves.where("wish > 0 and not go").select(*GROUP, "label", "goal", "n", "bucket"))
        moves = stage(moves.join(swaps, [*GROUP, "label"], "left").withColumn("go", F.col("go") | F.coalesce("swap", F.lit(False))),
                      "shard-moves")
        rounds += 1
        if moves.where("go").isEmpty():
            still += 1
            continue
        still = 0
        cells = stage(moves.select(*GROUP, F.when(F.col("go"), F.col("goal")).otherwise(F.col("label")).alias("label"), "n")
                      .groupBy(*GROUP, "label").agg(F.sum("n").alias("n")), "shard-cells")
    return cells


def gather(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Cells with the groups that are still split, or in a shard beyond its quota, laid out whole in the free room."""
    shards = len(quotas)
    groups = stage(cells.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"),
                                             F.max("label").alias("label")), "shard-split")
    loads = _per_shard(groups.where("parts = 1"), "label", F.col("n"), shards)
    fits = [int(x <= q) for q, x in zip(quotas, loads)]
    free = [q - x if f else q for q, x, f in zip(quotas, loads, fits)]
    stays = (F.col("parts") == 1) & (_of_shard(fits, F.col("label")) == 1)
    split = groups.where(~stays).withColumn("bucket", F.pmod(F.xxhash64(*GROUP), F.lit(4096)))
    before = running_offset(split, [], "bucket", F.col("n"), "_before")
    order = Window.partitionBy("bucket").orderBy(*GROUP).rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("_inside", F.coalesce(F.sum("n").over(order), F.lit(0))).join(before, "bucket")
    at = F.col("_before") + F.col("_inside")
    pieces = F.array(*(F.struct(F.lit(s).alias("label"), (F.least(at + F.col("n"), F.lit(a + x)) - F.greatest(at, F.lit(a))).alias("n"))
                       for s, (a, x) in enumerate(zip(_starts(free), free))))
    laid = split.select(*GROUP, F.explode(pieces).alias("c")).select(*GROUP, "c.label", "c.n").where("n > 0")
    return stage(groups.where(stays).select(*GROUP, "label", "n").unionByName(laid), "shard-cells")


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash")), "shard-rows")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    # stored, so that the join below reads plain exchanges whose hot partitions Spark can split
    groups = stage(rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shard-groups")
    is_heavy = F.col("members") * (HEAVY * shards) > total
    heavy = groups.where(is_heavy).orderBy(F.desc("members"), *GROUP).collect()  # fewer than HEAVY * shards rows
    given, room = place_heavy([g["members"] for g in heavy], quotas)
    start = _shard_at(_starts(room), F.pmod(F.xxhash64("row"), F.lit(max(1, sum(room)))))
    linked = stage(rows.withColumn("label", start).join(groups, GROUP, "left"), "shard-linked")
    cells = stage(linked.where("members > 1").where(~is_heavy).groupBy(*GROUP, "label")
                  .agg(F.count(F.lit(1)).alias("n")), "shard-cells")
    cells = gather(propagate(cells, room), room)
    fixed = [F.struct(*(F.lit(g[k]).alias(k) for k in GROUP), F.lit(s).alias("label"), F.lit(n).cast("long").alias("n"))
             for g, own in zip(heavy, given) for s, n in own]
    if fixed:
        one = docs.sparkSession.range(1).select(F.explode(F.array(*fixed)).alias("c")).select("c.*")
        cells = cells.unionByName(one.select(*(F.col(c).cast(cells.schema[c].dataType).alias(c) for c in cells.columns)))
    # members of a group take its cells in turn
    spans = cells.groupBy(*GROUP).agg(F.sort_array(F.collect_list(F.struct("label", "n"))).alias("cells"))  # <= shards entries
    spans = spans.withColumn("ends", F.expr(
        "transform(cells, (c, i) -> aggregate(slice(cells, 1, i + 1), 0L, (s, x) -> s + x.n))"))
    member = linked.where("members > 1").drop("label").withColumn(
        "part", F.pmod(F.xxhash64("row", F.lit(7)), F.greatest(F.lit(1), F.col("members") / BUCKET_ROWS).cast("long")))
    member = stage(_numbered(member, GROUP, "part", "turn"), "shard-members")
    placed = member.join(spans, GROUP).select("row", "doc_id", "size", "text_crc32", F.lit(0).alias("loose"), F.expr(
        "cells[size(filter(ends, e -> e <= turn))].label").alias("label"))
    rest = linked.where("members is null").select("row", "doc_id", "size", "text_crc32", F.lit(1).alias("loose"), "label")
    buckets = max(1, total // (shards * BUCKET_ROWS))
    wanted = stage(placed.unionByName(rest).withColumn(
        "bucket", F.col("loose") * buckets + F.pmod(F.xxhash64("row", F.lit(11)), F.lit(buckets))), "shard-wanted")
    ranked = stage(_numbered(wanted, ["label"], "bucket", "rank"), "shard-ranked")
    loads = _per_shard(ranked, "label", F.lit(1), shards)
    over, room_starts, taken, excess = [], [], 0, 0
    for load, quota in zip(loads, quotas):
        over.append(excess)  # number of the shard's first row in excess
        excess += max(0, load - quota)
        room_starts.append(taken)  # the excess rows that fill this shard begin here
        taken += max(0, quota - load)
    stays = F.col("rank") < _of_shard(quotas, F.col("label"))
    number = _of_shard(over, F.col("label")) + F.col("rank") - _of_shard(quotas, F.col("label"))
    ranked = ranked.withColumn("shard", F.when(stays, F.col("label")).otherwise(_shard_at(room_starts, number)).cast("int"))
    slot = F.when(stays, F.col("rank")).otherwise(
        F.least(_of_shard(loads, F.col("shard")), _of_shard(quotas, F.col("shard"))) + number - _of_shard(room_starts, F.col("shard")))
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
