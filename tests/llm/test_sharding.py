"""Label propagation on densely linked rows: groups are made whole by exchanges, not by the layout behind it."""

import collections

import pytest
from pyspark.sql import functions as F

from flowscope.llm import sharding


def cells_of(spark, groups, rows, shards):
    """Rows in groups of equal size, labels drawn by hash: what propagation starts from."""
    label = sharding._shard_at(sharding._starts([rows // shards] * shards), F.pmod(F.xxhash64("id"), F.lit(rows)))
    r = spark.range(rows).select(F.pmod("id", F.lit(groups)).alias("text_hash"), F.lit(0).cast("long").alias("text_crc32"),
                                 F.lit(1).cast("long").alias("size"), label.alias("label"))
    return r.groupBy(*sharding.GROUP, "label").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("groups, rows, quota", [(2000, 40_000, 1000), (18_000, 36_000, 1000), (500, 4_000, 2000)])
def test_dense_groups_are_made_whole(spark, groups, rows, quota):
    shards = 40
    start = cells_of(spark, groups, rows, shards)
    first = collections.Counter()
    for r in start.groupBy("label").agg(F.sum("n").alias("n")).collect():
        first[r.label] = r.n
    quotas = [max(quota, first[s]) for s in range(shards)]  # hashed starts lie a little above some quotas
    done = sharding.propagate(start, quotas).collect()
    parts, loads, members = collections.Counter(), collections.Counter(), collections.Counter()
    for r in done:
        parts[r.text_hash] += 1
        loads[r.label] += r.n
        members[r.text_hash] += r.n
    assert set(members.values()) == {rows // groups} and len(members) == groups
    assert all(loads[s] <= quotas[s] for s in range(shards))
    assert sum(n == 1 for n in parts.values()) >= 0.9 * groups
