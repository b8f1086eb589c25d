"""Selection chains, selectivity profiles and the cost model of the
reordering and fusion experiments (A16-A18, L3, L7, L8, X12-X14, S15).

The two selections are repeatable hash filters on a row key (A uses
``HASH_A``, B uses ``HASH_B``), so A->B and B->A keep exactly the same rows.
Selectivities are *measured* on the data in one scan (conditional counts),
per-tuple operator costs are parameters. Cost formulas:

* A then B: ``cost_a + sel_a * cost_b``; B then A: ``cost_b + sel_b * cost_a``
* fused (no hand-off cost): ``(cost_a + cost_b) * c / (c + 1)`` for a ratio
  ``c`` of operator cost to communication cost; the unfused chain keeps the
  A-then-B cost and ignores ``c``.

Throughput is the reciprocal of the per-tuple cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowscope.functions.hashing import HASH_A, HASH_B, HASH_RANGE, hash_keep, unit_hash
from flowscope.operators.running import running_sums


def _c(x) -> Column:
    return F.lit(float(x))


def filter_chain(df: DataFrame, key: str, rate_a: float, rate_b: float, order: str = "ab") -> DataFrame:
    """L3: selections A (rate_a) and B (rate_b) in the given order."""
    a, b = hash_keep(key, rate_a, HASH_A), hash_keep(key, rate_b, HASH_B)
    first, second = (a, b) if order == "ab" else (b, a)
    return df.where(first).where(second)


def chain_profile(df: DataFrame, key: str, rate_a: float, rate_b: float,
                  cost_a: float = 1.0, cost_b: float = 1.0) -> DataFrame:
    """A18 + L7: rows in and out of each stage in both orders, measured
    selectivities, modelled per-tuple costs and the cheaper order (one scan)."""
    a, b = hash_keep(key, rate_a, HASH_A), hash_keep(key, rate_b, HASH_B)
    c = df.agg(F.count(F.lit(1)).alias("n_in"), F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"),
               F.count_if(a & b).alias("n_ab"))
    sel_a, sel_b = F.try_divide("n_a", "n_in"), F.try_divide("n_b", "n_in")
    out = c.select("*", sel_a.alias("sel_a"), sel_b.alias("sel_b"))
    out = out.select("*", (_c(cost_a) + F.col("sel_a") * _c(cost_b)).alias("cost_ab"),
                     (_c(cost_b) + F.col("sel_b") * _c(cost_a)).alias("cost_ba"))
    return out.select("*", F.when(F.col("cost_ab") <= F.col("cost_ba"), F.lit("A,B"))
                      .otherwise(F.lit("B,A")).alias("best_order"))


def cost_model(table: DataFrame) -> DataFrame:
    """L8 over rows ``cost_a, cost_b, sel_a, sel_b, cost_ratio``: adds
    ``cost_ab``, ``cost_ba`` and ``cost_fused``."""
    ca, cb, sa, sb, r = (F.col(n) for n in ("cost_a", "cost_b", "sel_a", "sel_b", "cost_ratio"))
    return table.select("*", (ca + sa * cb).alias("cost_ab"), (cb + sb * ca).alias("cost_ba"),
                        ((ca + cb) * r / (r + F.lit(1.0))).alias("cost_fused"))


def measured_selectivities(df: DataFrame, key: str, runs: int = 1, rate_a: float = 0.5,
                           steps: int = 100, last: int = 99) -> DataFrame:
    """Per run ``r`` (the key is salted as ``key * runs + r``) and grid index
    ``i``: ``sel_a`` of A at ``rate_a`` and ``sel_b`` of B at ``i/steps``.

    One scan: each row is expanded to the ``runs`` salts (a small constant)
    and counted per ``(run, i_min)``, where ``i_min`` is the first grid rate
    that keeps it under B (see ``shedding.shed_sweep``). Those few counts
    are laid out over the grid and summed, so every selectivity comes from
    the same aggregate without a join.
    Output: ``run, i, rate_b, sel_a, sel_b``.
    """
    salted = df.select(F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), key)
    skey = F.col(key) * F.lit(runs) + F.col("run")
    i_min = (F.floor(unit_hash(skey, HASH_B) * F.lit(steps) / F.lit(HASH_RANGE)) + 1).cast("int")
    pre = (salted.groupBy("run", i_min.alias("i_min"))
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(hash_keep(skey, rate_a, HASH_A)).alias("n_a")))
    grid = pre.select("run", "i_min", "n", "n_a", F.explode(F.sequence(F.lit(1), F.lit(last))).alias("i"))
    g = grid.groupBy("run", "i").agg(
        F.sum("n").alias("n_in"), F.sum("n_a").alias("n_a"),
        F.sum(F.when(F.col("i_min") <= F.col("i"), F.col("n")).otherwise(0)).alias("n_b"))
    return g.select("run", "i", (F.col("i") / F.lit(steps)).alias("rate_b"),
                    (F.col("n_a") / F.col("n_in")).alias("sel_a"), (F.col("n_b") / F.col("n_in")).alias("sel_b"))


def experiment_series(df: DataFrame, key: str, runs: int = 5, cost_a: float = 1.0, cost_b: float = 1.0,
                      ratios: int = 49) -> DataFrame:
    """Both experiments as one long table ``run, experiment, variant, param, value``
    where ``value`` is the throughput ``1 / cost`` (X12).

    * ``reorder``: param = rate of B (0.01..0.99), variants ``A_B`` and ``B_A``.
    * ``fusion``: param = cost ratio c (0.1..4.9), A and B at rate 0.5,
      variants ``A_B`` (not fused) and ``AB`` (fused).

    Every output row is generated from the selectivity table in one
    projection (an array of result structs, exploded), so the input is
    scanned once.
    """
    sel = measured_selectivities(df, key, runs)
    ca, cb, one = _c(cost_a), _c(cost_b), F.lit(1.0)

    def row(exp, variant, param, cost):
        return F.struct(F.lit(exp).alias("experiment"), F.lit(variant).alias("variant"),
                        param.alias("param"), (one / cost).alias("value"))

    sa, sb, rb = F.col("sel_a"), F.col("sel_b"), F.col("rate_b")
    reorder = F.array(row("reorder", "A_B", rb, ca + sa * cb), row("reorder", "B_A", rb, cb + sb * ca))

    def fused(j):
        c = j / F.lit(10)
        return F.array(row("fusion", "A_B", c, ca + sa * cb), row("fusion", "AB", c, (ca + cb) * c / (c + one)))

    fusion = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(ratios)), fused))
    fusion = F.filter(fusion, lambda x: F.col("i") == 50)
    out = sel.select("run", F.explode(F.concat(reorder, fusion)).alias("r"))
    return out.select("run", "r.experiment", "r.variant", "r.param", "r.value")


def mean_over_runs(series: DataFrame, digits: int = 9) -> DataFrame:
    """Mean value per (experiment, variant, param), rounded to ``digits``
    decimals (sums of doubles depend on their order)."""
    return (series.groupBy("experiment", "variant", "param")
            .agg(F.round(F.avg("value"), digits).alias("value")))


def ratio_to_max(mean: DataFrame, base_variant: str = "A_B") -> DataFrame:
    """``value / max(value of the base variant)`` per experiment (min fixed at 0).

    The maximum is a window per experiment over the mean table, whose size is
    set by the parameter grids, not by the data.
    """
    mx = F.max(F.when(F.col("variant") == base_variant, F.col("value"))).over(Window.partitionBy("experiment"))
    return mean.select("experiment", "variant", "param", (F.col("value") / mx).alias("ratio"))


def minmax_scale(df: DataFrame, col: str, by: tuple[str, ...] = (), out: str = "scaled",
                 bounded: bool = False) -> DataFrame:
    """``(x - min) / (max - min)`` over all rows (per ``by`` group);
    null when the span is 0.

    * ``bounded=True`` (the input's size is fixed by a parameter grid, e.g.
      one row per shed rate): min and max are window aggregates, one pass.
    * with groups: one row per group of bounds, joined back on the keys.
    * otherwise: one scalar subquery (a one-row aggregate, run once).
    """
    if bounded:
        w = Window.partitionBy(*by)
        j, lo, hi = df, F.min(col).over(w), F.max(col).over(w)
    elif by:
        mm = df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
        j = df.join(mm, list(by))
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        j = df
        b = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
        lo, hi = b.getField("lo"), b.getField("hi")
    span = hi - lo
    return j.select(*df.columns, F.when(span != 0, (F.col(col) - lo) / span).alias(out))


def weights_to_cdf(df: DataFrame, key: str) -> DataFrame:
    """S15 from data: empirical weights of ``key`` -> ``idx, key, pdf, cdf``.

    Keys are indexed by name; ``cdf`` is the running count over the index
    divided by the total, so the last value is exactly 1.0. The counts are
    range-partitioned by key (``running_sums``): any number of keys will do.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    c = running_sums(counts, key, ["n", "one"])
    return c.select((F.col("one_upto") - 1).cast("int").alias("idx"), key, (F.col("n") / F.col("n_all")).alias("pdf"),
                    (F.col("n_upto") / F.col("n_all")).alias("cdf"))
