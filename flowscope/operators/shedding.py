"""Load shedding and its accuracy.

* ``bernoulli_shed`` keeps each row with probability ``rate`` (seeded
  ``rand``); ``hash_shed`` makes the same decision from a hash of a row key,
  so it is repeatable and independent of partitioning.
* ``wasserstein`` is the 1-D earth mover's distance between two weighted
  histograms on the same bucket axis:
  ``sum_j |U_j - V_j| * (b_{j+1} - b_j)`` with U, V the normalised cumulative
  weights. It is evaluated as
  ``sum_j |cu_j * Nv - cv_j * Nu| * gap_j / (Nu * Nv)`` so that the numerator is
  an exact integer (``decimal(38,0)``) and only the final division rounds.
* ``shed_sweep`` computes the shed histogram of every rate of a grid in one
  pass: a row with hash ``u`` is kept at rate ``i/steps`` iff
  ``u * steps < i * 65536``, i.e. for every ``i >= i_min = floor(u*steps/65536)+1``.
  Rows are aggregated to ``(bucket, i_min)`` first; only those few
  aggregates are expanded to the rates they belong to. No cross join, and
  the input is read once.

Running sums over buckets use a window partitioned by the rate (or by
nothing for a single pair); its partitions hold one row per bucket, a
number fixed by the value range and bucket width, not by the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowscope.functions.hashing import HASH_A, HASH_RANGE, hash_keep, unit_hash
from flowscope.operators.running import running_sums

DEC = "decimal(38,0)"


def bernoulli_shed(df: DataFrame, rate: float, seed: int = 7) -> DataFrame:
    """L1: keep each row with probability ``rate`` (seeded; re-drawn per plan)."""
    return df.where(F.rand(seed) < F.lit(float(rate)))


def shed_report(rows: DataFrame, kept: DataFrame, key: str, rate: float, deviations: float = 6.0) -> DataFrame:
    """One row on a shed table ``kept`` of ``rows`` (both with a unique ``key``): ``n_in, is_subset,
    no_repeats, share_in_bounds``. The share is in bounds when the number kept lies within so
    many standard deviations of a binomial draw, whatever the seed was."""
    a = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_in"))
    b = kept.groupBy(key).agg(F.count(F.lit(1)).alias("_out"))
    both = a.join(b, a[key].eqNullSafe(b[key]), "full").select(F.coalesce("_in", F.lit(0)).alias("_in"),
                                                              F.coalesce("_out", F.lit(0)).alias("_out"))
    one = both.agg(F.coalesce(F.sum("_in"), F.lit(0)).alias("n_in"), F.coalesce(F.sum("_out"), F.lit(0)).alias("n_out"),
                   (F.count_if((F.col("_out") > 0) & (F.col("_in") == 0)) == 0).alias("is_subset"),
                   (F.count_if(F.col("_out") > F.col("_in")) == 0).alias("no_repeats"))
    bound = F.lit(deviations) * F.sqrt(F.col("n_in") * F.lit(rate * (1 - rate)))
    return one.select("n_in", "is_subset", "no_repeats",
                      (F.abs(F.col("n_out") - F.col("n_in") * F.lit(rate)) <= bound).alias("share_in_bounds"))


def hash_shed(df: DataFrame, key: str, rate: float, mult: int = HASH_A) -> DataFrame:
    """L2: keep a row iff ``unit_hash(key) < rate * 65536``."""
    return df.where(hash_keep(key, rate, mult))


def bucket_of(bytes_col, width: int = 10000) -> Column:
    """Integer bucket ``bytes // width`` (bytes >= 0)."""
    c = F.col(bytes_col) if isinstance(bytes_col, str) else bytes_col
    return F.floor(c / F.lit(width)).cast("bigint")


def shed_input(lines: DataFrame, key: str = "event_id") -> DataFrame:
    """Lines whose last character is not ``-`` -> ``(key, bytes)``; like the
    shedding job, no host test is applied."""
    kept = lines.where(~F.col("value").endswith("-"))
    return kept.select(key, F.try_element_at(F.split("value", " "), F.lit(-1)).try_cast("bigint").alias("bytes"))


def histogram(df: DataFrame, bytes_col: str = "bytes", width: int = 10000) -> DataFrame:
    """``bucket, n`` (rows with unparsable bytes are not counted)."""
    return (df.where(F.col(bytes_col).isNotNull()).groupBy(bucket_of(bytes_col, width).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def wasserstein_aligned(h: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """L5 on one aligned table ``[*by,] bucket, nu, nv`` (counts of the two
    histograms per bucket, 0 where absent).

    Output: ``[*by,] n_u, n_v, distance`` (null when either side is empty).
    """
    nu, nv = F.col("nu").cast(DEC), F.col("nv").cast(DEC)
    if by:  # one window per group, which a parameter grid bounds
        order = Window.partitionBy(*by).orderBy("bucket")
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*by)
        c = h.select(*by, F.sum(nu).over(upto).alias("cu"), F.sum(nv).over(upto).alias("cv"),
                     F.sum(nu).over(whole).alias("tu"), F.sum(nv).over(whole).alias("tv"),
                     (F.lead("bucket").over(order) - F.col("bucket")).cast(DEC).alias("gap"))
    else:
        c = running_sums(h.select("bucket", nu.alias("u"), nv.alias("v")), "bucket", ["u", "v"])
        c = c.select(F.col("u_upto").alias("cu"), F.col("v_upto").alias("cv"), F.col("u_all").alias("tu"),
                     F.col("v_all").alias("tv"), (F.col("bucket_next") - F.col("bucket")).cast(DEC).alias("gap"))
    term = F.abs(F.col("cu") * F.col("tv") - F.col("cv") * F.col("tu")) * F.coalesce("gap", F.lit(0).cast(DEC))
    g = c.groupBy(*by).agg(F.sum(term).alias("num"), F.max("tu").alias("tu"), F.max("tv").alias("tv"))
    den = F.col("tu").cast("double") * F.col("tv").cast("double")
    dist = F.when(den > 0, F.col("num").cast("double") / den)
    return g.select(*by, F.col("tu").cast("bigint").alias("n_u"), F.col("tv").cast("bigint").alias("n_v"),
                    dist.alias("distance"))


def align(u: DataFrame, v: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Two histograms ``[*by,] bucket, n`` side by side (``nu``, ``nv``; 0 where a bucket is absent)."""
    return (u.withColumnRenamed("n", "nu").join(v.withColumnRenamed("n", "nv"), [*by, "bucket"], "full")
            .select(*by, "bucket", F.coalesce("nu", F.lit(0)).alias("nu"), F.coalesce("nv", F.lit(0)).alias("nv")))


def wasserstein(u: DataFrame, v: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """L5 + J2: distance between separate histograms ``u`` and ``v``
    (``[*by,] bucket, n``), aligned by a full outer join on the bucket."""
    return wasserstein_aligned(align(u, v, by), by)


def shed_distance(df: DataFrame, key: str, rate: float, bytes_col: str = "bytes", width: int = 10000,
                  mult: int = HASH_A) -> DataFrame:
    """L5 for one shed rate: the full and the shed histogram are counted in
    the same aggregate (``count`` and ``count_if(kept)``), so the input is
    read once and no join is needed."""
    h = (df.where(F.col(bytes_col).isNotNull()).groupBy(bucket_of(bytes_col, width).alias("bucket"))
         .agg(F.count(F.lit(1)).alias("nu"), F.count_if(hash_keep(key, rate, mult)).alias("nv")))
    return wasserstein_aligned(h)


def _rate_index(key: str, steps: int, mult: int) -> Column:
    """Smallest grid index ``i`` whose rate ``i/steps`` keeps the row."""
    return (F.floor(unit_hash(key, mult) * F.lit(steps) / F.lit(HASH_RANGE)) + 1).cast("int")


def _pre(df: DataFrame, key: str, bytes_col: str, width: int, steps: int, mult: int) -> DataFrame:
    """Rows counted per ``(bucket, i_min)``: the only pass over the input."""
    return (df.where(F.col(bytes_col).isNotNull())
            .groupBy(bucket_of(bytes_col, width).alias("bucket"), _rate_index(key, steps, mult).alias("i_min"))
            .agg(F.count(F.lit(1)).alias("n")))


def shed_sweep(df: DataFrame, key: str, bytes_col: str = "bytes", width: int = 10000,
               steps: int = 100, last: int = 98, mult: int = HASH_A) -> DataFrame:
    """L4: histogram of the rows kept at every rate ``i/steps``, ``i = 1..last``.

    Output: ``rate, bucket, n`` (buckets with no kept row are absent).
    """
    pre = _pre(df, key, bytes_col, width, steps, mult).where(F.col("i_min") <= last)
    exp = pre.select("bucket", "n", F.explode(F.sequence("i_min", F.lit(last))).alias("i"))
    return (exp.groupBy("i", "bucket").agg(F.sum("n").alias("n"))
            .select((F.col("i") / F.lit(steps)).alias("rate"), "bucket", "n"))


def shed_accuracy(df: DataFrame, key: str, bytes_col: str = "bytes", width: int = 10000,
                  steps: int = 100, last: int = 98, mult: int = HASH_A) -> DataFrame:
    """Per rate, rows kept, distance to the full histogram, ``accuracy = 1 - distance``.

    Each ``(bucket, i_min)`` count is laid out over every rate (a table of
    buckets x rates, both small): it counts for the full histogram always and
    for the shed one when ``i_min <= i``. Buckets emptied by shedding thus
    count with weight 0, as in the union of both supports. One input pass.
    """
    pre = _pre(df, key, bytes_col, width, steps, mult)
    grid = pre.select("bucket", "i_min", "n", F.explode(F.sequence(F.lit(1), F.lit(last))).alias("i"))
    h = (grid.groupBy("i", "bucket")
         .agg(F.sum("n").alias("nu"), F.sum(F.when(F.col("i_min") <= F.col("i"), F.col("n")).otherwise(0)).alias("nv"))
         .select((F.col("i") / F.lit(steps)).alias("rate"), "bucket", "nu", "nv"))
    d = wasserstein_aligned(h, by=("rate",))
    return d.select("rate", F.col("n_v").alias("n_kept"), "distance",
                    (F.lit(1.0) - F.col("distance")).alias("accuracy"))
