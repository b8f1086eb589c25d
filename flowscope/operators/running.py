"""Running sums over a whole table without a window that gathers it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from flowscope.session import stage


def _total(value: str, kind: str, below: Column | None = None) -> Column:
    """Sum of ``value`` over the entries of ``r``, only those of ranges ``below`` one if given."""
    entries = F.col("r") if below is None else F.filter("r", lambda y: y["_range"] < below)
    return F.aggregate(entries, F.lit(0).cast(kind), lambda a, y: (a + y[value]).cast(kind))


def running_sums(df: DataFrame, order_by: str, values: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with, for every value, ``<value>_upto`` (sum over all rows up to this one in the order of
    the unique column ``order_by``) and ``<value>_all`` (sum over all rows), and with
    ``<order_by>_next``, the next row's ``order_by``.

    The rows are range-partitioned and stored with the number of their range; sums run inside
    each range; the totals of the ranges, one small row each, give the sum before a range.
    A null value counts as 0; a null ``order_by`` comes first."""
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    parts = stage(df.repartitionByRange(n, F.asc(order_by)).withColumn("_range", F.spark_partition_id()), "running-sums")
    kinds = {v: _sum_type(df.schema[v].dataType) for v in values}
    sums = parts.groupBy("_range").agg(
        *[F.coalesce(F.sum(v).cast(kinds[v]), F.lit(0).cast(kinds[v])).alias(v) for v in values], F.min(order_by).alias("_first"))
    # one row with the list of the ranges' totals: as many entries as there are ranges
    ranges = sums.agg(F.array_sort(F.collect_list(F.struct("_range", *values, "_first"))).alias("r"))
    before = ranges.select("r", F.explode("r").alias("x")).select(
        "x._range", *[_total(v, kinds[v], F.col("x._range")).alias(f"_{v}_before") for v in values],
        *[_total(v, kinds[v]).alias(f"{v}_all") for v in values],
        F.array_min(F.transform(F.filter("r", lambda y: y["_range"] > F.col("x._range")), lambda y: y["_first"])).alias("_next"))
    order = Window.partitionBy("_range").orderBy(F.asc(order_by))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.select("*", *[F.coalesce(F.sum(v).over(upto), F.lit(0)).cast(kinds[v]).alias(f"_{v}") for v in values],
                         F.lead(order_by).over(order).alias("_lead"))
    out = local.join(before, "_range")
    return out.select(*df.columns, *[(F.col(f"_{v}") + F.col(f"_{v}_before")).cast(kinds[v]).alias(f"{v}_upto") for v in values],
                      *[f"{v}_all" for v in values], F.coalesce("_lead", "_next").alias(f"{order_by}_next"))


def _sum_type(kind: DataType) -> str:
    if isinstance(kind, DecimalType):
        return "decimal(38,0)" if kind.scale == 0 else f"decimal(38,{kind.scale})"
    return "double" if isinstance(kind, (DoubleType, FloatType)) else "bigint"
