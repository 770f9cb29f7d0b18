"""Running totals over a whole table without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import stash


def running_total(df: DataFrame, order: list[str], value: str, out: str = "before") -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over all rows that come before in ``order``.

    Rows are range partitioned and written once; per-partition sums (one row per
    partition) are summed in order and joined back, so each task only scans its own range.
    ``order`` must be unique for a defined result. Nulls in ``value`` count as 0.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stash(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "prefix")
    amount = F.coalesce(F.col(value), F.lit(0))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = laid.groupBy("_part").agg(F.sum(amount).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = laid.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return own.join(base, "_part").withColumn(out, F.col("_in") + F.col("_base")).drop("_part", "_in", "_base")
