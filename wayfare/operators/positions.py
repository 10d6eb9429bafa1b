"""Positions in a total order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.session import cut_lineage


def with_position(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Number the rows of ``df`` in ``order``, which must leave no ties.

    Ranges of rows are sorted side by side and written; what joins them is the row
    count of each range, a table with one row per partition.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_within", within)
    )
    written = cut_lineage(ranged)
    # One row per partition: this window is bounded by the number of partitions.
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        written.join(offsets, "_range")
        .withColumn(name, F.col("_within") + F.col("_offset") + start)
        .drop("_range", "_within", "_offset")
    )
