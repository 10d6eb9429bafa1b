"""Weighted descriptions of a distribution, never expanded to single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def weighted_histogram(df: DataFrame, value: str, weight: str) -> DataFrame:
    """``value, n``: total weight per value."""
    return (
        df.groupBy(F.col(value).alias("value"))
        .agg(F.sum(weight).cast("bigint").alias("n"))
        .where("n > 0")
    )


def describe_histogram(histogram: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of ``value`` counted ``n`` times."""
    x, n = F.col("value").cast("double"), F.col("n")
    total = F.sum(n).cast("double")
    s, ss = F.sum(x * n), F.sum(x * x * n)
    variance = F.try_divide(ss - s * s / total, total - 1)
    return (
        histogram.groupBy(*keys)
        .agg(
            total.alias("count"),
            (s / total).alias("mean"),
            F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"),
            F.min(x).alias("min"),
            F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n).alias("quartiles"),
            F.max(x).alias("max"),
        )
        .select(
            *keys,
            "count",
            F.round("mean", 3).alias("mean"),
            F.round("std", 3).alias("std"),
            "min",
            F.round(F.col("quartiles")[0], 3).alias("25%"),
            F.round(F.col("quartiles")[1], 3).alias("50%"),
            F.round(F.col("quartiles")[2], 3).alias("75%"),
            "max",
        )
    )


def describe(df: DataFrame, value: str, weight: str) -> DataFrame:
    return describe_histogram(weighted_histogram(df, value, weight))


def describe_segments(
    df: DataFrame, value: str, segments: dict[str, tuple[Column, str]]
) -> DataFrame:
    """One row per named segment ``(condition, weight column)``, in one pass."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("segment"),
                F.when(condition, F.col(weight)).otherwise(0).cast("bigint").alias("n"),
            )
            for name, (condition, weight) in segments.items()
        ]
    )
    histogram = (
        df.select(F.col(value).alias("value"), F.inline(rows))
        .groupBy("segment", "value")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
    )
    return describe_histogram(histogram, ("segment",))
