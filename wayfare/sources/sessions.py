"""Nested session tables, one partition per day, and their flat hits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.schemas import NESTED_SESSION

# Hits of one visit are first joined within pieces of this many hits.
HITS_PER_CHUNK = 1000


def read_sessions(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Sessions of a date range; the conditions prune ``date`` partitions."""
    sessions = spark.read.schema(NESTED_SESSION).parquet(path)
    return in_date_range(sessions, start, end, exclude)


def in_date_range(
    df: DataFrame, start: str | None, end: str | None, exclude: Iterable[str] = ()
) -> DataFrame:
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    excluded = [F.lit(day).cast("date") for day in exclude]
    return df.where(~F.col("date").isin(*excluded)) if excluded else df


def write_daily(df: DataFrame, path: str) -> None:
    """One folder per day."""
    df.write.mode("overwrite").partitionBy("date").parquet(path)


def dimension(dimensions: Column, index: int) -> Column:
    """Value of a custom dimension, NULL when the entry is missing."""
    return F.get(F.filter(dimensions, lambda d: d["index"] == index), F.lit(0))["value"]


def explode_hits(sessions: DataFrame) -> DataFrame:
    """One flat row per hit; sessions without hits vanish."""
    hit = F.col("hit")
    return sessions.select("*", F.explode("hits").alias("hit")).select(
        "fullVisitorId",
        "visitId",
        "visitNumber",
        "visitStartTime",
        "date",
        F.col("device.deviceCategory").alias("deviceCategory"),
        F.col("trafficSource.source").alias("trafficSource"),
        F.col("trafficSource.medium").alias("trafficMedium"),
        ab_variant_dimension(F.col("customDimensions")).alias("abVariant"),
        hit["hitNumber"].alias("hitNumber"),
        hit["type"].alias("type"),
        hit["page"]["pagePath"].alias("pagePath"),
        hit["eventInfo"]["eventCategory"].alias("eventCategory"),
        hit["eventInfo"]["eventAction"].alias("eventAction"),
        dimension(hit["customDimensions"], C.DIMENSION_TAXONS).alias("taxons"),
        dimension(hit["customDimensions"], C.DIMENSION_CONTENT_ID).alias("contentId"),
        dimension(hit["customDimensions"], C.DIMENSION_DOCUMENT_TYPE).alias("documentType"),
        hit["hitNumber"].alias("hitOrder"),
        F.expr(f"CAST(hit.hitNumber AS BIGINT) DIV {HITS_PER_CHUNK}").alias("hitChunk"),
    )


def ab_variant_dimension(dimensions: Column) -> Column:
    """The variant text; an entry without value reads ``NULL``, no entry stays NULL."""
    entry = F.get(
        F.filter(dimensions, lambda d: d["index"] == C.DIMENSION_AB_VARIANT), F.lit(0)
    )
    return F.when(entry.isNotNull(), F.coalesce(entry["value"], F.lit(C.NULL_TEXT)))
