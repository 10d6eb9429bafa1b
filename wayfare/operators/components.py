"""Connected components of links between numbers, and numbers for named nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage


def numbered(nodes: DataFrame) -> DataFrame:
    """``node, id``: distinct nodes with their place in sorted order, from 0; written."""
    return cut_lineage(with_position(nodes.select("node").distinct(), [F.col("node")], "id"))


def by_number(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """``edges`` with the numbers of their ends in place of ``src`` and ``dst``."""
    for end in ("src", "dst"):
        known = ids.select(F.col("node").alias(end), F.col("id").alias("_id"))
        edges = edges.join(known, end).drop(end).withColumnRenamed("_id", end)
    return edges


def _are_stars(links: DataFrame) -> bool:
    """Whether each node of links (u, v), v < u, is a centre or tied to one centre and nothing else."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return counts.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def star_components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that ``links`` (a, b) tie to another: the smallest node reachable.

    Each round, all larger neighbours of a node are tied to the least node it knows, then all its
    smaller ones; the links turn into stars whose centres are the answer, in rounds that grow with
    the logarithm of the longest path. The least neighbours are aggregated and written before they
    are joined, so a hub's links are split over tasks and never gathered.
    """
    links = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut_lineage(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        centre = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        to = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        links = cut_lineage(
            large.join(centre, "u").select(to.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
    centres = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cut_lineage(
        links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
    )
