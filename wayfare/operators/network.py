"""Weighted page networks from journeys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import features, parsing
from wayfare.operators.positions import with_position

STORED_TOTALS = ("Occurrences_NL", "Page_Seq_Occurrences")


def discard_totals(journeys: DataFrame) -> DataFrame:
    """Drop stored totals so that they are computed again."""
    return journeys.drop(*STORED_TOTALS)


def drop_one_off_share(
    journeys: DataFrame, percent: int, seed: int = 1234, key: str = "Sequence"
) -> DataFrame:
    """Drop about ``percent`` of the journeys that occur once, always the same ones."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))), 1, 8), 16, 10)
    dropped = (F.col("Occurrences") == 1) & (bucket.cast("bigint") % 100 < percent)
    return journeys.where(~dropped)


def without_search_pages(journeys: DataFrame, pages: str = "Page_List") -> DataFrame:
    return journeys.withColumn(pages, features.drop_search_pages(F.col(pages)))


def with_subpaths(journeys: DataFrame, pages: str = "Page_List") -> DataFrame:
    return journeys.withColumn("Subpaths", parsing.adjacent_pairs(F.col(pages)))


def per_sequence(journeys: DataFrame, delooped: bool = False) -> DataFrame:
    """One row per page sequence: its pages and the occurrences of all its journeys."""
    sequence, pages = (
        ("Page_Seq_NL", "Page_List_NL") if delooped else ("PageSequence", "Page_List")
    )
    return journeys.groupBy(F.col(sequence).alias("sequence")).agg(
        F.sum("Occurrences").alias("Occurrences"), F.min(pages).alias("pages")
    )


def edge_weights(journeys: DataFrame, delooped: bool = False) -> DataFrame:
    """``src, dst, weight``: sessions over each page pair, once per appearance."""
    pairs = per_sequence(journeys, delooped).select(
        F.explode(parsing.adjacent_pairs(F.col("pages"))).alias("pair"), "Occurrences"
    )
    return pairs.groupBy("pair.src", "pair.dst").agg(F.sum("Occurrences").alias("weight"))


def endpoints(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct end points; one pass over the edges."""
    return edges.select(F.explode(F.array(src, dst)).alias("Node")).distinct()


def number_nodes(nodes: DataFrame, start: int = 0) -> DataFrame:
    """``Node_id`` is the position in sorted order."""
    return with_position(nodes, [F.col("Node")], "Node_id", start)


def node_taxons(journeys: DataFrame) -> DataFrame:
    """The taxons first seen on each page, in the order of sequence text and position."""
    seen = journeys.select(
        "Sequence", F.posexplode("Taxon_Page_List").alias("position", "entry")
    )
    first = F.min_by("entry.taxons", F.struct("Sequence", "position"))
    return seen.groupBy(F.col("entry.page").alias("Node")).agg(first.alias("Node_Taxon"))


def attach_ends(edges: DataFrame, nodes: DataFrame, with_taxons: bool = False) -> DataFrame:
    """Edges with the id, and on request the taxons, of both ends."""

    def side(prefix: str, node: str) -> DataFrame:
        columns = [F.col("Node").alias(node), F.col("Node_id").alias(f"{prefix}_id")]
        if with_taxons:
            columns.append(F.col("Node_Taxon").alias(f"{prefix}_Taxon"))
        return nodes.select(*columns)

    joined = (
        edges.join(side("Source", "src"), "src", "left")
        .join(side("Destination", "dst"), "dst", "left")
        .withColumnsRenamed(
            {"src": "Source_node", "dst": "Destination_node", "weight": "Weight"}
        )
    )
    order = ["Source_node", "Source_id", "Destination_node", "Destination_id", "Weight"]
    if with_taxons:
        order += ["Source_Taxon", "Destination_Taxon"]
    return joined.select(*order)


def network_totals(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: number of nodes and edges."""
    n_edges = edges.agg(F.count("*").alias("n_edges")).scalar()
    return nodes.agg(F.count("*").alias("n_nodes")).select("n_nodes", n_edges.alias("n_edges"))


def adjacency_nodes(adjacency: DataFrame, start: int = 0) -> DataFrame:
    """Node table of a structural adjacency list."""
    return number_nodes(endpoints(adjacency, "source_base_path", "sink_base_path"), start)


def attach_node_ids(adjacency: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ids at both ends by left joins; a node with several ids is an error."""
    checked = nodes.groupBy("Node").agg(
        F.when(F.count("*") == 1, F.first("Node_id"))
        .otherwise(F.raise_error("a node has several ids").cast("bigint"))
        .alias("id")
    )
    return adjacency.join(
        checked.select(F.col("Node").alias("source_base_path"), F.col("id").alias("source_id")),
        "source_base_path",
        "left",
    ).join(
        checked.select(F.col("Node").alias("sink_base_path"), F.col("id").alias("sink_id")),
        "sink_base_path",
        "left",
    )


def frequent_edges(edges: DataFrame, threshold: int = 1000) -> DataFrame:
    """Edges between different pages with at least ``threshold`` sessions."""
    return edges.where((F.col("weight") >= threshold) & (F.col("src") != F.col("dst")))


def adjacency_lists(edges: DataFrame, parts: int = 1) -> DataFrame:
    """``src, part, pages``: every page's neighbours, dealt by a hash over ``parts`` lists.

    The number of lists is the caller's choice and does not depend on the data.
    """
    part = F.pmod(F.xxhash64("dst"), F.lit(parts))
    return (
        edges.withColumn("part", part)
        .groupBy("src", "part")
        .agg(F.sort_array(F.collect_set("dst")).alias("pages"))
    )


def adjacency_blocks(edges: DataFrame, longest: int = 10_000) -> DataFrame:
    """``src, part, pages``: every page's neighbours in order, in lists of ``longest``.

    A neighbour's rank comes from its place among all links sorted by page, so the links of a hub are
    sorted by many tasks, and no task gathers more than a list.
    """
    pairs = edges.select("src", "dst").distinct()
    placed = with_position(pairs, [F.col("src"), F.col("dst")], "place")
    first = placed.groupBy("src").agg(F.min("place").alias("first"))
    part = F.expr(f"(place - first) div {longest}").alias("part")
    return (
        placed.join(first, "src")
        .select("src", part, "dst")
        .groupBy("src", "part")
        .agg(F.sort_array(F.collect_list("dst")).alias("pages"))
    )
