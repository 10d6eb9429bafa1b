"""Measures of the page graph that need a fixed number of passes.

``edges`` are ``src, dst, weight`` with one row per directed pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.components import by_number
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage


def directed(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def undirected(edges: DataFrame) -> DataFrame:
    """One row per unordered pair; both directions' weights are added."""
    return edges.groupBy(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).agg(F.sum("weight").alias("weight"))


def both_ways(undirected_edges: DataFrame) -> DataFrame:
    """Each unordered pair as two directed rows, a self-loop as one."""
    there = F.struct(F.col("src").alias("src"), F.col("dst").alias("dst"), "weight")
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ways = F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back))
    return undirected_edges.select(F.inline(ways))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def with_attributes(edges: DataFrame, attributes: DataFrame, node: str = "node") -> DataFrame:
    """Edges with the attribute columns of both ends, ``src_`` and ``dst_`` in front."""
    for end in ("src", "dst"):
        renamed = attributes.select(
            F.col(node).alias(end),
            *[F.col(c).alias(f"{end}_{c}") for c in attributes.columns if c != node],
        )
        edges = edges.join(renamed, end, "left")
    return edges


def degrees(edges: DataFrame) -> DataFrame:
    """``node, degree, in_degree, out_degree``; a self-loop counts at both ends."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = F.array(
        F.struct(F.col("src").alias("node"), none.alias("i"), one.alias("o")),
        F.struct(F.col("dst").alias("node"), one.alias("i"), none.alias("o")),
    )
    return (
        edges.select(F.inline(ends))
        .groupBy("node")
        .agg(
            F.sum(F.col("i") + F.col("o")).alias("degree"),
            F.sum("i").alias("in_degree"),
            F.sum("o").alias("out_degree"),
        )
    )


def summary(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, mean in- and out-degree."""
    return degrees(edges).agg(
        F.count("*").alias("n_nodes"),
        F.sum("out_degree").alias("n_edges"),
        F.try_divide(F.sum("out_degree").cast("double"), F.count("*")).alias("mean_degree"),
    )


def self_loops(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count_if(F.col("src") == F.col("dst")).alias("n_self_loops"))


def edges_with_term(edges: DataFrame, term: str, or_weight_above: int | None = None) -> DataFrame:
    """Edges with the term in either url, or heavier than a threshold."""
    keep = F.col("src").contains(term) | F.col("dst").contains(term)
    if or_weight_above is not None:
        keep = keep | (F.col("weight") > or_weight_above)
    return edges.where(keep)


def induced_subgraph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes``."""
    return edges.join(nodes.select(F.col("node").alias("src")), "src", "left_semi").join(
        nodes.select(F.col("node").alias("dst")), "dst", "left_semi"
    )


def density(edges: DataFrame, is_directed: bool) -> DataFrame:
    """One row; ``edges`` hold one row per directed or per unordered pair."""
    n, m = F.col("n_nodes").cast("double"), F.col("n_edges").cast("double")
    pairs = n * (n - 1)
    ratio = F.try_divide(m if is_directed else m * 2, pairs)
    return summary(edges).select("n_nodes", "n_edges", ratio.alias("density"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    per_node = degrees(edges)
    others = per_node.agg((F.count("*") - 1).alias("n")).scalar()
    return per_node.select(
        "node",
        "degree",
        F.try_divide(F.col("degree").cast("double"), others).alias("degree_centrality"),
    )


def top_nodes(metric: DataFrame, column: str, k: int) -> DataFrame:
    return metric.orderBy(F.desc(column), "node").limit(k)


def ranked(metric: DataFrame, column: str) -> DataFrame:
    """Every node with its rank by the metric, names deciding between equals."""
    return with_position(metric, [F.desc(column), F.asc("node")], "rank", start=1)


def rank_of_matching(metric: DataFrame, column: str, term: str) -> DataFrame:
    return ranked(metric, column).where(F.col("node").contains(term))


def out_edges(edges: DataFrame, page: str) -> DataFrame:
    return edges.where(F.col("src") == page).orderBy(F.desc("weight"), "dst")


def nodes_with_prefix(nodes: DataFrame, prefix: str, limit: int) -> DataFrame:
    return nodes.where(F.col("node").startswith(prefix)).orderBy("node").limit(limit)


def transitivity(edges: DataFrame) -> DataFrame:
    """One row: triangles, connected triples and three times their ratio.

    Nodes are numbered by falling rank of their degree, and every edge points from the end with fewer
    neighbours to the other. A node's list of ends then has at most ``sqrt(2 * edges)`` entries, hubs
    included. For each entry, the later ones travel as one row to that entry's own list; what both
    have in common closes a triangle.
    """
    simple = cut_lineage(undirected(edges).where(F.col("src") != F.col("dst")).select("src", "dst"))
    degree = cut_lineage(degrees(simple.withColumn("weight", F.lit(1))).select("node", "degree"))
    ids = cut_lineage(with_position(degree, [F.col("degree"), F.col("node")], "id").select("node", "id"))
    known = by_number(simple, ids)
    oriented = known.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    lists = cut_lineage(oriented.groupBy("a").agg(F.sort_array(F.collect_list("b")).alias("ends")))
    entries = lists.where(F.size("ends") > 1).select("ends", F.posexplode("ends").alias("at", "a"))
    later = entries.where(F.col("at") + 1 < F.size("ends")).select("a", F.expr("slice(ends, at + 2, size(ends))").alias("later"))
    closed = F.size(F.array_intersect("later", "ends")).cast("bigint")
    triangles = later.join(lists, "a").agg(F.coalesce(F.sum(closed), F.lit(0)).alias("triangles"))
    triples = degree.agg(
        F.coalesce(
            F.sum(F.expr("degree * (degree - 1) DIV 2")), F.lit(0)
        ).alias("triples")
    )
    return triangles.withColumn("triples", triples.scalar()).select(
        F.col("triangles").cast("bigint"),
        F.col("triples").cast("bigint"),
        F.coalesce(
            F.try_divide(F.col("triangles") * 3.0, F.col("triples")).cast("double"), F.lit(0.0)
        ).alias("transitivity"),
    )
