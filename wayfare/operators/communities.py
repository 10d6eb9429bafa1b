"""Communities of the page graph by modularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators import graph
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage


def modularity(edges: DataFrame, communities: DataFrame) -> float:
    """Modularity of a partition ``node, community`` of undirected weighted edges."""
    left = communities.select(F.col("node").alias("src"), F.col("community").alias("a"))
    right = communities.select(F.col("node").alias("dst"), F.col("community").alias("b"))
    pairs = edges.join(left, "src").join(right, "dst")
    halves = F.array(
        F.struct(
            F.col("a").alias("community"),
            F.col("weight").alias("degree"),
            F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0).alias("inside"),
        ),
        F.struct(
            F.col("b").alias("community"),
            F.col("weight").alias("degree"),
            F.lit(0).cast("bigint").alias("inside"),
        ),
    )
    sums = (
        pairs.select(F.inline(halves))
        .groupBy("community")
        .agg(F.sum("degree").cast("double").alias("degree"), F.sum("inside").cast("double").alias("inside"))
    )
    row = sums.agg(
        F.sum("degree").alias("two_m"),
        F.sum("inside").alias("inside"),
        F.sum(F.col("degree") * F.col("degree")).alias("squares"),
    ).first()
    if not row["two_m"]:
        return 0.0
    return row["inside"] / (row["two_m"] / 2) - row["squares"] / row["two_m"] ** 2


def _local_moving(edges: DataFrame, tolerance: float) -> tuple[DataFrame, float]:
    """Communities of one level: half of the nodes may move in each round, by turns.

    Rounds go on until a turn of each half has not raised modularity.
    """
    links = cut_lineage(graph.both_ways(edges))
    # A self-loop adds its weight at both of its ends.
    doubled = F.when(F.col("src") == F.col("dst"), F.col("weight") * 2).otherwise(F.col("weight"))
    strength = cut_lineage(
        links.groupBy(F.col("src").alias("node")).agg(F.sum(doubled).cast("double").alias("k"))
    )
    two_m = strength.agg(F.sum("k")).first()[0] or 1.0
    best = strength.select("node", "k", F.col("node").alias("community"))
    best_value = modularity(edges, best)
    state, stale, turn = best, 0, 0
    while stale < 2:
        totals = state.groupBy("community").agg(F.sum("k").alias("total"))
        neighbour = state.select(F.col("node").alias("dst"), "community")
        toward = (
            links.where("src <> dst")
            .join(neighbour, "dst")
            .groupBy(F.col("src").alias("node"), "community")
            .agg(F.sum("weight").cast("double").alias("w"))
        )
        own = state.select("node", "k", F.col("community").alias("own"))
        stay = state.select("node", "community", F.lit(0.0).alias("w"))
        options = (
            toward.unionByName(stay)
            .groupBy("node", "community")
            .agg(F.sum("w").alias("w"))
            .join(own, "node")
            .join(totals, "community")
        )
        others = F.col("total") - F.when(F.col("community") == F.col("own"), F.col("k")).otherwise(0)
        gain = F.col("w") - F.col("k") * others / F.lit(two_m)
        choice = options.withColumn("gain", gain).groupBy("node", "k", "own").agg(
            F.max(
                F.struct(
                    F.round("gain", 9).alias("gain"),
                    (F.col("community") == F.col("own")).alias("stays"),
                    "community",
                )
            ).alias("choice")
        )
        may_move = F.pmod(F.xxhash64("node") + F.lit(turn), F.lit(2)) == 0
        moved = choice.select(
            "node",
            "k",
            F.when(may_move, F.col("choice.community")).otherwise(F.col("own")).alias("community"),
        )
        state = cut_lineage(moved)
        turn += 1
        value = modularity(edges, state)
        if value > best_value + tolerance:
            best, best_value, stale = state, value, 0
        else:
            stale += 1
    return best.select("node", "community"), best_value


def louvain(edges: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """``node, community``: local moving, then the same on the graph of communities.

    The result does not depend on the order of rows: nodes take turns by a hash, and a
    level counts only if it raises modularity.
    """
    current = cut_lineage(graph.undirected(edges))
    members = cut_lineage(graph.nodes_of(current).withColumn("community", F.col("node")))
    value = modularity(current, members)
    while True:
        found, found_value = _local_moving(current, tolerance)
        if found_value <= value + tolerance:
            break
        value = found_value
        step = found.select(F.col("node").alias("community"), F.col("community").alias("next"))
        members = cut_lineage(
            members.join(step, "community").select("node", F.col("next").alias("community"))
        )
        left = found.select(F.col("node").alias("src"), F.col("community").alias("a"))
        right = found.select(F.col("node").alias("dst"), F.col("community").alias("b"))
        joined = current.join(left, "src").join(right, "dst")
        current = cut_lineage(
            graph.undirected(
                joined.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight")
            )
        )
    return members


def community_sizes(communities: DataFrame) -> DataFrame:
    return communities.groupBy("community").agg(F.count("*").alias("n_nodes"))


def members_of_larger(communities: DataFrame, above: int = 2) -> DataFrame:
    """Members of the communities with more than ``above`` nodes, one row each."""
    large = community_sizes(communities).where(F.col("n_nodes") > above)
    return communities.join(large, "community")


def size_histogram(communities: DataFrame) -> DataFrame:
    return (
        community_sizes(communities)
        .groupBy("n_nodes")
        .agg(F.count("*").alias("n_communities"))
    )


def rank_in_communities(communities: DataFrame, metric: DataFrame, column: str) -> DataFrame:
    """Rank of each node within its community by a metric, names deciding ties.

    The rank comes from the position among all nodes sorted by community, so a large
    community is sorted by many tasks.
    """
    placed = with_position(
        communities.join(metric, "node"),
        [F.asc("community"), F.desc(column), F.asc("node")],
        "place",
    )
    first = placed.groupBy("community").agg(F.min("place").alias("first"))
    return placed.join(first, "community").select(
        "community", "node", column, (F.col("place") - F.col("first") + 1).alias("rank")
    )
