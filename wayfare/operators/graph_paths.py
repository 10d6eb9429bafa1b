"""Measures of the page graph found by repeated joins along edges.

Every round is written to the shared folder and checked by one small action, so the
plan does not grow with the number of rounds and a lost executor costs one round.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators import graph
from wayfare.operators.centrality import dependencies, farthest
from wayfare.operators.components import by_number, numbered, star_components
from wayfare.session import cut_lineage

# Rows of the (source, node) tables that one batch of sources may reach.
ROWS_PER_BATCH = 200_000_000
# Searches for the diameter that run side by side.
MOST_SOURCES = 1024
# Links, counted both ways, that every task may hold: 4 bytes each, 24 in the component it works on.
MOST_LINKS = 12_000_000
# The same for searches for the diameter, which take 4 to 6 bytes for each.
MOST_SEARCHED = 64_000_000
# Longest distance up to which all searches for the diameter that bounds leave run within tasks.
MOST_LEVELS = 64


def shortest_path(edges: DataFrame, source: str, target: str) -> DataFrame:
    """``position, node, length`` of a shortest path along the direction of the edges.

    Among equally short paths the first by name is taken. No rows: no path.
    """
    edges = cut_lineage(edges.select("src", "dst").distinct())
    spark = edges.sparkSession
    frontier = spark.range(1).select(
        F.lit(source).alias("node"), F.array(F.lit(source)).alias("path")
    )
    visited = frontier.select("node")
    while frontier.where(F.col("node") == target).isEmpty():
        reached = (
            frontier.join(edges, frontier["node"] == edges["src"])
            .join(visited.select(F.col("node").alias("dst")), "dst", "left_anti")
            .groupBy("dst")
            .agg(F.min("path").alias("path"))
        )
        frontier = cut_lineage(
            reached.select(F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"))
        )
        if frontier.isEmpty():
            break
        visited = visited.union(frontier.select("node"))
    return frontier.where(F.col("node") == target).select(
        F.posexplode("path").alias("position", "node"),
        (F.size("path") - 1).cast("bigint").alias("length"),
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component``, the component named by its smallest node.

    Nodes are numbered in the order of their names, so the smallest number stands for the smallest name.
    """
    ids = numbered(graph.nodes_of(edges))
    found = star_components(by_number(edges.select("src", "dst"), ids).select(F.col("src").alias("a"), F.col("dst").alias("b")))
    of = ids.join(found.withColumnRenamed("node", "id"), "id", "left").select("node", F.coalesce("component", "id").alias("top"))
    names = ids.select(F.col("id").alias("top"), F.col("node").alias("component"))
    return cut_lineage(of.join(names, "top").select("node", "component"))


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count("*").alias("n_nodes"))


def is_connected(components: DataFrame) -> DataFrame:
    return components.agg((F.countDistinct("component") == 1).alias("is_connected"))


def largest_component(components: DataFrame) -> DataFrame:
    """Nodes of the component with most nodes, the first by name among equals."""
    top = component_sizes(components).orderBy(F.desc("n_nodes"), "component").limit(1)
    return components.join(top, "component", "left_semi")


def _source_batches(nodes: DataFrame, sources: DataFrame | None, rows: int) -> list[DataFrame]:
    sources = (nodes if sources is None else sources).select(F.col("node").alias("source"))
    n_batches = max(1, math.ceil(nodes.count() * sources.count() / rows))
    if n_batches == 1:
        return [sources]
    batch = F.pmod(F.xxhash64("source"), F.lit(n_batches))
    return [sources.where(batch == i) for i in range(n_batches)]


def _distances(links: DataFrame, sources: DataFrame) -> DataFrame:
    """``source, node, distance`` by rounds of joins over ``src, dst, cost``."""
    known = cut_lineage(
        sources.select("source", F.col("source").alias("node"), F.lit(0).cast("bigint").alias("distance"))
    )
    frontier = known
    while True:
        offers = (
            frontier.join(links, frontier["node"] == links["src"])
            .groupBy("source", F.col("dst").alias("node"))
            .agg(F.min(F.col("distance") + F.col("cost")).alias("offer"))
        )
        merged = cut_lineage(
            known.join(offers, ["source", "node"], "full").select(
                "source",
                "node",
                F.least("distance", "offer").alias("distance"),
                (F.col("distance").isNull() | (F.col("offer") < F.col("distance"))).alias("better"),
            )
        )
        known = merged.drop("better")
        frontier = merged.where("better").drop("better")
        if frontier.isEmpty():
            return known


def _spread(links: DataFrame, nodes: DataFrame, sources: list[int]) -> tuple[DataFrame, list[int]]:
    """``node, level, w0, w1, ..`` and the eccentricity of each source.

    A search from all sources side by side: bit i of the words is source i. A row says which sources
    meet the node at that level; a round takes the bits of the last level along the links and leaves
    out those the node has had.
    """
    words = [f"w{at}" for at in range(-(-len(sources) // 64))]
    marks = {node: [0] * len(words) for node in sources}
    for at, node in enumerate(sources):
        bit = 1 << (at % 64)
        marks[node][at // 64] += bit if bit < 1 << 63 else -bit
    schema = ", ".join(["node long", *(f"{word} long" for word in words)])
    seen = cut_lineage(nodes.sparkSession.createDataFrame([(node, *own) for node, own in marks.items()], schema))
    front, levels, level = seen, seen.withColumn("level", F.lit(0)), 0
    far = [0] * len(sources)
    while True:
        met = front.join(links, front["node"] == links["src"]).groupBy("dst").agg(*(F.bit_or(word).alias(word) for word in words))
        had = seen.select(F.col("node").alias("dst"), *(F.col(word).alias(f"had_{word}") for word in words))
        joined = met.join(had, "dst", "left")
        new = [F.col(word).bitwiseAND(F.bitwise_not(F.coalesce(f"had_{word}", F.lit(0).cast("long")))).alias(word) for word in words]
        any_ = " OR ".join(f"{word} <> 0" for word in words)
        front = cut_lineage(joined.select(F.col("dst").alias("node"), *new).where(any_))
        level += 1
        bits = front.agg(*(F.bit_or(word) for word in words)).first()
        if bits[0] is None:
            return levels, far
        for at in range(len(sources)):
            if bits[at // 64] >> (at % 64) & 1:
                far[at] = level
        levels = levels.unionByName(front.withColumn("level", F.lit(level)))
        seen = cut_lineage(seen.unionByName(front).groupBy("node").agg(*(F.bit_or(word).alias(word) for word in words)))


def _narrowed(bounds: DataFrame, levels: DataFrame, sources: list[int], far: list[int]) -> DataFrame:
    """``node, degree, low, high`` after the searches of ``_spread``.

    A source of eccentricity e at distance d bounds the eccentricity of a node by e - d or d from
    below and by e + d from above; sources of the same e are taken together.
    """
    words = [f"w{at}" for at in range(-(-len(sources) // 64))]
    low, high = F.lit(0), F.lit(None).cast("int")
    for e in sorted(set(far)):
        masks = [0] * len(words)
        for at, own in enumerate(far):
            if own == e:
                bit = 1 << (at % 64)
                masks[at // 64] += bit if bit < 1 << 63 else -bit
        here = F.lit(False)
        for word, mask in zip(words, masks):
            if mask:
                here = here | (F.col(word).bitwiseAND(F.lit(mask).cast("long")) != 0)
        low = F.greatest(low, F.when(here, F.greatest(F.lit(e) - F.col("level"), F.col("level"))))
        high = F.least(high, F.when(here, F.lit(e) + F.col("level")))
    found = levels.select("node", low.alias("new_low"), high.alias("new_high"))
    found = found.groupBy("node").agg(F.max("new_low").alias("new_low"), F.min("new_high").alias("new_high"))
    return bounds.join(found, "node", "left").select(
        "node", "degree", F.greatest("low", "new_low").alias("low"), F.least("high", "new_high").alias("high")
    )


def diameter(edges: DataFrame, rows_per_batch: int = ROWS_PER_BATCH, most_links: int = MOST_SEARCHED) -> DataFrame:
    """One row: the diameter of the largest component, edges taken both ways.

    Searches from a few nodes bound the eccentricity of all. The next searches start where the upper
    bound is highest and where the lower bound is lowest, until no upper bound exceeds the longest
    distance seen. Searches run side by side, a bit each and at most ``rows_per_batch`` bits, so a
    table has one row for a node and level, never one for a pair of nodes. Where distances are short,
    bounds leave most nodes open: up to ``most_links`` links, tasks that hold them search from all those.
    """
    parts = connected_components(edges)
    members = numbered(largest_component(parts))
    links = by_number(graph.both_ways(graph.undirected(edges)).where("src <> dst").select("src", "dst"), members)
    links = cut_lineage(links.select("src", "dst"))
    degree = links.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    nodes = members.select(F.col("id").alias("node"))
    unknown = F.lit(None).cast("int").alias("high")
    bounds = cut_lineage(nodes.join(degree, "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"), F.lit(0).alias("low"), unknown))
    most_sources = min(MOST_SOURCES, max(2, rows_per_batch // max(1, nodes.count())))
    longest, n_sources, is_small = 0, min(64, most_sources), links.count() <= most_links
    while True:
        open_ = bounds.where(F.col("high").isNull() | (F.col("high") > longest))
        by_high = open_.orderBy(F.col("high").desc_nulls_first(), F.col("degree").desc(), "node").limit(max(1, n_sources // 2))
        by_low = open_.orderBy("low", F.col("degree").desc(), "node").limit(max(1, n_sources // 2))
        sources = [row["node"] for row in by_high.select("node").union(by_low.select("node")).distinct().collect()]
        if not sources:
            return bounds.sparkSession.range(1).select(F.lit(longest).cast("long").alias("diameter"))
        levels, far = _spread(links, nodes, sources)
        longest = max(longest, *far)
        bounds = cut_lineage(_narrowed(bounds, levels, sources, far))
        if is_small and longest <= MOST_LEVELS:
            open_ = bounds.where(F.col("high") > longest).select("node")
            longest = max(longest, farthest(links, bounds.count(), open_))
            return bounds.sparkSession.range(1).select(F.lit(longest).cast("long").alias("diameter"))
        n_sources = min(most_sources, 4 * n_sources)


def _tight_steps(links: DataFrame, distances: DataFrame) -> DataFrame:
    """``source, u, v``: the steps that lie on some shortest path from the source."""
    start = distances.select("source", F.col("node").alias("u"), F.col("distance").alias("du"))
    end = distances.select("source", F.col("node").alias("v"), F.col("distance").alias("dv"))
    return (
        start.join(links, start["u"] == links["src"])
        .withColumnRenamed("dst", "v")
        .join(end, ["source", "v"])
        .where(F.col("du") + F.col("cost") == F.col("dv"))
        .select("source", "u", "v")
    )


def _costed_links(edges: DataFrame, is_directed: bool, weighted: bool) -> DataFrame:
    pairs = graph.directed(edges) if is_directed else graph.both_ways(graph.undirected(edges))
    cost = F.col("weight").cast("bigint") if weighted else F.lit(1).cast("bigint")
    return cut_lineage(pairs.where("src <> dst").select("src", "dst", cost.alias("cost")))


def _path_counts(steps: DataFrame, distances: DataFrame) -> tuple[DataFrame, int]:
    """``source, node, paths`` and the number of steps on the longest shortest path."""
    paths = cut_lineage(
        distances.select(
            "source", "node", (F.col("source") == F.col("node")).cast("double").alias("paths")
        )
    )
    rounds = 0
    while True:
        incoming = (
            steps.join(
                paths.select("source", F.col("node").alias("u"), "paths"), ["source", "u"]
            )
            .groupBy("source", F.col("v").alias("node"))
            .agg(F.sum("paths").alias("incoming"))
        )
        following = cut_lineage(
            paths.join(incoming, ["source", "node"], "left").select(
                "source",
                "node",
                F.coalesce("incoming", "paths").alias("paths"),
                (F.coalesce("incoming", "paths") != F.col("paths")).alias("moved"),
            )
        )
        paths = following.drop("moved")
        if following.where("moved").isEmpty():
            return paths, rounds
        rounds += 1


def _backwards(shares: DataFrame, distances: DataFrame, rounds: int) -> DataFrame:
    """Sum ``share * (1 + value of v)`` at ``u`` over ``source, u, v, share``, from afar."""
    value = distances.select("source", "node", F.lit(0.0).alias("value"))
    for _ in range(rounds):
        passed = (
            shares.join(value.select("source", F.col("node").alias("v"), "value"), ["source", "v"])
            .groupBy("source", F.col("u").alias("node"))
            .agg(F.sum(F.col("share") * (1 + F.col("value"))).alias("passed"))
        )
        value = cut_lineage(
            distances.select("source", "node")
            .join(passed, ["source", "node"], "left")
            .select("source", "node", F.coalesce("passed", F.lit(0.0)).alias("value"))
        )
    return value


def _by_joins(links: DataFrame, nodes: DataFrame, sources: DataFrame | None, rows_per_batch: int, by_paths: bool) -> DataFrame:
    """``node, value`` by joins over (source, node) rows, in as many batches of sources as bounds ask for."""
    parts = None
    for batch in _source_batches(nodes, sources, rows_per_batch):
        distances = cut_lineage(_distances(links, cut_lineage(batch)))
        steps = cut_lineage(_tight_steps(links, distances))
        paths, rounds = _path_counts(steps, distances)
        if by_paths:
            before = paths.select("source", F.col("node").alias("u"), F.col("paths").alias("pu"))
            after = paths.select("source", F.col("node").alias("v"), F.col("paths").alias("pv"))
            shares = steps.join(before, ["source", "u"]).join(after, ["source", "v"]).select(
                "source", "u", "v", (F.col("pu") / F.col("pv")).alias("share")
            )
        else:
            ways = steps.groupBy("source", "v").agg(F.count("*").alias("ways"))
            shares = steps.join(ways, ["source", "v"]).select(
                "source", "u", "v", (F.lit(1.0) / F.col("ways")).alias("share")
            )
        value = _backwards(cut_lineage(shares), distances, rounds)
        part = cut_lineage(
            value.where(F.col("source") != F.col("node"))
            .groupBy("node")
            .agg(F.sum("value").alias("value"))
        )
        parts = part if parts is None else parts.union(part)
    return parts.groupBy("node").agg(F.sum("value").alias("value"))


def _centrality(
    edges: DataFrame,
    is_directed: bool,
    weighted: bool,
    sources: DataFrame | None,
    rows_per_batch: int,
    most_links: int,
    by_paths: bool,
    name: str,
) -> DataFrame:
    links = _costed_links(edges, is_directed, weighted)
    nodes = cut_lineage(graph.nodes_of(edges))
    if links.count() <= most_links:
        ids = numbered(nodes)
        starts = None if sources is None else ids.join(sources.select("node").distinct(), "node", "left_semi")
        found = dependencies(cut_lineage(by_number(links, ids)), ids, starts, weighted, not is_directed, by_paths)
        total = found.join(ids, "id").select("node", "value")
    else:
        total = _by_joins(links, nodes, sources, rows_per_batch, by_paths)
    n = float(nodes.count())
    scale = (n - 1) * (n - 2) if n > 2 else 1.0
    scaled = F.coalesce("value", F.lit(0.0)) / scale
    return nodes.join(total, "node", "left").select("node", scaled.alias(name))


def betweenness(
    edges: DataFrame,
    is_directed: bool = False,
    weighted: bool = False,
    sources: DataFrame | None = None,
    rows_per_batch: int = ROWS_PER_BATCH,
    most_links: int = MOST_LINKS,
) -> DataFrame:
    """``node, betweenness``: share of shortest paths that pass a node, normalised.

    Brandes' accumulation: paths are counted outwards from each source, then dependencies are added
    up backwards along the same steps. Sources are dealt over tasks. Up to ``most_links`` links a task
    holds the links themselves; beyond, the steps of batches of sources are joined.
    """
    return _centrality(
        edges, is_directed, weighted, sources, rows_per_batch, most_links, True, "betweenness"
    )


def load_centrality(
    edges: DataFrame,
    is_directed: bool = False,
    weighted: bool = False,
    sources: DataFrame | None = None,
    rows_per_batch: int = ROWS_PER_BATCH,
    most_links: int = MOST_LINKS,
) -> DataFrame:
    """``node, load``: as betweenness, each node splitting its load evenly backwards."""
    return _centrality(
        edges, is_directed, weighted, sources, rows_per_batch, most_links, False, "load"
    )


def eigenvector_centrality(
    edges: DataFrame,
    max_iter: int = 100,
    tolerance: float = 1e-6,
    steps_per_round: int = 5,
    must_converge: bool = True,
) -> DataFrame:
    """``node, eigenvector`` of the undirected graph by power iteration.

    Each step adds the values of the neighbours to the own value; a link from every
    node to itself stands for the latter, so a step reads the vector once. Several
    steps make one job; scaling and the test for convergence come at its end. Without
    ``must_converge`` the vector after ``max_iter`` steps stands, however far it still moves.
    """
    simple = graph.both_ways(graph.undirected(edges)).select("src", "dst")
    nodes = cut_lineage(simple.select(F.col("src").alias("node")).distinct())
    own = nodes.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(True).alias("own"))
    links = cut_lineage(simple.withColumn("own", F.lit(False)).unionByName(own))
    n = nodes.count()
    vector = nodes.withColumn("x", F.lit(1.0 / max(n, 1)))
    for done in range(0, max_iter, steps_per_round):
        for _ in range(min(steps_per_round, max_iter - done)):
            vector = (
                links.join(vector.select("node", "x"), F.col("src") == F.col("node"))
                .groupBy("dst")
                .agg(F.sum("x").alias("x"), F.max(F.when(F.col("own"), F.col("x"))).alias("before"))
                .withColumnRenamed("dst", "node")
            )
        written = cut_lineage(vector)
        norm, norm_before = written.agg(
            F.sqrt(F.sum(F.col("x") * F.col("x"))),
            F.sqrt(F.sum(F.col("before") * F.col("before"))),
        ).first()
        scaled = written.select(
            "node",
            (F.col("x") / norm).alias("x"),
            F.abs(F.col("x") / norm - F.col("before") / norm_before).alias("change"),
        )
        vector = scaled.select("node", "x")
        if scaled.agg(F.sum("change")).first()[0] < n * tolerance:
            return vector.withColumnRenamed("x", "eigenvector")
    if not must_converge:
        return vector.withColumnRenamed("x", "eigenvector")
    raise RuntimeError(f"no convergence within {max_iter} iterations")
