"""Graph measures on graphs solved by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wayfare.operators import communities, graph, graph_paths

SHAPES = {
    "path": [("a", "b"), ("b", "c"), ("c", "d")],
    "star": [("h", x) for x in "abcd"],
    "triangles": [("a", "b"), ("b", "c"), ("a", "c"), ("d", "e"), ("e", "f"), ("d", "f"), ("c", "d")],
    "apart": [("a", "b"), ("y", "z")],
}


@pytest.fixture
def shape(spark):
    def build(name, weight=1):
        return spark.createDataFrame([(s, d, weight) for s, d in SHAPES[name]], "src string, dst string, weight bigint")

    return build


def values(df, key="node", column=None):
    column = column or [c for c in df.columns if c != key][0]
    return {r[key]: r[column] for r in df.collect()}


def test_transitivity(shape):
    assert graph.transitivity(shape("triangles")).first().transitivity == pytest.approx(3 * 2 / 10)
    assert graph.transitivity(shape("star")).first().transitivity == 0.0


def test_density_and_degrees(shape):
    assert graph.density(shape("path"), False).first().density == pytest.approx(0.5)
    assert graph.density(shape("path"), True).first().density == pytest.approx(0.25)
    assert values(graph.degrees(shape("star")), column="degree") == {"h": 4, "a": 1, "b": 1, "c": 1, "d": 1}
    assert values(graph.degree_centrality(shape("star")), column="degree_centrality")["h"] == 1.0


def test_shortest_path(shape):
    both = graph.both_ways(graph.undirected(shape("triangles")))
    found = graph_paths.shortest_path(both, "a", "f").orderBy("position").collect()
    assert [r.node for r in found] == ["a", "c", "d", "f"] and found[0].length == 3
    assert graph_paths.shortest_path(shape("path"), "d", "a").isEmpty()
    assert graph_paths.shortest_path(shape("path"), "b", "b").collect()[0].length == 0


def test_components(spark, shape):
    assert values(graph_paths.connected_components(shape("apart"))) == {"a": "a", "b": "a", "y": "y", "z": "y"}
    # A long chain whose names jump about.
    names = [f"n{(i * 37) % 101:03d}" for i in range(101)]
    chain = spark.createDataFrame(list(zip(names, names[1:])), "src string, dst string").withColumn("weight", F.lit(1))
    assert set(values(graph_paths.connected_components(chain)).values()) == {"n000"}


def test_diameter_in_batches(shape):
    assert graph_paths.diameter(shape("path")).first().diameter == 3
    assert graph_paths.diameter(shape("triangles"), rows_per_batch=9).first().diameter == 3


def test_betweenness_and_load(shape):
    path = {"a": 0, "b": 2 / 3, "c": 2 / 3, "d": 0}
    assert values(graph_paths.betweenness(shape("path"))) == pytest.approx(path)
    assert values(graph_paths.load_centrality(shape("path"))) == pytest.approx(path)
    assert values(graph_paths.betweenness(shape("star")))["h"] == pytest.approx(1.0)
    directed = values(graph_paths.betweenness(shape("path"), is_directed=True))
    assert directed == pytest.approx({"a": 0, "b": 1 / 3, "c": 1 / 3, "d": 0})
    bridged = values(graph_paths.betweenness(shape("triangles"), rows_per_batch=7))
    assert bridged["c"] == pytest.approx(2 * 6 / 20) and bridged["a"] == 0


def test_weight_is_distance(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("a", "c", 5)], "src string, dst string, weight bigint")
    assert values(graph_paths.betweenness(edges, is_directed=True, weighted=True))["b"] == pytest.approx(0.5)
    assert values(graph_paths.betweenness(edges, is_directed=True))["b"] == 0


def test_load_splits_over_predecessors(spark):
    # a reaches d by b or c, and d leads on to e: from a, d sends one unit of its own and
    # one of e back in halves; from b and from c, d passes on one unit each.
    edges = spark.createDataFrame(
        [("a", "b", 1), ("a", "c", 1), ("b", "d", 1), ("c", "d", 1), ("d", "e", 1)], "src string, dst string, weight bigint"
    )
    found = values(graph_paths.load_centrality(edges, is_directed=True))
    assert found == pytest.approx({"a": 0, "b": 1 / 12, "c": 1 / 12, "d": 3 / 12, "e": 0})


def test_eigenvector(shape):
    star = values(graph_paths.eigenvector_centrality(shape("star"), tolerance=1e-8))
    assert star["h"] == pytest.approx(0.70710678, abs=1e-5)
    assert star["a"] == pytest.approx(0.35355339, abs=1e-5)


def test_louvain_finds_planted_groups(shape):
    edges = graph.undirected(shape("triangles"))
    found = communities.louvain(edges)
    groups = values(found)
    assert len({groups[x] for x in "abc"}) == 1 and len({groups[x] for x in "def"}) == 1
    assert groups["a"] != groups["d"]
    alone = graph.nodes_of(edges).withColumn("community", F.col("node"))
    assert communities.modularity(edges, found) == pytest.approx(6 / 7 - 0.5)
    assert communities.modularity(edges, found) > communities.modularity(edges, alone)


def test_ranks_and_members(shape):
    parts = graph_paths.connected_components(shape("apart")).withColumnRenamed("component", "community")
    metric = graph.degrees(shape("apart")).select("node", "degree")
    ranks = {(r.community, r.node): r.rank for r in communities.rank_in_communities(parts, metric, "degree").collect()}
    assert ranks == {("a", "a"): 1, ("a", "b"): 2, ("y", "y"): 1, ("y", "z"): 2}
    assert communities.members_of_larger(parts, 2).isEmpty()
    assert communities.size_histogram(parts).collect()[0].asDict() == {"n_nodes": 2, "n_communities": 2}
