"""Graph measures on random graphs beside brute force, and folds and tails beside plain Python."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections import Counter, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.functions import features, parsing, statistics
from wayfare.operators import centrality, components, graph, graph_paths, network, sessions


def edges_of(spark, pairs):
    rows = [(f"n{a:04d}", f"n{b:04d}", w) for a, b, w in pairs]
    return spark.createDataFrame(rows, "src string, dst string, weight bigint")


def drawn(seed, nodes, links, weights=1):
    """A random graph with trees hanging on it, a part of its own and a loop."""
    draw = random.Random(seed)
    pairs = {tuple(sorted(draw.sample(range(nodes), 2))) for _ in range(links)}
    pairs |= {(draw.randrange(nodes), nodes + i) for i in range(nodes // 2)} | {(nodes + i, 2 * nodes + i) for i in range(nodes // 4)}
    pairs |= {(9000, 9001), (9001, 9002), (9100, 9100)}
    return [(a, b, draw.randint(1, weights)) for a, b in sorted(pairs)]


def values(df):
    return {r[0]: r[1] for r in df.collect()}


def searched(pairs):
    """{node: {node: distance}} both ways."""
    near = {}
    for a, b, _ in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = {}
    for start in near:
        far, queue = {start: 0}, deque([start])
        while queue:
            at = queue.popleft()
            for other in near[at] - far.keys():
                far[other] = far[at] + 1
                queue.append(other)
        found[start] = far
    return found


def test_components_and_diameter(spark):
    pairs = drawn(2, 40, 60)
    found = searched(pairs)
    edges = edges_of(spark, pairs)
    assert values(graph_paths.connected_components(edges)) == {f"n{n:04d}": f"n{min(far):04d}" for n, far in found.items()}
    largest = max(found.values(), key=len)
    want = max(max(found[n].values()) for n in largest)
    assert graph_paths.diameter(edges).first().diameter == want
    assert graph_paths.diameter(edges, rows_per_batch=3 * len(largest)).first().diameter == want


def test_searches_that_bounds_leave_open_run_in_tasks(spark, monkeypatch):
    """On short distances the held search gives what rounds of bounds give, whatever is left open."""
    pairs = drawn(4, 400, 900)
    edges = edges_of(spark, pairs)
    want = max(max(far.values()) for far in searched(pairs).values())
    assert graph_paths.diameter(edges, most_links=0).first().diameter == want
    searches = []
    held = graph_paths.farthest
    monkeypatch.setattr(graph_paths, "farthest", lambda *given: searches.append(held(*given)) or searches[-1])
    assert graph_paths.diameter(edges, rows_per_batch=1).first().diameter == want
    assert len(searches) == 1


@pytest.mark.parametrize("both_ways", [True, False])
def test_sources_of_components_side_by_side(monkeypatch, both_ways):
    """Parts of one graph, sources in batches and hubs in pieces give what single sources give."""
    draw = np.random.default_rng(6)
    pairs = np.concatenate([draw.integers(0, 50, (200, 2)), draw.integers(60, 70, (20, 2)), [[80, at] for at in range(81, 300)]])
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]) if both_ways else pairs, axis=0)
    links = centrality._sorted_links(310, pairs[:, 0], pairs[:, 1], None, draw.integers(1, 4, 310))
    monkeypatch.setattr(centrality, "TABLE", 50 * 7)
    monkeypatch.setattr(centrality, "ROWS", 16)
    for by_paths in (True, False):
        want = sum(centrality.from_source(links, source, by_paths) for source in range(310))
        found = np.zeros(310)
        at, value = centrality.by_component(links).passed(np.arange(310), both_ways, by_paths)
        found[at] = value
        assert np.allclose(found, want)


def rows_taken(monkeypatch, run):
    """What ``run`` gives, and how many rows of tables it takes, each times its length."""
    taken, plain = [], np.take

    def take(table, places, *given, **named):
        taken.append(len(places) * table.shape[1] if table.ndim == 2 else 0)
        return plain(table, places, *given, **named)

    with monkeypatch.context() as patch:
        patch.setattr(np, "take", take)
        return run(), sum(taken)


def in_order(pairs):
    """Links both ways, nodes in falling order of their numbers of links."""
    n = int(pairs.max()) + 1
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    rank = np.argsort(np.argsort(-np.bincount(pairs[:, 0], minlength=n), kind="stable"))
    pairs = rank[pairs]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return centrality._sorted_links(n, pairs[:, 0], pairs[:, 1], None, np.zeros(0))


@pytest.mark.parametrize("shape", ["short", "long", "apart"])
def test_longest_distance_beside_single_searches(shape):
    """Whatever is known of the longest distance, the searches side by side give it."""
    draw = np.random.default_rng(8)
    pairs = draw.integers(0, 300, (1500, 2))
    if shape == "long":
        pairs = np.concatenate([pairs, [[at, at + 1] for at in range(299, 320)], [[7, 330], [330, 331]]])
    if shape == "apart":
        pairs = np.concatenate([pairs, pairs[:200] + 300])
    links = in_order(pairs)
    n = len(links.first) - 1
    plain = centrality.Links(links.first, links.to, None, np.ones(n, np.int64))
    far = np.array([sum(1 for _ in centrality._levels(plain, at)) for at in range(n)])
    for at_once in (n, 70):
        for most in range(far.max() + 1):
            searches, found = centrality.Searches(links), most
            for low in range(0, n, at_once):
                found = searches.longest(np.arange(low, min(n, low + at_once)), found)
            assert found == far.max()


def test_longest_distance_takes_few_rows(monkeypatch):
    """When the longest distance is known, far fewer rows are taken than there are links in each round."""
    draw = np.random.default_rng(9)
    links = in_order(draw.integers(0, 4_000, (80_000, 2)))
    sources = np.arange(0, 64)
    most = centrality.Searches(links).longest(np.arange(len(links.first) - 1), 0)
    found, taken = rows_taken(monkeypatch, lambda: centrality.Searches(links).longest(sources, most))
    assert found == most and taken < len(links.to)


def test_sources_side_by_side_take_few_rows(monkeypatch):
    """Rows are taken once a distance there and back where many cells are met, not for the first steps; shares are as of single sources."""
    draw = np.random.default_rng(10)
    links = in_order(draw.integers(0, 4_000, (80_000, 2)))
    links = centrality.Links(links.first, links.to, None, draw.integers(1, 4, 4_000))
    sources = draw.choice(4_000, 16, replace=False)
    for by_paths in (True, False):
        many = centrality._SideBySide(links, True)
        found, taken = rows_taken(monkeypatch, lambda: many.passed(sources, by_paths))
        assert np.allclose(found, sum(centrality.from_source(links, source, by_paths) for source in sources), rtol=1e-12)
        assert taken < 3 * len(sources) * len(links.to)


@pytest.mark.parametrize("widest", [centrality.MOST_CELLS, 0])
def test_numbers_of_paths_that_outgrow_their_types(monkeypatch, widest):
    """Layers of 20 nodes, each tied to the next: 20 ** 9 paths, by single cells and by rows."""
    monkeypatch.setattr(centrality, "MOST_CELLS", widest)
    pairs = [(20 * at + a, 20 * at + 20 + b) for at in range(10) for a in range(20) for b in range(20)]
    links = in_order(np.array(pairs + [(0, 220), (220, 221)]))
    links = centrality.Links(links.first, links.to, None, np.ones(222, np.int64))
    for by_paths in (True, False):
        found = centrality._SideBySide(links, True).passed(np.arange(222), by_paths)
        assert np.allclose(found, sum(centrality.from_source(links, at, by_paths) for at in range(222)), rtol=1e-12)


def test_long_path_and_giant_star(spark):
    path = spark.range(2_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(2_001, 102_000).select(F.lit(500_000).cast("long").alias("a"), F.col("id").alias("b"))
    found = components.star_components(path.unionByName(star)).groupBy("component").count().collect()
    assert {r["component"]: r["count"] for r in found} == {0: 2_001, 2_001: 100_000}


@pytest.mark.parametrize(("is_directed", "weighted"), [(False, False), (True, True)])
def test_held_links_give_what_joins_give(spark, is_directed, weighted):
    edges = edges_of(spark, drawn(3, 8, 12, weights=3))
    for measure in (graph_paths.betweenness, graph_paths.load_centrality):
        held = values(measure(edges, is_directed, weighted))
        joined = values(measure(edges, is_directed, weighted, most_links=0))
        assert held == pytest.approx(joined), measure.__name__
    some = edges.select(F.col("src").alias("node")).distinct().orderBy("node").limit(3)
    held = values(graph_paths.betweenness(edges, is_directed, weighted, sources=some))
    assert held == pytest.approx(values(graph_paths.betweenness(edges, is_directed, weighted, sources=some, most_links=0)))


def test_peeled_trees_lose_nothing():
    pairs = [(a, b) for a, b, _ in drawn(5, 20, 30) if a < 100 and a != b]
    n = max(map(max, pairs)) + 1
    src, dst = np.array(pairs + [(b, a) for a, b in pairs]).T
    whole = centrality._sorted_links(n, src, dst, None, np.ones(n, np.int64))
    want = sum(centrality.from_source(whole, s, True) for s in range(n))
    held, added, starts = centrality.peel(n, src, dst, None)
    assert len(starts) < n and np.allclose(want, added + sum(centrality.from_source(held, s, True) for s in starts.tolist()))


def test_distances_are_positive(spark):
    edges = spark.createDataFrame([("a", "b", 0), ("b", "c", 1)], "src string, dst string, weight bigint")
    with pytest.raises(ValueError):
        graph_paths.betweenness(edges, is_directed=True, weighted=True)


def test_transitivity_beside_brute_force(spark):
    pairs = drawn(7, 30, 120)
    near = searched(pairs)
    near = {n: {m for m, d in far.items() if d == 1} for n, far in near.items()}
    triangles = sum(1 for a, b, c in itertools.combinations(near, 3) if b in near[a] and c in near[a] and c in near[b])
    row = graph.transitivity(edges_of(spark, pairs)).first()
    assert row.triangles == triangles and row.triples == sum(len(m) * (len(m) - 1) // 2 for m in near.values())


def test_adjacency_blocks_of_a_hub(spark):
    edges = spark.range(1000).select(F.lit("hub").alias("src"), F.format_string("p%04d", "id").alias("dst")).unionByName(
        spark.createDataFrame([("p0001", "p0002"), ("p0001", "p0002")], "src string, dst string")
    )
    found = {(r["src"], r["part"]): r["pages"] for r in network.adjacency_blocks(edges, longest=300).collect()}
    assert {key: len(pages) for key, pages in found.items()} == {("hub", 0): 300, ("hub", 1): 300, ("hub", 2): 300, ("hub", 3): 100, ("p0001", 0): 1}
    assert sum((found[("hub", i)] for i in range(4)), []) == [f"p{i:04d}" for i in range(1000)]


def test_giant_visits_take_chunks(spark):
    draw = random.Random(2)
    rows = [(f"v{i % 3}", 1, "PAGE" if draw.random() < 0.7 else "EVENT", f"/p{draw.randrange(5)}", None, None, "t", i, i // 7, i % 2) for i in range(200)]
    names = "fullVisitorId string, visitId int, type string, pagePath string, eventCategory string, eventAction string, taxons string, hitOrder int, hitChunk int, n int"
    hits = spark.createDataFrame(rows, names)
    plain = sessions.visits(hits, head=("n",)).withColumn("heads", F.sort_array("heads"))
    giants = spark.createDataFrame([("v1", 1), ("v1", 1), ("v9", 1)], "fullVisitorId string, visitId int")
    split = sessions.visits(hits, head=("n",), giants=giants).withColumn("heads", F.sort_array("heads"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(plain.columns).collect()))


# Folds over lists


def counted(items):
    return list(Counter(items).items())


def test_frequencies_in_order_of_first_appearance(spark):
    draw = random.Random(4)
    pick = lambda: draw.choice([None, ("c1", None), (None, "a"), (None, None)] + [(c, a) for c in "xyz" for a in "ab"])
    lists = [None, [], [None]] + [[pick() for _ in range(draw.randrange(12))] for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(lists)), "i int, e array<struct<category:string,action:string>>")
    rows = frame.select("i", features.event_frequencies(F.col("e")).alias("both"), features.category_frequencies(F.col("e")).alias("one")).collect()
    for row in rows:
        own = lists[row["i"]]
        if own is None:
            assert row["both"] is None and row["one"] is None
            continue
        known = [e for e in own if e is not None]
        assert [((r["category"], r["action"]), r["n"]) for r in row["both"]] == counted(known)
        assert [(r["category"], r["n"]) for r in row["one"]] == counted([c for c, _ in known])


def kept_by_hand(hits):
    kept, previous = [], None
    for page, event in hits:
        if not kept:
            kept.append((0, page, event))
        elif page != previous:
            kept.append((kept[-1][0] + 1, page, event))
        elif event is not None and kept[-1][2] is not None and event != kept[-1][2]:
            kept.append((kept[-1][0], page, event))
        previous = page
    return kept


def test_reindexed_hits(spark):
    draw = random.Random(6)
    lists = [[], [(None, None)]] + [[(draw.choice("ab") if draw.random() < 0.9 else None, draw.choice(["e", "f", None])) for _ in range(draw.randrange(14))] for _ in range(120)]
    frame = spark.createDataFrame(list(enumerate(lists)), "i int, e array<struct<page:string,event:string>>")
    for row in frame.select("i", parsing.reindex_hits(F.col("e")).alias("found")).collect():
        assert [tuple(r) for r in row["found"]] == kept_by_hand(lists[row["i"]])


def test_folds_of_long_lists_are_linear(spark):
    events = F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.struct((i % 50_000).cast("string").alias("category"), F.lit("a").alias("action")))
    hits = F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.struct((i % 7).cast("string").alias("page"), (i % 3).cast("string").alias("event")))
    entries = F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: F.struct((i % 50_000).cast("string").alias("key"), F.lit(1).cast("long").alias("n")))
    start = time.time()
    row = spark.range(1).select(
        F.size(features.event_frequencies(events)).alias("events"),
        F.size(parsing.reindex_hits(hits)).alias("hits"),
        F.size(features.sum_entries(entries)).alias("keys"),
    ).first()
    assert tuple(row) == (50_000, 200_000, 50_000) and time.time() - start < 60


def test_tails(spark):
    points = [0.0, 1e-9, 0.3, 1.0, 1.96, 2.5, 3.5, 3.6, 5.0, 9.0, 25.0, None]
    frame = spark.createDataFrame([(i, z) for i, z in enumerate(points)], "i int, z double")
    for row in frame.select("i", statistics.normal_two_sided(F.col("z")).alias("p"), statistics.chi2_one_degree(F.col("z") * F.col("z")).alias("q")).collect():
        z = points[row["i"]]
        want = None if z is None else pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-12, abs=1e-300)
        assert row["p"] == want and row["q"] == want


def test_eigenvector_of_two_loose_groups(spark):
    """Groups tied by one link converge slowly: an error, unless the vector after so many steps is asked for."""
    pairs = [(a, b, 1) for low in (0, 6) for a in range(low, low + 6) for b in range(a + 1, low + 6)] + [(5, 6, 1), (11, 12, 1)]
    edges = edges_of(spark, pairs)
    with pytest.raises(RuntimeError):
        graph_paths.eigenvector_centrality(edges, max_iter=7, tolerance=1e-12)
    found = values(graph_paths.eigenvector_centrality(edges, max_iter=7, tolerance=1e-12, must_converge=False))
    near = np.eye(13)
    for a, b, _ in pairs:
        near[a, b] = near[b, a] = 1
    want = np.linalg.matrix_power(near, 7) @ np.ones(13)
    want /= np.linalg.norm(want)
    assert found == pytest.approx({f"n{at:04d}": value for at, value in enumerate(want)})


def rows_of_joins(plan) -> list[int]:
    """Output rows of every join of an executed plan."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return rows_of_joins(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return rows_of_joins(plan.plan())
    below = [n for at in range(plan.children().size()) for n in rows_of_joins(plan.children().apply(at))]
    own = [plan.metrics().apply("numOutputRows").value()] if "Join" in plan.nodeName() else []
    return own + below


def test_transitivity_joins_make_no_more_rows_than_edges(spark):
    pairs = [(a, b, 1) for a, b in itertools.combinations(range(40), 2)]
    frame = graph.transitivity(edges_of(spark, pairs))
    row = frame.collect()[0]
    assert (row.triangles, row.triples, row.transitivity) == (9880, 40 * 39 * 38 // 2, 1.0)
    made = rows_of_joins(frame._jdf.queryExecution().executedPlan())
    assert made and max(made) <= len(pairs)
