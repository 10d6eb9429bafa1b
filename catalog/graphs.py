"""Measures of the link and journey networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare.functions import parsing
from wayfare.operators import communities as C
from wayfare.operators import graph as G
from wayfare.operators import graph_paths as P
from wayfare.operators import network
from wayfare.operators import sessions as S
from wayfare.session import cut_lineage


def links(spark, sf):
    return cut_lineage(I.link_edges(spark, sf))


E = I.LINK_EDGES_SQL
U = E + """
undirected AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, CAST(sum(weight) AS BIGINT) AS weight FROM edges GROUP BY ALL),
"""
B = U + """
bi AS (SELECT src, dst FROM undirected UNION SELECT dst, src FROM undirected),
"""
DEGREES = """
degrees AS (
  SELECT node, CAST(sum(i + o) AS BIGINT) AS degree, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree FROM (
    SELECT src AS node, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY ALL
),
"""
register(
    "g1_directed_graph",
    lambda s, d: G.directed(
        I.adjacency(s, d).select(
            F.col("source_base_path").alias("src"), F.col("sink_base_path").alias("dst"), F.lit(1).alias("weight")
        )
    ),
    E,
    "SELECT * FROM edges",
)
register(
    "g2_undirected_graph",
    lambda s, d: G.undirected(I.journey_edges(s, d)),
    I.JOURNEY_EDGES_SQL,
    "SELECT least(src, dst) AS src, greatest(src, dst) AS dst, CAST(sum(weight) AS BIGINT) AS weight FROM edges GROUP BY ALL",
)


def g3(spark, sf):
    edges = links(spark, sf)
    return G.with_attributes(edges, G.degrees(edges).select("node", "degree"))


register(
    "g3_attributes",
    g3,
    E + DEGREES,
    """SELECT src, dst, weight, a.degree AS src_degree, b.degree AS dst_degree FROM edges
       JOIN degrees a ON a.node = src JOIN degrees b ON b.node = dst""",
)
register(
    "g4_summary",
    lambda s, d: G.summary(I.link_edges(s, d)),
    E + DEGREES,
    "SELECT count(*) AS n_nodes, CAST(sum(out_degree) AS BIGINT) AS n_edges, CAST(sum(out_degree) AS DOUBLE) / count(*) AS mean_degree FROM degrees",
)
register(
    "g5_self_loops",
    lambda s, d: G.self_loops(I.journey_edges(s, d)),
    I.JOURNEY_EDGES_SQL,
    "SELECT count(*) FILTER (src = dst) AS n_self_loops FROM edges",
)
register(
    "g6_edges_with_term",
    lambda s, d: G.edges_with_term(I.link_edges(s, d), "fr", or_weight_above=1),
    E,
    "SELECT * FROM edges WHERE contains(src, 'fr') OR contains(dst, 'fr') OR weight > 1",
)


def g7(spark, sf):
    edges = links(spark, sf)
    return G.induced_subgraph(edges, G.nodes_of(edges).where(F.col("node").rlike("e.")))


register(
    "g7_induced_subgraph",
    g7,
    E,
    "SELECT * FROM edges WHERE regexp_matches(src, 'e.') AND regexp_matches(dst, 'e.')",
)
register(
    "g8_density",
    lambda s, d: G.density(G.undirected(I.link_edges(s, d)), is_directed=False),
    U + DEGREES.replace("FROM edges", "FROM undirected"),
    """SELECT count(*) AS n_nodes, CAST(sum(out_degree) AS BIGINT) AS n_edges,
       CAST(sum(out_degree) AS DOUBLE) * 2 / (CAST(count(*) AS DOUBLE) * (CAST(count(*) AS DOUBLE) - 1)) AS density FROM degrees""",
)
register(
    "g8_directed_density",
    lambda s, d: G.density(I.link_edges(s, d), is_directed=True),
    E + DEGREES,
    """SELECT count(*) AS n_nodes, CAST(sum(out_degree) AS BIGINT) AS n_edges,
       CAST(sum(out_degree) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * (CAST(count(*) AS DOUBLE) - 1)) AS density FROM degrees""",
)
register("g9_degrees", lambda s, d: G.degrees(I.link_edges(s, d)), E + DEGREES, "SELECT * FROM degrees")
register(
    "g10_degree_centrality",
    lambda s, d: G.degree_centrality(links(s, d)),
    E + DEGREES,
    "SELECT node, degree, CAST(degree AS DOUBLE) / ((SELECT count(*) FROM degrees) - 1) AS degree_centrality FROM degrees",
)
register(
    "g11_top_nodes",
    lambda s, d: G.top_nodes(G.degrees(I.link_edges(s, d)), "degree", 20),
    E + DEGREES,
    "SELECT * FROM degrees ORDER BY degree DESC, node LIMIT 20",
)
register(
    "g12_rank_of_matching",
    lambda s, d: G.rank_of_matching(G.degrees(I.link_edges(s, d)), "degree", "fr").select("node", "degree", "rank"),
    E + DEGREES,
    "SELECT * FROM (SELECT node, degree, row_number() OVER (ORDER BY degree DESC, node) AS rank FROM degrees) WHERE contains(node, 'fr')",
)
register(
    "g13_out_edges",
    lambda s, d: G.out_edges(I.journey_edges(s, d), "/p1"),
    I.JOURNEY_EDGES_SQL,
    "SELECT * FROM edges WHERE src = '/p1'",
)
register(
    "g14_shortest_path",
    lambda s, d: P.shortest_path(G.both_ways(G.undirected(I.link_edges(s, d))), "/the", "/de").withColumn(
        "position", F.col("position").cast("bigint")
    ),
    B + """
walk AS (
  SELECT 0 AS level, '/the' AS node, ['/the'] AS path
  UNION ALL
  SELECT level + 1 AS level, dst AS node, min(list_append(path, dst)) AS path FROM walk JOIN bi ON src = node WHERE level < 10 GROUP BY level, dst
),
found AS (SELECT path FROM walk WHERE node = '/de' ORDER BY level LIMIT 1),
""",
    "SELECT unnest(range(len(path))) AS position, unnest(path) AS node, len(path) - 1 AS length FROM found",
)
REACH = B + """
reach AS (SELECT src AS node, src AS other FROM bi UNION SELECT r.node, dst FROM reach r JOIN bi ON src = r.other),
components AS (SELECT node, min(other) AS component FROM reach GROUP BY ALL),
"""
register(
    "g15_connected_components",
    lambda s, d: P.connected_components(I.link_edges(s, d)),
    REACH,
    "SELECT node, component FROM components",
)


def all_links(spark, sf):
    """The whole link graph, written once for the loops over it."""
    return cut_lineage(I.link_edges(spark, sf))


register(
    "g15_component_sizes",
    lambda s, d: P.component_sizes(P.connected_components(all_links(s, d))),
    REACH,
    "SELECT component, count(*) AS n_nodes FROM components GROUP BY ALL",
)
register(
    "g15_is_connected",
    lambda s, d: P.is_connected(P.connected_components(all_links(s, d))),
    REACH,
    "SELECT count(DISTINCT component) = 1 AS is_connected FROM components",
)
register(
    "g15_largest_component",
    lambda s, d: P.largest_component(P.connected_components(all_links(s, d))),
    REACH,
    """SELECT node, component FROM components WHERE component =
       (SELECT component FROM components GROUP BY ALL ORDER BY count(*) DESC, component LIMIT 1)""",
)
register(
    "g16_diameter",
    lambda s, d: P.diameter(all_links(s, d)),
    REACH + """
members AS (SELECT node FROM components WHERE component = (SELECT component FROM components GROUP BY ALL ORDER BY count(*) DESC, component LIMIT 1)),
walk AS (
  SELECT node AS source, node, 0 AS level FROM members
  UNION ALL
  SELECT DISTINCT source, dst, level + 1 FROM walk JOIN bi ON src = node WHERE level < 30
),
""",
    "SELECT CAST(max(d) AS BIGINT) AS diameter FROM (SELECT source, node, min(level) AS d FROM walk GROUP BY ALL)",
)


def item_edges(spark, sf):
    """Parts that follow one another in an order."""
    hits = I.order_hits(spark, sf, page=F.concat(F.lit("/item/"), F.col("l_partkey").cast("string")))
    counted = S.count_journeys(S.build_sessions(hits), keys=("PageSequence",))
    pages = counted.withColumn("Page_List", parsing.split_pages(F.col("PageSequence")))
    return network.edge_weights(pages)


ITEM_EDGES_SQL = """
follow AS (
  SELECT '/item/' || l_partkey AS src,
         '/item/' || lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM lineitem
),
edges AS (SELECT src, dst, count(*) AS weight FROM follow WHERE dst IS NOT NULL GROUP BY ALL),
"""
register("g1_item_graph", item_edges, ITEM_EDGES_SQL, "SELECT * FROM edges")
register(
    "g9_item_degrees",
    lambda s, d: G.degrees(item_edges(s, d)),
    ITEM_EDGES_SQL + DEGREES,
    "SELECT * FROM degrees",
)
register(
    "g17_transitivity",
    lambda s, d: G.transitivity(cut_lineage(item_edges(s, d))),
    ITEM_EDGES_SQL
    + """
simple AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
deg AS (SELECT node, count(*) AS k FROM (SELECT a AS node FROM simple UNION ALL SELECT b FROM simple) GROUP BY ALL),
tri AS (SELECT count(*) AS t FROM simple x JOIN simple y ON x.b = y.a JOIN simple z ON z.a = x.a AND z.b = y.b),
tr AS (SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS n FROM deg),
""",
    "SELECT t AS triangles, n AS triples, CAST(t * 3 AS DOUBLE) / n AS transitivity FROM tri, tr",
)


register("g16_item_diameter", lambda s, d: P.diameter(cut_lineage(item_edges(s, d))))

PAIR_COUNTS = """
walk AS (
  SELECT node AS s, node AS t, 0 AS level, CAST(1 AS DOUBLE) AS c FROM (SELECT DISTINCT src AS node FROM bi)
  UNION ALL
  SELECT s, dst AS t, level + 1 AS level, sum(c) AS c FROM walk JOIN bi ON src = t WHERE level < 20 GROUP BY s, dst, level
),
sp AS (SELECT s, t, min(level) AS d, arg_min(c, level) AS sigma FROM walk GROUP BY ALL),
"""
BETWEEN_SQL = (
    B
    + PAIR_COUNTS
    + """
through AS (
  SELECT x.t AS node, sum(x.sigma * y.sigma / z.sigma) AS v FROM sp x JOIN sp y ON x.t = y.s JOIN sp z ON z.s = x.s AND z.t = y.t
  WHERE x.s <> x.t AND y.s <> y.t AND x.s <> y.t AND x.d + y.d = z.d GROUP BY ALL
),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT DISTINCT src FROM bi)),
betweens AS (
  SELECT node, round(coalesce(v, 0) / ((n - 1) * (n - 2)), 6) AS betweenness
  FROM (SELECT DISTINCT src AS node FROM bi) LEFT JOIN through USING (node), n
),
"""
)
register(
    "g18_betweenness",
    lambda s, d: P.betweenness(all_links(s, d)).withColumn("betweenness", F.round("betweenness", 6)),
    BETWEEN_SQL,
    "SELECT node, betweenness FROM betweens",
)
WALKS = """
paths AS (
  SELECT src AS s, dst AS t, [src, dst] AS p, weight AS cost FROM edges WHERE src <> dst
  UNION ALL
  SELECT s, dst, list_append(p, dst), cost + weight FROM paths JOIN edges ON src = t WHERE NOT list_contains(p, dst)
),
best AS (SELECT s, t, p FROM (SELECT *, rank() OVER (PARTITION BY s, t ORDER BY cost) AS r FROM paths) WHERE r = 1),
cnt AS (SELECT s, t, count(*) AS k FROM best GROUP BY ALL),
inner_nodes AS (SELECT s, t, unnest(p[2:-2]) AS node FROM best),
"""
register(
    "g18_weighted_betweenness",
    lambda s, d: P.betweenness(
        cut_lineage(I.journey_edges(s, d)), is_directed=True, weighted=True
    ).withColumn("betweenness", F.round("betweenness", 6)),
    I.JOURNEY_EDGES_SQL + WALKS,
    """SELECT node, round(coalesce(v, 0) / ((n - 1) * (n - 2)), 6) AS betweenness FROM (SELECT src AS node FROM edges UNION SELECT dst FROM edges)
       LEFT JOIN (SELECT node, sum(1.0 / CAST(k AS DOUBLE)) AS v FROM inner_nodes JOIN cnt USING (s, t) GROUP BY ALL) USING (node),
       (SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT src FROM edges UNION SELECT dst FROM edges))""",
)
register(
    "g19_load_centrality",
    lambda s, d: P.load_centrality(all_links(s, d)).withColumn("load", F.round("load", 6)),
    B
    + """
walk AS (
  SELECT node AS s, node AS t, 0 AS level FROM (SELECT DISTINCT src AS node FROM bi)
  UNION ALL
  SELECT DISTINCT s, dst AS t, level + 1 AS level FROM walk JOIN bi ON src = t WHERE level < 20
),
sp AS (SELECT s, t, min(level) AS d FROM walk GROUP BY ALL),
steps AS (SELECT x.s, x.t AS u, y.t AS v FROM sp x JOIN bi ON bi.src = x.t JOIN sp y ON y.s = x.s AND y.t = bi.dst WHERE y.d = x.d + 1),
ways AS (SELECT s, v, CAST(count(*) AS DOUBLE) AS k FROM steps GROUP BY ALL),
back AS (SELECT s, u, v, 1 / k AS share FROM steps JOIN ways USING (s, v) WHERE u <> s),
loads AS (
  SELECT 0 AS turn, s, t AS node, CAST(1 AS DOUBLE) AS x FROM sp WHERE s <> t
  UNION ALL
  SELECT turn + 1 AS turn, b.s, b.u AS node, sum(x * share) AS x FROM loads l JOIN back b ON b.s = l.s AND b.v = l.node GROUP BY turn, b.s, b.u
),
passed AS (SELECT node, sum(x) AS x FROM loads WHERE turn > 0 GROUP BY ALL),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT DISTINCT src FROM bi)),
""",
    """SELECT node, round(coalesce(x, 0) / ((n - 1) * (n - 2)), 6) AS load
       FROM (SELECT DISTINCT src AS node FROM bi) LEFT JOIN passed USING (node), n""",
)
register(
    "g18_item_betweenness",
    lambda s, d: P.betweenness(cut_lineage(item_edges(s, d))).withColumn("betweenness", F.round("betweenness", 6)),
)
register(
    "g19_item_load",
    lambda s, d: P.load_centrality(cut_lineage(item_edges(s, d))).withColumn("load", F.round("load", 6)),
)
register(
    "g20_eigenvector_centrality",
    lambda s, d: P.eigenvector_centrality(
        I.link_edges(s, d), max_iter=300, tolerance=1e-9, steps_per_round=10, must_converge=False
    ).withColumn("eigenvector", F.round("eigenvector", 4)),
    B
    + """
power AS (
  SELECT 0 AS turn, src AS node, CAST(1 AS DOUBLE) AS x FROM (SELECT DISTINCT src FROM bi)
  UNION ALL
  SELECT turn + 1 AS turn, node, sum(x) / 5 AS x FROM (
    SELECT turn, node, x FROM power WHERE turn < 300 UNION ALL SELECT turn, dst, x FROM power JOIN bi ON src = node WHERE turn < 300)
  GROUP BY turn, node
),
""",
    "SELECT node, round(x / (SELECT sqrt(sum(x * x)) FROM power WHERE turn = 300), 4) AS eigenvector FROM power WHERE turn = 300",
)
register("g21_communities", lambda s, d: C.louvain(all_links(s, d)))


def g21_quality(spark, sf):
    edges = cut_lineage(G.undirected(all_links(spark, sf)))
    found = C.louvain(edges)
    value = C.modularity(edges, found)
    return found.agg(F.countDistinct("community").alias("n_communities")).withColumn(
        "modularity", F.lit(round(value, 6))
    )


register("g21_modularity", g21_quality)


def groups(spark, sf):
    parts = P.connected_components(all_links(spark, sf))
    return parts.withColumnRenamed("component", "community")


register(
    "g22_community_members",
    lambda s, d: C.members_of_larger(groups(s, d)).select("node", "community", "n_nodes"),
    REACH,
    """SELECT node, component AS community, n_nodes FROM components
       JOIN (SELECT component, count(*) AS n_nodes FROM components GROUP BY ALL) USING (component) WHERE n_nodes > 2""",
)
register(
    "g22_size_histogram",
    lambda s, d: C.size_histogram(groups(s, d)),
    REACH,
    "SELECT n_nodes, count(*) AS n_communities FROM (SELECT component, count(*) AS n_nodes FROM components GROUP BY ALL) GROUP BY ALL",
)
register(
    "g23_rank_in_communities",
    lambda s, d: C.rank_in_communities(
        groups(s, d), G.degrees(all_links(s, d)).select("node", "degree"), "degree"
    ),
    REACH + DEGREES,
    """SELECT component AS community, node, degree, row_number() OVER (PARTITION BY component ORDER BY degree DESC, node) AS rank
       FROM components JOIN degrees USING (node)""",
)


def g23_joined(spark, sf):
    edges = all_links(spark, sf)
    between = P.betweenness(edges).withColumn("betweenness", F.round("betweenness", 6))
    top = G.top_nodes(between, "betweenness", 10)
    return top.join(G.degrees(edges).select("node", "degree"), "node")


register(
    "g23_betweenness_with_degree",
    g23_joined,
    BETWEEN_SQL + DEGREES,
    """SELECT node, betweenness, degree FROM (SELECT * FROM betweens ORDER BY betweenness DESC, node LIMIT 10)
       JOIN (SELECT node, degree FROM degrees) USING (node)""",
)
register(
    "g24_nodes_with_prefix",
    lambda s, d: G.nodes_with_prefix(G.nodes_of(I.link_edges(s, d)), "/fr", 25),
    E,
    "SELECT * FROM (SELECT src AS node FROM edges UNION SELECT dst FROM edges) WHERE starts_with(node, '/fr') ORDER BY node LIMIT 25",
)
