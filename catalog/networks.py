"""Page networks and the taxonomy."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.extract import NODE_TAXONS_SQL, NODES_SQL, _network
from catalog.registry import register
from wayfare.operators import network as N
from wayfare.operators import taxonomy as T
from wayfare.session import cut_lineage, scratch_path
from wayfare.sources import journeys as J


def n1(spark, sf):
    journeys = N.discard_totals(I.with_totals(spark, sf))
    return N.edge_weights(journeys)


register("n1_recomputed_totals", n1, I.JOURNEY_EDGES_SQL, "SELECT src, dst, weight FROM edges")
register(
    "n2_drop_one_off_share",
    lambda s, d: N.drop_one_off_share(I.event_journeys(s, d), 30).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    """SELECT Sequence, Occurrences FROM journeys
       WHERE NOT (Occurrences = 1 AND CAST('0x' || substr(md5('1234:' || Sequence), 1, 8) AS BIGINT) % 100 < 30)""",
)
SEARCH_SQL = r"list_filter(pl, lambda p: NOT (regexp_matches(p, '^/search[/?|]') OR p = '/search'))"
register(
    "n3_without_search_pages",
    lambda s, d: N.without_search_pages(I.parsed(s, d)).select(
        "Sequence", F.array_join("Page_List", "|").alias("pages")
    ),
    I.PARSED_SQL,
    f"SELECT Sequence, array_to_string({SEARCH_SQL}, '|') AS pages FROM parsed",
)
register(
    "n4_sequence_occurrences",
    lambda s, d: N.per_sequence(I.parsed(s, d), delooped=True).select("sequence", "Occurrences"),
    I.PARSED_SQL,
    "SELECT seq_nl AS sequence, CAST(sum(Occurrences) AS BIGINT) AS Occurrences FROM parsed GROUP BY ALL",
)
register(
    "n5_row_per_sequence",
    lambda s, d: N.per_sequence(I.parsed(s, d)).select(
        "sequence", "Occurrences", F.array_join("pages", "|").alias("pages")
    ),
    I.PARSED_SQL,
    """SELECT PageSequence AS sequence, CAST(sum(Occurrences) AS BIGINT) AS Occurrences,
       array_to_string(min(pl), '|') AS pages FROM parsed GROUP BY ALL""",
)
register(
    "n6_subpaths",
    lambda s, d: N.with_subpaths(I.parsed(s, d))
    .select("Sequence", F.inline("Subpaths"))
    .groupBy("Sequence", "src", "dst")
    .agg(F.count("*").alias("n")),
    I.PARSED_SQL,
    """SELECT Sequence, pl[i] AS src, pl[i + 1] AS dst, count(*) AS n
       FROM (SELECT Sequence, pl, unnest(range(1, len(pl))) AS i FROM parsed) GROUP BY ALL""",
)
EDGE_SQL = "SELECT src, dst, weight FROM edges"
register("n7_edge_weights", lambda s, d: I.journey_edges(s, d), I.JOURNEY_EDGES_SQL, EDGE_SQL)


def order_edges(spark, sf):
    from wayfare.functions import parsing
    from wayfare.operators import sessions as S

    counted = S.count_journeys(S.build_sessions(I.order_hits(spark, sf)), keys=("PageSequence",))
    return N.edge_weights(
        counted.withColumn("Page_List", parsing.split_pages(F.col("PageSequence")))
    )


register(
    "n7_order_edge_weights",
    order_edges,
    I.ORDER_HITS_SQL,
    """SELECT src, dst, count(*) AS weight FROM (
         SELECT pagePath AS src, lead(pagePath) OVER (PARTITION BY visitId ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM hits)
       WHERE dst IS NOT NULL GROUP BY ALL""",
)
DELOOPED_SQL = I.JOURNEY_EDGES_SQL.replace(
    "SELECT PageSequence AS sequence, CAST(sum(Occurrences) AS BIGINT) AS occ, min(pl)",
    "SELECT seq_nl AS sequence, CAST(sum(Occurrences) AS BIGINT) AS occ, min(pnl)",
)
register("n8_delooped_edges", lambda s, d: I.journey_edges(s, d, True), DELOOPED_SQL, EDGE_SQL)
register(
    "n8_edges_without_search",
    lambda s, d: N.edge_weights(N.without_search_pages(I.parsed(s, d))),
    I.JOURNEY_EDGES_SQL.replace("min(pl)", f"min({SEARCH_SQL})"),
    EDGE_SQL,
)
register(
    "n9_node_ids",
    lambda s, d: _network(s, d)[0],
    I.JOURNEY_EDGES_SQL + NODES_SQL,
    "SELECT node AS Node, node_id AS Node_id FROM nodes",
)
register(
    "n10_node_taxons",
    lambda s, d: N.node_taxons(I.parsed(s, d)).select(
        "Node", F.array_join("Node_Taxon", ",").alias("taxons")
    ),
    I.PARSED_SQL + NODE_TAXONS_SQL,
    "SELECT node AS Node, taxons FROM node_taxons",
)


def n11(spark, sf):
    nodes, edges = _network(spark, sf, with_taxons=True)
    return N.attach_ends(edges, nodes, with_taxons=True).withColumns(
        {
            "Source_Taxon": F.array_join("Source_Taxon", ","),
            "Destination_Taxon": F.array_join("Destination_Taxon", ","),
        }
    )


register(
    "n11_attach_ends",
    n11,
    I.JOURNEY_EDGES_SQL + NODES_SQL + NODE_TAXONS_SQL,
    """SELECT src AS Source_node, a.node_id AS Source_id, dst AS Destination_node, b.node_id AS Destination_id, weight AS Weight,
       s.taxons AS Source_Taxon, t.taxons AS Destination_Taxon
       FROM edges JOIN nodes a ON a.node = src JOIN nodes b ON b.node = dst
       LEFT JOIN node_taxons s ON s.node = src LEFT JOIN node_taxons t ON t.node = dst""",
)


def n12(spark, sf):
    nodes, edges = _network(spark, sf)
    return N.network_totals(edges, nodes)


register(
    "n12_network_totals",
    n12,
    I.JOURNEY_EDGES_SQL + NODES_SQL,
    "SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges",
)
register(
    "n13_node_taxon_set",
    lambda s, d: T.node_taxon_set(N.node_taxons(I.parsed(s, d))),
    I.PARSED_SQL + NODE_TAXONS_SQL,
    "SELECT DISTINCT unnest(string_split(taxons, ',')) AS content_id FROM node_taxons",
)
register(
    "n14_ancestors",
    lambda s, d: T.ancestors(I.taxonomy(s, d)),
    I.ANCESTORS_SQL,
    "SELECT * FROM anc",
)


def n15(spark, sf):
    wanted = cut_lineage(T.node_taxon_set(N.node_taxons(I.parsed(spark, sf))))
    return T.taxon_table(I.taxonomy(spark, sf), wanted).select(
        "content_id",
        "title",
        "base_path",
        "level",
        "level1_parent",
        F.array_join(F.transform("parents", lambda p: p["content_id"]), ">").alias("parents"),
    )


TAXON_TABLE_SQL = """
taxon_table AS (
  SELECT t.content_id, t.title, t.base_path, CAST((SELECT count(*) FROM anc a WHERE a.content_id = t.content_id) + 1 AS INTEGER) AS level,
    coalesce((SELECT a.title FROM anc a WHERE a.content_id = t.content_id AND a.level = 1), t.title) AS level1_parent,
    coalesce((SELECT string_agg(a.ancestor_id, '>' ORDER BY a.level) FROM anc a WHERE a.content_id = t.content_id), '') AS parents
  FROM taxonomy t WHERE content_id IN (SELECT DISTINCT unnest(string_split(taxons, ',')) FROM node_taxons)
),
"""
register(
    "n15_taxon_table",
    n15,
    I.ANCESTORS_SQL + I.PARSED_SQL + NODE_TAXONS_SQL + TAXON_TABLE_SQL,
    "SELECT * FROM taxon_table",
)
register(
    "n15_whole_taxon_table",
    lambda s, d: T.taxon_table(I.taxonomy(s, d)).select(
        "content_id", "level", "level1_parent"
    ),
    I.ANCESTORS_SQL,
    """SELECT t.content_id, CAST(coalesce(c.n, 0) + 1 AS INTEGER) AS level, coalesce(r.title, t.title) AS level1_parent FROM taxonomy t
       LEFT JOIN (SELECT content_id, count(*) AS n FROM anc GROUP BY ALL) c USING (content_id)
       LEFT JOIN (SELECT content_id, title FROM anc WHERE level = 1) r USING (content_id)""",
)


def n16(spark, sf):
    nodes = N.node_taxons(I.parsed(spark, sf)).withColumn(
        "Node_Taxon", F.concat("Node_Taxon", F.array(F.lit("unknown")))
    )
    known = I.taxonomy(spark, sf)
    return T.translate_nodes(cut_lineage(nodes), known).select(
        "Node", F.array_join("Node_Taxon_basepath", ";").alias("paths")
    )


register(
    "n16_translate_nodes",
    n16,
    I.TAXONOMY_SQL + I.PARSED_SQL + NODE_TAXONS_SQL,
    """SELECT node AS Node, coalesce((SELECT string_agg(base_path, ';' ORDER BY i) FROM (
         SELECT unnest(string_split(taxons, ',')) AS content_id, unnest(range(len(string_split(taxons, ',')))) AS i)
         JOIN taxonomy USING (content_id)), '') AS paths FROM node_taxons""",
)
def io14_nodes(spark, sf):
    """The node table with the paths of its taxons, written and read back."""
    nodes = cut_lineage(N.node_taxons(I.parsed(spark, sf)))
    path = scratch_path(spark, "augmented_nodes")
    J.write_table(T.translate_nodes(nodes, I.taxonomy(spark, sf)), path)
    return spark.read.parquet(path).select(
        "Node", F.array_join("Node_Taxon", ",").alias("taxons"), F.array_join("Node_Taxon_basepath", ";").alias("paths")
    )


register(
    "io14_write_augmented_nodes",
    io14_nodes,
    I.TAXONOMY_SQL + I.PARSED_SQL + NODE_TAXONS_SQL,
    """SELECT node AS Node, taxons, coalesce((SELECT string_agg(base_path, ';' ORDER BY i) FROM (
         SELECT unnest(string_split(taxons, ',')) AS content_id, unnest(range(len(string_split(taxons, ',')))) AS i)
         JOIN taxonomy USING (content_id)), '') AS paths FROM node_taxons""",
)
register(
    "n17_journeys_with_taxon",
    lambda s, d: T.journeys_with_taxon(I.parsed(s, d), "t6").select("Sequence", "Occurrences"),
    I.PARSED_SQL,
    """SELECT Sequence, Occurrences FROM parsed
       WHERE list_contains(flatten(list_transform(tl, lambda t: string_split(t, ','))), 't6')""",
)
register(
    "n18_taxon_counts",
    lambda s, d: T.taxon_counts(I.parsed(s, d)).select(
        "Sequence", "taxon_nested_all", "taxon_nested_unique", "taxon_flat_all", "taxon_flat_unique"
    ),
    I.PARSED_SQL,
    """SELECT Sequence, len(tl) AS taxon_nested_all, len(list_distinct(tl)) AS taxon_nested_unique,
       len(flatten(list_transform(tl, lambda t: string_split(t, ',')))) AS taxon_flat_all,
       len(list_distinct(flatten(list_transform(tl, lambda t: string_split(t, ','))))) AS taxon_flat_unique FROM parsed""",
)
FREQUENCY_SQL = """
frequency AS (
  SELECT content_id, count(*) AS n FROM (
    SELECT unnest(flatten(list_transform(tl, lambda t: string_split(t, ',')))) AS content_id FROM parsed) GROUP BY ALL
),
"""
register(
    "n19_taxon_frequency",
    lambda s, d: T.taxon_frequency(I.parsed(s, d)).orderBy(F.desc("n"), "content_id").limit(10),
    I.PARSED_SQL + FREQUENCY_SQL,
    "SELECT content_id, n FROM frequency ORDER BY n DESC, content_id LIMIT 10",
)
register(
    "n20_taxon_coverage",
    lambda s, d: T.taxon_coverage(T.taxon_frequency(I.parsed(s, d)), I.taxonomy(s, d)),
    I.PARSED_SQL + FREQUENCY_SQL + I.TAXONOMY_SQL,
    """SELECT count(f.content_id) AS found, count(*) AS taxons, count(f.content_id) * 100.0 / CAST(count(*) AS DOUBLE) AS percent
       FROM taxonomy LEFT JOIN frequency f USING (content_id)""",
)
register(
    "n21_parent_frequency",
    lambda s, d: T.parent_frequency(T.taxon_frequency(I.parsed(s, d)), I.taxonomy(s, d)),
    I.PARSED_SQL + FREQUENCY_SQL + I.TAXONOMY_SQL,
    """SELECT coalesce(p.title, t.title) AS parent, CAST(sum(n) AS BIGINT) AS n FROM frequency JOIN taxonomy t USING (content_id)
       LEFT JOIN taxonomy p ON p.content_id = t.parent_content_id GROUP BY ALL""",
)


def known_taxonomy(spark, sf):
    return I.taxonomy(spark, sf)


def n22(spark, sf):
    edges = T.titled_edges(I.parsed(spark, sf), known_taxonomy(spark, sf))
    return edges.select(
        "src",
        T.page_label(F.col("src_titles")).alias("src_label"),
        "dst",
        T.page_label(F.col("dst_titles")).alias("dst_label"),
        "weight",
    ).groupBy("src", "src_label", "dst", "dst_label").agg(F.sum("weight").alias("weight"))


LABELS_SQL = """
labels2 AS (
  SELECT taxons, string_agg(coalesce(title, 'None'), '_' ORDER BY i) AS label FROM (
    SELECT taxons, unnest(string_split(taxons, ',')) AS content_id, unnest(range(len(string_split(taxons, ',')))) AS i
    FROM (SELECT DISTINCT unnest(tl) AS taxons FROM parsed))
  LEFT JOIN taxonomy USING (content_id) GROUP BY ALL
),
"""
register(
    "n22_titled_edges",
    n22,
    I.PARSED_SQL + I.TAXONOMY_SQL + LABELS_SQL,
    """SELECT src, a.label AS src_label, dst, b.label AS dst_label, CAST(sum(Occurrences) AS BIGINT) AS weight FROM (
         SELECT Occurrences, ph[i].page AS src, ph[i].taxons AS st, ph[i + 1].page AS dst, ph[i + 1].taxons AS dt
         FROM (SELECT Occurrences, ph, unnest(range(1, len(ph))) AS i FROM parsed))
       JOIN labels2 a ON a.taxons = st JOIN labels2 b ON b.taxons = dt GROUP BY ALL""",
)
register(
    "n23_frequent_edges",
    lambda s, d: N.frequent_edges(order_edges(s, d), 1000),
    I.ORDER_HITS_SQL,
    """SELECT src, dst, count(*) AS weight FROM (
         SELECT pagePath AS src, lead(pagePath) OVER (PARTITION BY visitId ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM hits)
       WHERE dst IS NOT NULL AND src <> dst GROUP BY ALL HAVING count(*) >= 1000""",
)
register(
    "n23_adjacency_lists",
    lambda s, d: N.adjacency_blocks(N.frequent_edges(cut_lineage(I.journey_edges(s, d)), 20), longest=3).select(
        "src", "part", F.array_join("pages", "|").alias("pages")
    ),
    I.JOURNEY_EDGES_SQL,
    """SELECT src, part, string_agg(dst, '|' ORDER BY dst) AS pages FROM (
         SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 3 AS part FROM edges WHERE weight >= 20 AND src <> dst)
       GROUP BY ALL""",
)
ADJ_NODES_SQL = I.ADJACENCY_SQL + """
adj_nodes AS (
  SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id
  FROM (SELECT source_base_path AS node FROM adjacency UNION SELECT sink_base_path FROM adjacency)
),
"""
register(
    "n24_adjacency_nodes",
    lambda s, d: N.adjacency_nodes(I.adjacency(s, d)),
    ADJ_NODES_SQL,
    "SELECT node AS Node, node_id AS Node_id FROM adj_nodes",
)


def n25(spark, sf):
    links = cut_lineage(I.adjacency(spark, sf))
    return N.attach_node_ids(links, N.adjacency_nodes(links))


register(
    "n25_attach_node_ids",
    n25,
    ADJ_NODES_SQL,
    """SELECT source_base_path, sink_base_path, link_type, a.node_id AS source_id, b.node_id AS sink_id FROM adjacency
       JOIN adj_nodes a ON a.node = source_base_path JOIN adj_nodes b ON b.node = sink_base_path""",
)


def n26(spark, sf):
    nodes = N.node_taxons(I.parsed(spark, sf))
    titles = T.taxon_titles(nodes.select("Node_Taxon"), known_taxonomy(spark, sf), "Node_Taxon")
    return nodes.join(titles, "Node_Taxon", "left").select(
        "Node", T.page_label(F.col("titles")).alias("label")
    )


register(
    "n26_page_labels",
    n26,
    I.PARSED_SQL + I.TAXONOMY_SQL + NODE_TAXONS_SQL + LABELS_SQL,
    "SELECT node AS Node, label FROM node_taxons JOIN labels2 USING (taxons)",
)
