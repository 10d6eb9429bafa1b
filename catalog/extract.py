"""Sources, sinks and the way from sessions to counted journeys."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare.operators import network, pagetypes, report, taxonomy
from wayfare.operators import sessions as S
from wayfare.plans import stages
from wayfare.schemas import RAW_JOURNEY
from wayfare.session import cut_lineage, scratch_path
from wayfare.sources import journeys as J
from wayfare.sources import sessions as N


def day():
    return F.date_format("date", "yyyy-MM-dd").alias("day")


DAY_SQL = "strftime(date, '%Y-%m-%d') AS day"


def multiset_rows(df, column, *keys):
    return df.select(*keys, F.explode(column).alias("item", "n"))


# --- IO: sources and sinks ---


def io1(spark, sf):
    hits = N.explode_hits(N.read_sessions(spark, I.written_sessions(spark, sf)))
    return hits.select(
        S.session_id().alias("session_id"),
        F.col("hitNumber").cast("bigint").alias("hit"),
        "type",
        "pagePath",
        "deviceCategory",
        "taxons",
    )


register(
    "io1_nested_sessions",
    io1,
    I.HITS_SQL,
    """SELECT fullVisitorId || '-' || visitId || '-' || visitNumber AS session_id, hitNumber AS hit,
       type, pagePath, deviceCategory, taxons FROM hits""",
)


def _hits_per_day(sessions):
    return N.explode_hits(sessions).groupBy(day()).agg(F.count("*").alias("n"))


register(
    "io2_date_range",
    lambda s, d: _hits_per_day(
        N.read_sessions(s, I.written_sessions(s, d), "2024-01-10", "2024-01-15")
    ),
    I.HITS_SQL,
    f"SELECT {DAY_SQL}, count(*) AS n FROM hits WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' GROUP BY ALL",
)
register(
    "io3_date_range_from_flat_hits",
    lambda s, d: N.in_date_range(I.event_hits(s, d), "2024-01-20", None)
    .groupBy(day())
    .agg(F.count("*").alias("n")),
    I.HITS_SQL,
    f"SELECT {DAY_SQL}, count(*) AS n FROM hits WHERE date >= DATE '2024-01-20' GROUP BY ALL",
)

DAILY_KEYS = ("date", *S.JOURNEY_KEYS)
DAILY_SQL = f"""SELECT {DAY_SQL}, Sequence, PageSequence, PageSeq_Length, Actions_Length, count(*) AS Occurrences
   FROM sessions WHERE date NOT IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY ALL"""


def io4(spark, sf):
    nested = N.read_sessions(
        spark, I.written_sessions(spark, sf), exclude=["2024-01-05", "2024-01-06"]
    )
    daily = S.count_journeys(S.sessions_of(S.nested_visits(nested)), keys=DAILY_KEYS)
    path = scratch_path(spark, "daily")
    N.write_daily(daily, path)
    return spark.read.parquet(path).select(day(), *S.JOURNEY_KEYS, "Occurrences")


register("io4_daily_extraction", io4, I.SESSIONS_SQL, DAILY_SQL)


def written_extracts(spark, sf):
    """Daily journeys as gzip text below one folder, devices and dates as lists."""
    daily = S.count_journeys(
        I.event_sessions(spark, sf), keys=DAILY_KEYS, multisets=I.MULTISETS
    )
    rows = daily.select(
        "date",
        "Occurrences",
        J.render_multiset(F.col("DeviceCategories")).alias("DeviceCategories"),
        "PageSeq_Length",
        "Actions_Length",
        J.render_multiset(F.col("Dates")).alias("Dates"),
        "Sequence",
        "PageSequence",
    )
    path = scratch_path(spark, "extracts")
    rows.write.partitionBy("date").option("sep", "\t").option("header", True).option(
        "compression", "gzip"
    ).csv(path)
    return path


def stubbed_extracts(spark, sf):
    """A folder with two writers' extracts, and the part of the names that only those of even days have."""
    rows = spark.read.option("sep", "\t").option("header", True).schema(RAW_JOURNEY).csv(written_extracts(spark, sf))
    rows = cut_lineage(rows.where("Sequence IS NOT NULL"))
    folder = scratch_path(spark, "stubs")
    even = F.dayofmonth(F.to_date(F.substring("Dates", 1, 10))) % 2 == 0
    J.write_extract(rows.where(even), f"{folder}/even")
    J.write_extract(rows.where(~even), f"{folder}/odd")
    return folder, I.file_stub(spark, f"{folder}/even")


def io5(spark, sf):
    folder, stub = stubbed_extracts(spark, sf)
    return J.read_extracts(spark, folder, stub=stub)


register(
    "io5_read_by_stub",
    lambda s, d: io5(s, d)
    .groupBy("Dates")
    .agg(F.sum("Occurrences").alias("n"))
    .select(F.substring("Dates", 1, 10).alias("day"), "n")
    .groupBy("day")
    .agg(F.sum("n").alias("n")),
    I.SESSIONS_SQL,
    f"SELECT {DAY_SQL}, count(*) AS n FROM sessions WHERE Sequence IS NOT NULL AND day(date) % 2 = 0 GROUP BY ALL",
)
register(
    "io6_read_gzip_extract",
    lambda s, d: J.read_extracts(s, written_extracts(s, d)).select(
        "Sequence", "PageSequence", "PageSeq_Length", "Actions_Length", "Occurrences", "DeviceCategories", "Dates"
    ),
    I.SESSIONS_SQL,
    f"""SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length, count(*) AS Occurrences,
       string_agg(deviceCategory, ',' ORDER BY deviceCategory) AS DeviceCategories,
       string_agg(strftime(date, '%Y-%m-%d'), ',') AS Dates
       FROM sessions WHERE Sequence IS NOT NULL GROUP BY date, Sequence, PageSequence, PageSeq_Length, Actions_Length""",
)


def io7(spark, sf):
    path = scratch_path(spark, "merged")
    merged = I.event_journeys(spark, sf, I.MULTISETS).withColumns(
        {name: J.render_multiset(F.col(name)) for name in I.MULTISETS}
    )
    J.write_extract(merged, path)
    return J.read_extracts(spark, path, schema=merged.schema)


register(
    "io7_write_merged",
    io7,
    I.JOURNEYS_SQL,
    """SELECT Sequence, Occurrences, PageSequence, PageSeq_Length, Actions_Length,
       (SELECT string_agg(deviceCategory, ',' ORDER BY deviceCategory) FROM sessions s WHERE s.Sequence = j.Sequence) AS DeviceCategories,
       (SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM sessions s WHERE s.Sequence = j.Sequence) AS Dates
       FROM journeys j""",
)


def _written(spark, df, name):
    path = scratch_path(spark, name)
    J.write_table(df, path)
    return path


def io8(spark, sf):
    processed = I.with_totals(spark, sf, I.MULTISETS)
    back = J.read_columns(
        spark,
        _written(spark, processed, "processed"),
        ["Sequence", "Page_Seq_NL", "Page_Seq_Occurrences", "Occurrences_NL", "num_event_cats", "absent"],
    )
    return back.withColumn("Page_Seq_Occurrences", F.coalesce("Page_Seq_Occurrences", F.lit(-1)))


register(
    "io8_process_and_write",
    io8,
    I.PARSED_SQL,
    """SELECT Sequence, seq_nl AS Page_Seq_NL, coalesce(seq_occ, -1) AS Page_Seq_Occurrences, nl_occ AS Occurrences_NL,
       len(list_distinct(list_transform(el, lambda e: e.category))) AS num_event_cats FROM parsed""",
)


def io9(spark, sf):
    thin = stages.add_thin_columns(I.event_journeys(spark, sf)).select(
        "Sequence", *stages.THIN_COLUMNS
    )
    back = spark.read.parquet(_written(spark, thin, "thin"))
    return back.select(
        "Sequence",
        F.size("Page_Event_List").cast("bigint").alias("n_hits"),
        F.array_join("Page_List", ">>").alias("pages"),
        "Page_Seq_NL",
        F.size("Page_List_NL").cast("bigint").alias("n_pages_nl"),
    )


register(
    "io9_thin_columns",
    io9,
    I.PARSED_SQL,
    """SELECT Sequence, len(pel) AS n_hits, array_to_string(pl, '>>') AS pages, seq_nl AS Page_Seq_NL,
       len(pnl) AS n_pages_nl FROM parsed""",
)
register(
    "io10_read_wanted_columns",
    lambda s, d: J.read_columns(
        s, _written(s, I.event_journeys(s, d), "journeys"), ["Occurrences", "Sequence", "Taxon_Page_List"]
    ),
    I.JOURNEYS_SQL,
    "SELECT Occurrences, Sequence FROM journeys",
)


def _network(spark, sf, with_taxons=False):
    from wayfare.session import cut_lineage

    journeys = cut_lineage(I.parsed(spark, sf))
    edges = cut_lineage(network.edge_weights(journeys))
    nodes = network.number_nodes(network.endpoints(edges))
    if with_taxons:
        nodes = nodes.join(network.node_taxons(journeys), "Node", "left")
    return cut_lineage(nodes), edges


NODES_SQL = """
nodes AS (
  SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id
  FROM (SELECT src AS node FROM edges UNION SELECT dst FROM edges)
),
"""
NODE_TAXONS_SQL = """
node_taxons AS (
  SELECT node, taxons FROM (
    SELECT ph[i].page AS node, ph[i].taxons AS taxons, row_number() OVER (PARTITION BY ph[i].page ORDER BY Sequence, i) AS r
    FROM (SELECT Sequence, ph, unnest(range(1, len(ph) + 1)) AS i FROM parsed)) WHERE r = 1
),
"""


def io11(spark, sf):
    nodes, edges = _network(spark, sf)
    return spark.read.parquet(_written(spark, network.attach_ends(edges, nodes), "edges"))


register(
    "io11_write_edges",
    io11,
    I.JOURNEY_EDGES_SQL + NODES_SQL,
    """SELECT src AS Source_node, a.node_id AS Source_id, dst AS Destination_node, b.node_id AS Destination_id, weight AS Weight
       FROM edges JOIN nodes a ON a.node = src JOIN nodes b ON b.node = dst""",
)


def io12(spark, sf):
    nodes, _ = _network(spark, sf, with_taxons=True)
    back = spark.read.parquet(_written(spark, nodes, "nodes"))
    return back.select("Node", "Node_id", F.array_join("Node_Taxon", ",").alias("Node_Taxon"))


register(
    "io12_write_nodes",
    io12,
    I.JOURNEY_EDGES_SQL + NODES_SQL + NODE_TAXONS_SQL,
    "SELECT n.node AS Node, node_id AS Node_id, taxons AS Node_Taxon FROM nodes n LEFT JOIN node_taxons USING (node)",
)


def io13(spark, sf):
    path = scratch_path(spark, "taxons")
    I.taxonomy(spark, sf).write.option("compression", "gzip").json(path)
    return J.read_taxonomy(spark, path)


register("io13_read_taxonomy_json", io13, I.TAXONOMY_SQL, "SELECT * FROM taxonomy")


def io14(spark, sf):
    table = spark.read.parquet(
        _written(spark, taxonomy.taxon_table(I.taxonomy(spark, sf)), "taxon_table")
    )
    return table.select("content_id", "title", "level", "level1_parent")


register(
    "io14_write_taxon_table",
    io14,
    I.ANCESTORS_SQL,
    """SELECT t.content_id, t.title, CAST((SELECT count(*) FROM anc a WHERE a.content_id = t.content_id) + 1 AS INTEGER) AS level,
       coalesce((SELECT a.title FROM anc a WHERE a.content_id = t.content_id AND a.level = 1), t.title) AS level1_parent
       FROM taxonomy t""",
)


def io15_lengths(spark, sf):
    """The description of lengths as a delimited file, written and read back."""
    path = scratch_path(spark, "lengths")
    found = report.describe_lengths(report.prepare(I.event_journeys(spark, sf, I.MULTISETS)))
    J.write_extract(found, path, sep=",")
    return spark.read.option("header", True).schema(found.schema).csv(path)


def io15(spark, sf):
    path = scratch_path(spark, "report")
    prepared = report.prepare(I.event_journeys(spark, sf, I.MULTISETS))
    J.write_extract(report.device_report(prepared), path, sep=",")
    return spark.read.option("header", True).schema(
        "Segment string, Volume bigint, Percentage double, Shape bigint"
    ).csv(path)



register(
    "io16_write_journeys_naming_taxon",
    lambda s, d: s.read.parquet(
        _written(s, taxonomy.mentioning_taxon(I.event_journeys(s, d), "t6"), "taxon_journeys")
    ).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    "SELECT Sequence, Occurrences FROM journeys WHERE contains(Sequence, 't6')",
)


def io17(spark, sf):
    path = scratch_path(spark, "adjacency")
    I.adjacency(spark, sf).write.option("header", True).csv(path)
    return J.read_adjacency(spark, path)


register("io17_read_adjacency_csv", io17, I.ADJACENCY_SQL, "SELECT * FROM adjacency")

# --- X: sessions and journeys ---

register(
    "x1_unnest_hits",
    lambda s, d: N.explode_hits(I.nested_sessions(s, d)).select(
        "fullVisitorId", "visitId", F.col("hitNumber").cast("bigint").alias("hit"), "pagePath"
    ),
    I.HITS_SQL,
    "SELECT fullVisitorId, visitId, hitNumber AS hit, pagePath FROM hits",
)
register(
    "x2_hit_dimensions",
    lambda s, d: N.explode_hits(I.nested_sessions(s, d)).select(
        "fullVisitorId", "visitId", F.col("hitNumber").cast("bigint").alias("hit"), "taxons", "contentId", "documentType"
    ),
    I.HITS_SQL,
    "SELECT fullVisitorId, visitId, hitNumber AS hit, taxons, contentId, documentType FROM hits",
)
register(
    "x3_session_dimension",
    lambda s, d: I.nested_sessions(s, d).select(
        "fullVisitorId", "visitId", N.ab_variant_dimension(F.col("customDimensions")).alias("variant")
    ),
    I.HITS_SQL,
    "SELECT DISTINCT fullVisitorId, visitId, abVariant AS variant FROM hits",
)
register(
    "x4_session_id",
    lambda s, d: I.event_sessions(s, d).select("sessionId", "Actions_Length"),
    I.SESSIONS_SQL,
    "SELECT sessionId, Actions_Length FROM sessions",
)
register(
    "x5_session_id_with_start",
    lambda s, d: I.event_sessions(s, d, head=("visitNumber", "visitStartTime")).select(
        S.session_id(with_start_time=True).alias("sessionId"), "PageSeq_Length"
    ),
    I.SESSIONS_SQL,
    """SELECT sessionId || '-' || strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS sessionId, PageSeq_Length FROM sessions""",
)
for number, style in (("x6", "event"), ("x7", "taxon"), ("x8", "no_type"), ("x9", "legacy")):
    register(
        f"{number}_{style}_sequence",
        lambda s, d, style=style: I.event_sessions(s, d, style).select("sessionId", "Sequence"),
        I.sessions_sql(style),
        "SELECT sessionId, Sequence FROM sessions",
    )


def x10(spark, sf):
    rows = S.sessions_of(S.nested_visits(I.nested_sessions(spark, sf)))
    return rows.select("sessionId", "Sequence", "PageSequence", "Actions_Length", "PageSeq_Length", "EventYes")


register(
    "x10_sequence_from_nested",
    x10,
    I.SESSIONS_SQL,
    "SELECT sessionId, Sequence, PageSequence, Actions_Length, PageSeq_Length, EventYes FROM sessions",
)
for style in ("event", "no_type", "legacy"):
    register(
        f"x10_{style}_from_nested",
        lambda s, d, style=style: S.sessions_of(S.nested_visits(I.nested_sessions(s, d), style)).select("sessionId", "Sequence"),
        I.sessions_sql(style),
        "SELECT sessionId, Sequence FROM sessions",
    )


def x10_giants(spark, sf):
    """Orders of at least five lines take the way of visits with too many hits for one task."""
    hits = cut_lineage(I.order_hits(spark, sf))
    giants = hits.groupBy("fullVisitorId", "visitId").count().where("count >= 5")
    return S.sessions_of(S.visits(hits, giants=giants)).select("visitId", "PageSequence", "PageSeq_Length")


ORDER_SEQUENCES_SQL = """SELECT visitId, string_agg(pagePath, '>>' ORDER BY l_linenumber, l_partkey, l_suppkey) AS PageSequence,
       count(*) AS PageSeq_Length FROM hits GROUP BY ALL"""
register("x10_giant_visits", x10_giants, I.ORDER_HITS_SQL, ORDER_SEQUENCES_SQL)
register(
    "x10_order_sequences",
    lambda s, d: S.build_sessions(I.order_hits(s, d)).select("visitId", "PageSequence", "PageSeq_Length"),
    I.ORDER_HITS_SQL,
    ORDER_SEQUENCES_SQL,
)
for name, column in (
    ("x11_page_sequence", "PageSequence"),
    ("x12_actions_length", "Actions_Length"),
    ("x13_page_length", "PageSeq_Length"),
    ("x14_event_yes", "EventYes"),
):
    register(
        name,
        lambda s, d, column=column: I.event_sessions(s, d).select("sessionId", column),
        I.SESSIONS_SQL,
        f"SELECT sessionId, {column} FROM sessions",
    )
register(
    "x15_sessions",
    lambda s, d: I.event_sessions(s, d, head=I.FULL_HEAD).select(
        "sessionId", day(), "deviceCategory", "trafficSource", "trafficMedium", "abVariant", "Sequence"
    ),
    I.SESSIONS_SQL,
    f"SELECT sessionId, {DAY_SQL}, deviceCategory, trafficSource, trafficMedium, abVariant, Sequence FROM sessions",
)
COUNT_SQL = "SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length, count(*) AS Occurrences FROM sessions"
register(
    "x16_longer_than_one_page",
    lambda s, d: S.count_journeys(S.longer_than_one_page(I.event_sessions(s, d))),
    I.SESSIONS_SQL,
    COUNT_SQL + " WHERE PageSeq_Length > 1 GROUP BY ALL",
)
AB_WHERE = "WHERE starts_with(abVariant, 'Test:') AND deviceCategory <> 'tablet'"
AB_HEAD = ("visitNumber", "deviceCategory", "abVariant")
register(
    "x17_ab_filter",
    lambda s, d: S.ab_sessions(I.event_sessions(s, d, head=AB_HEAD), "Test").select(
        "sessionId", F.col("deviceCategory")
    ),
    I.SESSIONS_SQL,
    f"SELECT sessionId, deviceCategory FROM sessions {AB_WHERE}",
)
register(
    "x18_strip_prefix",
    lambda s, d: S.ab_sessions(I.event_sessions(s, d, head=AB_HEAD), "Test").select("sessionId", "ABVariant"),
    I.SESSIONS_SQL,
    f"SELECT sessionId, replace(abVariant, 'Test:', '') AS ABVariant FROM sessions {AB_WHERE}",
)
register(
    "x19_journey_counts",
    lambda s, d: S.count_journeys(I.event_sessions(s, d)),
    I.SESSIONS_SQL,
    COUNT_SQL + " GROUP BY ALL",
)
register(
    "x19_order_journey_counts",
    lambda s, d: S.count_journeys(
        S.build_sessions(I.order_hits(s, d)), keys=("PageSequence", "PageSeq_Length")
    ),
    I.ORDER_HITS_SQL,
    """SELECT PageSequence, PageSeq_Length, count(*) AS Occurrences FROM (
       SELECT visitId, string_agg(pagePath, '>>' ORDER BY l_linenumber, l_partkey, l_suppkey) AS PageSequence,
       count(*) AS PageSeq_Length FROM hits GROUP BY ALL) GROUP BY ALL""",
)
register(
    "x20_variant_counts",
    lambda s, d: S.count_journeys(
        S.ab_sessions(I.event_sessions(s, d, head=AB_HEAD), "Test"), keys=("Sequence", "ABVariant")
    ),
    I.SESSIONS_SQL,
    f"SELECT Sequence, replace(abVariant, 'Test:', '') AS ABVariant, count(*) AS Occurrences FROM sessions {AB_WHERE} GROUP BY ALL",
)


def x21(column):
    def build(spark, sf):
        counted = S.count_journeys(I.event_sessions(spark, sf), multisets=I.MULTISETS)
        return multiset_rows(counted, column, *S.JOURNEY_KEYS)

    return build


JOURNEY_COLUMNS = "Sequence, PageSequence, PageSeq_Length, Actions_Length"
register(
    "x21_device_multiset",
    x21("DeviceCategories"),
    I.SESSIONS_SQL,
    f"SELECT {JOURNEY_COLUMNS}, deviceCategory AS item, count(*) AS n FROM sessions GROUP BY ALL",
)
register(
    "x21_date_multiset",
    x21("Dates"),
    I.SESSIONS_SQL,
    f"SELECT {JOURNEY_COLUMNS}, strftime(date, '%Y-%m-%d') AS item, count(*) AS n FROM sessions GROUP BY ALL",
)
register(
    "x22_device_columns",
    lambda s, d: S.device_counts(S.longer_than_one_page(I.event_sessions(s, d))),
    I.SESSIONS_SQL,
    f"""SELECT {JOURNEY_COLUMNS}, count(*) AS Occurrences, count(*) FILTER (deviceCategory = 'mobile') AS MobileCount,
       count(*) FILTER (deviceCategory = 'desktop') AS DesktopCount FROM sessions WHERE PageSeq_Length > 1 GROUP BY ALL""",
)
TRAFFIC_HEAD = ("visitNumber", "trafficSource", "trafficMedium", "date")
register(
    "x23_traffic_keys",
    lambda s, d: S.count_journeys(
        I.event_sessions(s, d, "legacy", TRAFFIC_HEAD),
        keys=("Sequence", "PageSeq_Length", "Actions_Length", "trafficSource", "trafficMedium", "date"),
    ).select("Sequence", "PageSeq_Length", "Actions_Length", "trafficSource", "trafficMedium", day(), "Occurrences"),
    I.sessions_sql("legacy"),
    f"""SELECT Sequence, PageSeq_Length, Actions_Length, trafficSource, trafficMedium, {DAY_SQL}, count(*) AS Occurrences
        FROM sessions GROUP BY ALL""",
)


def x24(column):
    def build(spark, sf):
        keys = ("Sequence", "PageSeq_Length", "Actions_Length", "date")
        rows = S.longer_than_one_page(I.event_sessions(spark, sf, "legacy", TRAFFIC_HEAD))
        counted = S.count_journeys(
            rows,
            keys=keys,
            multisets={"TrafficSources": "trafficSource", "TrafficMediums": "trafficMedium"},
        )
        return multiset_rows(counted, column, "Sequence", "PageSeq_Length", "Actions_Length", day())

    return build


for name, column, field in (
    ("x24_source_multiset", "TrafficSources", "trafficSource"),
    ("x24_medium_multiset", "TrafficMediums", "trafficMedium"),
):
    register(
        name,
        x24(column),
        I.sessions_sql("legacy"),
        f"""SELECT Sequence, PageSeq_Length, Actions_Length, {DAY_SQL}, {field} AS item, count(*) AS n
            FROM sessions WHERE PageSeq_Length > 1 GROUP BY ALL""",
    )

CONTENT_WHERE = """WHERE contentId IS NOT NULL AND contentId NOT IN ('00000000-0000-0000-0000-000000000000', '[object Object]')"""
FINDING = ", ".join(f"'{name}'" for name in pagetypes.C.FINDING_DOCUMENT_TYPES)
register(
    "x25_page_types",
    lambda s, d: pagetypes.page_types(I.event_hits(s, d)),
    I.HITS_SQL,
    f"SELECT pagePath, max(CASE WHEN documentType IN ({FINDING}) THEN 1 ELSE 0 END) AS is_finding FROM hits {CONTENT_WHERE} GROUP BY ALL",
)
register(
    "x26_content_page_types",
    lambda s, d: pagetypes.content_page_types(I.event_hits(s, d)),
    I.HITS_SQL,
    f"""SELECT DISTINCT contentId, pagePath, CASE WHEN documentType IN ({FINDING}) THEN 'finding' ELSE 'thing' END AS finding_or_thing
        FROM hits {CONTENT_WHERE}""",
)

