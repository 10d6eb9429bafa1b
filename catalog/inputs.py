"""Hits, sessions and journeys derived from the given tables, as Spark and as SQL.

Each ``*_SQL`` text states for DuckDB what the builder of the same name computes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.operators import network, sessions
from wayfare.plans import stages
from wayfare.session import cut_lineage, scratch_path
from wayfare.sources.sessions import write_daily


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat hits: a visit is one user on one day, its chunks are six hours."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events").withColumn("k", k).withColumn("date", F.to_date("ts"))
    day = F.date_format("date", "yyyyMMdd").cast("bigint")
    kind = F.col("event_type")
    signup_action = F.concat(
        F.lit("1."),
        (F.col("k") % 4).cast("string"),
        F.when(F.col("k") % 2 == 0, " Related content").otherwise(" Explore the topic"),
    )
    error = kind == "error"
    feedback = error & (F.col("k") % 10 == 0)
    page = F.when(
        F.col("k") % 8 == 0, F.concat(F.lit("/search?q="), (F.col("k") % 3).cast("string"))
    ).otherwise(F.concat(F.lit("/p"), (F.col("k") % 5).cast("string")))
    user = F.col("user_id")
    return e.select(
        user.cast("string").alias("fullVisitorId"),
        day.alias("visitId"),
        day.alias("visitNumber"),
        (F.unix_date("date").cast("bigint") * 86400).alias("visitStartTime"),
        "date",
        F.when(user % 5 < 2, "desktop")
        .when(user % 5 < 4, "mobile")
        .otherwise("tablet")
        .alias("deviceCategory"),
        F.concat(F.lit("source"), (user % 3).cast("string")).alias("trafficSource"),
        F.concat(F.lit("medium"), (user % 2).cast("string")).alias("trafficMedium"),
        F.when(user % 13 == 0, F.lit(None))
        .when(user % 2 == 0, "Test:A")
        .otherwise("Test:B")
        .alias("abVariant"),
        F.when(kind.isin("view", "click", "purchase"), "PAGE").otherwise("EVENT").alias("type"),
        page.alias("pagePath"),
        F.when(kind == "signup", "relatedLinkClicked")
        .when(feedback, "yesNoFeedbackForm")
        .when(error, "breadcrumbClicked")
        .alias("eventCategory"),
        F.when(kind == "signup", signup_action)
        .when(feedback, "ffYesClick")
        .when(error, (F.col("k") % 3).cast("string"))
        .alias("eventAction"),
        F.when(
            F.col("k") % 11 != 0,
            F.concat(
                F.lit("t"),
                (F.col("k") % 4).cast("string"),
                F.lit(",t"),
                (F.col("k") % 7).cast("string"),
            ),
        ).alias("taxons"),
        F.when(F.col("k") % 13 == 0, "00000000-0000-0000-0000-000000000000")
        .when(F.col("k") % 17 != 0, F.concat(F.lit("c"), (F.col("k") % 6).cast("string")))
        .alias("contentId"),
        F.when(F.col("k") % 8 == 0, "search")
        .when(F.col("k") % 5 == 0, "taxon")
        .otherwise("guide")
        .alias("documentType"),
        "k",
        F.struct("ts", "event_id").alias("hitOrder"),
        F.expr("CAST(hour(ts) DIV 6 AS BIGINT)").alias("hitChunk"),
    )


def numbered_event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_hits`` with a position per visit, for sources that carry one."""
    w = W.partitionBy("fullVisitorId", "visitId").orderBy("hitOrder")
    return event_hits(spark, sf_dir).withColumn("hitNumber", F.row_number().over(w))


HITS_SQL = """
hits AS (
  SELECT *, row_number() OVER (PARTITION BY fullVisitorId, visitId ORDER BY ts, event_id) AS hitNumber
  FROM (
    SELECT CAST(user_id AS VARCHAR) AS fullVisitorId,
           CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS visitId,
           CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS visitNumber,
           CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS visitStartTime,
           CAST(ts AS DATE) AS date, ts, event_id, user_id, k,
           CASE WHEN user_id % 5 < 2 THEN 'desktop' WHEN user_id % 5 < 4 THEN 'mobile' ELSE 'tablet' END AS deviceCategory,
           'source' || (user_id % 3) AS trafficSource, 'medium' || (user_id % 2) AS trafficMedium,
           CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'Test:A' ELSE 'Test:B' END AS abVariant,
           CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'PAGE' ELSE 'EVENT' END AS type,
           CASE WHEN k % 8 = 0 THEN '/search?q=' || (k % 3) ELSE '/p' || (k % 5) END AS pagePath,
           CASE WHEN event_type = 'signup' THEN 'relatedLinkClicked'
                WHEN event_type = 'error' AND k % 10 = 0 THEN 'yesNoFeedbackForm'
                WHEN event_type = 'error' THEN 'breadcrumbClicked' END AS eventCategory,
           CASE WHEN event_type = 'signup' THEN '1.' || (k % 4) || CASE WHEN k % 2 = 0 THEN ' Related content' ELSE ' Explore the topic' END
                WHEN event_type = 'error' AND k % 10 = 0 THEN 'ffYesClick'
                WHEN event_type = 'error' THEN CAST(k % 3 AS VARCHAR) END AS eventAction,
           CASE WHEN k % 11 <> 0 THEN 't' || (k % 4) || ',t' || (k % 7) END AS taxons,
           CASE WHEN k % 13 = 0 THEN '00000000-0000-0000-0000-000000000000' WHEN k % 17 <> 0 THEN 'c' || (k % 6) END AS contentId,
           CASE WHEN k % 8 = 0 THEN 'search' WHEN k % 5 = 0 THEN 'taxon' ELSE 'guide' END AS documentType
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))
),
"""


def order_hits(spark: SparkSession, sf_dir: str, page=None) -> DataFrame:
    """Page hits of orders: a visit is one order, its pages are part types."""
    if page is None:
        page = F.concat(F.lit("/"), F.lower("p_type"))
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    joined = line.join(part, line["l_partkey"] == part["p_partkey"]).join(
        order, line["l_orderkey"] == order["o_orderkey"]
    )
    urgent = F.substring("o_orderpriority", 1, 1).cast("int")
    return joined.select(
        F.col("l_orderkey").cast("string").alias("fullVisitorId"),
        F.col("l_orderkey").alias("visitId"),
        F.lit(1).cast("bigint").alias("visitNumber"),
        F.to_date("o_orderdate").alias("date"),
        F.when(urgent <= 2, "desktop").when(urgent <= 4, "mobile").otherwise("tablet").alias(
            "deviceCategory"
        ),
        F.lit("PAGE").alias("type"),
        page.alias("pagePath"),
        F.lit(None).cast("string").alias("eventCategory"),
        F.lit(None).cast("string").alias("eventAction"),
        F.lit("t").alias("taxons"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("hitOrder"),
        F.expr("CAST(l_linenumber DIV 4 AS BIGINT)").alias("hitChunk"),
    )


ORDER_HITS_SQL = """
hits AS (
  SELECT l_orderkey AS visitId, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 THEN 'desktop'
              WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 4 THEN 'mobile' ELSE 'tablet' END AS deviceCategory,
         '/' || lower(p_type) AS pagePath, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
),
"""

FULL_HEAD = (
    "visitNumber",
    "deviceCategory",
    "date",
    "trafficSource",
    "trafficMedium",
    "abVariant",
)


def event_sessions(
    spark: SparkSession, sf_dir: str, style: str = "taxon", head=sessions.SESSION_HEAD
) -> DataFrame:
    return sessions.build_sessions(event_hits(spark, sf_dir), style, head)


TOKEN_SQL = {
    "event": "pagePath || '<<' || type || '<:<' || coalesce(eventCategory, 'NULL') || '<:<' || coalesce(eventAction, 'NULL')",
    "no_type": "pagePath || '<<' || coalesce(eventCategory, 'NULL') || '<:<' || coalesce(eventAction, 'NULL')",
    "legacy": "pagePath || '::' || coalesce(eventCategory, 'NULL') || '//' || coalesce(eventAction, 'NULL')",
}
TOKEN_SQL["taxon"] = TOKEN_SQL["event"] + " || '<<' || taxons"


def sessions_sql(style: str = "taxon") -> str:
    return (
        HITS_SQL
        + f"""
sessions AS (
  SELECT fullVisitorId, visitId, visitNumber, date, deviceCategory, trafficSource, trafficMedium, abVariant,
         fullVisitorId || '-' || visitId || '-' || visitNumber AS sessionId,
         string_agg({TOKEN_SQL[style]}, '>>' ORDER BY hitNumber) AS Sequence,
         string_agg(CASE WHEN type = 'PAGE' THEN pagePath END, '>>' ORDER BY hitNumber) AS PageSequence,
         count(*) AS Actions_Length, count(*) FILTER (type = 'PAGE') AS PageSeq_Length,
         count(*) FILTER (eventAction = 'ffYesClick') AS EventYes
  FROM hits GROUP BY ALL
),
"""
    )


SESSIONS_SQL = sessions_sql()


MULTISETS = {"DeviceCategories": "deviceCategory", "Dates": "date"}
KEPT = ("PageSequence", "PageSeq_Length", "Actions_Length")


def event_journeys(spark: SparkSession, sf_dir: str, multisets=None) -> DataFrame:
    """One row per ``Sequence``, without missing sequences."""
    return sessions.count_journeys(
        event_sessions(spark, sf_dir).where("Sequence IS NOT NULL"),
        keys=("Sequence",),
        multisets=multisets,
        kept=KEPT,
    )


JOURNEYS_SQL = (
    SESSIONS_SQL
    + """
counted AS (
  SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length, count(*) AS Occurrences
  FROM sessions WHERE Sequence IS NOT NULL GROUP BY ALL
),
journeys AS (
  SELECT Sequence, Occurrences, PageSequence, PageSeq_Length, Actions_Length FROM (
    SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length,
           CAST(sum(Occurrences) OVER (PARTITION BY Sequence) AS BIGINT) AS Occurrences,
           row_number() OVER (PARTITION BY Sequence ORDER BY PageSequence NULLS FIRST, PageSeq_Length, Actions_Length) AS r
    FROM counted) WHERE r = 1
),
seq_devices AS (SELECT Sequence, deviceCategory AS device, count(*) AS n FROM sessions WHERE Sequence IS NOT NULL GROUP BY ALL),
seq_dates AS (SELECT Sequence, strftime(date, '%Y-%m-%d') AS day, count(*) AS n FROM sessions WHERE Sequence IS NOT NULL GROUP BY ALL),
"""
)


def parsed(spark: SparkSession, sf_dir: str, multisets=None) -> DataFrame:
    """``event_journeys`` with the parsed lists and their features."""
    df = stages.add_sequence_columns(event_journeys(spark, sf_dir, multisets))
    return stages.add_delooped_columns(stages.add_taxon_columns(stages.add_event_columns(df)))


def with_totals(spark: SparkSession, sf_dir: str, multisets=None) -> DataFrame:
    """``parsed`` with the totals per page sequence.

    The journeys are written first: the totals read them again.
    """
    return stages.process_journeys(cut_lineage(event_journeys(spark, sf_dir, multisets)))


# Lists per row of ``journeys``; positions in DuckDB lists start at 1.
PARSE_SQL = """
parsed0 AS (
  SELECT *, list_transform(
      list_filter(list_transform(string_split(regexp_replace(Sequence, '>>iii\\.+|>>\\.+|\\s>>>\\s', '', 'g'), '>>'),
                                 lambda h: list_transform(string_split(h, '<<'), lambda f: regexp_replace(f, '["'']', '', 'g'))),
                  lambda f: len(f) IN (2, 3)),
      lambda f: {'page': f[1], 'event': f[2], 'taxons': f[3]}) AS pel
  FROM journeys
),
parsed1 AS (
  SELECT *, list_filter(pel, lambda h: h.event = 'PAGE<:<NULL<:<NULL') AS ph,
    list_transform(pel, lambda h: CASE WHEN len(string_split(h.event, '<:<')) = 2
        THEN {'category': string_split(h.event, '<:<')[1], 'action': string_split(h.event, '<:<')[2]}
      WHEN len(string_split(h.event, '<:<')) = 3 AND contains(string_split(h.event, '<:<')[2], 'NULL')
        THEN {'category': string_split(h.event, '<:<')[1] || '_' || string_split(h.event, '<:<')[2],
              'action': string_split(h.event, '<:<')[1] || '_' || string_split(h.event, '<:<')[3]}
      WHEN len(string_split(h.event, '<:<')) = 3
        THEN {'category': string_split(h.event, '<:<')[2], 'action': string_split(h.event, '<:<')[3]} END) AS el
  FROM parsed0
),
parsed2 AS (
  SELECT *, list_transform(ph, lambda h: h.page) AS pl, list_transform(ph, lambda h: h.taxons) AS tl FROM parsed1
),
parsed3 AS (
  SELECT *, list_filter(pl, lambda p, i: i = 1 OR p <> pl[i - 1]) AS pnl FROM parsed2
),
parsed AS (
  SELECT *, array_to_string(pnl, '>>') AS seq_nl,
    CASE WHEN PageSequence IS NOT NULL THEN CAST(sum(Occurrences) OVER (PARTITION BY PageSequence) AS BIGINT) END AS seq_occ,
    CAST(sum(Occurrences) OVER (PARTITION BY array_to_string(pnl, '>>')) AS BIGINT) AS nl_occ
  FROM parsed3
),
"""
PARSED_SQL = JOURNEYS_SQL + PARSE_SQL


def nested_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits of ``event_hits`` as nested sessions."""

    def dimensions(*pairs):
        entries = [
            F.when(
                F.col(name).isNotNull(),
                F.struct(F.lit(index).alias("index"), F.col(name).alias("value")),
            )
            for index, name in pairs
        ]
        return F.filter(F.array(*entries), lambda d: d.isNotNull())

    hit = F.struct(
        F.col("hitNumber").cast("int").alias("hitNumber"),
        "type",
        F.struct("pagePath").alias("page"),
        F.struct("eventCategory", "eventAction").alias("eventInfo"),
        dimensions((59, "taxons"), (4, "contentId"), (2, "documentType")).alias("customDimensions"),
    )
    keys = ["fullVisitorId", "visitId", "visitNumber", "visitStartTime", "date"]
    head = ["deviceCategory", "trafficSource", "trafficMedium", "abVariant"]
    return (
        numbered_event_hits(spark, sf_dir)
        .groupBy(*keys, *head)
        .agg(F.collect_list(hit).alias("hits"))
        .select(
            *keys[:4],
            F.struct("deviceCategory").alias("device"),
            F.struct(
                F.col("trafficSource").alias("source"), F.col("trafficMedium").alias("medium")
            ).alias("trafficSource"),
            dimensions((65, "abVariant")).alias("customDimensions"),
            "hits",
            "date",
        )
    )


def written_sessions(spark: SparkSession, sf_dir: str) -> str:
    """Path of the nested sessions, one folder per day."""
    path = scratch_path(spark, "sessions")
    write_daily(nested_sessions(spark, sf_dir), path)
    return path


def page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages and ``/p0`` help to find, the rest are things."""
    page = F.col("pagePath")
    finding = page.startswith("/search") | (page == "/p0")
    return event_hits(spark, sf_dir).select(
        "pagePath", finding.cast("int").alias("is_finding")
    ).distinct()


PAGE_TYPES_SQL = """
page_types AS (
  SELECT DISTINCT pagePath, CAST(starts_with(pagePath, '/search') OR pagePath = '/p0' AS INTEGER) AS is_finding FROM hits
),
"""


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a tree of four children each, with unknown parents and one circle."""
    key = F.col("p_partkey")
    parent = (
        F.when(key == 0, F.lit(None))
        .when(key % 97 == 5, "missing")
        .when(key == 300, "t1201")
        .otherwise(F.concat(F.lit("t"), F.expr("p_partkey DIV 4").cast("string")))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("t"), key.cast("string")).alias("content_id"),
        F.concat("p_name", F.lit(" "), (key % 50).cast("string")).alias("title"),
        F.concat(F.lit("/"), F.lower("p_type"), F.lit("/"), key.cast("string")).alias("base_path"),
        parent.alias("parent_content_id"),
    )


TAXONOMY_SQL = """
taxonomy AS (
  SELECT 't' || p_partkey AS content_id, p_name || ' ' || (p_partkey % 50) AS title,
         '/' || lower(p_type) || '/' || p_partkey AS base_path,
         CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey % 97 = 5 THEN 'missing'
              WHEN p_partkey = 300 THEN 't1201' ELSE 't' || (p_partkey // 4) END AS parent_content_id
  FROM part
),
"""

ANCESTORS_SQL = (
    TAXONOMY_SQL
    + """
chain AS (
  SELECT content_id, 0 AS distance, content_id AS ancestor_id, parent_content_id AS ancestor_parent_id, title, [content_id] AS path FROM taxonomy
  UNION ALL
  SELECT c.content_id, c.distance + 1, t.content_id, t.parent_content_id, t.title, list_append(c.path, t.content_id)
  FROM chain c JOIN taxonomy t ON t.content_id = c.ancestor_parent_id WHERE NOT list_contains(c.path, t.content_id)
),
anc AS (
  SELECT content_id, CAST(max(distance) OVER (PARTITION BY content_id) - distance + 1 AS INTEGER) AS level,
         ancestor_id, ancestor_parent_id, title
  FROM chain WHERE distance > 0
),
"""
)


def adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of raw pages: path of the page, link target, first part of the path."""
    path = F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?#]*)", 1)
    return (
        table(spark, sf_dir, "pages")
        .select(
            path.alias("source_base_path"),
            F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias(
                "sink_base_path"
            ),
        )
        .select(
            "*", F.regexp_extract("source_base_path", "^/([^/]*)", 1).alias("link_type")
        )
    )


ADJACENCY_SQL = """
adjacency AS (
  SELECT source_base_path, sink_base_path, regexp_extract(source_base_path, '^/([^/]*)', 1) AS link_type
  FROM (SELECT regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS source_base_path,
               unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS sink_base_path FROM pages)
),
"""


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structural network, weighted by the number of equal links."""
    return (
        adjacency(spark, sf_dir)
        .groupBy(F.col("source_base_path").alias("src"), F.col("sink_base_path").alias("dst"))
        .agg(F.count("*").alias("weight"))
    )


LINK_EDGES_SQL = (
    ADJACENCY_SQL
    + """
edges AS (SELECT source_base_path AS src, sink_base_path AS dst, count(*) AS weight FROM adjacency GROUP BY ALL),
"""
)


def journey_edges(spark: SparkSession, sf_dir: str, delooped: bool = False) -> DataFrame:
    return network.edge_weights(parsed(spark, sf_dir), delooped)


JOURNEY_EDGES_SQL = (
    PARSED_SQL
    + """
per_seq AS (SELECT PageSequence AS sequence, CAST(sum(Occurrences) AS BIGINT) AS occ, min(pl) AS pages FROM parsed GROUP BY ALL),
edges AS (
  SELECT src, dst, CAST(sum(occ) AS BIGINT) AS weight FROM (
    SELECT occ, unnest(list_transform(pages[2:], lambda p, i: {'src': pages[i], 'dst': p}), recursive := true) FROM per_seq)
  GROUP BY ALL
),
"""
)


def ab_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed journeys per sequence and variant, without tablets."""
    rows = sessions.ab_sessions(
        event_sessions(spark, sf_dir, head=("visitNumber", "deviceCategory", "abVariant")), "Test"
    )
    counted = sessions.count_journeys(
        rows.where("Sequence IS NOT NULL"), keys=("Sequence", "ABVariant")
    )
    return stages.add_event_columns(stages.add_sequence_columns(counted))


AB_PARSED_SQL = (
    SESSIONS_SQL
    + """
journeys AS (
  SELECT Sequence, replace(abVariant, 'Test:', '') AS ABVariant, count(*) AS Occurrences, CAST(NULL AS VARCHAR) AS PageSequence
  FROM sessions WHERE starts_with(abVariant, 'Test:') AND deviceCategory <> 'tablet' AND Sequence IS NOT NULL GROUP BY ALL
),
"""
    + PARSE_SQL
)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order; the customers are the clients."""
    started = F.date_format("o_orderdate", "dd/MM/yyyy")
    client = F.col("o_custkey")
    answer = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).when(
        F.col("o_orderkey") % 7 == 1, "  "
    ).otherwise(F.concat(F.col("o_orderpriority"), F.lit("  "), F.col("o_orderstatus")))
    return table(spark, sf_dir, "orders").select(
        client.cast("string").alias("clientID"),
        F.concat(F.lit("/p"), (F.col("o_orderkey") % 5).cast("string")).alias("Page_Path"),
        F.concat(started, F.lit(" 10:00:00")).alias("Started"),
        F.concat(started, F.lit(" 10:05:00")).alias("Ended"),
        F.concat(F.lit("u"), (F.col("o_orderkey") % 9).cast("string")).alias("UserID"),
        answer.alias("answer"),
        F.col("o_orderkey").alias("response"),
    )


def client_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose id carries the client as its fourth field."""
    rows = event_sessions(spark, sf_dir)
    client = (F.col("fullVisitorId").cast("bigint") * 20).cast("string")
    return rows.select(
        F.concat(
            F.lit("s-"), F.col("fullVisitorId"), F.lit("-"), F.col("visitId").cast("string"), F.lit("-"), client
        ).alias("sessionId"),
        "PageSequence",
    )


SURVEY_SQL = """
survey AS (
  SELECT CAST(o_custkey AS VARCHAR) AS clientID, '/p' || (o_orderkey % 5) AS Page_Path,
         strftime(o_orderdate, '%d/%m/%Y') || ' 10:00:00' AS Started, strftime(o_orderdate, '%d/%m/%Y') || ' 10:05:00' AS Ended,
         'u' || (o_orderkey % 9) AS UserID,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '  ' ELSE o_orderpriority || '  ' || o_orderstatus END AS answer,
         o_orderkey AS response
  FROM orders
),
"""
CLIENT_SESSIONS_SQL = (
    SESSIONS_SQL
    + """
client_sessions AS (
  SELECT 's-' || fullVisitorId || '-' || visitId || '-' || (CAST(fullVisitorId AS BIGINT) * 20) AS sessionId,
         CAST(CAST(fullVisitorId AS BIGINT) * 20 AS VARCHAR) AS client_id, PageSequence FROM sessions
),
"""
)


def file_stub(spark, folder):
    """The writing job's id, which all files of ``folder`` and no others have in their names."""
    name = spark.read.text(folder).select(F.col("_metadata.file_name").alias("f")).first()["f"]
    return "-".join(name.split("-")[2:7]).split("-c000")[0]
