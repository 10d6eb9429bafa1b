"""Sequence text to lists, and features of the lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare import constants as C
from wayfare.functions import features, parsing

from wayfare.plans import stages
from wayfare.session import cut_lineage


def pel():
    return F.col("Page_Event_List")


def pl():
    return F.col("Page_List")


def pairs():
    return parsing.adjacent_pairs(pl())


def per_journey(name, sql, **columns):
    """Columns of each journey beside its sequence, built when the query runs."""
    register(
        name,
        lambda s, d: I.parsed(s, d).select(
            "Sequence", *[column().alias(alias) for alias, column in columns.items()]
        ),
        I.PARSED_SQL,
        f"SELECT Sequence, {sql} FROM parsed",
    )


def joined(entries, *fields):
    """One text of an array of structs, for comparison."""
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("|", *[e[f] for f in fields])), ";")


register(
    "p1_strip_quotes",
    lambda s, d: I.table(s, d, "conversations").select(
        "conv_id", "turn", parsing.strip_quotes(F.col("text")).alias("clean")
    ),
    None,
    """SELECT conv_id, turn, regexp_replace(text, '["'']', '', 'g') AS clean FROM conversations""",
)


def noisy(spark, sf):
    odd = (
        F.when(F.col("Occurrences") % 3 == 0, ">>iii...x")
        .when(F.col("Occurrences") % 3 == 1, ">>..y")
        .otherwise(" >>> z")
    )
    return I.event_journeys(spark, sf).withColumn("noisy", F.concat("Sequence", odd, F.lit('>>/"q"<<a<:<b')))


NOISY_SQL = I.JOURNEYS_SQL + """
noisy AS (
  SELECT *, Sequence || CASE Occurrences % 3 WHEN 0 THEN '>>iii...x' WHEN 1 THEN '>>..y' ELSE ' >>> z' END || '>>/"q"<<a<:<b' AS noisy FROM journeys
),
"""
SCRUB_SQL = r"regexp_replace(noisy, '>>iii\.+|>>\.+|\s>>>\s', '', 'g')"
register(
    "p2_scrub_fragments",
    lambda s, d: noisy(s, d).select("Sequence", parsing.scrub_fragments(F.col("noisy")).alias("clean")),
    NOISY_SQL,
    f"SELECT Sequence, {SCRUB_SQL} AS clean FROM noisy",
)
register(
    "p3_page_event_list",
    lambda s, d: noisy(s, d)
    .select("Sequence", F.posexplode(parsing.page_event_list(F.col("noisy"))).alias("position", "hit"))
    .select("Sequence", F.col("position").cast("bigint").alias("position"), "hit.page", "hit.event", "hit.taxons"),
    NOISY_SQL,
    f"""SELECT Sequence, i - 1 AS position, l[i][1] AS page, l[i][2] AS event, l[i][3] AS taxons FROM (
          SELECT Sequence, l, unnest(range(1, len(l) + 1)) AS i FROM (
            SELECT Sequence, list_filter(list_transform(string_split({SCRUB_SQL}, '>>'),
              lambda h: list_transform(string_split(h, '<<'), lambda f: regexp_replace(f, '["'']', '', 'g'))), lambda f: len(f) IN (2, 3)) AS l FROM noisy))""",
)


def p4(spark, sf):
    hit = I.event_hits(spark, sf)
    plain = F.concat_ws("<:<", "eventCategory", "eventAction")
    typed = F.concat_ws(
        "<:<", "type", F.coalesce("eventCategory", F.lit("NULL")), F.coalesce("eventAction", F.lit("NULL"))
    )
    long = F.concat(typed, F.lit("<:<x"))
    text = F.when(F.col("k") % 4 == 0, plain).when(F.col("k") % 4 == 1, long).otherwise(typed)
    pairs = hit.select("hitOrder.event_id", parsing.split_event(text).alias("pair"))
    return pairs.select("event_id", "pair.category", "pair.action")


register(
    "p4_split_event",
    p4,
    I.HITS_SQL,
    """SELECT event_id,
       CASE WHEN k % 4 = 0 THEN eventCategory WHEN k % 4 > 1 AND eventCategory IS NULL THEN type || '_NULL' WHEN k % 4 > 1 THEN eventCategory END AS category,
       CASE WHEN k % 4 = 0 THEN eventAction WHEN k % 4 > 1 AND eventCategory IS NULL THEN type || '_NULL' WHEN k % 4 > 1 THEN eventAction END AS action
       FROM hits""",
)
per_journey("p5_page_list", "array_to_string(pl, '|') AS pages", pages=lambda: F.array_join(pl(), "|"))
per_journey(
    "p6_event_list",
    "array_to_string(list_transform(el, lambda e: e.category || '|' || e.action), ';') AS events",
    events=lambda: joined("Event_List", "category", "action"),
)
per_journey("p7_page_sequence", "array_to_string(pl, '>>') AS pages", pages=lambda: parsing.join_pages(pl()))
per_journey("p8_taxon_list", "array_to_string(tl, ';') AS taxons", taxons=lambda: F.array_join("Taxon_List", ";"))
register(
    "p9_page_taxons",
    lambda s, d: I.parsed(s, d)
    .select("Sequence", F.posexplode("Taxon_Page_List").alias("position", "entry"))
    .select("Sequence", F.col("position").cast("bigint").alias("position"), "entry.page", F.explode("entry.taxons").alias("taxon")),
    I.PARSED_SQL,
    """SELECT Sequence, i - 1 AS position, ph[i].page AS page, unnest(string_split(ph[i].taxons, ',')) AS taxon
       FROM (SELECT Sequence, ph, unnest(range(1, len(ph) + 1)) AS i FROM parsed)""",
)
per_journey(
    "p10_all_hits_taxons",
    "array_to_string(list_transform(pel, lambda h: h.page || '|' || h.taxons), ';') AS hits",
    hits=lambda: joined(parsing.all_hits_taxons(pel()), "page", "taxons"),
)
per_journey(
    "p11_nest_taxons",
    "array_to_string(list_transform(tl, lambda t: CAST(len(string_split(t, ',')) AS VARCHAR) || ':' || string_split(t, ',')[1]), ';') AS nested",
    nested=lambda: F.array_join(
        F.transform(
            parsing.nest_taxons(F.col("Taxon_List")),
            lambda t: F.concat(F.size(t).cast("string"), F.lit(":"), t[0]),
        ),
        ";",
    ),
)
per_journey(
    "p12_collapse_loops", "array_to_string(pnl, '|') AS pages", pages=lambda: F.array_join(parsing.collapse_loops(pl()), "|")
)
per_journey(
    "p13_delooped_sequence",
    "seq_nl AS Page_Seq_NL, len(pnl) AS n_pages",
    Page_Seq_NL=lambda: F.col("Page_Seq_NL"),
    n_pages=lambda: F.size(parsing.split_pages(F.col("Page_Seq_NL"))).cast("bigint"),
)
register(
    "p14_adjacent_pairs",
    lambda s, d: I.parsed(s, d)
    .select("Sequence", F.posexplode(parsing.adjacent_pairs(pl())).alias("position", "pair"))
    .select("Sequence", F.col("position").cast("bigint").alias("position"), "pair.src", "pair.dst"),
    I.PARSED_SQL,
    """SELECT Sequence, i - 1 AS position, pl[i] AS src, pl[i + 1] AS dst
       FROM (SELECT Sequence, pl, unnest(range(1, len(pl))) AS i FROM parsed)""",
)
per_journey(
    "p15_first_last_page",
    "pl[1] AS start_page, pl[-1] AS end_page",
    start_page=lambda: parsing.first_item(pl()),
    end_page=lambda: parsing.last_item(pl()),
)
per_journey(
    "p16_ends_of_pairs",
    """CASE WHEN len(pl) > 1 THEN pl[1] END AS start_page, CASE WHEN len(pl) > 1 THEN pl[-1] END AS end_page,
       CASE WHEN len(pl) > 1 THEN pl[1] || '>' || pl[2] END AS first_pair,
       CASE WHEN len(pl) > 1 THEN pl[-2] || '>' || pl[-1] END AS last_pair""",
    start_page=lambda: parsing.ends_of_pairs(pairs())["start"],
    end_page=lambda: parsing.ends_of_pairs(pairs())["end"],
    first_pair=lambda: F.concat(
        parsing.end_pairs(pairs())["first"]["src"], F.lit(">"), parsing.end_pairs(pairs())["first"]["dst"]
    ),
    last_pair=lambda: F.concat(
        parsing.end_pairs(pairs())["last"]["src"], F.lit(">"), parsing.end_pairs(pairs())["last"]["dst"]
    ),
)
register(
    "p17_reindex_hits",
    lambda s, d: I.parsed(s, d)
    .select("Sequence", F.posexplode(parsing.reindex_hits(pel())).alias("i", "hit"))
    .select("Sequence", F.col("hit.position").cast("bigint").alias("position"), "hit.page", "hit.event"),
    I.PARSED_SQL,
    """SELECT Sequence, position, page, event FROM (
         SELECT Sequence, i, pel[i].page AS page, pel[i].event AS event,
           i = 1 OR pel[i].page <> pel[i - 1].page OR pel[i].event <> pel[i - 1].event AS kept,
           CAST(sum(CASE WHEN i > 1 AND pel[i].page <> pel[i - 1].page THEN 1 ELSE 0 END) OVER (PARTITION BY Sequence ORDER BY i) AS BIGINT) AS position
         FROM (SELECT Sequence, pel, unnest(range(1, len(pel) + 1)) AS i FROM parsed)) WHERE kept""",
)
per_journey("p18_has_loop", "len(pnl) <> len(pl) AS has_loop", has_loop=lambda: features.has_loop(pl()))
per_journey(
    "p19_has_repetition",
    "len(list_distinct(pnl)) <> len(pnl) AS has_repetition",
    has_repetition=lambda: features.has_repetition(F.col("Page_List_NL")),
)
per_journey(
    "p20_count_categories",
    "len(list_distinct(list_transform(el, lambda e: e.category))) AS n",
    n=lambda: features.count_event_categories(F.col("Event_List")),
)
per_journey(
    "p21_count_event",
    "len(list_filter(el, lambda e: e.category = 'yesNoFeedbackForm' AND e.action = 'ffYesClick')) AS n",
    n=lambda: features.count_event(F.col("Event_List"), "yesNoFeedbackForm", C.FEEDBACK_YES),
)
register(
    "p22_category_frequencies",
    lambda s, d: I.parsed(s, d).select("Sequence", F.inline("Event_cats_agg")),
    I.PARSED_SQL,
    """SELECT Sequence, category, count(*) AS n FROM (
         SELECT Sequence, unnest(list_transform(el, lambda e: e.category)) AS category FROM parsed) GROUP BY ALL""",
)
register(
    "p23_event_frequencies",
    lambda s, d: I.parsed(s, d).select("Sequence", F.inline("Event_cat_act_agg")),
    I.PARSED_SQL,
    """SELECT Sequence, category, action, count(*) AS n FROM (
         SELECT Sequence, unnest(el, recursive := true) FROM parsed) GROUP BY ALL""",
)
register(
    "p24_sequence_columns",
    lambda s, d: stages.add_sequence_columns(I.event_journeys(s, d).drop("PageSequence")).select(
        "Sequence",
        "PageSequence",
        F.size("Page_Event_List").cast("bigint").alias("n_hits"),
        F.size("Page_List").cast("bigint").alias("n_pages"),
    ),
    I.PARSED_SQL,
    "SELECT Sequence, array_to_string(pl, '>>') AS PageSequence, len(pel) AS n_hits, len(pl) AS n_pages FROM parsed",
)
per_journey(
    "p25_event_columns",
    """len(el) AS n_events, len(list_distinct(list_transform(el, lambda e: e.category))) AS num_event_cats,
       len(list_distinct(list_transform(el, lambda e: e.category || '|' || e.action))) AS n_pairs""",
    n_events=lambda: F.size("Event_List").cast("bigint"),
    num_event_cats=lambda: F.col("num_event_cats"),
    n_pairs=lambda: F.size("Event_cat_act_agg").cast("bigint"),
)
per_journey(
    "p26_taxon_columns",
    "len(tl) AS n_texts, len(list_distinct(flatten(list_transform(tl, lambda t: string_split(t, ','))))) AS n_taxons",
    n_texts=lambda: F.size("Taxon_List").cast("bigint"),
    n_taxons=lambda: F.size(F.array_distinct(F.flatten(F.transform("Taxon_Page_List", lambda p: p["taxons"])))).cast("bigint"),
)


def p27(spark, sf):
    base = stages.add_sequence_columns(cut_lineage(I.event_journeys(spark, sf)))
    return stages.add_loop_columns(base).select(
        "Sequence",
        "Page_Seq_NL",
        F.coalesce("Page_Seq_Occurrences", F.lit(-1)).alias("Page_Seq_Occurrences"),
        "Occurrences_NL",
    )


register(
    "p27_loop_columns",
    p27,
    I.PARSED_SQL,
    "SELECT Sequence, seq_nl AS Page_Seq_NL, coalesce(seq_occ, -1) AS Page_Seq_Occurrences, nl_occ AS Occurrences_NL FROM parsed",
)
register(
    "p28_sequence_check",
    lambda s, d: I.parsed(s, d)
    .withColumn("same", F.coalesce("PageSequence", F.lit("")) == parsing.join_pages(pl()))
    .groupBy("same")
    .agg(F.count("*").alias("n"), F.sum("Occurrences").alias("Occurrences")),
    I.PARSED_SQL,
    """SELECT coalesce(PageSequence, '') = array_to_string(pl, '>>') AS same, count(*) AS n,
       CAST(sum(Occurrences) AS BIGINT) AS Occurrences FROM parsed GROUP BY ALL""",
)
per_journey("p29_list_length", "len(pl) AS n, len(pnl) AS n_nl", n=lambda: F.size(pl()).cast("bigint"), n_nl=lambda: F.size("Page_List_NL").cast("bigint"))
register(
    "p30_delimiter_length",
    lambda s, d: I.event_sessions(s, d)
    .where("PageSequence IS NOT NULL")
    .select("sessionId", parsing.delimiter_length(F.col("PageSequence")).cast("bigint").alias("n")),
    I.SESSIONS_SQL,
    "SELECT sessionId, PageSeq_Length AS n FROM sessions WHERE PageSequence IS NOT NULL",
)

