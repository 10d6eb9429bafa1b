"""Exploration of journeys, pages and their sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from catalog.reports import DESCRIBE_COLUMNS, DEVICES_CTE, describe_sql
from wayfare import constants as C
from wayfare.operators import eda as E
from wayfare.operators import merge
from wayfare.operators.describe import describe
from wayfare.session import cut_lineage

SERVICE = "service.example.org"


def derived(spark, sf):
    journeys = I.with_totals(spark, sf, {"DeviceCategories": "deviceCategory"})
    return E.derive_columns(journeys, SERVICE)


def columns(*names):
    return lambda s, d: derived(s, d).select("Sequence", *names)


SEARCHED = "coalesce(regexp_matches(PageSequence, '/search?') OR contains(PageSequence, '/search/'), false)"
LAST_EVENT = "pel[-1].event"
TYPE_CASES = " ".join(
    f"WHEN regexp_matches(pl[-1], '{pattern}') THEN '{name}'" for pattern, name in reversed(C.FINAL_PAGE_TYPES)
)
DERIVED_SQL = I.PARSED_SQL + DEVICES_CTE + f"""
derived AS (
  SELECT *, len(pl) AS page_seq_len, len(pnl) AS page_seq_len_NL,
    len(regexp_extract_all(PageSequence, '/search?')) + len(regexp_extract_all(PageSequence, '/search/')) AS count_search,
    CAST(len(list_filter(el, lambda e: contains(e.category, 'start') OR contains(e.action, 'start'))) > 0 AS INTEGER) AS event_list_contains_start,
    CAST(contains(Sequence, 'start') AS INTEGER) AS page_seq_contains_start, CAST(contains(Sequence, '{SERVICE}') AS INTEGER) AS page_seq_contains_service,
    pl[-1] AS final_page, {LAST_EVENT} AS final_interaction, CAST({SEARCHED} AS INTEGER) AS contains_search_regex,
    CAST(d > m + t AS INTEGER) AS more_desktop, CAST({SEARCHED} AS INTEGER) * seq_occ AS contains_search_n,
    CASE {TYPE_CASES} ELSE 'other' END AS final_page_type,
    CASE WHEN regexp_matches({LAST_EVENT}, '<:<(.*)<:<') THEN regexp_extract({LAST_EVENT}, '<:<(.*)<:<', 1) END AS final_interaction_type,
    CASE WHEN regexp_matches({LAST_EVENT}, 'EVENT<:<External Link Clicked<:(.*)') THEN regexp_extract({LAST_EVENT}, 'EVENT<:<External Link Clicked<:<?(.*)', 1) END AS final_external_link
  FROM parsed JOIN devices USING (Sequence)
),
"""


def simple(name, *names, sql=None):
    register(name, columns(*names), DERIVED_SQL, f"SELECT Sequence, {sql or ', '.join(names)} FROM derived")


simple("e1_final_page", "final_page")
simple("e2_final_interaction", "final_interaction")
register(
    "e2_final_field",
    lambda s, d: I.parsed(s, d).select(
        "Sequence", E.final_interaction(F.col("Page_Event_List"), with_taxons=True).alias("final_field")
    ),
    I.PARSED_SQL,
    "SELECT Sequence, coalesce(pel[-1].taxons, pel[-1].event) AS final_field FROM parsed",
)
simple("e3_device_counts", "desktop", "mobile", "other_device", sql="d AS desktop, m AS mobile, t AS other_device")
simple("e4_more_desktop", "more_desktop")
simple("e5_lengths", "page_seq_len", "page_seq_len_NL")
register(
    "e6_count_search",
    lambda s, d: I.event_journeys(s, d)
    .where("PageSequence IS NOT NULL")
    .select(
        "Sequence",
        E.count_searches(F.col("PageSequence")).alias("count_search"),
        E.count_searches(F.col("PageSequence"), literal=True).alias("count_literal"),
    ),
    I.JOURNEYS_SQL,
    r"""SELECT Sequence, len(regexp_extract_all(PageSequence, '/search?')) + len(regexp_extract_all(PageSequence, '/search/')) AS count_search,
        len(regexp_extract_all(PageSequence, '/search\?')) + len(regexp_extract_all(PageSequence, '/search/')) AS count_literal
        FROM journeys WHERE PageSequence IS NOT NULL""",
)
simple("e7_contains_text", "event_list_contains_start", "page_seq_contains_start", "page_seq_contains_service")


def e7_every(spark, sf):
    """Every flag on and off: parts name the events and pages, their numbers say where the texts stand."""
    kind = F.col("p_partkey") % 5
    category = F.when(kind == 1, "startPage").otherwise(F.col("p_type"))
    action = F.when(kind == 2, "click start").otherwise(F.col("p_name"))
    plain = F.struct(F.col("p_name").alias("category"), F.col("p_type").alias("action"))
    events = F.array(plain, F.struct(category.alias("category"), action.alias("action")))
    tail = F.when(kind == 3, ">>/start").when(kind == 4, f">>/{SERVICE}").otherwise("")
    sequence = F.concat(F.lit("/"), F.col("p_type"), tail)
    return I.table(spark, sf, "part").select(
        "p_partkey",
        E.events_contain_start(events).alias("in_events"),
        E.flag(sequence.contains("start")).alias("in_sequence"),
        E.flag(sequence.contains(SERVICE)).alias("names_service"),
    )


register(
    "e7_every_flag",
    e7_every,
    None,
    f"""SELECT p_partkey,
          CAST(p_partkey % 5 IN (1, 2) OR contains(p_name, 'start') OR contains(p_type, 'start') AS INTEGER) AS in_events,
          CAST(p_partkey % 5 = 3 OR contains(p_type, 'start') AS INTEGER) AS in_sequence,
          CAST(p_partkey % 5 = 4 OR contains(p_type, '{SERVICE}') AS INTEGER) AS names_service FROM part""",
)
register(
    "e8_contains_search",
    lambda s, d: derived(s, d).where("PageSequence IS NOT NULL").select("Sequence", "contains_search_regex", "contains_search_n"),
    DERIVED_SQL,
    "SELECT Sequence, contains_search_regex, contains_search_n FROM derived WHERE PageSequence IS NOT NULL",
)
simple("e9_final_page_type", "final_page_type")
URL_CASES = TYPE_CASES.replace("pl[-1]", "url")
register(
    "e9_url_type",
    lambda s, d: I.table(s, d, "pages").select(
        "page_id", E.final_page_type(F.concat("url", F.element_at(F.split("html", " "), -1))).alias("kind")
    ),
    None,
    f"""SELECT page_id, CASE {URL_CASES} ELSE 'other' END AS kind FROM (SELECT page_id, url || string_split(html, ' ')[-1] AS url FROM pages)""",
)
# An address for each pattern and each pair of neighbours, dealt over all parts, so that every branch is taken.
SAMPLES = [pattern.replace(".*", "x") for pattern, _ in C.FINAL_PAGE_TYPES]
ADDRESSES = ["/plain", *SAMPLES, *[a + "/" + b for a, b in zip(SAMPLES, SAMPLES[1:])]]


def e9_every(spark, sf):
    samples = F.array(*[F.lit(a) for a in ADDRESSES])
    address = F.concat(F.element_at(samples, (F.col("p_partkey") % len(ADDRESSES)).cast("int") + 1), F.lit("/"), F.col("p_partkey"))
    return I.table(spark, sf, "part").select("p_partkey", E.final_page_type(address).alias("kind"))


register(
    "e9_every_page_type",
    e9_every,
    None,
    f"""SELECT p_partkey, CASE {URL_CASES} ELSE 'other' END AS kind FROM (
          SELECT p_partkey, ({ADDRESSES!r})[CAST(p_partkey % {len(ADDRESSES)} AS INTEGER) + 1] || '/' || p_partkey AS url FROM part)""",
)
simple("e10_final_interaction_type", "final_interaction_type")


def e11(spark, sf):
    link = F.concat(F.lit("EVENT<:<External Link Clicked<:<"), F.col("url"))
    text = F.when(F.col("page_id") % 3 == 0, F.lit("EVENT<:<breadcrumbClicked<:<1")).otherwise(link)
    found = I.table(spark, sf, "pages").select("page_id", E.final_external_link(text).alias("link"))
    return found.withColumn("exit_to_service", E.flag(F.col("link").contains("example.org")))


register(
    "e11_external_link",
    e11,
    None,
    """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN url END AS link,
       CAST(coalesce(page_id % 3 <> 0 AND contains(url, 'example.org'), false) AS INTEGER) AS exit_to_service FROM pages""",
)


def e11_every(spark, sf):
    url = F.when(F.col("page_id") % 4 == 1, F.concat(F.lit(f"https://{SERVICE}/"), F.col("page_id"))).otherwise(F.col("url"))
    kind = F.when(F.col("page_id") % 3 == 0, "breadcrumbClicked").otherwise("External Link Clicked")
    link = E.final_external_link(F.concat(F.lit("EVENT<:<"), kind, F.lit("<:<"), url))
    return I.table(spark, sf, "pages").select("page_id", E.flag(link.contains(SERVICE)).alias("exit_to_service"))


register(
    "e11_every_exit",
    e11_every,
    None,
    f"""SELECT page_id, CAST(page_id % 3 <> 0 AND (page_id % 4 = 1 OR contains(url, '{SERVICE}')) AS INTEGER) AS exit_to_service FROM pages""",
)
simple("e11_exit_to_service", "exit_to_assessed_service", sql="0 AS exit_to_assessed_service")


def percent_sql(column, source="derived"):
    return f"SELECT {column}, count(*) AS n, count(*) * 1e2 / (SELECT CAST(count(*) AS DOUBLE) FROM {source}) AS percent FROM {source} GROUP BY ALL"


register(
    "e12_group_percent",
    lambda s, d: E.group_percent(I.parsed(s, d), "PageSeq_Length"),
    I.PARSED_SQL,
    percent_sql("PageSeq_Length", "parsed"),
)
U = "(CAST(CAST('0x' || substr(md5('1234:' || {0}), 1, 12) AS BIGINT) AS DOUBLE) + 1.0) / CAST(281474976710657 AS DOUBLE)"
register(
    "e13_weighted_sample",
    lambda s, d: E.weighted_sample(I.event_journeys(s, d), 100).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    f"SELECT Sequence, Occurrences FROM journeys ORDER BY -ln({U.format('Sequence')}) / Occurrences, Sequence LIMIT 100",
)
register(
    "e14_sample_with_replacement",
    lambda s, d: E.sample_with_replacement(I.event_journeys(s, d), 0.4).select("Sequence", "Occurrences", "draws"),
    I.JOURNEYS_SQL
    + """
total AS (SELECT CAST(sum(Occurrences) AS BIGINT) AS n FROM journeys),
picks AS (SELECT CAST('0x' || substr(md5('1234:' || i), 1, 12) AS BIGINT) % n AS pick
          FROM (SELECT unnest(range(CAST(ceil(CAST(0.4 AS DOUBLE) * n) AS BIGINT))) AS i, n FROM total)),
spans AS (SELECT Sequence, Occurrences, CAST(sum(Occurrences) OVER (ORDER BY Sequence) AS BIGINT) AS upto FROM journeys),
""",
    """SELECT Sequence, Occurrences, count(*) AS draws FROM picks ASOF JOIN spans ON pick < upto GROUP BY ALL""",
)
register(
    "e15_uniform_sample",
    lambda s, d: E.uniform_sample(I.event_journeys(s, d), 0.25).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    f"SELECT Sequence, Occurrences FROM journeys WHERE {U.format('Sequence')} < 0.25::DOUBLE",
)
register(
    "e16_union_lengths",
    lambda s, d: merge.union_daily(
        [
            merge.drop_length_one(I.event_journeys(s, d)).select("Sequence", "Occurrences", "PageSeq_Length"),
            merge.keep_length_one(I.event_journeys(s, d)).select("Occurrences", "Sequence", "PageSeq_Length"),
        ]
    ),
    I.JOURNEYS_SQL,
    "SELECT Sequence, Occurrences, PageSeq_Length FROM journeys WHERE PageSeq_Length >= 1",
)
register(
    "e17_expand_sessions",
    lambda s, d: E.expand_sessions(I.event_journeys(s, d), per_block=2).select("Sequence", "session"),
    I.JOURNEYS_SQL,
    "SELECT Sequence, unnest(range(Occurrences)) AS session FROM journeys",
)
register(
    "e18_page_rows",
    lambda s, d: E.page_rows(I.parsed(s, d).select("Sequence", "Occurrences", "Page_List_NL")).withColumn(
        "position", F.col("position").cast("bigint")
    ),
    I.PARSED_SQL,
    "SELECT Sequence, Occurrences, unnest(range(len(pnl))) AS position, unnest(pnl) AS page FROM parsed",
)
register(
    "e19_distinct_page_rows",
    lambda s, d: E.distinct_page_rows(I.parsed(s, d).select("Sequence", "Occurrences", "Page_List_NL")),
    I.PARSED_SQL,
    "SELECT DISTINCT Sequence, Occurrences, page FROM (SELECT Sequence, Occurrences, unnest(pnl) AS page FROM parsed)",
)
register(
    "e20_describe_lengths",
    lambda s, d: describe(
        I.parsed(s, d).withColumn("length", F.size("Page_List_NL")), "length", "Occurrences"
    ),
    describe_sql(I.PARSED_SQL + "seg AS (SELECT 'x' AS segment, len(pnl) AS value, Occurrences AS n FROM parsed),\n"),
    f"SELECT {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
)
register(
    "e20_describe_occurrences",
    lambda s, d: describe(I.event_journeys(s, d).withColumn("one", F.lit(1)), "Occurrences", "one"),
    describe_sql(I.JOURNEYS_SQL + "seg AS (SELECT 'x' AS segment, Occurrences AS value, 1 AS n FROM journeys),\n"),
    f"SELECT {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
)
register(
    "e21_consistency_totals",
    lambda s, d: E.consistency_totals(I.parsed(s, d)),
    I.PARSED_SQL,
    """SELECT *, CAST(journeys AS DOUBLE) / journey_types_nl AS journeys_per_type, CAST(page_visits AS DOUBLE) / pages_once_per_session AS visits_per_page FROM (
         SELECT CAST(sum(Occurrences) AS BIGINT) AS journeys, count(*) AS journey_types, count(DISTINCT seq_nl) AS journey_types_nl,
           CAST(sum(len(pnl) * Occurrences) AS BIGINT) AS page_visits, CAST(sum(len(list_distinct(pnl)) * Occurrences) AS BIGINT) AS pages_once_per_session FROM parsed)""",
)
register(
    "e22_search_by_length",
    lambda s, d: E.search_by_length(derived(s, d)),
    DERIVED_SQL,
    """SELECT *, percent / 1e2 * (1 - percent / 1e2) / denom AS variance FROM (
         SELECT page_seq_len AS length, CAST(sum(contains_search_n) AS BIGINT) AS n, CAST(sum(seq_occ) AS BIGINT) AS denom,
           round(CAST(sum(contains_search_n) AS BIGINT) * 1e2 / CAST(sum(seq_occ) AS BIGINT), 1) AS percent
         FROM derived WHERE page_seq_len >= 1 GROUP BY ALL)""",
)
for name, condition in (("e23_searches", "true"), ("e23_searches_of_searching", "contains_search_regex = 1")):
    register(
        name,
        lambda s, d, condition=condition: describe(
            derived(s, d).where("count_search IS NOT NULL").where(condition).withColumn("one", F.lit(1)),
            "count_search",
            "one",
        ),
        describe_sql(
            DERIVED_SQL
            + f"seg AS (SELECT 'x' AS segment, count_search AS value, 1 AS n FROM derived WHERE count_search IS NOT NULL AND {condition}),\n"
        ),
        f"SELECT {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
    )
VISITS_SQL = I.PARSED_SQL + """
visits AS (SELECT page, CAST(sum(Occurrences) AS BIGINT) AS visits FROM (
  SELECT Occurrences, unnest(list_distinct(pnl)) AS page FROM parsed) GROUP BY ALL),
"""
register(
    "e24_most_visited_pages",
    lambda s, d: E.page_visits(I.parsed(s, d)).orderBy(F.desc("visits"), "page").limit(20),
    VISITS_SQL,
    "SELECT page, visits FROM visits ORDER BY visits DESC, page LIMIT 20",
)


def link_visits(spark, sf):
    """Pages by the links to them."""
    return I.adjacency(spark, sf).groupBy(F.col("sink_base_path").alias("page")).agg(F.count("*").alias("visits"))


LINK_VISITS_SQL = I.ADJACENCY_SQL + "visits AS (SELECT sink_base_path AS page, count(*) AS visits FROM adjacency GROUP BY ALL),\n"


def concentration_sql(shares):
    values = ", ".join(f"(CAST({share!r} AS DOUBLE))" for share in shares)
    return f"""
shares(share) AS (VALUES {values}),
ranked AS (SELECT visits, row_number() OVER (ORDER BY visits DESC, page) AS r FROM visits),
tops AS (SELECT share, CAST(floor((SELECT count(*) FROM visits) * share) AS BIGINT) AS top FROM shares),
"""


CONCENTRATION = """SELECT share AS share_of_pages, top, CAST(coalesce(sum(visits), 0) AS BIGINT) AS visits,
       CAST(coalesce(sum(visits), 0) AS DOUBLE) / (SELECT sum(visits) FROM visits) AS share_of_visits
       FROM tops LEFT JOIN ranked ON r <= top GROUP BY share, top"""
TOP_SHARES = [0.02, 0.13]
register(
    "e25_top_page_share",
    lambda s, d: E.concentration(link_visits(s, d), TOP_SHARES),
    LINK_VISITS_SQL + concentration_sql(TOP_SHARES),
    CONCENTRATION,
)
register(
    "e26_concentration_curve",
    lambda s, d: E.concentration_curve(link_visits(s, d)),
    LINK_VISITS_SQL + concentration_sql([i / 100 for i in range(100)]),
    CONCENTRATION,
)
register(
    "e26_journey_concentration_curve",
    lambda s, d: E.concentration_curve(E.page_visits(I.parsed(s, d))),
    VISITS_SQL + concentration_sql([i / 100 for i in range(100)]),
    CONCENTRATION,
)


def share_sql(column, source="derived"):
    return f"""SELECT {column}, CAST(sum(Occurrences) AS BIGINT) AS n, CAST(sum(Occurrences) AS BIGINT) * 1e0 / (SELECT CAST(sum(Occurrences) AS DOUBLE) FROM {source}) AS share
        FROM {source} GROUP BY ALL"""


register(
    "e27_flag_shares",
    lambda s, d: E.value_shares(derived(s, d), "contains_search_regex"),
    DERIVED_SQL,
    share_sql("contains_search_regex"),
)
register(
    "e28_destinations",
    lambda s, d: E.destinations(derived(s, d)),
    DERIVED_SQL,
    "SELECT final_page, CAST(sum(Occurrences) AS BIGINT) AS n FROM derived GROUP BY ALL",
)
register(
    "e28_count_destinations",
    lambda s, d: E.count_destinations(derived(s, d)),
    DERIVED_SQL,
    "SELECT count(DISTINCT final_page) AS n_destinations FROM derived",
)
register(
    "e29_ways_to_page",
    lambda s, d: E.ways_to_page(derived(s, d)),
    DERIVED_SQL,
    "SELECT final_page, count(DISTINCT seq_nl) AS n_ways FROM derived GROUP BY ALL",
)
register(
    "e30_final_page_types",
    lambda s, d: E.group_percent(derived(s, d), "final_page_type"),
    DERIVED_SQL,
    percent_sql("final_page_type"),
)
register(
    "e30_final_interaction_types",
    lambda s, d: E.group_percent(derived(s, d), "final_interaction_type"),
    DERIVED_SQL,
    percent_sql("final_interaction_type"),
)
register(
    "e31_missing_shares",
    lambda s, d: E.missing_shares(I.event_sessions(s, d), ["Sequence", "PageSequence", "sessionId"]),
    I.SESSIONS_SQL,
    """SELECT "column", n_missing, n_missing * 1e0 / (SELECT count(*) FROM sessions) AS share FROM (
         SELECT 'Sequence' AS "column", count(*) FILTER (Sequence IS NULL) AS n_missing FROM sessions
         UNION ALL SELECT 'PageSequence', count(*) FILTER (PageSequence IS NULL) FROM sessions
         UNION ALL SELECT 'sessionId', count(*) FILTER (sessionId IS NULL) FROM sessions)""",
)
register(
    "e31_complete_rows",
    lambda s, d: E.complete_rows(I.event_sessions(s, d), ["Sequence", "PageSequence"]).select("sessionId"),
    I.SESSIONS_SQL,
    "SELECT sessionId FROM sessions WHERE Sequence IS NOT NULL AND PageSequence IS NOT NULL",
)


def per_sequence(spark, sf):
    return E.sessions_per_sequence(I.event_journeys(spark, sf))


PER_SQL = I.JOURNEYS_SQL + """
per AS (SELECT PageSequence, CAST(sum(Occurrences) AS BIGINT) AS journey_occurrences FROM journeys WHERE PageSequence IS NOT NULL GROUP BY ALL),
"""
register("e32_sessions_per_sequence", per_sequence, PER_SQL, "SELECT * FROM per")
register(
    "e33_top_and_others",
    lambda s, d: E.top_and_others(cut_lineage(per_sequence(s, d)), 10),
    PER_SQL
    + """
top AS (SELECT * FROM per ORDER BY journey_occurrences DESC, PageSequence LIMIT 10),
both_parts AS (SELECT * FROM top UNION ALL SELECT 'Others', CAST((SELECT sum(journey_occurrences) FROM per) - (SELECT sum(journey_occurrences) FROM top) AS BIGINT)),
""",
    "SELECT *, journey_occurrences * 1e2 / (SELECT sum(journey_occurrences) FROM per) AS percent FROM both_parts",
)
register(
    "e34_histogram",
    lambda s, d: E.fixed_width_histogram(cut_lineage(per_sequence(s, d)), "journey_occurrences", 5, 200),
    PER_SQL,
    """SELECT bin, count(b) AS frequency, count(b) * 1e0 / (SELECT count(*) FROM per) AS share FROM (
         SELECT unnest(range(1, greatest(40, (SELECT CAST(max(ceil(journey_occurrences / 5.0)) AS BIGINT) FROM per)) + 1)) AS bin)
       LEFT JOIN (SELECT CAST(ceil(journey_occurrences / 5.0) AS BIGINT) AS b FROM per) ON b = bin
       GROUP BY bin HAVING bin <= 40 OR count(b) > 0""",
)
register(
    "e35_one_off_shares",
    lambda s, d: E.one_off_shares(per_sequence(s, d)),
    PER_SQL,
    """SELECT o AS one_offs, n - o AS not_one_offs, round(o * 1e2 / n, 0) AS percent_one_off, round((n - o) * 1e2 / n, 0) AS percent_not_one_off
       FROM (SELECT count(*) FILTER (journey_occurrences = 1) AS o, count(*) AS n FROM per)""",
)
register(
    "e35_rare_shares",
    lambda s, d: E.rare_shares(cut_lineage(per_sequence(s, d))),
    PER_SQL,
    """SELECT journey_occurrences, count(*) AS n, count(*) * 1e0 / (SELECT count(*) FROM per WHERE journey_occurrences <= 10) AS share
       FROM per WHERE journey_occurrences <= 10 GROUP BY ALL""",
)


def link_sequences(spark, sf):
    return link_visits(spark, sf).select(F.col("page").alias("PageSequence"), F.col("visits").alias("journey_occurrences"))


LINK_PER_SQL = LINK_VISITS_SQL + "per AS (SELECT page AS PageSequence, visits AS journey_occurrences FROM visits),\n"
JUNK = [(name, f"regexp_matches(PageSequence, '{pattern}')") for name, pattern in E.JUNK_PATTERNS.items()]
CLEAN_SQL = f"NOT ({' OR '.join(c for _, c in JUNK)}) AND regexp_matches(PageSequence, '{E.CLEAN_PATTERN}')"
register(
    "e36_drop_junk",
    lambda s, d: E.drop_junk(link_sequences(s, d)),
    LINK_PER_SQL,
    f"SELECT * FROM per WHERE {CLEAN_SQL}",
)
register(
    "e36_junk_counts",
    lambda s, d: E.junk_counts(link_sequences(s, d)),
    LINK_PER_SQL,
    "SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in JUNK) + f", count(*) FILTER ({CLEAN_SQL}) AS kept FROM per",
)
# Every leading pattern, sequences that fit none and those that are not clean, dealt over all parts.
LEADS = ["/ x", "/-x", "/:x", "/?x", "/name", "/_x", "name", "/9"]
BUILT_SQL = f"""
per AS (SELECT ({LEADS!r})[CAST(p_partkey % {len(LEADS)} AS INTEGER) + 1] || p_partkey AS PageSequence, p_size AS journey_occurrences FROM part),
"""


def built_sequences(spark, sf):
    lead = F.element_at(F.array(*[F.lit(x) for x in LEADS]), (F.col("p_partkey") % len(LEADS)).cast("int") + 1)
    return I.table(spark, sf, "part").select(
        F.concat(lead, F.col("p_partkey").cast("string")).alias("PageSequence"), F.col("p_size").alias("journey_occurrences")
    )


register(
    "e36_drop_every_junk",
    lambda s, d: E.drop_junk(built_sequences(s, d)),
    BUILT_SQL,
    f"SELECT * FROM per WHERE {CLEAN_SQL}",
)
register(
    "e36_every_junk_counts",
    lambda s, d: E.junk_counts(built_sequences(s, d)),
    BUILT_SQL,
    "SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in JUNK) + f", count(*) FILTER ({CLEAN_SQL}) AS kept FROM per",
)
TYPED_SQL = PER_SQL + """
typed AS (SELECT *, len(string_split(PageSequence, '>>')) AS journey_length, CASE WHEN journey_occurrences = 1 THEN 'one-off' ELSE 'not-one-off' END AS pageseq_type FROM per),
bucketed AS (SELECT *, CASE WHEN journey_length < 11 THEN CAST(journey_length AS VARCHAR) WHEN journey_length < 101 THEN '11<=x<100'
             WHEN journey_length < 500 THEN '101<=x<500' ELSE 'x>=500' END AS journey_length_type FROM typed),
"""


def typed(spark, sf):
    return E.with_length_and_type(per_sequence(spark, sf))


register(
    "e37_length_and_type",
    lambda s, d: typed(s, d).withColumn("journey_length", F.col("journey_length").cast("bigint")),
    TYPED_SQL,
    "SELECT * FROM typed",
)


def e37_summary(spark, sf):
    from wayfare.operators.describe import describe_segments

    kind = F.col("pageseq_type")
    return describe_segments(
        typed(spark, sf).withColumn("one", F.lit(1)),
        "journey_length",
        {name: (kind == name, "one") for name in ("one-off", "not-one-off")},
    )


register(
    "e37_length_summary",
    e37_summary,
    describe_sql(TYPED_SQL + "seg AS (SELECT pageseq_type AS segment, journey_length AS value, 1 AS n FROM typed),\n"),
    f"SELECT segment, {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
)


def e38(spark, sf):
    """Texts stand in for long journeys: their words are the pages."""
    words = F.size(F.split("text", " "))
    return I.table(spark, sf, "documents").groupBy(E.length_bucket(words).alias("bucket")).agg(F.count("*").alias("n"))


register(
    "e38_length_buckets",
    e38,
    None,
    """SELECT CASE WHEN w < 11 THEN CAST(w AS VARCHAR) WHEN w < 101 THEN '11<=x<100' WHEN w < 500 THEN '101<=x<500' ELSE 'x>=500' END AS bucket,
       count(*) AS n FROM (SELECT len(string_split(text, ' ')) AS w FROM documents) GROUP BY ALL""",
)


def bucket_sql(*keys):
    names = ", ".join(keys)
    return f"""SELECT {names}, CAST(sum(journey_occurrences) AS BIGINT) AS journey_occurrences,
        CAST(sum(journey_occurrences) AS BIGINT) * 1e0 / (SELECT CAST(sum(journey_occurrences) AS DOUBLE) FROM bucketed) AS share FROM bucketed GROUP BY {names}"""


register(
    "e39_occurrences_by_bucket",
    lambda s, d: E.occurrences_by_bucket(cut_lineage(typed(s, d))),
    TYPED_SQL,
    bucket_sql("journey_length_type"),
)
register(
    "e40_occurrences_by_bucket_and_type",
    lambda s, d: E.occurrences_by_bucket(cut_lineage(typed(s, d)), by_type=True),
    TYPED_SQL,
    bucket_sql("journey_length_type", "pageseq_type"),
)


def delooped(spark, sf):
    sequences = E.sessions_per_sequence(I.parsed(spark, sf).where("Page_Seq_NL <> ''"), "Page_Seq_NL")
    return cut_lineage(E.with_length_and_type(sequences))


NL_SQL = TYPED_SQL.replace(I.JOURNEYS_SQL, I.PARSED_SQL).replace(
    "SELECT PageSequence, CAST(sum(Occurrences) AS BIGINT) AS journey_occurrences FROM journeys WHERE PageSequence IS NOT NULL",
    "SELECT seq_nl AS PageSequence, CAST(sum(Occurrences) AS BIGINT) AS journey_occurrences FROM parsed WHERE seq_nl <> ''",
)
register(
    "e41_delooped_buckets",
    lambda s, d: E.occurrences_by_bucket(delooped(s, d), by_type=True),
    NL_SQL,
    bucket_sql("journey_length_type", "pageseq_type"),
)
register(
    "e41_delooped_top_and_others",
    lambda s, d: E.top_and_others(delooped(s, d).select("PageSequence", "journey_occurrences"), 10),
    NL_SQL
    + """
top AS (SELECT PageSequence, journey_occurrences FROM per ORDER BY journey_occurrences DESC, PageSequence LIMIT 10),
both_parts AS (SELECT * FROM top UNION ALL SELECT 'Others', CAST((SELECT sum(journey_occurrences) FROM per) - (SELECT sum(journey_occurrences) FROM top) AS BIGINT)),
""",
    "SELECT *, journey_occurrences * 1e2 / (SELECT sum(journey_occurrences) FROM per) AS percent FROM both_parts",
)
register(
    "e42_by_occurrences",
    lambda s, d: E.by_occurrences(I.event_journeys(s, d)).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    "SELECT Sequence, Occurrences FROM journeys ORDER BY Occurrences DESC, Sequence",
)

