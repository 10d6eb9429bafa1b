"""Comparison of two page variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare.functions import features
from wayfare.functions.statistics import normal_quantile
from wayfare.operators import abtest as A
from wayfare.session import cut_lineage

KEYS = ("Sequence", "ABVariant")
AB = I.AB_PARSED_SQL


def clicked(spark, sf):
    return A.add_related_clicks(A.keep_variants(I.ab_journeys(spark, sf)))


def counted(spark, sf):
    """Clicks, navigation events and searches of each journey and variant."""
    journeys = cut_lineage(clicked(spark, sf))
    return A.content_page_counts(journeys, I.page_types(spark, sf), KEYS)


CLICKS_SQL = AB + """
ab AS (
  SELECT *, len(list_filter(el, lambda e: e.category = 'relatedLinkClicked' AND contains(e.action, 'Related content'))) AS clicks FROM parsed
),
"""
COUNTS_SQL = CLICKS_SQL + I.PAGE_TYPES_SQL + """
nav AS (
  SELECT Sequence, ABVariant, count(*) AS n FROM (SELECT Sequence, ABVariant, unnest(pel, recursive := true) FROM parsed)
  JOIN page_types ON page = pagePath AND is_finding = 0
  WHERE contains(event, 'breadcrumbClicked') OR contains(event, 'homeLinkClicked') OR (contains(event, 'relatedLinkClicked') AND contains(event, 'Explore the topic'))
  GROUP BY ALL
),
sea AS (
  SELECT Sequence, ABVariant, count(*) AS n FROM (SELECT Sequence, ABVariant, pl[i] AS src, pl[i + 1] AS dst
    FROM (SELECT Sequence, ABVariant, pl, unnest(range(1, len(pl))) AS i FROM parsed))
  JOIN page_types ON src = pagePath AND is_finding = 0 WHERE contains(dst, '/search?q=') GROUP BY ALL
),
counts AS (
  SELECT ab.*, coalesce(nav.n, 0) AS navs, coalesce(sea.n, 0) AS searches, (coalesce(nav.n, 0) + coalesce(sea.n, 0) + 1) / CAST(clicks * Occurrences + 1 AS DOUBLE) AS ratio
  FROM ab LEFT JOIN nav USING (Sequence, ABVariant) LEFT JOIN sea USING (Sequence, ABVariant)
),
"""
register(
    "a1_keep_variants",
    lambda s, d: A.keep_variants(I.ab_journeys(s, d)).select(*KEYS, "Occurrences"),
    AB,
    "SELECT Sequence, ABVariant, Occurrences FROM journeys WHERE ABVariant IN ('A', 'B')",
)
register(
    "a2_related_clicks",
    lambda s, d: clicked(s, d).select(*KEYS, "Related_Clicks"),
    CLICKS_SQL,
    "SELECT Sequence, ABVariant, clicks AS Related_Clicks FROM ab",
)
register(
    "a3_click_flags",
    lambda s, d: clicked(s, d).select(*KEYS, "Has_Related", "Related_Clicks_Total"),
    CLICKS_SQL,
    "SELECT Sequence, ABVariant, clicks > 0 AS Has_Related, clicks * Occurrences AS Related_Clicks_Total FROM ab",
)


def event_text():
    return F.concat_ws("<:<", "type", "eventCategory", "eventAction")


register(
    "a4_navigation_event",
    lambda s, d: I.event_hits(s, d).select(
        F.col("hitOrder.event_id").alias("event_id"), features.is_navigation_event(event_text()).alias("is_nav")
    ),
    I.HITS_SQL,
    """SELECT event_id, coalesce(eventCategory = 'breadcrumbClicked' OR (eventCategory = 'relatedLinkClicked' AND contains(eventAction, 'Explore the topic')), false) AS is_nav FROM hits""",
)
register(
    "a5_navigation_from_content",
    lambda s, d: counted(s, d).select(*KEYS, "Content_Page_Nav_Event_Count"),
    COUNTS_SQL,
    "SELECT Sequence, ABVariant, navs AS Content_Page_Nav_Event_Count FROM counts",
)
register(
    "a6_searches_from_content",
    lambda s, d: counted(s, d).select(*KEYS, "Content_Search_Event_Count"),
    COUNTS_SQL,
    "SELECT Sequence, ABVariant, searches AS Content_Search_Event_Count FROM counts",
)
register(
    "a7_ratio",
    lambda s, d: A.add_ratio(counted(s, d)).select(*KEYS, "Ratio_Nav_Search_to_Rel"),
    COUNTS_SQL,
    "SELECT Sequence, ABVariant, ratio AS Ratio_Nav_Search_to_Rel FROM counts",
)
register(
    "a8_any_navigation",
    lambda s, d: I.ab_journeys(s, d).select(
        *KEYS, features.any_navigation_event(F.col("Event_cat_act_agg")).alias("any_nav")
    ),
    AB,
    """SELECT Sequence, ABVariant, len(list_filter(el, lambda e: e.category IN ('breadcrumbClicked', 'homeLinkClicked')
       OR (e.category = 'relatedLinkClicked' AND contains(e.action, 'Explore the topic')))) > 0 AS any_nav FROM parsed""",
)
register(
    "a9_any_finding_page",
    lambda s, d: A.any_finding_page(cut_lineage(I.ab_journeys(s, d)), I.page_types(s, d), KEYS).select(
        *KEYS, "Any_Finding"
    ),
    AB + I.PAGE_TYPES_SQL,
    """SELECT Sequence, ABVariant, len(list_intersect(pl, (SELECT list(pagePath) FROM page_types WHERE is_finding = 1))) > 0 AS Any_Finding FROM parsed""",
)
RATE_SQL = "SELECT ABVariant, CAST(coalesce(sum(Occurrences) FILTER ({0}), 0) AS BIGINT) AS x, CAST(sum(Occurrences) AS BIGINT) AS n FROM counts GROUP BY ALL"
RATES_SQL = COUNTS_SQL + f"rates AS ({RATE_SQL.format('clicks > 0')}),\n"
NO_NAV_SQL = COUNTS_SQL + f"rates AS ({RATE_SQL.format('navs = 0')}),\n"


def click_rates(spark, sf):
    return A.rates(clicked(spark, sf), F.col("Has_Related"))


def no_nav_rates(spark, sf):
    return A.rates(counted(spark, sf), F.col("Content_Page_Nav_Event_Count") == 0)


P = "SELECT ABVariant, x, n, CAST(x AS DOUBLE) / n AS p FROM rates"
register("a10_click_rates", click_rates, RATES_SQL, P)
register("a10_no_navigation_rates", no_nav_rates, NO_NAV_SQL, P)
register(
    "a10_overall_rate",
    lambda s, d: A.overall_rate(clicked(s, d), F.col("Has_Related")),
    RATES_SQL,
    "SELECT CAST(sum(x) AS BIGINT) AS x, CAST(sum(n) AS BIGINT) AS n, CAST(sum(x) AS DOUBLE) / sum(n) AS p FROM rates",
)
PAIR_SQL = """
pair AS (SELECT CAST(sum(x) FILTER (ABVariant = 'A') AS DOUBLE) AS xa, CAST(sum(n) FILTER (ABVariant = 'A') AS DOUBLE) AS na,
                CAST(sum(x) FILTER (ABVariant = 'B') AS DOUBLE) AS xb, CAST(sum(n) FILTER (ABVariant = 'B') AS DOUBLE) AS nb FROM rates),
pooled AS (SELECT *, (xa + xb) / (na + nb) AS p, xa / na AS pa, xb / nb AS pb FROM pair),
"""
register(
    "a11_sample_size_checks",
    lambda s, d: A.sample_size_checks(click_rates(s, d)),
    RATES_SQL + PAIR_SQL,
    "SELECT na * p >= 5 AS a_with_ok, na * (1 - p) >= 5 AS a_without_ok, nb * p >= 5 AS b_with_ok, nb * (1 - p) >= 5 AS b_without_ok FROM pooled",
)
register(
    "a12_z_statistic",
    lambda s, d: A.z_test(click_rates(s, d)).withColumn("z", F.round("z", 8)),
    RATES_SQL + PAIR_SQL,
    "SELECT xa AS x_a, na AS n_a, xb AS x_b, nb AS n_b, round((pa - pb) / sqrt(p * (1 - p) * (1 / na + 1 / nb)), 8) AS z FROM pooled",
)
# Twice the normal density from |z| on, by Simpson's rule over 14 units.
TAIL_SQL = """
tail AS (
  SELECT round(2 * sum(exp(-(z + k * 0.0035) * (z + k * 0.0035) / 2) * CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
    * 0.0035 / 3 / sqrt(2 * pi()), 9) AS p_value
  FROM (SELECT abs(CAST(z AS DOUBLE)) AS z, CAST(unnest(range(4001)) AS DOUBLE) AS k FROM scores)
),
"""
register(
    "a12_z_test",
    lambda s, d: A.with_p_value(A.z_test(no_nav_rates(s, d))).withColumns(
        {"z": F.round("z", 8), "p_value": F.round("p_value", 9)}
    ),
    NO_NAV_SQL + PAIR_SQL + "scores AS (SELECT (pa - pb) / sqrt(p * (1 - p) * (1 / na + 1 / nb)) AS z FROM pooled),\n" + TAIL_SQL,
    "SELECT xa AS x_a, na AS n_a, xb AS x_b, nb AS n_b, round(z, 8) AS z, p_value FROM pooled, scores, tail",
)
Z = normal_quantile(1 - 0.01 / 2)
SE = "sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb)"
register(
    "a13_difference_interval",
    lambda s, d: A.difference_interval(click_rates(s, d), alpha=0.01).select(
        "level",
        F.round("standard_error", 8).alias("standard_error"),
        F.round("low", 8).alias("low"),
        F.round("high", 8).alias("high"),
    ),
    RATES_SQL + PAIR_SQL,
    f"""SELECT CAST(0.99 AS DOUBLE) AS level, round({SE}, 8) AS standard_error, round(pb - pa - {Z!r} * {SE}, 8) AS low,
        round(pb - pa + {Z!r} * {SE}, 8) AS high FROM pooled""",
)


def length_bootstrap(spark, sf, replicates=10_000):
    journeys = A.keep_variants(I.ab_journeys(spark, sf)).withColumn("length", F.size("Page_List"))
    return A.bootstrap_means(journeys, "length", replicates)


register("a14_bootstrap_means", length_bootstrap)
register(
    "a14_ratio_bootstrap",
    lambda s, d: A.bootstrap_means(A.add_ratio(counted(s, d)), "Ratio_Nav_Search_to_Rel", 2000),
)
register("a15_density_intervals", lambda s, d: A.highest_density_interval(cut_lineage(length_bootstrap(s, d))))
register("a16_posterior_difference", lambda s, d: A.posterior_difference(cut_lineage(length_bootstrap(s, d))))
register(
    "a17_clicks_distribution",
    lambda s, d: A.clicks_distribution(clicked(s, d)),
    CLICKS_SQL,
    "SELECT clicks AS Related_Clicks, CAST(sum(Occurrences) AS BIGINT) AS Occurrences FROM ab GROUP BY ALL",
)
register(
    "a18_page_views",
    lambda s, d: A.page_views(I.ab_journeys(s, d)).select(*KEYS, "Page_Views"),
    AB,
    "SELECT Sequence, ABVariant, len(pl) * Occurrences AS Page_Views FROM parsed",
)
register(
    "a18_total_page_views",
    lambda s, d: A.page_views(I.ab_journeys(s, d)).agg(F.sum("Page_Views").alias("total")),
    AB,
    "SELECT CAST(sum(len(pl) * Occurrences) AS BIGINT) AS total FROM parsed",
)
register(
    "a19_journeys_with_event",
    lambda s, d: A.containing_event(I.event_journeys(s, d), "yesNoFeedbackForm", 5).select("Sequence", "Occurrences"),
    I.JOURNEYS_SQL,
    "SELECT Sequence, Occurrences FROM journeys WHERE contains(Sequence, 'yesNoFeedbackForm') ORDER BY Sequence LIMIT 5",
)
register(
    "a19_contains_search",
    lambda s, d: I.event_journeys(s, d).select("Sequence", A.contains_search(F.col("Sequence")).alias("search")),
    I.JOURNEYS_SQL,
    "SELECT Sequence, contains(Sequence, '/search?q=') AS search FROM journeys",
)
register(
    "a20_distinct_events",
    lambda s, d: A.distinct_events(I.parsed(s, d)),
    I.PARSED_SQL,
    "SELECT DISTINCT category, action FROM (SELECT unnest(el, recursive := true) FROM parsed)",
)
