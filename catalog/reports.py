"""Device and related-link reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.extract import io15, io15_lengths
from catalog.registry import register
from wayfare.functions import features
from wayfare.operators import report as R


def devices():
    return F.col("DeviceCategories")


def journeys(spark, sf):
    return I.event_journeys(spark, sf, I.MULTISETS)


def prepared(spark, sf):
    return R.prepare(I.event_journeys(spark, sf, {"DeviceCategories": "deviceCategory"}))


BASE_SQL = I.JOURNEYS_SQL + """
devices AS (
  SELECT Sequence, count(*) FILTER (deviceCategory = 'desktop') AS d, count(*) FILTER (deviceCategory = 'mobile') AS m,
         count(*) FILTER (deviceCategory = 'tablet') AS t FROM sessions WHERE Sequence IS NOT NULL GROUP BY ALL
),
rep AS (
  SELECT j.Sequence, PageSeq_Length, Occurrences, d, m, t, Occurrences - t AS occ,
         contains(Sequence, 'relatedLinkClicked') AND contains(Sequence, 'Related content') AS rel
  FROM journeys j JOIN devices USING (Sequence)
),
"""
VOLUMES_SQL = """
vol AS (
  SELECT CAST(sum(occ) AS BIGINT) AS a, CAST(sum(occ) FILTER (rel) AS BIGINT) AS ar, CAST(sum(d) AS BIGINT) AS d, CAST(sum(d) FILTER (rel) AS BIGINT) AS dr,
         CAST(sum(m) AS BIGINT) AS m, CAST(sum(m) FILTER (rel) AS BIGINT) AS mr, count(*) AS na, count(*) FILTER (rel) AS nar,
         count(*) FILTER (d > 0) AS nd, count(*) FILTER (d > 0 AND rel) AS ndr, count(*) FILTER (m > 0) AS nm, count(*) FILTER (m > 0 AND rel) AS nmr FROM rep
),
"""


def row(name, sql_body, build, prefix=BASE_SQL):
    register(name, build, prefix, sql_body)


row(
    "d1_device_count",
    "SELECT Sequence, t AS n FROM rep",
    lambda s, d: journeys(s, d).select("Sequence", features.multiset_count(devices(), "tablet").alias("n")),
)
row(
    "d2_device_columns",
    "SELECT Sequence, d AS DesktopCount, m AS MobileCount, t AS TabletCount FROM rep",
    lambda s, d: R.add_device_columns(journeys(s, d)).select("Sequence", *R.DEVICE_COLUMNS),
)
row(
    "d3_remove_tablets",
    "SELECT Sequence, occ AS Occurrences FROM rep WHERE occ <> 0",
    lambda s, d: R.remove_tablets(R.add_device_columns(journeys(s, d)), drop_empty=True).select(
        "Sequence", "Occurrences"
    ),
)
row(
    "d4_mentions_related",
    "SELECT Sequence, rel AS Has_Related FROM rep",
    lambda s, d: R.add_related_flag(I.event_journeys(s, d)).select("Sequence", "Has_Related"),
)
NAV = " OR ".join(f"contains(Sequence, '{name}')" for name in features.C.NAVIGATION_CATEGORIES)
row(
    "d5_mentions_navigation",
    f"SELECT Sequence, {NAV} AS has_nav FROM rep",
    lambda s, d: I.event_journeys(s, d).select(
        "Sequence", features.mentions_navigation(F.col("Sequence")).alias("has_nav")
    ),
)
row(
    "d6_mentions_navigation_pair",
    "SELECT Sequence, contains(Sequence, 'relatedLinkClicked') AND contains(Sequence, 'Explore the topic') AS has_nav FROM rep",
    lambda s, d: I.event_journeys(s, d).select(
        "Sequence", features.mentions_navigation_pair(F.col("Sequence")).alias("has_nav")
    ),
)
VOLUME_COLUMNS = 'a AS "all", ar AS all_related, na AS all_rows, nar AS all_related_rows, d AS desktop, dr AS desktop_related, nd AS desktop_rows, ndr AS desktop_related_rows, m AS mobile, mr AS mobile_related, nm AS mobile_rows, nmr AS mobile_related_rows'
row("d7_volumes", f"SELECT {VOLUME_COLUMNS} FROM vol", lambda s, d: R.volumes(prepared(s, d)), BASE_SQL + VOLUMES_SQL)
row(
    "d8_percentages",
    """SELECT round(d * 1e2 / a, 2) AS percent_desktop, round(m * 1e2 / a, 2) AS percent_mobile, round(ar * 1e2 / a, 2) AS percent_related,
       round(dr * 1e2 / d, 2) AS percent_desktop_related, round(mr * 1e2 / m, 2) AS percent_mobile_related FROM vol""",
    lambda s, d: R.device_shares(prepared(s, d)),
    BASE_SQL + VOLUMES_SQL,
)
REPORT_SQL = """SELECT 'All' AS Segment, a AS Volume, CAST(100 AS DOUBLE) AS Percentage, na AS Shape FROM vol
       UNION ALL SELECT 'All_related', ar, round(ar * 1e2 / a, 2), nar FROM vol UNION ALL SELECT 'Desktop', d, round(d * 1e2 / a, 2), nd FROM vol
       UNION ALL SELECT 'Desktop_rel', dr, round(dr * 1e2 / d, 2), ndr FROM vol UNION ALL SELECT 'Mobile', m, round(m * 1e2 / a, 2), nm FROM vol
       UNION ALL SELECT 'Mobile_rel', mr, round(mr * 1e2 / m, 2), nmr FROM vol"""
row("d9_device_report", REPORT_SQL, lambda s, d: R.device_report(prepared(s, d)), BASE_SQL + VOLUMES_SQL)
row("io15_write_report", REPORT_SQL, io15, BASE_SQL + VOLUMES_SQL)

CELLS_SQL = VOLUMES_SQL + """
ct AS (SELECT CAST(mr AS DOUBLE) AS a, CAST(m - mr AS DOUBLE) AS b, CAST(dr AS DOUBLE) AS c, CAST(d - dr AS DOUBLE) AS d FROM vol),
cells AS (
  SELECT a AS o, (a + b) * (a + c) / (a + b + c + d) AS e FROM ct UNION ALL SELECT b, (a + b) * (b + d) / (a + b + c + d) FROM ct
  UNION ALL SELECT c, (c + d) * (a + c) / (a + b + c + d) FROM ct UNION ALL SELECT d, (c + d) * (b + d) / (a + b + c + d) FROM ct
),
corrected AS (SELECT o + least(0.5, abs(e - o)) * sign(e - o) AS o, e FROM cells),
"""
TEST_SQL = """SELECT mr AS mobile_related, m - mr AS mobile_not_related, dr AS desktop_related, d - dr AS desktop_not_related,
       round((SELECT {} FROM corrected), 6) AS statistic, 1 AS degrees_of_freedom FROM vol"""
# Twice the normal density from the root of the statistic on, by Simpson's rule over 14 units.
TAIL_SQL = """
tail AS (
  SELECT round(2 * sum(exp(-(z + k * 0.0035) * (z + k * 0.0035) / 2) * CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
    * 0.0035 / 3 / sqrt(2 * pi()), 9) AS p_value
  FROM (SELECT CAST(z AS DOUBLE) AS z, CAST(unnest(range(4001)) AS DOUBLE) AS k FROM scores)
),
"""
P_VALUE_SQL = """SELECT mr AS mobile_related, m - mr AS mobile_not_related, dr AS desktop_related, d - dr AS desktop_not_related,
       round(z * z, 6) AS statistic, 1 AS degrees_of_freedom, p_value FROM vol, scores, tail"""
row(
    "d10_chi2_statistic",
    TEST_SQL.format("sum((o - e) * (o - e) / e)"),
    lambda s, d: R.chi2_test(prepared(s, d)).withColumn("statistic", F.round("statistic", 6)),
    BASE_SQL + CELLS_SQL,
)
row(
    "d10_chi2_test",
    P_VALUE_SQL,
    lambda s, d: R.with_p_value(R.chi2_test(prepared(s, d))).withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 9)}
    ),
    BASE_SQL + CELLS_SQL + "scores AS (SELECT sqrt(sum((o - e) * (o - e) / e)) AS z FROM corrected),\n" + TAIL_SQL,
)
row(
    "d11_g_statistic",
    TEST_SQL.format("2 * sum(CASE WHEN o = 0 THEN 0 ELSE o * ln(o / e) END)"),
    lambda s, d: R.g_test(prepared(s, d)).withColumn("statistic", F.round("statistic", 6)),
    BASE_SQL + CELLS_SQL,
)
row(
    "d11_g_test",
    P_VALUE_SQL,
    lambda s, d: R.with_p_value(R.g_test(prepared(s, d))).withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 9)}
    ),
    BASE_SQL + CELLS_SQL + "scores AS (SELECT sqrt(2 * sum(CASE WHEN o = 0 THEN 0 ELSE o * ln(o / e) END)) AS z FROM corrected),\n" + TAIL_SQL,
)
row(
    "d12_length_distribution",
    "SELECT PageSeq_Length, CAST(sum(occ) AS BIGINT) AS n FROM rep GROUP BY ALL",
    lambda s, d: R.length_distribution(prepared(s, d)),
)


def describe_sql(source: str) -> str:
    """Expands ``seg(segment, value, n)`` and describes it."""
    return source + """
hist AS (SELECT segment, value, CAST(sum(n) AS BIGINT) AS n FROM seg GROUP BY ALL HAVING sum(n) > 0),
expanded AS (SELECT segment, CAST(value AS DOUBLE) AS x, unnest(range(n)) AS i FROM hist),
"""


DESCRIBE_COLUMNS = """CAST(count(*) AS DOUBLE) AS "count", round(sum(x) / CAST(count(*) AS DOUBLE), 3) AS mean,
       round(sqrt(greatest(CASE WHEN count(*) > 1 THEN (sum(x * x) - sum(x) * sum(x) / CAST(count(*) AS DOUBLE)) / (CAST(count(*) AS DOUBLE) - 1) END, 0)), 3) AS std,
       min(x) AS "min", round(quantile_cont(x, 0.25), 3) AS "25%", round(quantile_cont(x, 0.5), 3) AS "50%", round(quantile_cont(x, 0.75), 3) AS "75%", max(x) AS "max" """
SEGMENTS_SQL = BASE_SQL + """
seg AS (
  SELECT 'All_Journeys' AS segment, PageSeq_Length AS value, occ AS n FROM rep UNION ALL SELECT 'All_Desktop', PageSeq_Length, d FROM rep
  UNION ALL SELECT 'All_Mobile', PageSeq_Length, m FROM rep UNION ALL SELECT 'Journeys_Related', PageSeq_Length, occ FROM rep WHERE rel
  UNION ALL SELECT 'Desktop_Related', PageSeq_Length, d FROM rep WHERE rel UNION ALL SELECT 'Mobile_Related', PageSeq_Length, m FROM rep WHERE rel
),
"""
row(
    "d13_describe_lengths",
    f"SELECT segment, {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
    lambda s, d: R.describe_lengths(prepared(s, d)),
    describe_sql(SEGMENTS_SQL),
)
row(
    "io15_write_lengths",
    f"SELECT segment, {DESCRIBE_COLUMNS} FROM expanded GROUP BY segment",
    io15_lengths,
    describe_sql(SEGMENTS_SQL),
)
LONGER_SQL = BASE_SQL.replace("FROM journeys j JOIN devices USING (Sequence)", "FROM journeys j JOIN devices USING (Sequence) WHERE PageSeq_Length > 1")
row(
    "d14_report_without_length_one",
    REPORT_SQL,
    lambda s, d: R.device_report(R.without_length_one(prepared(s, d))),
    LONGER_SQL + VOLUMES_SQL,
)
row(
    "d15_category_totals",
    "SELECT category, count(*) AS n FROM (SELECT unnest(el, recursive := true) FROM parsed) GROUP BY ALL",
    lambda s, d: R.category_totals(I.parsed(s, d)),
    I.PARSED_SQL,
)
row(
    "d16_device_totals",
    "SELECT device, CAST(sum(n) AS BIGINT) AS n FROM seq_devices GROUP BY ALL",
    lambda s, d: R.device_totals(journeys(s, d)),
)
row(
    "d17_device_ratio",
    """SELECT Sequence, CASE WHEN m = 0 THEN -1 ELSE CAST(d AS DOUBLE) / CAST(m AS DOUBLE) END AS ratio, d * 1e2 / (d + m + t) AS percent_desktop FROM rep""",
    lambda s, d: journeys(s, d).select(
        "Sequence", R.device_ratio(devices()).alias("ratio"), R.percent_desktop(devices()).alias("percent_desktop")
    ),
)
row(
    "d18_most_used_device",
    "SELECT Sequence, d >= m AND d >= t AS more_desktop, m > d AND m >= t AS more_mobile FROM rep",
    lambda s, d: journeys(s, d).select(
        "Sequence",
        R.most_used_device_is(devices(), "desktop").alias("more_desktop"),
        R.most_used_device_is(devices(), "mobile").alias("more_mobile"),
    ),
)
CLICKS = "len(list_filter(el, lambda e: contains(e.action, 'Related content')))"
row(
    "d19_occurrences_by_clicks",
    f"SELECT {CLICKS} AS num_rel_cont, CAST(sum(Occurrences) AS BIGINT) AS Occurrences FROM parsed GROUP BY ALL",
    lambda s, d: R.occurrences_by_clicks(I.parsed(s, d)),
    I.PARSED_SQL,
)
DEVICES_CTE = BASE_SQL[len(I.JOURNEYS_SQL) :]
row(
    "d20_clicks_by_desktop_share",
    f"""SELECT d * 1e2 / (d + m + t) AS percent_desktop, round(avg({CLICKS}), 3) AS mean_clicks
        FROM parsed JOIN devices USING (Sequence) GROUP BY ALL""",
    lambda s, d: R.clicks_by_desktop_share(I.parsed(s, d, I.MULTISETS)),
    I.PARSED_SQL + DEVICES_CTE,
)
RELATED = "contains(Sequence, 'relatedLinkClicked')"
row(
    "d21_one_off_share",
    f"""SELECT count(*) FILTER (seq_occ = 1) AS one_offs, count(*) AS journeys, round(count(*) FILTER (seq_occ = 1) * 1e2 / count(*), 4) AS percent
        FROM parsed WHERE {RELATED}""",
    lambda s, d: R.one_off_share(
        I.with_totals(s, d).where(F.col("Sequence").contains("relatedLinkClicked"))
    ),
    I.PARSED_SQL,
)
row(
    "d22_related_content_share",
    f"""SELECT count(*) FILTER (contains(Sequence, 'Related content')) AS related_content, count(*) AS journeys,
        round(count(*) FILTER (contains(Sequence, 'Related content')) * 1e2 / count(*), 2) AS percent FROM journeys WHERE {RELATED}""",
    lambda s, d: R.related_content_share(
        I.event_journeys(s, d).where(F.col("Sequence").contains("relatedLinkClicked"))
    ),
)
