"""Journeys that a page of interest disrupts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare.operators import disruption as D

PAGE = "/p1"


def marked(spark, sf):
    return D.mark(I.parsed(spark, sf), PAGE)


def as_text(array):
    return F.array_join(F.transform(array, lambda v: v.cast("string")), ",")


MARKED = I.PARSED_SQL + f"""
marked AS (
  SELECT *, list_contains(pl, '{PAGE}') AS has, coalesce(pl[-1] = '{PAGE}', false) AS ends,
    list_filter(range(1, len(pl) + 1), lambda i: pl[i] = '{PAGE}') AS pos FROM parsed
),
"""


def flagged_sql(exits: bool, wrap: bool = True) -> str:
    """Positions count from 1; with exits the list that is looked up ends in /exit."""
    pages = "list_append(pl, '/exit')" if exits else "pl"
    first = f"({pages})[-1]" if wrap else "NULL"
    return MARKED + f"""
flagged AS (
  SELECT *, list_transform(pos, lambda i: (CASE WHEN i = 1 THEN {first} ELSE pl[i - 1] END) IS DISTINCT FROM ({pages})[i + 1]) AS dis
  FROM marked WHERE has {'' if exits else 'AND NOT ends'}
),
"""


register(
    "j1_drop_length_one",
    lambda s, d: D.drop_length_one(I.parsed(s, d)).select("Sequence", "Occurrences"),
    MARKED,
    "SELECT Sequence, Occurrences FROM marked WHERE len(pl) <> 1",
)
register(
    "j2_contains_page",
    lambda s, d: marked(s, d).select("Sequence", "contains_page"),
    MARKED,
    "SELECT Sequence, has AS contains_page FROM marked",
)
register(
    "j2_touching_shares",
    lambda s, d: D.touching_shares(marked(s, d)),
    MARKED,
    """SELECT count(*) FILTER (has) AS types_with, count(*) AS types, CAST(sum(Occurrences) FILTER (has) AS BIGINT) AS sessions_with,
       CAST(sum(Occurrences) AS BIGINT) AS sessions, CAST(count(*) FILTER (has) AS DOUBLE) / count(*) AS share_types,
       CAST(sum(Occurrences) FILTER (has) AS DOUBLE) / sum(Occurrences) AS share_sessions FROM marked""",
)
register(
    "j3_positions",
    lambda s, d: marked(s, d).select("Sequence", as_text("positions").alias("positions")),
    MARKED,
    "SELECT Sequence, array_to_string(list_transform(pos, lambda i: CAST(i - 1 AS VARCHAR)), ',') AS positions FROM marked",
)
register(
    "j4_exit_flags",
    lambda s, d: marked(s, d).select("Sequence", "exits_on_page"),
    MARKED,
    "SELECT Sequence, ends AS exits_on_page FROM marked",
)
register(
    "j4_exit_shares",
    lambda s, d: D.exit_shares(marked(s, d)),
    MARKED,
    """SELECT count(*) FILTER (ends) AS types_exit, count(*) AS types, CAST(sum(Occurrences) FILTER (ends) AS BIGINT) AS sessions_exit,
       CAST(sum(Occurrences) AS BIGINT) AS sessions, CAST(count(*) FILTER (ends) AS DOUBLE) / count(*) AS share_types,
       CAST(sum(Occurrences) FILTER (ends) AS DOUBLE) / sum(Occurrences) AS share_sessions FROM marked WHERE has""",
)
DIS_TEXT = "array_to_string(list_transform(dis, lambda x: CAST(x AS VARCHAR)), ',')"
for suffix, options in (
    ("", {}),
    ("_without_wrap", {"wrap": False}),
    ("_with_exits", {"count_exits": True}),
):
    prefix = flagged_sql(options.get("count_exits", False), options.get("wrap", True))
    number = "j9" if options.get("count_exits") else "j5"

    def flagged(s, d, options=options):
        return D.with_disruptions(I.parsed(s, d), PAGE, **options)

    register(
        f"{number}_disruptions{suffix}",
        lambda s, d, f=flagged: f(s, d).select("Sequence", as_text("disrupted").alias("disrupted")),
        prefix,
        f"SELECT Sequence, {DIS_TEXT} AS disrupted FROM flagged",
    )
    if suffix == "_without_wrap":
        continue
    names = ("j9", "j9", "j9") if options else ("j6", "j7", "j8")
    register(
        f"{names[0]}_patterns{suffix}",
        lambda s, d, f=flagged: D.pattern_frequencies(f(s, d)).withColumn("disrupted", as_text("disrupted")),
        prefix,
        f"SELECT {DIS_TEXT} AS disrupted, count(*) AS n FROM flagged GROUP BY ALL",
    )
    register(
        f"{names[1]}_totals{suffix}",
        lambda s, d, f=flagged: D.disruption_totals(f(s, d)),
        prefix,
        """SELECT CAST(sum(len(list_filter(dis, lambda x: x))) AS BIGINT) AS disruptions,
           CAST(sum(len(list_filter(dis, lambda x: NOT x))) AS BIGINT) AS non_disruptions, count(*) AS types FROM flagged""",
    )
    register(
        f"{names[2]}_disrupted_share{suffix}",
        lambda s, d, f=flagged: D.disrupted_share(f(s, d)),
        prefix,
        """SELECT CAST(sum(Occurrences) FILTER (list_contains(dis, true)) AS BIGINT) AS sessions_disrupted,
           CAST(sum(Occurrences) FILTER (NOT list_contains(dis, true)) AS BIGINT) AS sessions_undisrupted, CAST(sum(Occurrences) AS BIGINT) AS sessions,
           CAST(sum(Occurrences) FILTER (list_contains(dis, true)) AS DOUBLE) / sum(Occurrences) AS share FROM flagged""",
    )
